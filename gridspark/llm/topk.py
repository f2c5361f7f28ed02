"""Exact top-k by inner product over a pivot-distance index.

Vectors become integers and get one more coordinate that gives all the same length; the nearest in that space
then have the largest inner products. Each vector is keyed by its nearest pivot and the ring of its distance from it; rings are
cut into blocks of a bounded number of rows. A query first searches the blocks of the ring that can lie nearest,
which gives it a score that its results must reach, and then only those rings whose distance range comes
within the radius of that score by the triangle inequality. Pivots and ring widths are fitted on ``SAMPLE``
rows with the smallest id hashes; all rows are indexed, and the result does not depend on the fit.
"""
from __future__ import annotations


import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from gridspark.llm import vectors
from gridspark.session import settle

SAMPLE, PIVOTS, RINGS = 2048, 24, 24
#: rows of a block
BLOCK = 1024
#: relative slack of distance comparisons, far above double rounding
SLACK = 1e-6


def as_integers(rows: DataFrame, scale: int, vector: str) -> DataFrame:
    """Rows (vec_id, z array<long>, norm): floor(scale * x) of every component and the sum of squares as a double."""
    z = F.transform(vector, lambda x: F.floor(F.lit(float(scale)) * x).cast("long"))
    norm = F.aggregate("z", F.lit(0.0), lambda acc, x: acc + x.cast("double") * x.cast("double"))
    return rows.withColumn("z", z).select("vec_id", "z", norm.alias("norm"))


class Index:
    """Pivots of vectors of one length, and the rings around them; small and sent to tasks whole."""

    def __init__(self, sample: np.ndarray, norms: np.ndarray, top: float):
        self.top = top
        chosen = [0]
        points = self.lifted(sample, norms)
        far = ((points - points[0]) ** 2).sum(axis=1)
        while len(chosen) < min(PIVOTS, len(points)) and far.max() > 0:
            chosen.append(int(far.argmax()))
            far = np.minimum(far, ((points - points[chosen[-1]]) ** 2).sum(axis=1))
        self.pivots = points[chosen]
        near = self.distances(points).min(axis=1)
        self.width = max(float(np.quantile(near, 0.98)) / (RINGS - 1), 1e-9)

    def lifted(self, v: np.ndarray, norms: np.ndarray) -> np.ndarray:
        return np.column_stack([v, np.sqrt(np.maximum(self.top - norms, 0))])

    def distances(self, points: np.ndarray) -> np.ndarray:
        """Distance of every point from every pivot."""
        square = (points**2).sum(axis=1)[:, None] + (self.pivots**2).sum(axis=1)[None, :] - 2 * points @ self.pivots.T
        return np.sqrt(np.maximum(square, 0))

    def place(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Pivot, ring and distance of each point."""
        d = self.distances(points)
        pivot = d.argmin(axis=1)
        d = d[np.arange(len(d)), pivot]
        return pivot, np.minimum((d / self.width).astype(np.int64), RINGS - 1), d


def _as_matrix(lists: list) -> np.ndarray:
    return np.array(lists, np.float64).reshape(len(lists), -1)


def _best(scores: np.ndarray, ids: np.ndarray, own: np.ndarray, floor: np.ndarray, k: int) -> tuple[list, list, list]:
    """(query place, candidate id, score) of the k largest scores of each row that reach ``floor``; ties to smaller ids."""
    out: tuple[list, list, list] = ([], [], [])
    valid = ids[None, :] != own[:, None]
    if scores.dtype == object:
        for q in range(len(own)):
            for s, v in sorted((-s, v) for s, v, ok in zip(scores[q].tolist(), ids.tolist(), valid[q].tolist(), strict=True) if ok)[:k]:
                for column, value in zip(out, (q, v, max(-(2**63), min(2**63 - 1, -s))), strict=True):
                    column.append(value)
        return out
    least = np.where(valid, scores, -np.inf)
    if least.shape[1] > k:
        floor = np.maximum(floor, np.partition(least, -k, axis=1)[:, -k])
    hit = valid & (scores >= floor[:, None])
    for q in np.flatnonzero(hit.any(axis=1)).tolist():
        at = np.flatnonzero(hit[q])
        at = at[np.lexsort((ids[at], -scores[q, at]))][:k]
        out[0].extend([q] * len(at))
        out[1].extend(ids[at].tolist())
        out[2].extend(scores[q, at].tolist())
    return out


def _exact(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Inner products; doubles are exact below 2^53, larger values go through Python integers."""
    if len(x) and len(q) and float(np.abs(q).max()) * float(np.abs(x).max()) * q.shape[1] >= 2**53:
        return np.array([[sum(int(a) * int(b) for a, b in zip(r, s, strict=True)) for s in x] for r in q], object)
    return q @ x.T


def _searched(blocks: DataFrame, asked: DataFrame, k: int) -> DataFrame:
    """Rows (query_id, vec_id, score): the best k of every (query, block), from rows (pivot, ring, sub, vec_id, z) and
    (pivot, ring, sub, query_id, z, floor). A task holds one block and streams its queries."""

    def each(batches):
        key, ids, x, pending = None, [], [], []

        def answer():
            if not pending or not ids:
                return None
            own, q = np.array([p[0] for p in pending]), _as_matrix([p[1] for p in pending])
            scores = _exact(q, _as_matrix(x))
            got = _best(scores, np.array(ids), own, np.array([p[2] for p in pending]), k)
            return pa.RecordBatch.from_arrays([pa.array(own[got[0]] if got[0] else [], pa.int64()), pa.array(got[1], pa.int64()), pa.array([int(s) for s in got[2]], pa.int64())], ["query_id", "vec_id", "score"])

        for batch in batches:
            for p, r, s, side, v, z, floor in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if (p, r, s) != key:
                    if (got := answer()) is not None:
                        yield got
                    key, ids, x, pending = (p, r, s), [], [], []
                if side == 0:
                    ids.append(v)
                    x.append(z)
                else:
                    pending.append((v, z, floor))
                    if len(pending) >= BLOCK:
                        if (got := answer()) is not None:
                            yield got
                        pending = []
        if (got := answer()) is not None:
            yield got

    a = blocks.select("pivot", "ring", "sub", F.lit(0).alias("side"), "vec_id", "z", F.lit(0.0).alias("floor"))
    b = asked.select("pivot", "ring", "sub", F.lit(1).alias("side"), F.col("query_id").alias("vec_id"), "z", "floor")
    ready = a.unionAll(b).repartition("pivot", "ring", "sub").sortWithinPartitions("pivot", "ring", "sub", "side", "vec_id")
    return ready.mapInArrow(each, "query_id long, vec_id long, score long")


def _top(found: DataFrame, k: int) -> DataFrame:
    best = W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)


def _one_length(rows: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """Top k among vectors of one length."""
    top = float(rows.agg(F.max("norm")).first()[0] or 0.0)
    sample = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE).toPandas()
    index = Index(_as_matrix(sample["z"].tolist()), sample["norm"].to_numpy(float), top)

    def place(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            pivot, ring, d = index.place(index.lifted(_as_matrix(batch.column(1).to_pylist()), np.asarray(batch.column(2))))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(pivot), pa.array(ring), pa.array(d)], ["vec_id", "z", "pivot", "ring", "d"])

    placed = settle(rows.select("vec_id", "z", "norm").mapInArrow(place, "vec_id long, z array<long>, pivot long, ring long, d double"))
    # at most PIVOTS * RINGS rows
    rings = placed.groupBy("pivot", "ring").agg(F.count(F.lit(1)).alias("n"), F.min("d").alias("low"), F.max("d").alias("high"))
    rings = rings.withColumn("tiles", F.ceil(F.col("n") / BLOCK).cast("int")).orderBy("pivot", "ring").toPandas()
    pivots, ring_of, counts, tiles, low, high = (rings[c].to_numpy() for c in ("pivot", "ring", "n", "tiles", "low", "high"))
    size = np.zeros((PIVOTS, RINGS), np.int64)
    size[pivots, ring_of] = tiles
    cut = F.create_map(*[F.lit(int(x)) for p, r, t in zip(pivots, ring_of, tiles, strict=True) for x in (p * RINGS + r, t)])
    blocks = placed.withColumn("sub", F.pmod(F.xxhash64("vec_id"), F.element_at(cut, F.col("pivot") * RINGS + F.col("ring"))).cast("long"))
    blocks = blocks.select("pivot", "ring", "sub", "vec_id", "z")

    def asks(first: bool):
        """Blocks each query has to search: those of its nearest ring, or all others within its radius."""

        def rows_(batches):
            for batch in batches:
                if not batch.num_rows:
                    continue
                z = _as_matrix(batch.column(1).to_pylist())
                norms = (z**2).sum(axis=1)
                d = index.distances(np.column_stack([z, np.zeros(len(z))]))
                away = np.maximum(np.maximum(d[:, pivots] - high[None, :], low[None, :] - d[:, pivots]), 0)
                near = np.argsort(away, axis=1, kind="stable")
                # the nearest rings that hold more than k vectors together
                enough = np.cumsum(counts[near], axis=1)
                start = np.argmax(enough > min(k, int(counts.sum()) - 1), axis=1)
                order = np.empty_like(near)
                np.put_along_axis(order, near, np.arange(near.shape[1])[None, :], axis=1)
                done = order <= start[:, None]
                floor = np.asarray(batch.column(2)) if not first else np.full(len(z), -np.inf)
                if first:
                    pick = done
                else:
                    square = norms + index.top - 2 * floor
                    slack = SLACK * (norms + index.top + 1)
                    pick = ~done & (away <= np.sqrt(np.maximum(square, 0) + slack)[:, None] + SLACK)
                q, ring = np.nonzero(pick)
                n = tiles[ring].astype(np.int64)
                q, ring = np.repeat(q, n), np.repeat(ring, n)
                sub = np.arange(len(q)) - np.repeat(np.cumsum(n) - n, n)
                yield pa.RecordBatch.from_arrays([pa.array(pivots[ring]), pa.array(ring_of[ring]), pa.array(sub), batch.column(0).take(pa.array(q)), batch.column(1).take(pa.array(q)), pa.array(floor[q])],
                                                 ["pivot", "ring", "sub", "query_id", "z", "floor"])

        return rows_

    schema = "pivot long, ring long, sub long, query_id long, z array<long>, floor double"
    near = settle(_top(_searched(blocks, queries.select("vec_id", "z", F.lit(0.0).alias("floor")).mapInArrow(asks(True), schema), k), k))
    floors = near.groupBy("query_id").agg(F.min("score").cast("double").alias("s"), F.count(F.lit(1)).alias("n"))
    bounded = queries.join(floors, F.col("vec_id") == F.col("query_id"), "left")
    floor = F.when(F.col("n") >= k, F.col("s")).otherwise(F.lit(-float("inf")))
    rest = _searched(blocks, bounded.select("vec_id", "z", floor.alias("floor")).mapInArrow(asks(False), schema), k)
    return _top(near.select("query_id", "vec_id", "score").unionAll(rest), k)


def top_k(rows: DataFrame, is_query: F.Column, k: int = 5, scale: int = 256, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """Rows (query_id, rank, vec_id, score): for each row that ``is_query`` selects, the ``k`` other rows with the largest
    integer inner products, ties to the smaller id; all others if there are fewer.

    Null and empty vectors, vectors with null or non-finite components and rows without an id take no part. Rows
    that repeat an id are one vector, the smallest of them. Components beyond 2^53 are rounded to doubles, scores beyond a long
    are cut to its range. Vectors are only compared with vectors of their length. An
    empty table gives no rows; other columns are not read.
    """
    source = rows.select(F.col(key).cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("vector"))
    fine = vectors.one_per_id(source, "vec_id", "vector").where(vectors.usable("vector"))
    whole = settle(as_integers(fine, scale, "vector").withColumn("dim", F.size("z")))
    got = None
    for dim in sorted(r.dim for r in whole.select("dim").distinct().collect()):
        mine = whole.where(F.col("dim") == dim)
        part = _one_length(mine, mine.where(is_query), k)
        got = part if got is None else got.unionAll(part)
    if got is None:
        return whole.select(F.col("vec_id").alias("query_id"), F.lit(1).alias("rank"), "vec_id", F.lit(0).cast("long").alias("score")).where("false")
    return got.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS z FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.z, c.z) AS BIGINT) AS score FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""
