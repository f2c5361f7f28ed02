"""Embedding near-duplicates by collision counting over one-dimensional projections.

Unit vectors are projected on ``PROJECTIONS`` random lines. Two vectors of cosine c are sqrt(2 - 2c) apart, so on a
Gaussian line their difference is normal with that deviation: within a window of ``WIDTH`` deviations around
the query with a known probability. A pair is verified if it collides in at least as many windows as a pair exactly at
the threshold does with probability ``RECALL``. The first line also orders the vectors: its windows, five deviations
wide, cut a label into cells, a pair can only meet in one cell or two neighbours, and cells are split into tiles of at most
``TILE`` vectors, so that a task holds two tiles however large a cell is. Links are counted and reduced to a
spanning forest inside the task; pairs are never rows.
"""
from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridspark.llm import tiles, vectors
from gridspark.llm.graph import components
from gridspark.session import settle

PROJECTIONS, WIDTH, CELL_WIDTH = 24, 2.0, 5.0
RECALL = 1 - 1e-7
TILE = 1024


def lines(dim: int) -> np.ndarray:
    """The random lines of vectors of one length."""
    return np.random.default_rng(dim).standard_normal((dim, PROJECTIONS))


def least_collisions() -> int:
    """Largest count that a pair at the threshold reaches with probability ``RECALL``."""
    p = math.erf(WIDTH / math.sqrt(2))
    tail, need = 1.0, 0
    for k in range(PROJECTIONS):
        tail -= math.comb(PROJECTIONS, k) * p**k * (1 - p) ** (PROJECTIONS - k)
        if tail < RECALL:
            break
        need = k + 1
    return need


def _projected(rows: DataFrame, apart: float) -> DataFrame:
    """Rows (group, cell, vec_id, unit, at): label with length, cell on the first line, unit vector and its projections."""

    def each(batches):
        for batch in batches:
            sizes = np.diff(np.asarray(batch.column(2).offsets))
            for dim in np.unique(sizes).tolist():
                part = batch.filter(pa.array(sizes == dim))
                v = vectors.matrix(part.column(2))
                v = v / np.abs(v).max(axis=1, keepdims=True)
                v /= np.linalg.norm(v, axis=1, keepdims=True)
                at = (v @ lines(dim))
                cell = np.floor(at[:, 0] / (CELL_WIDTH * apart)).astype(np.int64)
                offsets = lambda k, n=part.num_rows: pa.array(np.arange(0, (n + 1) * k, k), pa.int32())
                unit = pa.ListArray.from_arrays(offsets(dim), pa.array(v.ravel()))
                places = pa.ListArray.from_arrays(offsets(PROJECTIONS), pa.array(at.ravel().astype(np.float32)))
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(np.full(part.num_rows, dim)), pa.array(cell), unit, places], ["vec_id", "label", "dim", "cell", "unit", "at"])

    made = rows.select("vec_id", "label", "vector").mapInArrow(each, "vec_id long, label long, dim long, cell long, unit array<double>, at array<float>")
    return made.select(F.shiftleft(F.col("label"), 24).bitwiseXOR(F.col("dim")).alias("group"), "cell", "vec_id", "unit", "at")


def _tile_links(columns: list[list], least: float, window: float, need: int) -> tuple[np.ndarray, ...]:
    """Links of one task as columns vec_id, n_links, root."""
    side, ids, unit, at = np.array(columns[0]), np.array(columns[1]), np.array(columns[2]), np.array(columns[3], np.float32)
    a = np.flatnonzero(side == 0)
    alone = not side.any()
    b = a if alone else np.flatnonzero(side == 1)
    left, right = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for k in range(0, len(a), 256):
        block = a[k:k + 256]
        met = np.zeros((len(block), len(b)), np.uint8)
        for j in range(PROJECTIONS):  # window around each query on each line
            met += np.abs(at[block, j][:, None] - at[b, j][None, :]) <= window
        x, y = np.nonzero(met >= need)
        if alone:
            x, y = x[x + k < y], y[x + k < y]
        for s in range(0, len(x), 1 << 17):
            i, j = block[x[s:s + (1 << 17)]], b[y[s:s + (1 << 17)]]
            close = np.einsum("ij,ij->i", unit[i], unit[j]) >= least
            left.append(i[close])
            right.append(j[close])
    i, j = np.concatenate(left), np.concatenate(right)
    links = np.bincount(i, minlength=len(ids)) + np.bincount(j, minlength=len(ids))
    root, some = tiles.roots(len(ids), i, j), np.flatnonzero(links)
    return ids[some], links[some], ids[root[some]]


def near_links(rows: DataFrame, least: float) -> tuple[DataFrame, DataFrame]:
    """(counts, edges): rows (vec_id, n_links) of vectors with links, and edges (a, b) spanning all links."""
    apart = math.sqrt(2 - 2 * least)
    made = settle(_projected(rows, apart))
    tasks = tiles.paired(made, "vec_id", F.ceil(F.count(F.lit(1)) / TILE))
    window, need = WIDTH * apart, least_collisions()
    found = settle(tiles.by_task(tasks, lambda t: _tile_links(t, least, window, need), "vec_id long, n_links long, root long"))
    return found.groupBy("vec_id").agg(F.sum("n_links").alias("n_links")), found.select(F.col("vec_id").alias("a"), F.col("root").alias("b"))


def near_duplicates(rows: DataFrame, least: float = 0.98, key: str = "vec_id", label: str = "label", vector: str = "embedding") -> DataFrame:
    """Rows (vec_id, n_links, component_id, kept), one per row of ``rows``.

    Vectors of one label and length link if their cosine is ``least`` or more. Null labels, null, empty and zero vectors and
    vectors with null or non-finite components link with nothing, nor do rows without an id, whose component is null.
    Rows that repeat an id are one vector, the smallest (label, vector) of them, and get one result. Two vectors
    of different ids may be equal. An empty table gives no rows; other columns are not read.
    """
    source = rows.select(F.col(key).cast("long").alias("vec_id"), F.col(label).cast("long").alias("label"), F.col(vector).cast("array<double>").alias("vector"))
    once = vectors.one_per_id(source, "vec_id", "label", "vector")
    fine = once.where(F.col("label").isNotNull() & vectors.usable("vector")).where(F.exists("vector", lambda x: x != 0))
    counts, edges = near_links(fine, least)
    named = components(edges).withColumnRenamed("node", "vec_id").join(counts, "vec_id")
    got = source.select("vec_id").join(named, "vec_id", "left")
    component = F.coalesce("component", "vec_id")
    return got.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.col("vec_id").eqNullSafe(component).alias("kept"))


SQL = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id WHERE list_cosine_similarity(a.e, b.e) >= 0.98),
reach AS (SELECT a AS node, a AS other FROM links UNION SELECT r.node, l.b FROM reach r JOIN links l ON r.other = l.a),
comp AS (SELECT node, min(other) AS component FROM reach GROUP BY node),
n AS (SELECT a, count(*) AS n_links FROM links GROUP BY a)
SELECT e.vec_id, CAST(coalesce(n.n_links, 0) AS BIGINT) AS n_links, coalesce(component, e.vec_id) AS component_id,
       e.vec_id = coalesce(component, e.vec_id) AS kept
FROM embeddings e LEFT JOIN comp ON comp.node = e.vec_id LEFT JOIN n ON n.a = e.vec_id
"""
