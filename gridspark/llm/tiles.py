"""Comparison of all rows of neighbouring cells in bounded tasks.

A cell is split into tiles of a bounded number of rows; a task holds one tile, or two tiles of the same cell or of two
neighbouring cells, so no task grows with a cell. Pairs never become rows: a task returns what it makes of them.
"""
from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridspark.session import settle

KEYS = ["group", "cell", "i", "cell2", "j"]
TASKS = "array<struct<cell: bigint, i: int, cell2: bigint, j: int, side: int>>"


def paired(rows: DataFrame, id_: str, tiles: Column) -> DataFrame:
    """Rows of the tasks: ``KEYS``, side, then the columns of ``rows`` but group and cell.

    ``rows`` has columns group and cell (long); ``tiles`` is the aggregate that says into how many tiles a cell is split.
    Side 0 is to be compared with side 1, or with itself where side 1 is empty.
    """
    cells = settle(rows.groupBy("group", "cell").agg(tiles.cast("int").alias("tiles")))
    below = cells.select("group", (F.col("cell") + 1).alias("cell"), F.col("tiles").alias("__below"))
    above = cells.select("group", (F.col("cell") - 1).alias("cell"), F.col("tiles").alias("__above"))
    cells = settle(cells.join(below, ["group", "cell"], "left").join(above, ["group", "cell"], "left"))
    payload = [c for c in rows.columns if c not in ("group", "cell")]
    placed = rows.join(cells, ["group", "cell"]).withColumn("__sub", F.pmod(F.xxhash64(id_), F.col("tiles")).cast("int"))
    # each row names its own tasks by the numbers of tiles: the tasks, of which a cell has the square of its tiles, are no table
    cell, sub = F.col("cell"), F.col("__sub")

    def tasks(first, last, of):
        each = F.transform(F.sequence(first, last), lambda k: F.struct(*[c.alias(n) for c, n in zip(of(k), [*KEYS[1:], "side"], strict=True)]))
        return F.when(last >= first, each).otherwise(F.array().cast(TASKS))

    same = tasks(sub, F.col("tiles") - 1, lambda j: (cell, sub, cell, j, F.lit(0)))
    after = tasks(F.lit(0), F.col("__above") - 1, lambda j: (cell, sub, cell + 1, j, F.lit(0)))
    before = tasks(F.lit(0), F.col("__below") - 1, lambda i: (cell - 1, i, cell, sub, F.lit(1)))
    other = tasks(F.lit(0), sub - 1, lambda i: (cell, i, cell, sub, F.lit(1)))
    named = placed.select("group", F.explode(F.concat(same, other, after, before)).alias("__task"), *payload)
    return named.select("group", *[f"__task.{n}" for n in [*KEYS[1:], "side"]], *payload)


def by_task(rows: DataFrame, work: Callable[[list[list]], tuple[list, ...]], schema: str) -> DataFrame:
    """Applies ``work`` to the columns (side and payload, as lists) of each task, in the order of its sides."""
    names = [x.split()[0] for x in schema.split(", ")]
    n = len(KEYS)

    def each(batches):
        held, out = None, [[] for _ in names]
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = np.stack([np.asarray(batch.column(i)).astype(np.int64) for i in range(n)])
            cuts = (np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1).tolist()
            columns = [batch.column(i).to_pylist() for i in range(n, batch.num_columns)]
            for a, b in zip([0, *cuts], [*cuts, batch.num_rows], strict=True):
                key, piece = tuple(keys[:, a]), [c[a:b] for c in columns]
                if held is not None and held[0] == key:
                    held = (key, [x + y for x, y in zip(held[1], piece, strict=True)])
                    continue
                if held is not None:
                    out = [x + list(y) for x, y in zip(out, work(held[1]), strict=True)]
                held = (key, piece)
                if len(out[0]) > 1000:
                    yield pa.RecordBatch.from_pydict(dict(zip(names, out, strict=True)))
                    out = [[] for _ in names]
        if held is not None:
            out = [x + list(y) for x, y in zip(out, work(held[1]), strict=True)]
        if out[0]:
            yield pa.RecordBatch.from_pydict(dict(zip(names, out, strict=True)))

    return rows.repartition(*KEYS).sortWithinPartitions(*KEYS, "side").mapInArrow(each, schema)


def roots(n: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Smallest place that each of ``n`` places reaches over the links (left, right)."""
    root = np.arange(n)
    while len(left):
        low = np.minimum(root[left], root[right])
        if (root[left] == low).all() and (root[right] == low).all():
            break
        np.minimum.at(root, root[left], low)
        np.minimum.at(root, root[right], low)
        root = root[root]
    return root
