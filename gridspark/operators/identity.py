"""Content identity of tables: digests of key ranges, combined into a tree, and differences found from the top.

A row's digest is the SHA-256 of its canonical text. The digests of a range are added up in ``LANES`` words of 32 bits, which needs no
order and combines before the shuffle; the sums and the number of rows are hashed again, so a range is one digest whatever
its rows, and rows that change do not cancel out. Ranges are ``2**BITS`` consecutive keys, a node above holds ``2**BITS`` nodes
below it. The shape of the tree depends on the keys alone: a table that grows keeps the nodes of what it had.
"""
from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridspark.session import settle

LANES = 8
BITS = 8


def row_text(columns: list[Column | str]) -> Column:
    """Text that tells rows apart: a JSON of the columns in order, nulls included."""
    return F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})


def range_digests(rows: DataFrame, by: list[str], text: Column) -> DataFrame:
    """Rows (by, n_rows, digest): one digest of all rows of each group, in any order; groups combine before the shuffle."""
    hashed = rows.select(*by, F.sha2(text, 256).alias("_h"))
    lanes = [F.sum(F.conv(F.substring("_h", 8 * i + 1, 8), 16, 10).cast("bigint")).alias(f"_{i}") for i in range(LANES)]
    sums = hashed.groupBy(*by).agg(F.count(F.lit(1)).alias("n_rows"), *lanes)
    words = [F.col(c).cast("string") for c in ("n_rows", *[f"_{i}" for i in range(LANES)])]
    return sums.select(*by, "n_rows", F.sha2(F.concat_ws(":", *words), 256).alias("digest"))


def digest_tree(rows: DataFrame, key: str, text: Column, bits: int = BITS) -> DataFrame:
    """All nodes (level, range_id, n_rows, digest) of the tree over an integer key; the top level has one node.

    Level 0 holds ranges of ``2**bits`` keys (range_id is the key shifted right), every level above as many nodes each. Rows without
    a key are the range null of every level. The levels follow from the largest range; an empty table has no node.
    """
    at = rows.withColumn("range_id", F.shiftright(F.col(key).cast("bigint"), bits))
    level = settle(range_digests(at, ["range_id"], text))
    low, high = level.agg(F.min("range_id"), F.max("range_id")).first()
    levels = [level.withColumn("level", F.lit(0))]
    while low is not None and low != high and (low, high) != (-1, 0):  # keys of both signs never meet below the top
        levels.append(_above(levels[-1], F.shiftright("range_id", bits), len(levels)))
        low, high = low >> bits, high >> bits
    top = _above(levels[-1], F.lit(None).cast("bigint"), len(levels))
    return settle(functools.reduce(DataFrame.unionByName, [*levels, top]).select("level", "range_id", "n_rows", "digest"))


def _above(level: DataFrame, parent: Column, number: int) -> DataFrame:
    child = F.struct(F.col("range_id"), F.concat_ws("=", F.coalesce(F.col("range_id").cast("string"), F.lit("null")), "digest").alias("t"))
    grouped = level.withColumn("_c", child).groupBy(parent.alias("range_id")).agg(
        F.sum("n_rows").alias("n_rows"), F.array_sort(F.collect_list("_c")).alias("_c"))
    return grouped.select("range_id", "n_rows", F.sha2(F.array_join(F.col("_c.t"), ","), 256).alias("digest"), F.lit(number).alias("level"))


def root(tree: DataFrame) -> DataFrame:
    """The one row (n_rows, digest) that names the whole table."""
    return tree.groupBy().agg(F.max_by("n_rows", "level").alias("n_rows"), F.max_by("digest", "level").alias("digest"))


def changed_ranges(before: DataFrame, after: DataFrame, bits: int = BITS) -> DataFrame:
    """Level-0 ranges (range_id, n_before, n_after) that differ between two trees; equal tops end the search at once.

    Only children of nodes that differ are compared, level by level from the top of the higher tree.
    """
    def facts(t: DataFrame):
        r = t.agg(F.max("level").alias("m"), F.max_by("digest", "level").alias("d")).first()
        return (-1 if r["m"] is None else r["m"]), r["d"]

    (m, d), (k, e) = facts(before), facts(after)
    a, b = (t.select("level", "range_id", F.col("n_rows").alias(f"n_{n}"), F.col("digest").alias(f"d_{n}")) for t, n in ((before, "before"), (after, "after")))

    def at(level: int, parents: DataFrame | None) -> DataFrame:
        x, y = (t.where(F.col("level") == level).drop("level") for t in (a, b))
        if parents is not None:
            x, y = (t.join(parents, F.shiftright(t["range_id"], bits).eqNullSafe(parents["parent"]), "left_semi") for t in (x, y))
        both = x.join(y.withColumnRenamed("range_id", "other"), F.col("range_id").eqNullSafe(F.col("other")), "full_outer")
        return both.where(~F.col("d_before").eqNullSafe(F.col("d_after"))).select(F.coalesce("range_id", "other").alias("range_id"), "n_before", "n_after")

    if d == e:
        return at(0, None).where("false")
    differ = None
    if m == k and m > 0:
        for level in range(m - 1, -1, -1):
            differ = settle(at(level, None if differ is None else differ.select(F.col("range_id").alias("parent"))))
    else:  # trees of another height share only their lower levels
        differ = at(0, None)
    return differ
