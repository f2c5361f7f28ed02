"""Connected components of a distributed edge table."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridspark.session import discard, settle, settled


def components(edges: DataFrame) -> DataFrame:
    """Union-find over ``edges`` (a, b): rows (node, component) with the smallest node reachable.

    Large-star and small-star steps alternate until the edge set is a star per component. Each step is
    a grouped minimum (combined before the shuffle), written, and an equi-join of written tables, which adaptive
    execution can split, so a hub that touches a third of all edges is no single task. Every step is written to the shared
    folder, which cuts the lineage, and the tables of the step before are removed then. Edges with a null end and self-loops are ignored; nodes that occur in
    no other edge have no row.
    """
    spark, others = edges.sparkSession, set(settled(edges.sparkSession))

    def only(table: DataFrame) -> DataFrame:
        discard(spark, [p for p in settled(spark) if p not in others and p != table.settled_at])
        return table

    u, v = F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")
    now = settle(edges.where("a is not null and b is not null and a <> b").select(u, v).distinct())
    now, seen = only(_small_star(now)), None  # first, as it leaves fewest edges
    while (mark := now.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first()) != seen:
        seen = mark
        if not mark[0]:
            break
        now = only(_small_star(_large_star(now)))
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return roots.unionAll(now.select(F.col("u").alias("node"), F.col("v").alias("component")))


def _large_star(edges: DataFrame) -> DataFrame:
    """Ties every larger neighbour of a node to the smallest of its neighbours and itself."""
    both = edges.unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = settle(both.groupBy("u").agg(F.min("v").alias("m")))
    return settle(both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.least("u", "m").alias("v")).distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    """Ties a node and its smaller neighbours to the smallest of them; edges (u, v) have v below u."""
    low = settle(edges.groupBy("u").agg(F.min("v").alias("m")))
    moved = edges.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return settle(moved.unionAll(low.select("u", F.col("m").alias("v"))).distinct())
