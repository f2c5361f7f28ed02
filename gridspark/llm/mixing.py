"""Mixing sources to target weights, in DataFrame functions only.

Documents get a hash-random key. Within a source they are ordered by key: the leading hex digits of the key name one of
4,096 key ranges, so the order of ranges and the order inside a range give the order of the source without a sort of
the whole source in one place. Prefix sums of the range totals find, per source, the one range in which its
budget ends; only those ranges are sorted by key and summed again. The result of the search is one row per
source, and a document is taken if its key lies before that of its source's cut, so texts are never shuffled.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from gridspark.session import settle

RANGE_DIGITS = 3


def size_of(text: Column) -> Column:
    """Number of runs of characters other than ASCII white space; zero for null."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def random_key(doc_id: Column, seed: str) -> Column:
    """Hex digest of seed and id: the place of the document in its source's random order."""
    return F.md5(F.concat(F.lit(seed + ":"), F.coalesce(doc_id.cast("string"), F.lit(""))))


def targets(sizes: DataFrame, weights: tuple[float, ...] = (3, 1, 2), share: float = 1.5, most: float = 2.0) -> DataFrame:
    """Rows (source, source_size, target) from rows (source, source_size).

    Sources by code point, null last, get ``weights`` in turn and divide ``share`` times all sizes by
    weight. A target stops at ``most`` times its source's size and the excess is shared again among the others;
    that ends at min(most * size, level * weight) for one level, found here by sorting the sources by the
    level at which they stop. The table has one row per source; windows run over those rows only.
    """
    turn = (F.row_number().over(W.orderBy(F.col("source").asc_nulls_last())) - 1) % len(weights)
    weighted = sizes.withColumn("weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (turn + 1).cast("int")))
    weighted = weighted.withColumn("cap", F.lit(float(most)) * F.col("source_size"))
    order = W.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before = order.rowsBetween(W.unboundedPreceding, -1)
    level = (F.lit(float(share)) * F.sum("source_size").over(W.partitionBy(F.lit(1))) - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) \
        / F.sum("weight").over(order.rowsBetween(W.currentRow, W.unboundedFollowing))
    # sources below the first that does not stop share what is left
    stops = weighted.withColumn("level", level).withColumn("open", F.col("cap") > F.col("level") * F.col("weight"))
    shared = F.min(F.when(F.col("open"), F.struct(F.col("cap") / F.col("weight"), F.col("level")))).over(W.partitionBy(F.lit(1)))
    stops = stops.withColumn("shared", shared.getField("level"))
    return stops.select("source", "source_size", F.coalesce(F.least("cap", F.col("shared") * F.col("weight")), "cap").alias("target"))


def mix_plan(docs: DataFrame, weights: tuple[float, ...] = (3, 1, 2), share: float = 1.5, most: float = 2.0, seed: str = "mix", key: str = "doc_id") -> DataFrame:
    """One row per source: source, source_size, target, epochs, cut_range, cut_key.

    A source's documents are all taken ``epochs`` times, and once more those whose key lies before the cut: in a range
    below ``cut_range``, or in it with a key up to ``cut_key`` (null: none of that range). The cut is at the
    document whose middle word is the last within the budget, so the taken words differ from the target by at most
    half a document.
    """
    rk = random_key(F.col(key), seed)
    keyed = settle(docs.select("source", rk.alias("rk"), size_of(F.col("text")).alias("size")))
    ranges = keyed.groupBy("source", F.substring("rk", 1, RANGE_DIGITS).alias("bin")).agg(F.sum("size").alias("size"))
    ranges = settle(ranges)
    plan = targets(ranges.groupBy("source").agg(F.sum("size").alias("source_size")), weights, share, most)
    plan = plan.withColumn("epochs", F.coalesce(F.floor(F.try_divide("target", "source_size")), F.lit(0)))
    plan = settle(plan.withColumn("budget", F.col("target") - F.col("epochs") * F.col("source_size")))
    earlier = W.partitionBy("source").orderBy("bin").rowsBetween(W.unboundedPreceding, -1)
    starts = ranges.withColumn("start", F.coalesce(F.sum("size").over(earlier), F.lit(0)))
    s = plan.select(F.col("source").alias("s"), "budget")
    ends = starts.join(s, F.col("source").eqNullSafe(F.col("s"))).where("budget >= start and budget < start + size")
    ends = ends.select(F.col("source").alias("s"), F.col("bin").alias("cut_range"), "start", "budget")
    inside = keyed.join(ends, keyed["source"].eqNullSafe(ends["s"]) & (F.substring("rk", 1, RANGE_DIGITS) == F.col("cut_range")))
    # documents with one key are taken together
    inside = inside.groupBy("s", "cut_range", "start", "budget", "rk").agg(F.sum("size").alias("size"))
    upto = F.col("start") + F.coalesce(F.sum("size").over(W.partitionBy("s").orderBy("rk").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    taken = inside.withColumn("upto", upto).withColumn("fits", F.col("upto") + F.col("size") / 2 <= F.col("budget"))
    cuts = taken.groupBy("s", "cut_range").agg(F.max(F.when(F.col("fits"), F.col("rk"))).alias("cut_key"))
    return plan.join(cuts, F.col("source").eqNullSafe(F.col("s")), "left").select("source", "source_size", "target", "epochs", "cut_range", "cut_key")


def taken_times(plan: DataFrame, seed: str = "mix", key: str = "doc_id") -> Column:
    """How often a document joined with its source's plan row is taken."""
    rk = random_key(F.col(key), seed)
    bin_ = F.substring(rk, 1, RANGE_DIGITS)
    more = (bin_ < plan["cut_range"]) | ((bin_ == plan["cut_range"]) & (rk <= plan["cut_key"]))
    return plan["epochs"] + F.coalesce(more, F.lit(False)).cast("long")


def mix(docs: DataFrame, weights: tuple[float, ...] = (3, 1, 2), share: float = 1.5, most: float = 2.0, seed: str = "mix", key: str = "doc_id") -> DataFrame:
    """Rows (doc_id, size, source_size, target, times, taken), one per row of ``docs``.

    Null texts have size zero, null sources are one source, null ids are ordered like an empty id. Rows that share an id share
    a key and are taken or left together. A source without words has target zero. An empty table gives no rows. Only id,
    source and text are read, so other columns cannot clash. The same rows give the same mix on every run.
    """
    plan = settle(mix_plan(docs, weights, share, most, seed, key))
    p = plan.withColumnRenamed("source", "plan_source")
    doc = docs.select(F.col(key).alias("doc_id"), "source", size_of(F.col("text")).alias("size"))
    got = doc.join(p, doc["source"].eqNullSafe(p["plan_source"])).withColumn("times", taken_times(p, seed))
    return got.select("doc_id", "size", "source_size", "target", "times", (F.col("times") * F.col("size")).alias("taken"))


def mixed_rows(docs: DataFrame, weights: tuple[float, ...] = (3, 1, 2), share: float = 1.5, most: float = 2.0, seed: str = "mix", key: str = "doc_id") -> DataFrame:
    """The mixed corpus: rows of ``docs`` with all their columns, each as often as it is taken."""
    plan = settle(mix_plan(docs, weights, share, most, seed, key))
    p = plan.select(*[F.col(c).alias(f"__{c}") for c in plan.columns])
    named = {c: f"__{c}" for c in plan.columns}
    rk = random_key(docs[key], seed)
    bin_ = F.substring(rk, 1, RANGE_DIGITS)
    more = (bin_ < p[named["cut_range"]]) | ((bin_ == p[named["cut_range"]]) & (rk <= p[named["cut_key"]]))
    times = (p["__epochs"] + F.coalesce(more, F.lit(False)).cast("long")).cast("int")
    got = docs.join(p, docs["source"].eqNullSafe(p["__source"])).where(times > 0)
    return got.withColumn("__copy", F.explode(F.sequence(F.lit(1), times))).select(*[docs[c] for c in docs.columns])


SQL = """
WITH sized AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS BIGINT) AS size,
         md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS rk
  FROM documents),
per_source AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source),
weighted AS (
  SELECT source, source_size, CAST(2 AS DOUBLE) * source_size AS cap,
         CAST(CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 3 WHEN 1 THEN 1 ELSE 2 END AS DOUBLE) AS weight
  FROM per_source),
levels AS (
  SELECT *, (CAST(1.5 AS DOUBLE) * sum(source_size) OVER ()
             - coalesce(sum(cap) OVER (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
            / sum(weight) OVER (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM weighted),
planned AS (
  SELECT source, source_size,
         least(cap, coalesce((SELECT arg_min(level, cap / weight) FROM levels WHERE cap > level * weight) * weight, cap)) AS target
  FROM levels),
placed AS (
  SELECT s.doc_id, s.size, p.source_size, p.target,
         CASE WHEN p.source_size = 0 THEN 0 ELSE CAST(floor(p.target / p.source_size) AS BIGINT) END AS epochs,
         coalesce(sum(s.size) OVER (PARTITION BY s.source ORDER BY s.rk RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 0)
           - sum(s.size) OVER (PARTITION BY s.source, s.rk) AS upto,
         sum(s.size) OVER (PARTITION BY s.source, s.rk) AS together
  FROM sized s JOIN planned p ON s.source IS NOT DISTINCT FROM p.source)
SELECT doc_id, size, source_size, target,
       CAST(size * (epochs + CASE WHEN upto + together / 2.0 <= target - epochs * source_size THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM placed
"""
