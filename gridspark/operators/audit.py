"""Table and configuration differences, product completeness, category sanity."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridspark.operators.identity import range_digests, row_text
from gridspark.session import settle

RANGES = 4096


def diff_tables(a: DataFrame, b: DataFrame, keys: list[str], values: list[str]) -> DataFrame:
    """Per variable: rows on one side only, rows that differ, largest and RMS difference.

    Values are compared null-safe; one full outer join, one small aggregation.
    """
    left = a.select(*keys, *[F.col(v).alias(f"a_{v}") for v in values], F.lit(True).alias("_a"))
    right = b.select(*keys, *[F.col(v).alias(f"b_{v}") for v in values], F.lit(True).alias("_b"))
    both = left.join(right, keys, "full_outer")
    inside = F.col("_a").isNotNull() & F.col("_b").isNotNull()
    rows = []
    for v in values:
        d = F.when(inside, F.col(f"a_{v}") - F.col(f"b_{v}"))
        rows.append(F.struct(F.lit(v).alias("variable"), d.cast("double").alias("d"),
                             (inside & ~F.col(f"a_{v}").eqNullSafe(F.col(f"b_{v}"))).alias("ne")))
    long = both.select("_a", "_b", F.explode(F.array(*rows)).alias("e")).select("_a", "_b", "e.*")
    return long.groupBy("variable").agg(
        F.sum((F.col("_b").isNull()).cast("bigint")).alias("only_a"),
        F.sum((F.col("_a").isNull()).cast("bigint")).alias("only_b"),
        F.sum(F.col("ne").cast("bigint")).alias("n_diff"), F.max(F.abs("d")).alias("max_abs"),
        F.sqrt(F.avg(F.col("d") * F.col("d"))).alias("rms"))


def diff_large(a: DataFrame, b: DataFrame, keys: list[str], values: list[str], ranges: int = RANGES) -> DataFrame:
    """What :func:`diff_tables` returns, for tables that are mostly equal: rows are joined only in ranges that differ.

    Each side is read once for one digest and a few counts per range of key hashes, which combine before the shuffle.
    Ranges of one digest hold the same rows; only the rows of the others (at most ``ranges`` range numbers are broadcast) are
    shuffled and joined. Equal tables shuffle no rows.
    """
    place = F.pmod(F.xxhash64(*keys), F.lit(ranges))
    number = {v: F.col(v).cast("double") for v in values}
    odd = {v: F.isnan(n) | (F.abs(n) == float("inf")) for v, n in number.items()}

    def facts(side: DataFrame, name: str) -> DataFrame:
        rows = side.select(place.alias("range"), *keys, *values)
        digests = range_digests(rows, ["range"], row_text([*keys, *values]))
        counts = rows.groupBy("range").agg(*[F.count(v).alias(f"n_{v}") for v in values], *[F.count(F.when(odd[v], 1)).alias(f"odd_{v}") for v in values])
        return digests.join(counts, "range").select("range", F.col("digest").alias(f"digest_{name}"), *([f"n_{v}" for v in values] + [f"odd_{v}" for v in values] if name == "a" else []))

    met = settle(facts(a, "a").join(facts(b, "b"), "range", "full_outer"))
    same = F.col("digest_a").eqNullSafe(F.col("digest_b"))
    differing = met.where(~same).select("range")

    def rows_of(side: DataFrame) -> DataFrame:
        return side.withColumn("range", place).join(F.broadcast(differing), "range", "left_semi").select(*keys, *values)

    left = rows_of(a).select(*keys, *[F.col(v).alias(f"a_{v}") for v in values], F.lit(True).alias("_a"))
    right = rows_of(b).select(*keys, *[F.col(v).alias(f"b_{v}") for v in values], F.lit(True).alias("_b"))
    both = left.join(right, keys, "full_outer")
    inside = F.col("_a").isNotNull() & F.col("_b").isNotNull()
    found, equal = [], []
    zero = F.lit(0).cast("bigint")
    for v in values:
        d = F.when(inside, F.col(f"a_{v}") - F.col(f"b_{v}")).cast("double")
        unlike = inside & ~F.col(f"a_{v}").eqNullSafe(F.col(f"b_{v}"))
        found.append(F.struct(F.lit(v).alias("variable"), F.col("_b").isNull().cast("bigint").alias("only_a"), F.col("_a").isNull().cast("bigint").alias("only_b"),
                              unlike.cast("bigint").alias("n_diff"), F.abs(d).alias("top"), (d * d).alias("square"), d.isNotNull().cast("bigint").alias("n")))
        # rows of equal ranges differ by 0, or by no number where they are not finite
        top = F.when(F.col(f"odd_{v}") > 0, F.lit(float("nan"))).when(F.col(f"n_{v}") > 0, F.lit(0.0))
        equal.append(F.struct(F.lit(v).alias("variable"), zero.alias("only_a"), zero.alias("only_b"), zero.alias("n_diff"), top.alias("top"), top.alias("square"), F.col(f"n_{v}").alias("n")))
    every = both.select(F.explode(F.array(*found)).alias("e")).select("e.*").unionByName(met.where(same).select(F.explode(F.array(*equal)).alias("e")).select("e.*"))
    return every.groupBy("variable").agg(
        *[F.sum(c).alias(c) for c in ("only_a", "only_b", "n_diff")], F.max("top").alias("max_abs"), F.sqrt(F.sum("square") / F.sum("n")).alias("rms"))


def diff_config(reference: DataFrame, candidate: DataFrame, ignore: str | None = None) -> DataFrame:
    """Settings (key, value) that DIFFER, are MISSING from or EXTRA in the candidate; ``ignore`` is a key pattern."""
    r = reference.select("key", F.col("value").alias("reference"), F.lit(True).alias("_r"))
    c = candidate.select("key", F.col("value").alias("candidate"), F.lit(True).alias("_c"))
    both = r.join(c, "key", "full_outer")
    status = F.when(F.col("_c").isNull(), "MISSING").when(F.col("_r").isNull(), "EXTRA").when(
        F.col("reference") != F.col("candidate"), "DIFFERS")
    out = both.withColumn("status", status).filter(F.col("status").isNotNull())
    if ignore:
        out = out.filter(~F.col("key").rlike(ignore))
    return out.select("key", "status", "reference", "candidate")


def audit_products(required: DataFrame, values: DataFrame, nonzero: list[str] = ()) -> DataFrame:
    """Status per required (stream, product, field): ok, missing_product, missing_field, all_zero.

    ``nonzero`` names fields that must hold a finite value other than 0 somewhere; a listed field no stream
    provides is reported with stream ``-``.
    """
    v = F.col("value")
    finite = v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))
    fields = values.groupBy("product", "field").agg(F.bool_or(finite & (v != 0)).alias("alive"))
    products = fields.select("product").distinct().withColumn("_p", F.lit(True))
    j = required.join(products, "product", "left").join(fields, ["product", "field"], "left")
    need = F.col("field").isin(list(nonzero)) if nonzero else F.lit(False)
    status = (F.when(F.col("_p").isNull(), "missing_product").when(F.col("alive").isNull(), "missing_field")
              .when(need & ~F.col("alive"), "all_zero").otherwise("ok"))
    out = j.select("stream", "product", "field", status.alias("status"))
    if nonzero:
        listed = required.sparkSession.createDataFrame([(n,) for n in nonzero], "field string")
        none = listed.join(required.select("field").distinct(), "field", "left_anti").select(
            F.lit("-").alias("stream"), F.lit("-").alias("product"), "field", F.lit("no_provider").alias("status"))
        out = out.unionByName(none)
    return out


def check_categories(veg: DataFrame, fire_size_times: DataFrame, start=None, end=None) -> DataFrame:
    """Violations of a category product: codes outside 0..4, repeated or missing days, coverage, other timestamps.

    veg(valid_time, cell_id, category), fire_size_times(valid_time).
    """
    code = F.col("category")
    bad = veg.filter(code.isNull() | ~code.isin(0, 1, 2, 3, 4)).groupBy("valid_time").agg(F.count(F.lit(1)).alias("n"))
    rows = [bad.select(F.lit("category").alias("rule"), "valid_time", "n")]
    times = veg.select("valid_time").distinct()
    ref = fire_size_times.groupBy("valid_time").agg(F.count(F.lit(1)).alias("n"))
    rows.append(ref.filter("n > 1").select(F.lit("repeated_time").alias("rule"), "valid_time", "n"))
    one = F.lit(1).cast("bigint")
    rows.append(times.join(ref, "valid_time", "left_anti").select(F.lit("not_in_fire_size").alias("rule"), "valid_time", one.alias("n")))
    rows.append(ref.select("valid_time").join(times, "valid_time", "left_anti").select(
        F.lit("not_in_category").alias("rule"), "valid_time", one.alias("n")))
    span = times.agg(F.min("valid_time").alias("lo"), F.max("valid_time").alias("hi"))
    day = F.expr("interval 1 day")
    full = span.filter("lo IS NOT NULL").select(F.explode(F.sequence("lo", "hi", day)).alias("valid_time"))
    rows.append(full.join(times, "valid_time", "left_anti").select(F.lit("gap").alias("rule"), "valid_time", one.alias("n")))
    if start is not None:
        a, b = F.lit(start).cast("timestamp"), F.lit(end).cast("timestamp")
        open_ = span.filter((a < F.col("lo")) | (b >= F.col("hi") + day))
        rows.append(open_.select(F.lit("not_covered").alias("rule"), F.col("lo").alias("valid_time"), one.alias("n")))
    out = rows[0]
    for r in rows[1:]:
        out = out.unionByName(r)
    return out
