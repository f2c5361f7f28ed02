"""Which source supplies each day of a product, and the values that follow from the choice."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridspark.operators.skew import lookup_join
from gridspark.session import settle


def day_calendar(start, end, series: DataFrame) -> DataFrame:
    """One row per series and day from start to end inclusive."""
    a, b = F.lit(start).cast("date"), F.lit(end).cast("date")
    return series.withColumn("day", F.explode(F.sequence(a, b, F.expr("interval 1 day"))))


def _in_ranges(day: Column, ranges) -> Column:
    hit = F.lit(False)
    for lo, hi in ranges:
        hit = hit | day.between(F.lit(lo).cast("date"), F.lit(hi).cast("date"))
    return hit


def resolve_days(calendar: DataFrame, available: DataFrame, series: str = "series_id", max_missing: int = 0,
                 forced=()) -> DataFrame:
    """Emission policy per day: forced fallback, primary, short linear gap, fallback, else missing.

    available(series, day, source) lists the days of ``primary`` and ``fallback``. The output has
    status (with the bracket for linear days), before_day, after_day and alpha. Windows run over the
    calendar of one series, one row per day.
    """
    by_day = available.groupBy(series, "day").agg(
        F.bool_or(F.col("source") == "primary").alias("has_primary"),
        F.bool_or(F.col("source") == "fallback").alias("has_fallback"))
    # days outside the calendar still serve as brackets
    frame = calendar.select(series, "day").withColumn("wanted", F.lit(True))
    days = frame.join(by_day, [series, "day"], "full_outer").select(
        series, "day", F.coalesce("wanted", F.lit(False)).alias("wanted"),
        F.coalesce("has_primary", F.lit(False)).alias("p"), F.coalesce("has_fallback", F.lit(False)).alias("f"))
    w = Window.partitionBy(series).orderBy("day")
    mark = F.when(F.col("p"), F.col("day"))
    days = days.withColumn("before_day", F.last(mark, True).over(w.rowsBetween(Window.unboundedPreceding, -1)))
    days = days.withColumn("after_day", F.first(mark, True).over(w.rowsBetween(1, Window.unboundedFollowing)))
    span = F.date_diff("after_day", "before_day")
    linear = F.coalesce(span - 1 <= max_missing, F.lit(False))
    force = _in_ranges(F.col("day"), forced)
    label = F.concat(F.lit("linear:"), F.col("before_day").cast("string"), F.lit("->"), F.col("after_day").cast("string"))
    status = (
        F.when(force & F.col("f"), "fallback-forced").when(force, "missing-forced").when(F.col("p"), "primary")
        .when(linear, label).when(F.col("f"), "fallback").otherwise("missing"))
    days = days.filter("wanted").withColumn("status", status)
    is_linear = F.col("status").startswith("linear:")
    return days.select(
        series, "day", "status", F.when(is_linear, F.col("before_day")).alias("before_day"),
        F.when(is_linear, F.col("after_day")).alias("after_day"),
        F.when(is_linear, F.date_diff("day", "before_day") / span).alias("alpha"))


def resolve_fire_size_days(calendar: DataFrame, available: DataFrame, series: str = "series_id", max_missing: int = 1,
                           forced=(), prefer_linear: bool = False) -> DataFrame:
    """Fire-size policy per day: forced fallback if there is one, dedicated, primary, fallback, linear, else missing.

    A fallback for the day is used before a linear fill is tried; ``prefer_linear`` swaps the two.
    Brackets are searched ``max_missing + 1`` days to each side among dedicated and primary days.
    """
    def has(name):
        return F.bool_or(F.col("source") == name)

    by_day = available.groupBy(series, "day").agg(
        has("dedicated").alias("d"), has("primary").alias("p"), has("fallback").alias("f"))
    frame = calendar.select(series, "day").withColumn("wanted", F.lit(True))
    days = frame.join(by_day, [series, "day"], "full_outer").select(
        series, "day", F.coalesce("wanted", F.lit(False)).alias("wanted"),
        *[F.coalesce(c, F.lit(False)).alias(c) for c in "dpf"])
    w = Window.partitionBy(series).orderBy("day")
    mark = F.when(F.col("d") | F.col("p"), F.col("day"))
    days = days.withColumn("b", F.last(mark, True).over(w.rowsBetween(Window.unboundedPreceding, -1)))
    days = days.withColumn("a", F.first(mark, True).over(w.rowsBetween(1, Window.unboundedFollowing)))
    reach = max(1, max_missing + 1)
    near = (F.date_diff("day", "b") <= reach) & (F.date_diff("a", "day") <= reach)
    linear = F.coalesce(near & (F.date_diff("a", "b") - 1 <= max_missing), F.lit(False))
    label = F.concat(F.lit("linear:"), F.col("b").cast("string"), F.lit("->"), F.col("a").cast("string"))
    force = _in_ranges(F.col("day"), forced)
    status = F.when(force & F.col("f"), "fallback-area-forced").when(F.col("d"), "dedicated").when(
        F.col("p"), "primary-area")
    if prefer_linear:
        status = status.when(linear, label).when(F.col("f"), "fallback-area")
    else:
        status = status.when(F.col("f"), "fallback-area").when(linear, label)
    days = days.filter("wanted").withColumn("status", status.otherwise("missing"))
    is_linear = F.col("status").startswith("linear:")
    return days.select(
        series, "day", "status", F.when(is_linear, F.col("b")).alias("before_day"),
        F.when(is_linear, F.col("a")).alias("after_day"),
        F.when(is_linear, F.date_diff("day", "b") / F.date_diff("a", "b")).alias("alpha"))


def day_parts(resolved: DataFrame, series: str = "series_id") -> DataFrame:
    """(series, day, source, source_day, weight): where the values of each resolved day come from."""
    s = F.col("status")

    def part(source, day, weight):
        return F.struct(F.lit(source).alias("source"), day.alias("source_day"), weight.alias("weight"))

    day, one = F.col("day"), F.lit(1.0)
    base = F.when(s.isin("dedicated"), F.lit("dedicated")).otherwise(F.lit("primary"))
    parts = (
        F.when(s.startswith("fallback"), F.array(part("fallback", day, one)))
        .when(s.startswith("linear:"), F.array(part("primary", F.col("before_day"), 1.0 - F.col("alpha")),
                                               part("primary", F.col("after_day"), F.col("alpha"))))
        .when(s.startswith("missing"), F.array().cast("array<struct<source:string,source_day:date,weight:double>>"))
        .otherwise(F.array(F.struct(base.alias("source"), day.alias("source_day"), one.alias("weight")))))
    return resolved.select(series, "day", F.explode(parts).alias("p")).select(series, "day", "p.*")


def fill_days(values: DataFrame, resolved: DataFrame, keys: list[str], series: str = "series_id",
              value: str = "value") -> DataFrame:
    """Values of every resolved day: values(series, source, day, keys, value) -> (series, day, keys, value).

    An absent cell of a sparse day counts as 0, so a blend of two days is a weighted sum.
    """
    parts = day_parts(resolved, series)
    src = values.withColumnRenamed("day", "source_day")
    # a day may hold most of the rows; the choice is one row per day and source
    joined = lookup_join(src, parts, [series, "source", "source_day"], "inner")
    return joined.groupBy(series, "day", *keys).agg(F.sum(F.col("weight") * F.col(value)).alias(value))


def even_days(days: DataFrame, limit: int, series: str = "series_id") -> DataFrame:
    """At most ``limit`` days spread evenly over each series' day list.

    Kept positions are the half-even rounded points of an even division of [0, n-1].
    """
    w = Window.partitionBy(series).orderBy("day")
    ranked = days.select(series, "day").distinct().withColumn("pos", F.row_number().over(w) - 1).withColumn(
        "n", F.count(F.lit(1)).over(Window.partitionBy(series)))
    step = (F.col("n") - 1) / F.lit(max(limit - 1, 1))
    picks = F.transform(F.sequence(F.lit(0), F.lit(limit - 1)), lambda i: F.rint(i * step).cast("int"))
    keep = (F.col("n") <= limit) | F.array_contains(picks, F.col("pos"))
    return ranked.filter(keep if limit > 0 else F.lit(True)).select(series, "day")


def fallback_factors(primary: DataFrame, fallback: DataFrame, mesh: DataFrame, fields: list[str],
                     method: str = "robust_median_ratio", fixed: dict[str, float] | None = None,
                     clip: tuple[float, float] = (0.25, 4.0), min_days: int = 3, max_days: int = 0,
                     skip: tuple[str, ...] = ()) -> DataFrame:
    """(field, factor) that brings the fallback to the level of the primary source.

    primary/fallback are (day, field, cell_id, value). ``robust_median_ratio`` takes the clipped median
    of daily ratios of area-weighted totals over all days both sources have; with fewer than ``min_days``
    of them the factor is 1. ``max_days`` above 0 asks for that many evenly spaced days instead.
    """
    spark = primary.sparkSession
    names = spark.createDataFrame([(f,) for f in fields], "field string")
    if method == "none":
        return names.withColumn("factor", F.lit(1.0))
    if method == "fixed":
        table = {**{f: (fixed or {}).get("default", 1.0) for f in fields}, **(fixed or {})}
        return spark.createDataFrame([(f, float(table[f])) for f in fields], "field string, factor double")
    if method != "robust_median_ratio":
        raise ValueError(f"unknown fallback scale method {method!r}")
    area = mesh.select("cell_id", "area_m2")

    def totals(df, name):
        return df.filter(~F.col("field").isin(list(skip)) if skip else F.lit(True)).join(area, "cell_id").groupBy(
            "day", "field").agg(F.sum(F.col("value") * F.col("area_m2")).alias(name))

    # a row per day and field, each read twice below
    num, den = settle(totals(primary, "num")), settle(totals(fallback, "den"))
    overlap = num.select("day").intersect(den.select("day")).withColumn("series_id", F.lit("overlap"))
    days = even_days(overlap, max_days).select("day") if max_days > 0 else overlap.select("day")
    ratios = num.join(den, ["day", "field"]).join(days, "day", "left_semi").filter(
        (F.col("den") > 0) & (F.col("num") >= 0)).withColumn("r", F.col("num") / F.col("den"))
    med = ratios.groupBy("field").agg(F.percentile("r", 0.5).alias("m"), F.count(F.lit(1)).alias("n"))
    bounded = F.least(F.greatest(F.col("m"), F.lit(float(clip[0]))), F.lit(float(clip[1])))
    return names.join(med, "field", "left").select(
        "field", F.when(F.coalesce(F.col("n"), F.lit(0)) >= min_days, bounded).otherwise(F.lit(1.0)).alias("factor"))
