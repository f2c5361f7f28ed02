"""Target schedules and time brackets: as-of joins per series, blending, gap filling."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridspark.operators.skew import lookup_join
from gridspark.session import settle

BUCKET_SECONDS = 86400
_METHODS = ("linear", "nearest", "hold")
STEPS_AT_ONCE = 1024


def schedule(start, end, step_seconds: int) -> Column:
    """Array of timestamps from start to end inclusive."""
    if step_seconds <= 0:
        raise ValueError("step_seconds has to be above zero")
    a = start if isinstance(start, Column) else F.lit(start).cast("timestamp")
    b = end if isinstance(end, Column) else F.lit(end).cast("timestamp")
    step = F.make_dt_interval(secs=F.lit(step_seconds))
    return F.when(b >= a, F.sequence(a, b, step)).otherwise(F.array().cast("array<timestamp>"))


def target_schedule(records: DataFrame, start, end, frequency: str, step: float = 1.0,
                    series: str = "series_id") -> DataFrame:
    """Targets (series, target) at ``source``, ``monthly``, ``daily`` or ``hourly`` frequency.

    Monthly targets sit on the source records when each covered month has exactly one, else on
    the first of the month.
    """
    a, b = F.lit(start).cast("timestamp"), F.lit(end).cast("timestamp")
    if frequency == "source":
        return records.filter(F.col("valid_time").between(a, b)).select(series, F.col("valid_time").alias("target"))
    all_series = records.select(series).distinct()
    if frequency in ("daily", "hourly"):
        seconds = int(step * (86400 if frequency == "daily" else 3600))
        return all_series.withColumn("target", F.explode(schedule(a, b, seconds)))
    if frequency != "monthly":
        raise ValueError(f"frequency is source, monthly, daily or hourly, not {frequency!r}")
    firsts = F.sequence(F.trunc(a, "month"), F.trunc(b, "month"), F.expr("interval 1 month"))
    months = all_series.withColumn("month", F.explode(firsts))
    per = records.groupBy(series, F.trunc("valid_time", "month").alias("month")).agg(
        F.count(F.lit(1)).alias("n"), F.min("valid_time").alias("at"))
    seen = months.join(per, [series, "month"], "left")
    anchored = seen.groupBy(series).agg(F.bool_and(F.coalesce(F.col("n") == 1, F.lit(False))).alias("anchored"))
    picked = seen.join(anchored, series).withColumn(
        "target", F.when(F.col("anchored"), F.col("at")).otherwise(F.col("month").cast("timestamp")))
    inside = F.when(F.col("anchored"), F.col("target").between(a, b)).otherwise(F.col("target") >= a)
    return picked.filter(inside).select(series, "target")


def duplicate_times(records: DataFrame, series: str = "series_id", per_day: bool = False) -> DataFrame:
    """Series and times (or days) claimed by more than one record."""
    at = F.to_date("valid_time") if per_day else F.col("valid_time")
    return records.groupBy(series, at.alias("claimed")).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")


def neighbours(records: DataFrame, targets: DataFrame, series: str) -> DataFrame:
    """Latest record at or before, and earliest at or after, every target.

    records(series, t, record_id), targets(series, t), both distinct, t in seconds. Time is cut
    into buckets: a window runs over one bucket of one series, and the record carried in from
    earlier (or back from later) buckets comes from one summary row per bucket, so a series that
    holds most of the rows is still spread over many tasks.
    """
    bucket = F.floor(F.col("t") / BUCKET_SECONDS)
    rec = F.struct("t", "record_id")
    r = records.select(series, "t", bucket.alias("b"), rec.alias("rec"), F.lit(False).alias("is_target"))
    q = targets.select(series, "t", bucket.alias("b"), F.lit(None).cast(r.schema["rec"].dataType).alias("rec"),
                       F.lit(True).alias("is_target"))
    both = r.unionByName(q)
    inside = Window.partitionBy(series, "b").orderBy("t")
    local = both.withColumn("before", F.last("rec", True).over(
        inside.rangeBetween(Window.unboundedPreceding, 0))).withColumn(
        "after", F.first("rec", True).over(inside.rangeBetween(0, Window.unboundedFollowing)))
    summary = both.groupBy(series, "b").agg(F.min("rec").alias("lo"), F.max("rec").alias("hi"))
    over_b = Window.partitionBy(series).orderBy("b")
    carried = summary.select(
        series, "b",
        F.last("hi", True).over(over_b.rowsBetween(Window.unboundedPreceding, -1)).alias("prev"),
        F.first("lo", True).over(over_b.rowsBetween(1, Window.unboundedFollowing)).alias("next"))
    out = local.filter("is_target").join(carried, [series, "b"])
    return out.select(series, "t", F.coalesce("before", "prev").alias("before"), F.coalesce("after", "next").alias("after"))


def _brackets(found: DataFrame, series: str, method: str, max_gap: float | None, extrapolate: bool) -> DataFrame:
    """before_id, after_id, alpha, kind from neighbours; kind names the violation when there is one."""
    if method not in _METHODS:
        raise ValueError(f"method is one of {sorted(_METHODS)}, not {method!r}")
    b, a, t = F.col("before"), F.col("after"), F.col("t")
    gap = a["t"] - b["t"]
    exact, one_sided = b["t"] == a["t"], b.isNull() | a.isNull()
    too_wide = F.lit(False) if max_gap is None else gap > max_gap
    kind = (
        F.when(b.isNull() & a.isNull(), "no_records").when(exact, "exact")
        .when(one_sided, "extrapolated" if extrapolate else "outside").when(too_wide, "gap")
        .otherwise("interpolated" if method == "linear" else "held"))
    first = F.when(one_sided, F.coalesce(b, a)).when(exact, b)
    if method == "linear":
        lo, hi = F.coalesce(first, b), F.coalesce(first, a)
        alpha = F.when(exact | one_sided, 0.0).otherwise((t - b["t"]) / gap)
    else:
        nearest = F.when(t - b["t"] <= a["t"] - t, b).otherwise(a)
        lo = hi = F.coalesce(first, nearest if method == "nearest" else b)
        alpha = F.lit(0.0)
    bad = F.col("kind").isin("no_records", "outside", "gap")
    out = found.withColumn("kind", kind).withColumn("_lo", lo).withColumn("_hi", hi).withColumn("_alpha", alpha)
    return out.select(
        series, "t", F.when(~bad, F.col("_lo")["record_id"]).alias("before_id"),
        F.when(~bad, F.col("_hi")["record_id"]).alias("after_id"), F.when(~bad, F.col("_alpha")).alias("alpha"),
        "kind", F.when(~one_sided, gap).alias("gap"))


def time_brackets(records: DataFrame, targets: DataFrame, series: str = "series_id", method: str = "linear",
                  max_gap_seconds: float | None = None, extrapolate: bool = False) -> DataFrame:
    """As-of bracket per target: (series, target, before_id, after_id, alpha, kind, gap_seconds).

    records(series, valid_time, record_id), targets(series, target). ``kind`` is exact, interpolated,
    held, extrapolated, or one of the violations outside, gap, no_records. A gap wider than allowed is a
    violation for every method.
    """
    r = records.select(series, F.unix_micros("valid_time").alias("us"), "record_id").withColumn("t", F.col("us") / 1e6)
    q = targets.select(series, F.unix_micros("target").alias("us")).distinct().withColumn("t", F.col("us") / 1e6)
    out = _brackets(neighbours(r, q, series), series, method, max_gap_seconds, extrapolate)
    return out.withColumn("target", F.timestamp_micros(F.round(F.col("t") * 1e6).cast("bigint"))).withColumn(
        "gap_seconds", F.col("gap")).drop("t", "gap")


def day_brackets(records: DataFrame, targets: DataFrame, series: str = "series_id", method: str = "linear",
                 max_gap_days: float | None = None, extrapolate: bool = False) -> DataFrame:
    """Brackets for daily means: a record stands for its whole day, and only missing days are filled.

    The blend factor uses whole days, so it does not change within a day.
    """
    day = lambda c: F.unix_date(F.to_date(c)).cast("double") * 86400.0  # noqa: E731  seconds, as the buckets are
    r = records.select(series, day("valid_time").alias("t"), "record_id")
    q = targets.select(series, day("target").alias("t")).distinct()
    gap = None if not max_gap_days else float(max_gap_days) * 86400.0
    by_day = _brackets(neighbours(r, q, series), series, method, gap, extrapolate)
    by_day = by_day.withColumn("gap_days", F.col("gap") / 86400.0).drop("gap")
    return targets.select(series, "target").withColumn("t", day("target")).join(by_day, [series, "t"]).drop("t")


def needed_records(brackets: DataFrame, series: str = "series_id") -> DataFrame:
    """Distinct record ids the brackets use; remap these once, then blend."""
    return brackets.select(series, F.explode(F.array("before_id", "after_id")).alias("record_id")).filter(
        F.col("record_id").isNotNull()).distinct()


def interpolate(values: DataFrame, brackets: DataFrame, keys: list[str], value: str = "value",
                series: str = "series_id") -> DataFrame:
    """Blend record values to targets: values(series, record_id, keys, value) -> (series, target, keys, value).

    Targets between the same two records share them, so values are shuffled once per record pair and
    the targets are exploded afterwards, in place: what moves grows with the source, not with the
    schedule. Targets that take one record alone (exact or held ones) have nothing to blend, so its values stay where they are.
    ``record_id`` and keys identify a value; a key absent from one record counts as 0 there.
    """
    b = brackets.filter(F.col("before_id").isNotNull())
    pair = [series, "before_id", "after_id"]
    # the targets of a pair travel in lists of about STEPS_AT_ONCE, however long the schedule is
    lists = settle(b.groupBy(*pair).agg(F.ceil(F.count(F.lit(1)) / STEPS_AT_ONCE).cast("int").alias("_k")))
    steps = b.join(lists, pair).groupBy(*pair, F.pmod(F.xxhash64("target"), F.col("_k")).alias("_part")).agg(
        F.collect_list(F.struct("target", "alpha")).alias("steps")).drop("_part")
    steps, same = settle(steps), F.col("before_id") == F.col("after_id")
    alone = lookup_join(values, steps.filter(same).select(series, F.col("before_id").alias("record_id"), "steps"), [series, "record_id"], "inner")
    alone = alone.withColumn("s", F.explode("steps")).select(series, F.col("s.target").alias("target"), *keys, F.coalesce(F.col(value), F.lit(0.0)).alias(value))
    ends = F.array(F.struct(F.col("before_id").alias("record_id"), F.lit(True).alias("first")),
                   F.struct(F.col("after_id").alias("record_id"), F.lit(False).alias("first")))
    sides = b.filter(~same).select(*pair).distinct().withColumn("e", F.explode(ends)).select(*pair, "e.*")
    # a record may hold most of the rows; what is joined to it is one row per record or pair
    both = lookup_join(values, sides, [series, "record_id"], "inner").groupBy(*pair, *keys).agg(
        F.sum(F.when(F.col("first"), F.col(value))).alias("_b"), F.sum(F.when(~F.col("first"), F.col(value))).alias("_a"))
    wide = lookup_join(both, steps.filter(~same), pair, "inner").withColumn("s", F.explode("steps"))
    x, y, alpha = F.coalesce("_b", F.lit(0.0)), F.coalesce("_a", F.lit(0.0)), F.col("s.alpha")
    blended = wide.select(series, F.col("s.target").alias("target"), *keys, ((1.0 - alpha) * x + alpha * y).alias(value))
    return alone.unionByName(blended)


def fill_times(values: DataFrame, records: DataFrame, start, end, step_seconds: int, keys: list[str],
               method: str = "linear", max_gap_seconds: float | None = None, extrapolate: bool = False,
               series: str = "series_id") -> tuple[DataFrame, DataFrame]:
    """Regular schedule from an irregular series on one mesh: (filled values, brackets)."""
    targets = records.select(series).distinct().withColumn("target", F.explode(schedule(start, end, step_seconds)))
    b = time_brackets(records, targets, series, method, max_gap_seconds, extrapolate)
    return interpolate(values, b, keys, series=series), b


def bracket_summary(brackets: DataFrame, series: str = "series_id") -> DataFrame:
    """Counts of exact, interpolated and held targets and the widest interpolated gap in hours."""
    k = F.col("kind")
    return brackets.groupBy(series).agg(
        F.count(F.lit(1)).alias("target_count"),
        F.sum((k == "exact").cast("bigint")).alias("exact"),
        F.sum((k == "interpolated").cast("bigint")).alias("interpolated"),
        F.sum(k.isin("held", "extrapolated").cast("bigint")).alias("held_or_nearest"),
        F.coalesce(F.max(F.when(k == "interpolated", F.col("gap_seconds") / 3600.0)), F.lit(0.0)).alias("largest_gap_hours"))


def period_token(targets: DataFrame, year: int | str, series: str = "series_id") -> DataFrame:
    """Period part of a product name per series: the year when it is covered, else first-last day.

    ``year`` is one year for all, or the name of a column that holds it; then there is a row per series and year.

    Twelve covered months make a year; with more than twelve records they must also reach the first
    and the last day. A closing record on 1 January of the next year is not extra coverage.
    """
    t = F.col("target")
    by = [series, year] if isinstance(year, str) else [series]
    year = F.col(year) if isinstance(year, str) else F.lit(year)
    own = F.year(t) == year
    per = targets.groupBy(*by).agg(
        F.min(t).alias("t0"), F.max(t).alias("t1"),
        F.countDistinct(F.when(own, F.month(t))).alias("months"), F.sum(own.cast("int")).alias("n"))

    def on(c, month, day):
        return (F.month(c) == month) & (F.dayofmonth(c) == day)

    closing = (F.year("t1") == year + 1) & on(F.col("t1"), 1, 1)
    ends = on(F.col("t0"), 1, 1) & (closing | on(F.col("t1"), 12, 31))
    whole = (F.col("months") == 12) & ((F.year("t1") == year) | closing) & ((F.col("n") <= 12) | ends)
    span = F.concat(F.date_format("t0", "yyyyMMdd"), F.lit("-"), F.date_format("t1", "yyyyMMdd"))
    return per.select(*by, F.when(whole, year.cast("string")).otherwise(span).alias("period"))
