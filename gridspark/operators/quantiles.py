"""Exact percentiles without gathering or sorting all values."""
from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridspark.session import settle

#: values that are ranked in one window
AT_ONCE = 200_000


def exact_quantiles(df: DataFrame, column: str, probs: list[float], bins: int = 4096) -> DataFrame:
    """One row (prob, value): linear interpolation between order statistics; NULL is left out, no values give no rows.

    One pass counts values in ``bins`` equal steps between the smallest and the largest. Only the bins that hold a
    wanted rank are read again and ranked, repeated values counted first; a bin that still holds too many is cut
    into steps in its turn. The driver sees bin totals and the wanted order statistics.
    """
    spark = df.sparkSession
    values = settle(df.filter(F.col(column).isNotNull()).select(F.col(column).cast("double").alias("v")))
    n = values.count()
    if not n:
        return spark.createDataFrame([], "prob double, value double")
    at = {p: p * (n - 1) for p in probs}
    found = _order_statistics(values, sorted({f(x) for x in at.values() for f in (math.floor, math.ceil)}), bins)
    rows = [(float(p), found[math.floor(x)] + ((x - math.floor(x)) * (found[math.ceil(x)] - found[math.floor(x)]) if x % 1 else 0.0)) for p, x in at.items()]
    return spark.createDataFrame(rows, "prob double, value double")


def _order_statistics(values: DataFrame, ranks: list[int], bins: int) -> dict[int, float]:
    """{rank: value} of the wanted ranks, counted from zero, over values(v)."""
    finite = F.when(~F.isnan("v") & (F.abs("v") < float("inf")), F.col("v"))
    ends = values.agg(F.count(F.lit(1)).alias("n"), F.min(finite).alias("lo"), F.max(finite).alias("hi")).first()
    if ends["n"] <= AT_ONCE or ends["lo"] == ends["hi"]:
        return _ranked(values, ranks)
    width = (ends["hi"] - ends["lo"]) / bins if ends["lo"] is not None else 1.0
    step = F.least(F.floor((finite - F.lit(ends["lo"])) / F.lit(width)), F.lit(bins - 1))
    # infinite values and NaN, which counts as largest, stand outside the steps
    bin_ = F.when(F.isnan("v"), F.lit(bins + 1)).when(F.col("v") == float("inf"), F.lit(bins)).when(F.col("v") == -float("inf"), F.lit(-1)).otherwise(step)
    binned = values.withColumn("b", bin_.cast("int"))
    below, out = 0, {}
    for b, m in sorted((r["b"], r["m"]) for r in binned.groupBy("b").agg(F.count(F.lit(1)).alias("m")).collect()):
        inside = [r for r in ranks if below <= r < below + m]
        if inside:
            got = _order_statistics(settle(binned.filter(F.col("b") == b).select("v")), [r - below for r in inside], bins)
            out |= {r: got[r - below] for r in inside}
        below += m
    return out


def _ranked(values: DataFrame, ranks: list[int]) -> dict[int, float]:
    counted = values.groupBy("v").agg(F.count(F.lit(1)).alias("n"))
    upto = F.sum("n").over(Window.orderBy("v").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    wanted = F.filter(F.array(*[F.lit(r).cast("bigint") for r in ranks]), lambda r: (r >= F.col("upto") - F.col("n")) & (r < F.col("upto")))
    hits = counted.withColumn("upto", upto).select("v", F.explode(wanted).alias("r"))
    return {r["r"]: r["v"] for r in hits.collect()}
