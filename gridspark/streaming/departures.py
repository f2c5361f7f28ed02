"""Departure statistics and bias sums over a stream of observations.

The cycle is a tumbling window shifted by half its length, so that it is centred on the analysis time.
State holds one row of sums per open window and group; late rows are bounded by the watermark.
"""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridspark.functions.numbers import is_valid
from gridspark.operators.bias import check_predictors, normal_aggregates, solve_bias
from gridspark.operators.departures import normalised_departure

CYCLE, HALF_CYCLE = "6 hours", "3 hours"


def cycle_window(time: str = "obs_time") -> Column:
    """Window of one cycle that starts half a cycle before its label."""
    return F.window(time, CYCLE, CYCLE, HALF_CYCLE)


def _labelled(df: DataFrame) -> DataFrame:
    label = F.col("window.start") + F.expr(f"interval {HALF_CYCLE}")
    return df.withColumn("cycle", label).drop("window")


def stream_departures(obs: DataFrame, by: list[str], watermark: str = "3 hours", time: str = "obs_time") -> DataFrame:
    """n_file, n, RMS, mean and mean squared normalised background departure per cycle and group."""
    b, e = F.col("ombg"), F.col("err0")
    m = is_valid(b) & (F.col("qc0") <= 1)
    stats = obs.withWatermark(time, watermark).groupBy(cycle_window(time), *by).agg(
        F.sum(is_valid(b).cast("bigint")).alias("n_file"), F.sum(m.cast("bigint")).alias("n"),
        F.sqrt(F.avg(F.when(m, b * b))).alias("omb_rms"), F.avg(F.when(m, b)).alias("omb_mean"),
        F.avg(F.when(m, normalised_departure(b, e))).alias("jo_b"))
    return _labelled(stats)


def stream_normal_sums(obs: DataFrame, predictors: list[str], by: list[str], watermark: str = "3 hours",
                       time: str = "obs_time") -> DataFrame:
    """Normal-equation sums per cycle and group; they add up over batches."""
    check_predictors(obs, predictors)
    sums = obs.withWatermark(time, watermark).groupBy(cycle_window(time), *by).agg(*normal_aggregates(predictors))
    return _labelled(sums)


def solve_each_batch(predictors: list[str], by: list[str], sink: Callable[[DataFrame, int], None]) -> Callable:
    """``foreachBatch`` function: solve the closed cycles of a batch and hand the coefficients to ``sink``."""

    def run(batch: DataFrame, batch_id: int) -> None:
        sink(solve_bias(batch, predictors, ["cycle", *by]), batch_id)

    return run
