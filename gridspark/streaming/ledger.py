"""Additive statistics of a stream in a ledger keyed by batch: late rows are kept aside, replayed batches add nothing.

Every batch of ``foreachBatch`` writes three tables under its own number, each replaced as a whole if the batch runs again: the sums of
its rows by cycle and group, its late rows, and the watermark it leaves. Sums add up, so a cycle is the sum of its
batches, whatever their number, and statistics and coefficients follow from the sums alone. A row is late if its cycle had closed
before its batch: the end of the cycle is no later than the largest time of all earlier batches less the delay. Rows without a time
are put aside with the late ones. So emitted and late rows together are all rows.
"""
from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridspark.functions.numbers import is_valid
from gridspark.operators.bias import check_predictors, normal_aggregates, solve_bias
from gridspark.operators.departures import normalised_departure
from gridspark.streaming.departures import CYCLE, HALF_CYCLE, cycle_window

PARTS = ("sums", "late", "marks")


def departure_sums() -> list[Column]:
    """Sums from which :func:`departures` are made; they add up over batches."""
    b, e = F.col("ombg"), F.col("err0")
    m = is_valid(b) & (F.col("qc0") <= 1)
    return [F.sum(is_valid(b).cast("bigint")).alias("n_file"), F.sum(m.cast("bigint")).alias("n"), F.sum(F.when(m, b)).alias("sum_b"),
            F.sum(F.when(m, b * b)).alias("sum_bb"), F.sum(F.when(m, normalised_departure(b, e))).alias("sum_jo"),
            F.sum(F.when(m & normalised_departure(b, e).isNotNull(), 1)).alias("n_jo")]


class Ledger:
    """Sums of a stream by cycle and ``by`` in folder ``path``; ``aggregates`` are named sums."""

    def __init__(self, spark: SparkSession, path: str, by: list[str], aggregates: list[Column], delay: str = "3 hours", time: str = "obs_time"):
        self.spark, self.path, self.by, self.aggregates, self.delay, self.time = spark, path.rstrip("/"), list(by), list(aggregates), delay, time

    def _read(self, part: str) -> DataFrame | None:
        try:
            return self.spark.read.parquet(f"{self.path}/{part}")
        except AnalysisException:
            return None

    def _write(self, part: str, rows: DataFrame, batch_id: int) -> None:
        # the folder of a batch is replaced as a whole
        rows.write.mode("overwrite").parquet(f"{self.path}/{part}/batch={batch_id}")

    def watermark(self, before: int | None = None) -> datetime | None:
        """Largest time less the delay over all batches, or those before one."""
        marks = self._read("marks")
        if marks is None:
            return None
        marks = marks if before is None else marks.where(F.col("batch") < before)
        return marks.agg(F.max(F.col("largest") - F.expr(f"INTERVAL {self.delay}"))).first()[0]

    def add(self, batch: DataFrame, batch_id: int) -> None:
        """``foreachBatch`` function. The mark is written last: a batch that stops half-way runs again and replaces its own."""
        closed = self.watermark(batch_id)
        rows = batch.withColumn("window", cycle_window(self.time))
        late = F.lit(False) if closed is None else F.coalesce(F.col("window.end") <= F.lit(closed), F.lit(False))
        rows = rows.withColumn("cycle", F.col("window.start") + F.expr(f"INTERVAL {HALF_CYCLE}")).withColumn("_late", late).drop("window")
        # a window leaves rows without a time out, so they are put aside here
        timeless = batch.where(F.col(self.time).isNull()).withColumn("cycle", F.lit(None).cast("timestamp"))
        self._write("late", rows.where("_late").drop("_late").unionByName(timeless), batch_id)
        self._write("sums", rows.where("not _late").groupBy("cycle", *self.by).agg(*self.aggregates), batch_id)
        self._write("marks", batch.agg(F.max(self.time).alias("largest")), batch_id)

    def sums(self, open_cycles: bool = False) -> DataFrame:
        """Sums per cycle and group over all batches that are complete; closed cycles only, unless ``open_cycles``."""
        found = self._read("sums")
        if found is None:
            raise FileNotFoundError(self.path)
        found = found.join(self._read("marks").select("batch").distinct(), "batch", "left_semi")
        names = [c for c in found.columns if c not in ("batch", "cycle", *self.by)]
        total = found.groupBy("cycle", *self.by).agg(*[F.sum(c).alias(c) for c in names])
        if open_cycles:
            return total
        end = F.col("cycle") + F.expr(f"INTERVAL {CYCLE}") - F.expr(f"INTERVAL {HALF_CYCLE}")
        return total.where(end <= F.lit(self.watermark()))

    def late(self) -> DataFrame:
        """Rows that came after their cycle had closed, with their cycle and batch; rows without a time have no cycle."""
        return self._read("late")

    def run(self, stream: DataFrame, checkpoint: str) -> None:
        """Take all that the stream has now; a later call goes on where this one ended."""
        stream.writeStream.option("checkpointLocation", checkpoint).foreachBatch(self.add).trigger(availableNow=True).start().awaitTermination()


def departures(sums: DataFrame, by: list[str]) -> DataFrame:
    """n_file, n, RMS, mean and mean squared normalised background departure per cycle and group, from :func:`departure_sums`."""
    n = F.when(F.col("n") > 0, F.col("n"))
    return sums.select("cycle", *by, "n_file", "n", F.sqrt(F.col("sum_bb") / n).alias("omb_rms"), (F.col("sum_b") / n).alias("omb_mean"),
                       (F.col("sum_jo") / F.when(F.col("n_jo") > 0, F.col("n_jo"))).alias("jo_b"))


def normal_ledger(spark: SparkSession, path: str, predictors: list[str], by: list[str], sample: DataFrame, delay: str = "3 hours") -> Ledger:
    """A ledger of normal-equation sums; ``sample`` gives the columns."""
    check_predictors(sample, predictors)
    return Ledger(spark, path, by, normal_aggregates(predictors), delay)


def coefficients(sums: DataFrame, predictors: list[str], by: list[str]) -> DataFrame:
    """Bias coefficients of the closed cycles, from the sums of a :func:`normal_ledger`."""
    return solve_bias(sums, predictors, ["cycle", *by])


def each_batch(ledger: Ledger, then: Callable[[DataFrame, int], None]) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function that adds a batch and hands the closed cycles on."""

    def run(batch: DataFrame, batch_id: int) -> None:
        ledger.add(batch, batch_id)
        then(ledger.sums(), batch_id)

    return run
