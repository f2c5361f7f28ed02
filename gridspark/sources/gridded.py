"""Gridded inventories: path choice, aliases, records and ingest checks."""
from __future__ import annotations

import os
import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridspark.functions.numbers import missing_policy

LAT_NAMES, LON_NAMES = ["latitude", "lat"], ["longitude", "lon"]


def first_available(spark: SparkSession, patterns: list[str], **tokens) -> list[str]:
    """Paths of the first pattern that matches anything; lists the patterns tried when none does.

    A pattern with an undefined environment variable is skipped. Names come from a listing of the store, no file is read.
    """
    tried = []
    for pattern in patterns:
        path = os.path.expandvars(pattern)
        if re.search(r"\$\{?[A-Za-z_]", path):
            tried.append(f"{pattern} (variable not set)")
            continue
        path = path.format(**tokens)
        tried.append(path)
        place = spark._jvm.org.apache.hadoop.fs.Path(path)
        found = place.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(place)
        if found:
            return sorted(f.getPath().toString() for f in found)
    raise FileNotFoundError(f"no input found; tried {tried}")


def resolve_alias(columns: list[str], aliases: list[str], ignore_case: bool = False) -> str:
    """First alias among the columns."""
    have = {c.strip().lower(): c for c in columns} if ignore_case else {c: c for c in columns}
    for alias in aliases:
        hit = have.get(alias.strip().lower() if ignore_case else alias)
        if hit is not None:
            return hit
    raise KeyError(f"none of {aliases} among {columns}")


def select_aliases(df: DataFrame, wanted: dict[str, list[str]], keep: list[str] = (), ignore_case: bool = False) -> DataFrame:
    """Columns under their canonical names; decided from the schema before any job."""
    return df.select(*keep, *[F.col(resolve_alias(df.columns, a, ignore_case)).alias(n) for n, a in wanted.items()])


def source_records(df: DataFrame, offset_hours: float = 0.0, by: list[str] = ("series_id", "record_id")) -> DataFrame:
    """Distinct records with their valid time moved by a fixed offset."""
    moved = F.col("valid_time") + F.make_dt_interval(secs=F.lit(float(offset_hours) * 3600.0))
    return df.select(*by, moved.alias("valid_time")).distinct()


def clean_values(df: DataFrame, policy: str = "error", value: str = "value") -> DataFrame:
    """Apply the missing value policy."""
    return df.withColumn(value, missing_policy(F.col(value), policy))


def missing_values(df: DataFrame, by: list[str], value: str = "value") -> DataFrame:
    """Groups with values missing under the ``error`` policy."""
    return df.groupBy(*by).agg(F.sum(F.col(value).isNull().cast("bigint")).alias("n_missing")).filter("n_missing > 0")
