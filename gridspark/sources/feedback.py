"""Observation feedback tables: parts, sentinels, repairs, schema migration."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridspark.functions.numbers import FEEDBACK_FILL, clear_fill, to_int

MISSING_CHANNEL = -999


def clear_sentinels(df: DataFrame, fill: float = FEEDBACK_FILL) -> DataFrame:
    """Fill constants of every floating column become NULL, in one projection."""
    return df.select(*[
        clear_fill(F.col(f.name), fill).alias(f.name) if isinstance(f.dataType, (T.DoubleType, T.FloatType)) else F.col(f.name)
        for f in df.schema.fields])


def read_feedback(spark: SparkSession, paths: list[str], fill: float = FEEDBACK_FILL) -> DataFrame:
    """All parts of an observation space as one table along location."""
    return clear_sentinels(spark.read.parquet(*paths), fill)


def concat_parts(parts: list[DataFrame], fill: float = FEEDBACK_FILL) -> DataFrame:
    """Union of parts that must have the same columns."""
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=False)
    return clear_sentinels(out, fill)


def repair_int_columns(df: DataFrame, columns: list[str], fill: float = FEEDBACK_FILL) -> DataFrame:
    """Float columns that hold integers become integers, fill becomes NULL."""
    return df.withColumns({c: to_int(F.col(c), fill) for c in columns if c in df.columns})


def has_missing_channel(df: DataFrame, by: list[str], channel: str = "channel") -> DataFrame:
    """Groups and whether any of their channel ids is the missing id."""
    return df.groupBy(*by).agg(F.bool_or(F.col(channel) == MISSING_CHANNEL).alias("missing_channel"))


def migrate_schema(df: DataFrame, registry: list[dict]) -> tuple[DataFrame, list[str]]:
    """(table under current names and types, problems).

    A registry entry has ``name`` and optionally ``type`` (default float), ``deprecated`` names and
    ``remove``. Deprecated names are renamed, unless the current name is there too, removed ones are
    dropped, known ones are cast. Columns the registry does not know are kept and reported.
    """
    problems, known = [], set()
    out = df
    for entry in registry:
        name = entry["name"]
        known.add(name)
        for old in entry.get("deprecated", []):
            if old in out.columns:
                if name in out.columns:
                    problems.append(f"{old}: {name} is present too, dropped")
                    out = out.drop(old)
                else:
                    out = out.withColumnRenamed(old, name)
        if entry.get("remove"):
            out = out.drop(name)
        elif name in out.columns:
            out = out.withColumn(name, F.col(name).cast(entry.get("type", "float")))
    problems += [f"{c}: not in the registry" for c in out.columns if c not in known]
    return out, problems
