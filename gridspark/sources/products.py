"""Mesh products: runs of checked partitions, and versions of a manifest that names the run of each partition."""
from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from gridspark.functions.numbers import is_finite
from gridspark.sources import files


class ProductRejected(ValueError):
    """A fatal rule has rows; nothing was written."""


def violation_table(named: dict[str, DataFrame]) -> DataFrame:
    """(rule, detail) of any number of check results, each row rendered as JSON."""
    out = None
    for rule, df in named.items():
        part = df.select(F.lit(rule).alias("rule"), F.to_json(F.struct(*df.columns)).alias("detail"))
        out = part if out is None else out.unionByName(part)
    return out


def violation_counts(named: dict[str, DataFrame]) -> DataFrame:
    """(rule, n) of any number of check results, also of those without a row."""
    out = None
    for rule, df in named.items():
        part = df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(rule).alias("rule"), "n")
        out = part if out is None else out.unionByName(part)
    return out


def finite_violations(values: DataFrame, by: list[str], value: str = "value") -> DataFrame:
    """Groups holding NULL, NaN or infinite values."""
    return values.groupBy(*by).agg(F.sum((~is_finite(F.col(value))).cast("bigint")).alias("n_bad")).filter("n_bad > 0")


def incomplete_steps(values: DataFrame, fields: list[str], by: list[str]) -> DataFrame:
    """Time steps that do not hold every field."""
    per = values.groupBy(*by).agg(F.collect_set(F.when(F.col("field").isin(fields), F.col("field"))).alias("have"))
    lost = F.array_except(F.array(*[F.lit(f) for f in fields]), F.col("have"))
    return per.select(*by, F.explode(lost).alias("missing"))


def write_product(values: DataFrame, path: str, provenance: DataFrame | None = None, violations: DataFrame | None = None,
                  partition_by: tuple[str, ...] = ("product", "field"), value: str = "value", stamps: dict[str, str] | None = None,
                  drop: list[str] = (), rebalance: bool = True) -> int:
    """Publish a version of a product: single-precision Parquet, partitioned by product and field; all or nothing.

    Refuses when any violation exists or when a value is not finite in single precision. Values and provenance of a run go to a folder of
    their own and are checked there. The manifest, which names the run of each partition, then takes the new partitions over
    those of the version this run started from, leaves out the folders in ``drop``, and is renamed into place. So a writer that
    stops between any two steps leaves the product as it was, and of two writers at once the later one fails
    (:class:`gridspark.sources.files.Conflict`). ``stamps`` records a text per partition folder. Rows are rebalanced by partition
    first: small ones share a file and a large one is split over tasks; without ``rebalance`` they are written where they lie. Returns the version.
    """
    if violations is not None and (found := violations.limit(20).collect()):
        raise ProductRejected("; ".join(f"{r['rule']}: {r['detail']}" for r in found))
    spark, path = values.sparkSession, path.rstrip("/")
    before = files.current(spark, path)
    have = json.loads(before[1]) if before else {"partitions": {}, "stamps": {}}
    parts = [c for c in partition_by if c in values.columns]
    if before and (have["partition_by"], have["value"]) != (parts, value):
        raise ProductRejected(f"the product is partitioned by {have['partition_by']}, not by {parts}")
    out = values.withColumn(value, F.col(value).cast("float"))
    out = out.hint("rebalance", *parts) if parts and rebalance else out
    run = uuid.uuid4().hex
    folder = f"{path}/data/run={run}"
    try:
        out.write.partitionBy(*parts).parquet(folder)
        bad = finite_violations(spark.read.schema(out.schema).parquet(folder), parts, value).limit(20).collect()
        if bad:
            raise ProductRejected("; ".join(f"not finite: {r.asDict()}" for r in bad))
        if provenance is not None:
            provenance.write.json(f"{path}/provenance/{run}")
        new = _partitions(spark, folder, len(parts))
        manifest = {
            "partition_by": parts, "value": value, "schema": json.loads(out.schema.json()),
            "partitions": {k: v for k, v in have["partitions"].items() if k not in drop} | dict.fromkeys(new, run),
            "stamps": {k: v for k, v in have["stamps"].items() if k not in drop} | {k: v for k, v in (stamps or {}).items() if k in new},
            "provenance": run if provenance is not None else have.get("provenance")}
        return files.publish(spark, path, json.dumps(manifest, sort_keys=True), before[0] if before else 0)
    except Exception:
        for p in (folder, f"{path}/provenance/{run}"):
            files.delete(spark, p)
        raise


def manifest(spark: SparkSession, path: str, version: int | None = None) -> dict | None:
    """The description of a version (by default the newest), None without a product."""
    path = path.rstrip("/")
    if version is not None:
        return json.loads(files.read(spark, path, version))
    found = files.current(spark, path)
    return json.loads(found[1]) if found else None


def read_product(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """The partitions that a version names, whichever run wrote them; writers at work are not seen."""
    found = manifest(spark, path, version)
    if found is None:
        raise FileNotFoundError(path)
    schema = StructType.fromJson(found["schema"])
    base = f"{path.rstrip('/')}/data"
    folders = [f"{base}/run={run}{folder}" for folder, run in sorted(found["partitions"].items())]
    if not folders:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema.add("run", "string")).option("basePath", base).parquet(*folders).drop("run")


def vacuum(spark: SparkSession, path: str, keep: int = 2) -> list[str]:
    """Remove the runs that none of the newest ``keep`` versions names, and older versions; the removed runs.

    For a time when no writer is at work: a run that is not published yet is not named either.
    """
    path = path.rstrip("/")
    have = files.versions(spark, path)
    named = [manifest(spark, path, v) for v in have[-keep:]]
    used = {r for m in named for r in m["partitions"].values()} | {m["provenance"] for m in named}
    gone = []
    for folder, name in ((f"{path}/data", lambda n: n.removeprefix("run=")), (f"{path}/provenance", str)):
        fs, p = files.file_system(spark, folder)
        for child in [c.getPath() for c in fs.listStatus(p)] if fs.exists(p) else []:
            if (run := name(child.getName())) not in used:
                fs.delete(child, True)
                gone.append(run)
    for v in have[:-keep]:
        files.delete(spark, f"{path}/versions/{v:012d}")
    return sorted(set(gone))


def _partitions(spark: SparkSession, path: str, depth: int) -> list[str]:
    """Partition folders below ``path``, as ``/a=1/b=2``; a product has a handful of products and fields."""
    found = [""]
    for _ in range(depth):
        below = []
        for f in found:
            fs, p = files.file_system(spark, path + f)
            below += [f"{f}/{s.getPath().getName()}" for s in fs.listStatus(p) if s.isDirectory()]
        found = below
    return found


def inventory_provenance(summary: DataFrame, facts: dict) -> DataFrame:
    """Bracket counts joined with run facts (scaling, fingerprints, offset) as one row per series."""
    return summary.select("*", *[F.lit(json.dumps(v, sort_keys=True) if isinstance(v, (dict, list)) else v).alias(k)
                                 for k, v in facts.items()])


def reuse_decision(spark: SparkSession, path: str, want_offset: float) -> str:
    """``build`` without a product, ``rebuild`` if its recorded time offset differs, else ``reuse``.

    A product without a record predates it and is reused.
    """
    found = manifest(spark, path)
    if found is None:
        return "build"
    if not found["provenance"]:
        return "reuse"
    record = spark.read.json(f"{path.rstrip('/')}/provenance/{found['provenance']}")
    if "source_time_offset_hours" not in record.columns:
        return "reuse"
    row = record.select(F.max("source_time_offset_hours").alias("o")).first()
    return "reuse" if row["o"] is None or float(row["o"]) == want_offset else "rebuild"


def widen_fields(values: DataFrame, fields: list[str], keys: list[str]) -> DataFrame:
    """One column per field from a given list, so no pass is needed to find the names."""
    return values.groupBy(*keys).pivot("field", fields).agg(F.first("value"))
