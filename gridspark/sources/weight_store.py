"""Weights laid out once: validated, bucketed by source cell, and named by the grid and mesh they belong to."""
from __future__ import annotations

import hashlib
import json
import math
import uuid
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridspark.operators import weights as W
from gridspark.sources import files

LINK_BYTES = 24
BUCKET_BYTES = 128 << 20


class WeightsRejected(ValueError):
    """Weights break a rule or belong to another grid or mesh."""


@dataclass(frozen=True)
class StoredWeights:
    """A bucketed table of links (dst_id, src_id, s), 0-based, with the sizes and identities it was made for."""

    links: DataFrame
    n_dst: int
    n_src: int
    buckets: int
    n_links: int
    src_identity: str | None
    dst_identity: str | None


def bucket_count(spark: SparkSession, n_links: int) -> int:
    """Buckets of about ``BUCKET_BYTES``, and no fewer than a shuffle has partitions, so that the other side of a join is dealt to them."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(n_links * LINK_BYTES / BUCKET_BYTES))


def store_weights(weights: DataFrame, path: str, n_dst: int, n_src: int, src_identity: str | None = None, dst_identity: str | None = None,
                  require_full_src: bool = False, buckets: int | None = None) -> StoredWeights:
    """Validate a 0-based weight table and write it below ``path``: shuffled by source cell here, and never again.

    The table becomes current when its description is renamed into place; a writer that stops before leaves the older one.
    """
    bad = W.validate_weights(weights, n_dst, n_src, True, require_full_src).collect()
    if bad:
        raise WeightsRejected("; ".join(f"{r['rule']}: {r['n']}" for r in bad))
    spark, path = weights.sparkSession, path.rstrip("/")
    n_links = weights.count()
    buckets = buckets or bucket_count(spark, n_links)
    folder = f"{path}/links-{uuid.uuid4().hex}"
    table = _table(folder)
    links = weights.select(F.col("dst_id").cast("bigint"), F.col("src_id").cast("bigint"), F.col("s").cast("double"))
    # one file per bucket, so that a scan of the table has one partition per bucket
    links.repartition(buckets, "src_id").write.bucketBy(buckets, "src_id").sortBy("src_id").option("path", folder).saveAsTable(table)
    facts = {"folder": folder, "n_dst": n_dst, "n_src": n_src, "buckets": buckets, "n_links": n_links, "src_identity": src_identity, "dst_identity": dst_identity}
    files.publish(spark, path, json.dumps(facts))
    return open_weights(spark, path)


def open_weights(spark: SparkSession, path: str) -> StoredWeights:
    """The current table below ``path``; registered again in a session that does not know it yet."""
    found = files.current(spark, path.rstrip("/"))
    if found is None:
        raise FileNotFoundError(path)
    facts = json.loads(found[1])
    folder = facts.pop("folder")
    table = _table(folder)
    if not spark.catalog.tableExists(table):
        spark.sql(f"CREATE TABLE {table} (dst_id BIGINT, src_id BIGINT, s DOUBLE) USING parquet CLUSTERED BY (src_id) SORTED BY (src_id) "
                  f"INTO {facts['buckets']} BUCKETS LOCATION '{folder}'")
    return StoredWeights(spark.table(table), **facts)


def _table(folder: str) -> str:
    return f"weights_{hashlib.md5(folder.encode()).hexdigest()[:16]}"


def usable(spark: SparkSession, path: str, src_identity: str, dst_identity: str) -> bool:
    """Whether weights that a run generated itself may be reused: absent or mismatched ones are generated again.

    Ones without a recorded identity predate it and are reused.
    """
    try:
        have = open_weights(spark, path)
    except (FileNotFoundError, AnalysisException):
        return False
    return not mismatches(have, src_identity, dst_identity)


def mismatches(weights: StoredWeights, src_identity: str | None, dst_identity: str | None) -> dict[str, tuple[str, str]]:
    """Recorded identities that are not the given ones: name to (recorded, given)."""
    pairs = {"source_grid": (weights.src_identity, src_identity), "mesh": (weights.dst_identity, dst_identity)}
    return {k: (a, b) for k, (a, b) in pairs.items() if a is not None and b is not None and a != b}


def require(weights: StoredWeights, src_identity: str, dst_identity: str) -> None:
    """Weights that a user supplied must belong to the grid and mesh at hand: a mismatch is an error, never a rebuild."""
    if wrong := mismatches(weights, src_identity, dst_identity):
        raise WeightsRejected("; ".join(f"{k}: weights have {a}, the run has {b}" for k, (a, b) in wrong.items()))


def ensure_weights(spark: SparkSession, path: str, make, n_dst: int, n_src: int, src_identity: str, dst_identity: str, supplied: bool = False, **options) -> StoredWeights:
    """Weights for the grid and mesh at hand. Supplied ones are checked and never replaced; own ones are reused if they match, else
    made again by ``make() -> DataFrame``."""
    if supplied:
        have = open_weights(spark, path)
        require(have, src_identity, dst_identity)
        return have
    if not usable(spark, path, src_identity, dst_identity):
        return store_weights(make(), path, n_dst, n_src, src_identity, dst_identity, **options)
    return open_weights(spark, path)
