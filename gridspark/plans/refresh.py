"""Published inventories: dense, checked, and brought up to date by computing only what changed."""
from __future__ import annotations

import dataclasses
import hashlib
import json
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridspark.operators import weights
from gridspark.operators.identity import range_digests, row_text
from gridspark.plans import inventories as IP
from gridspark.session import settle
from gridspark.sources import products

KEY = "target_key"


@dataclass(frozen=True)
class Refreshed:
    """The version after a refresh and the targets (folder names) that were computed, kept and left out."""

    version: int
    computed: list[str]
    kept: list[str]
    dropped: list[str]


def target_key(target: Column) -> Column:
    """A folder name of a time, to the second."""
    return F.date_format(target, "yyyyMMdd'T'HHmmss")


def record_fingerprints(wide: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """(keys, fingerprint) of the source values of each record, whatever the order of its rows; records combine before the shuffle."""
    found = range_digests(wide, keys, row_text(["src_id", *columns]))
    return found.select(*keys, F.col("digest").alias("fingerprint"))


def target_stamps(brackets: DataFrame, fingerprints: DataFrame, config: str, series: str = "series_id") -> DataFrame:
    """(series, target, stamp): all that a target's values depend on, in one digest: its bracket, the contents of its two records, the configuration."""
    sides = {}
    for side in ("before", "after"):
        sides[side] = fingerprints.select(series, F.col("record_id").alias(f"{side}_id"), F.col("fingerprint").alias(f"{side}_print"))
    both = brackets.join(sides["before"], [series, "before_id"], "left").join(sides["after"], [series, "after_id"], "left")
    text = row_text([series, "target", "kind", "before_id", "after_id", "alpha", "before_print", "after_print", F.lit(config).alias("config")])
    return both.select(series, "target", F.sha2(text, 256).alias("stamp"))


def refresh_inventory(path: str, wide: DataFrame, records: DataFrame, links, src_area: DataFrame | None, dst_area: DataFrame | None,
                      specs: list[IP.FieldSpec], time: IP.TimeSpec, blocks: list = (), series: str = "series_id",
                      guard: IP.Guard = IP.Guard()) -> Refreshed:
    """Bring the product of a regular inventory up to date with its sources; a folder per series and target.

    One scan gives every used record a content fingerprint. A target is computed again only if its stamp differs from that in the
    manifest: one changed record touches the targets it brackets, another configuration or other weights touch all. Only
    records of such targets are remapped. Targets that left the schedule leave the manifest. Violations of what is computed stop the
    version as a whole. The result equals that of a run from nothing.
    """
    spark = wide.sparkSession
    columns = sorted({c for s in specs for c, _ in s.terms})
    if not hasattr(links, "links"):
        links = weights.laid_out(links)  # read by the digest and by the remapping
    identity = [links.src_identity, links.dst_identity, links.n_links] if hasattr(links, "links") else weights_digest(links)
    config = hashlib.sha256(json.dumps([[dataclasses.asdict(s) for s in specs], list(blocks), identity], sort_keys=True).encode()).hexdigest()
    brackets = settle(IP.target_brackets(records, time, series))
    used = IP.timeaxis.needed_records(brackets, series)
    prints = record_fingerprints(IP.lookup_join(wide, used, [series, "record_id"], "left_semi"), [series, "record_id"], columns)
    folder = F.concat(F.lit(f"/{series}="), F.col(series), F.lit(f"/{KEY}="), target_key(F.col("target")))
    stamps = settle(target_stamps(brackets, settle(prints), config, series).withColumn("folder", folder))
    want = {r["folder"]: r["stamp"] for r in stamps.select("folder", "stamp").collect()}  # the schedule: thousands of rows
    found = products.manifest(spark, path) or {"partitions": {}, "stamps": {}}
    stale = sorted(k for k, v in want.items() if k not in found["partitions"] or found["stamps"].get(k) != v)
    gone = sorted(k for k in found["partitions"] if k not in want)
    kept = sorted(set(want) - set(stale))
    if not stale and not gone:
        return Refreshed(products.files.versions(spark, path)[-1], [], kept, [])
    changed = stamps.join(spark.createDataFrame([(k,) for k in stale], "folder string"), "folder", "left_semi").select(series, "target")
    done = IP.regular_inventory(wide, records, links, src_area, dst_area, specs, time, blocks, series, guard=guard, only=changed)
    values = done.values.withColumn(KEY, target_key(F.col("valid_time")))
    version = products.write_product(values, path, done.extras.get("summary"), done.violations, (series, KEY), stamps={k: want[k] for k in stale}, drop=gone)
    return Refreshed(version, stale, kept, gone)


def weights_digest(links: DataFrame) -> str:
    """One digest of a weight table that brings no identity of its own; of a written table it is made once."""
    if (known := getattr(links, "known_digest", None)) is None:
        found = range_digests(links, [], row_text(["dst_id", "src_id", "s"])).first()
        known = found["digest"] if found else ""
        if hasattr(links, "settled_at"):
            links.known_digest = known
    return known


def publish_dense(result: IP.Result, cells: DataFrame, axes: dict[str, Column], path: str, partition_by: tuple[str, ...],
                  cell: str = "cell_id") -> int:
    """A job's values as its product: every cell at every entry of ``axes``, zero where there is none, refused as a whole while a violation is left.

    ``axes`` are the key columns of the product beside the cell (times, fields), as array expressions.
    """
    dense = weights.densify(result.values.select(*axes, cell, "value"), cells, axes, cell=cell)
    return products.write_product(dense, path, result.extras.get("provenance"), result.violations, partition_by)
