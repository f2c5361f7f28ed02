"""Session defaults and the shared working folder."""
from __future__ import annotations

import atexit
import contextlib
import shutil
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"
BATCH_KEY = "spark.sql.execution.arrow.maxRecordsPerBatch"
PARTITION_KEY = "spark.sql.requireAllClusterKeysForCoPartition"
SHUFFLE_KEY = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_local_dirs: dict[str, str] = {}
_settled: dict[str, list[str]] = {}


def get_session(app: str = "gridspark", **conf: str) -> SparkSession:
    """A session with the settings the operators assume: UTC, AQE and skew handling on."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.sources.partitionOverwriteMode", "dynamic")
        # sides already partitioned by part of the join key are joined as they are
        .config("spark.sql.requireAllClusterKeysForCoPartition", "false")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def work_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, taken from ``spark.checkpoint.dir``.

    Only a local master without that setting gets a temporary folder, removed when the process ends; a cluster
    without it is an error, since a machine-local path would be lost with its host.
    """
    configured = spark.conf.get(CHECKPOINT_KEY, None) or spark.sparkContext.getCheckpointDir()
    if configured:
        return str(configured).rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_KEY} to a folder shared by all executors")
    app = spark.sparkContext.applicationId
    if app not in _local_dirs:
        _local_dirs[app] = tempfile.mkdtemp(prefix="gridspark-")
        atexit.register(shutil.rmtree, _local_dirs[app], ignore_errors=True)
    return _local_dirs[app]


@contextlib.contextmanager
def small_batches(spark: SparkSession, rows: int = 1000) -> Iterator[None]:
    """Steps run inside hand ``rows`` rows at a time to Python: for rows of kilobytes, of which the usual batch would fill
    tens of megabytes in the executor and again in each worker."""
    before = spark.conf.get(BATCH_KEY)
    spark.conf.set(BATCH_KEY, str(min(rows, int(before)) if int(before) > 0 else rows))
    try:
        yield
    finally:
        spark.conf.set(BATCH_KEY, before)


@contextlib.contextmanager
def keep_partitions(spark: SparkSession) -> Iterator[None]:
    """Steps run inside join sides that are partitioned alike by part of the join key as they lie, also in a plain session."""
    before = spark.conf.get(PARTITION_KEY)
    spark.conf.set(PARTITION_KEY, "false")
    try:
        yield
    finally:
        spark.conf.set(PARTITION_KEY, before)


@contextlib.contextmanager
def drop_shuffles(spark: SparkSession) -> Iterator[None]:
    """Queries run inside remove their shuffle files when they end, rather than when the driver happens to collect its garbage."""
    before = spark.conf.get(SHUFFLE_KEY, None)
    spark.conf.set(SHUFFLE_KEY, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(SHUFFLE_KEY)
        else:
            spark.conf.set(SHUFFLE_KEY, before)


def settle(df: DataFrame) -> DataFrame:
    """Write ``df`` once to the shared folder and continue from the written table.

    This cuts lineage in a way that survives executor loss, and gives Catalyst true
    file sizes, so a small result is broadcast by size check and a large one is not. The shuffles of the
    write are removed at its end, as only the table is read again.
    """
    spark = df.sparkSession
    path = f"{work_dir(spark)}/gridspark/{spark.sparkContext.applicationId}/{uuid.uuid4().hex}"
    with drop_shuffles(spark):
        df.write.parquet(path)
    _settled.setdefault(spark.sparkContext.applicationId, []).append(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.settled_at = path
    return out


def settled(spark: SparkSession) -> list[str]:
    """Paths of the tables that this application settled and has not discarded, oldest first."""
    return list(_settled.get(spark.sparkContext.applicationId, []))


def release(spark: SparkSession, before: set[str], *kept: DataFrame) -> None:
    """Remove the tables settled since ``before`` but ``kept``; for a step whose other tables no later step reads."""
    stay = before | {df.settled_at for df in kept}
    discard(spark, [p for p in settled(spark) if p not in stay])


def discard(spark: SparkSession, paths: list[str] | None = None) -> None:
    """Remove settled tables, by default all of this application; for the owner of a run or step, when what is made of them is written."""
    app = spark.sparkContext.applicationId
    for path in [f"{work_dir(spark)}/gridspark/{app}"] if paths is None else paths:
        folder = spark._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
    gone = set(settled(spark) if paths is None else paths)
    _settled[app] = [p for p in settled(spark) if p not in gone]
