import time

from pyspark.sql import functions as F

from gridspark.session import SHUFFLE_KEY, release, settle, settled


def shuffle_files(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().mkString("\n")
    return {f for f in files.split("\n") if "/shuffle_" in f and f.endswith(".data")}


def test_shuffles_of_a_settled_table_go_when_it_is_written(spark):
    before, setting = shuffle_files(spark), spark.conf.get(SHUFFLE_KEY, None)
    table = settle(spark.range(100_000).groupBy((F.col("id") % 50_000).alias("k")).agg(F.count(F.lit(1)).alias("n")).orderBy("k"))
    for _ in range(50):  # the files are removed by another thread
        if not (left := shuffle_files(spark) - before):
            break
        time.sleep(0.1)
    assert not left
    assert table.count() == 50_000 and spark.conf.get(SHUFFLE_KEY, None) == setting


def test_release_keeps_what_is_named_and_what_was_there(spark):
    old = settle(spark.range(3))
    before = set(settled(spark))
    gone, kept = settle(spark.range(4)), settle(spark.range(5))
    release(spark, before, kept)
    assert gone.settled_at not in settled(spark)
    assert (old.count(), kept.count()) == (3, 5)
