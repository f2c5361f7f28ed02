import datetime as dt

import pytest
from conftest import rows
from pyspark.sql import functions as F

from gridspark.operators import weights as W
from gridspark.plans import inventories as IP
from gridspark.plans import refresh as R
from gridspark.sources import products
from gridspark.sources import weight_store as WS
from gridspark.sources.files import Conflict  # noqa: F401

SPECS = [IP.FieldSpec("a", (("x", 1.0),)), IP.FieldSpec("b", (("x", 1.0), ("y", 2.0)))]
TIME = IP.TimeSpec("2024-01-01 00:00:00", "2024-01-05 00:00:00", "hourly", 12.0)


def source(spark, change=()):
    days = [dt.datetime(2024, 1, d) for d in (1, 2, 3, 5)]
    records = spark.createDataFrame([("s", f"r{d.day}", d) for d in days], "series_id string, record_id string, valid_time timestamp")
    wide = [("s", f"r{d.day}", i, d.day + i * 0.5 + (100.0 if (d.day, i) in change else 0.0), float(i)) for d in days for i in range(4)]
    return spark.createDataFrame(wide, "series_id string, record_id string, src_id bigint, x double, y double"), records


def links(spark, last=0.75):
    return spark.createDataFrame([(0, 0, 0.25), (0, 1, 0.75), (1, 2, 1.0), (2, 3, 1 - last), (2, 0, last)], "dst_id bigint, src_id bigint, s double")


def published(spark, path):
    return rows(products.read_product(spark, path).select("target_key", "field", "cell_id", "value"))


def test_one_changed_record_rewrites_its_targets_only(spark, tmp_path):
    path, clean = str(tmp_path / "p"), str(tmp_path / "clean")
    wide, records = source(spark)
    first = R.refresh_inventory(path, wide, records, links(spark), None, None, SPECS, TIME)
    assert first.version == 1 and len(first.computed) == 9 and not first.kept
    again = R.refresh_inventory(path, wide.repartition(3), records, links(spark), None, None, SPECS, TIME)
    assert again.version == 1 and not again.computed and len(again.kept) == 9
    wide, _ = source(spark, {(2, 3)})
    second = R.refresh_inventory(path, wide, records, links(spark), None, None, SPECS, TIME)
    assert [k[-15:] for k in second.computed] == ["20240101T120000", "20240102T000000", "20240102T120000"]
    R.refresh_inventory(clean, wide, records, links(spark), None, None, SPECS, TIME)
    assert published(spark, path) == published(spark, clean)
    # a record comes in: the targets of its gap; a shorter schedule leaves targets out
    more = records.unionByName(spark.createDataFrame([("s", "r1", dt.datetime(2024, 1, 4))], "series_id string, record_id string, valid_time timestamp"))
    short = IP.TimeSpec(TIME.start, "2024-01-04 12:00:00", "hourly", 12.0)
    third = R.refresh_inventory(path, wide, more, links(spark), None, None, SPECS, short)
    assert [k[-15:] for k in third.computed] == ["20240103T120000", "20240104T000000", "20240104T120000"] and [k[-15:] for k in third.dropped] == ["20240105T000000"]
    other = R.refresh_inventory(path, wide, more, links(spark, 0.5), None, None, SPECS, short)
    assert len(other.computed) == 8 and not other.kept
    bad = wide.withColumn("x", F.when((F.col("record_id") == "r5") & (F.col("src_id") == 1), float("nan")).otherwise(F.col("x")))
    with pytest.raises(products.ProductRejected, match="missing_value"):
        R.refresh_inventory(path, bad, more, links(spark, 0.5), None, None, SPECS, short)
    assert products.files.versions(spark, path)[-1] == other.version


def test_stored_weights_are_not_shuffled_again(spark, tmp_path):
    path = str(tmp_path / "w")
    have = WS.store_weights(links(spark), path, 3, 4, "grid", "mesh", buckets=4)
    assert (have.n_src, have.n_dst, have.n_links) == (4, 3, 5)
    wide, records = source(spark)
    values = wide.select("record_id", "src_id", F.col("x").alias("value"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = IP.weights.apply_weights(values, have, ["record_id"])
        plan = got._jdf.queryExecution().sparkPlan().toString() + got._jdf.queryExecution().executedPlan().toString()
        below = plan.split("FileScan parquet spark_catalog")[0].splitlines()[-4:]
        assert "Bucketed: true" in plan and not any("Exchange" in x for x in below)
        assert rows(got) == rows(IP.weights.apply_weights(values, links(spark), ["record_id"]))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    spark.sql(f"DROP TABLE {WS._table(WS.json.loads(WS.files.current(spark, path)[1])['folder'])}")  # as in a new session
    assert rows(WS.open_weights(spark, path).links) == rows(links(spark))
    with pytest.raises(WS.WeightsRejected, match="row_sum"):
        WS.store_weights(links(spark).withColumn("s", F.col("s") * 2), path, 3, 4)
    assert WS.open_weights(spark, path).n_links == 5


def test_own_weights_are_made_again_supplied_ones_are_not(spark, tmp_path):
    path, made = str(tmp_path / "w"), []

    def make():
        made.append(1)
        return links(spark)

    for mesh, n in (("m", 1), ("m", 1), ("other", 2)):
        assert WS.ensure_weights(spark, path, make, 3, 4, "g", mesh).dst_identity == mesh and len(made) == n
    with pytest.raises(WS.WeightsRejected, match="mesh: weights have other, the run has m"):
        WS.ensure_weights(spark, path, make, 3, 4, "g", "m", supplied=True)
    assert len(made) == 2
    WS.store_weights(links(spark), path, 3, 4)  # without identities
    assert WS.ensure_weights(spark, path, make, 3, 4, "g", "m", supplied=True).n_links == 5 and WS.usable(spark, path, "g", "m")


def test_guards_of_the_inventory_jobs(spark, tmp_path):
    wide, records = source(spark)
    grids = spark.createDataFrame([("f1", "g"), ("f2", "g"), ("f3", "h")], "grid_id string, fingerprint string")
    have = WS.store_weights(links(spark), str(tmp_path / "w"), 3, 4, "g", "mesh")

    def rules(w, guard):
        return {r["rule"] for r in IP.regular_inventory(wide, records, w, None, None, SPECS, TIME, guard=guard).violations.collect()}

    assert rules(have, IP.Guard(grids=grids.where("grid_id <> 'f3'"), dst_identity="mesh")) == set()
    assert rules(have, IP.Guard(grids=grids, dst_identity="this")) == {"source_grid", "weights_identity"}
    assert rules(have, IP.Guard(is_global=True)) == {"conservation_unchecked"}
    assert rules(links(spark), IP.Guard(n_src=5, n_dst=3)) == {"source_length"}
    bad = links(spark).where("dst_id <> 1").withColumn("s", F.col("s") * 1.1)
    assert "weights" in rules(bad, IP.Guard(n_src=4, n_dst=3, src_identity="h", grids=grids))
    sector = spark.createDataFrame([(1, 0, "sum", 1.0)], "month int, src_id bigint, sector string, value double")
    found = IP.sectoral_inventory(sector, bad, [], {}, None, "x", "x", 1, guard=IP.Guard(n_src=4, n_dst=3, grids=grids, src_identity="g"))
    assert {r["rule"] for r in found.violations.collect()} == {"weights", "source_grid"}


def test_dense_product_of_a_job(spark, tmp_path):
    wide, records = source(spark)
    done = IP.regular_inventory(wide, records, links(spark), None, None, SPECS, TIME)
    done.values = done.values.where("cell_id <> 1")
    axes = {"valid_time": F.sequence(*(F.lit(x).cast("timestamp") for x in (TIME.start, TIME.end)), F.expr("interval 12 hours")), "field": F.array(F.lit("a"), F.lit("b"))}
    cells = spark.range(4).select(F.col("id").alias("cell_id"))
    R.publish_dense(done, cells, axes, str(tmp_path / "p"), ("field",))
    got = products.read_product(spark, str(tmp_path / "p"))
    assert got.count() == 9 * 2 * 4 and got.where("value = 0").count() == 9 * 2 * 2 and got.where("value is null").count() == 0
    done.violations = spark.createDataFrame([("x", "y")], "rule string, detail string")
    with pytest.raises(products.ProductRejected):
        R.publish_dense(done, cells, axes, str(tmp_path / "q"), ("field",))
    assert not (tmp_path / "q").exists()


def test_links_are_laid_out_and_digested_once(spark, tmp_path, monkeypatch):
    wide, records = source(spark)
    digests, inner = [], R.range_digests

    def watched(rows_, by, text):
        digests.append((by, rows_._jdf.queryExecution().optimizedPlan().toString()))
        return inner(rows_, by, text)

    monkeypatch.setattr(R, "range_digests", watched)
    heavy = links(spark).groupBy("dst_id", "src_id").agg(F.sum("s").alias("s"))
    R.refresh_inventory(str(tmp_path / "p"), wide, records, heavy, None, None, SPECS, TIME)
    # the digest reads the written table, it does not derive the links again
    assert "Aggregate" not in next(p for by, p in digests if not by)
    have, digests[:] = W.laid_out(links(spark)), []
    for k in range(2):
        R.refresh_inventory(str(tmp_path / f"q{k}"), wide, records, have, None, None, SPECS, TIME)
    assert len([by for by, _ in digests if not by]) == 1
    assert published(spark, str(tmp_path / "p")) == published(spark, str(tmp_path / "q1"))
    # checks of the guard read it as well
    seen = []
    monkeypatch.setattr(W, "validate_weights", lambda table, *a, **k: seen.append(hasattr(table, "settled_at")) or spark.createDataFrame([], "rule string, n bigint"))
    IP.regular_inventory(wide, records, heavy, None, None, SPECS, TIME, guard=IP.Guard(n_src=4, n_dst=3))
    assert seen == [True]
