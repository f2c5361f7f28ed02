import datetime as dt

import duckdb
import numpy as np
import pandas as pd
import pytest
from conftest import rows
from pyspark.sql import functions as F

import __spark_entry__ as entry
from catalog.check import compare
from catalog.registry import TABLES
from gridspark.operators import bias as B
from gridspark.operators import departures as D
from gridspark.operators import qc as Q
from gridspark.operators import state as ST
from gridspark.plans import inventories as IP
from gridspark.sources import feedback as FB
from gridspark.sources import gridded as GR
from gridspark.sources import products as PR
from gridspark.streaming import departures as SD

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", ["weight_apply", "nearest_cell", "time_interpolate", "day_resolution", "departure_stats", "bias_solve", "qc_rules",
                                  "rtps", "state_carry", "fire_text_parse", "job_regular_inventory", "job_fire_size", "stream_departures"])
def test_queries_agree_with_sql(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{FOLDER}/{t}.parquet')")
    _, n, verdict = compare(spark, con, name, FOLDER)
    assert verdict.startswith("ok") and n > 0, verdict


def test_entry_runs(spark):
    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())


def training_rows(n=300, seed=3):
    rng = np.random.default_rng(seed)
    p1 = rng.normal(size=n)
    return pd.DataFrame(dict(channel=rng.integers(1, 3, n).astype("int32"), p0=1.0, p1=p1, obs=2.0 + 0.5 * p1 + rng.normal(size=n) * .1, hofx=0.0, bias=0.0,
                             err0=rng.uniform(.5, 2, n), qc0=rng.integers(0, 2, n).astype("int32"), cycle=[dt.datetime(2024, 1, 1) + dt.timedelta(hours=6 * int(k)) for k in rng.integers(0, 4, n)]))


def reference_solve(pdf, beta0, err0):
    p = pdf[["p0", "p1"]].to_numpy().T
    rinv, y = 1 / pdf.err0.to_numpy(), (pdf.obs - pdf.hofx + pdf.bias).to_numpy()
    binv = np.linalg.pinv(np.diag(err0))
    a = np.linalg.pinv(binv + (p * rinv) @ p.T)
    return a @ (binv @ beta0 + (p * rinv) @ y), np.diag(a)


def test_training_matches_dense_algebra(spark):
    pdf = training_rows()
    out = B.solve_bias(B.normal_sums(spark.createDataFrame(pdf), ["p0", "p1"], ["channel"]), ["p0", "p1"], ["channel"])
    for ch, g in pdf[pdf.qc0 == 0].groupby("channel"):
        beta, err = reference_solve(g, np.zeros(2), np.full(2, 1e20))
        got = {r["predictor"]: r for r in out.filter(F.col("channel") == int(ch)).collect()}
        assert np.allclose([got["p0"]["beta"], got["p1"]["beta"]], beta) and np.allclose([got["p0"]["err"], got["p1"]["err"]], err)
        assert got["p0"]["n_obs"] == len(g)


def test_sequential_training(spark):
    pdf = training_rows()
    pdf = pdf[pdf.cycle != pd.Timestamp("2024-01-01 12:00:00")]  # a gap restarts from the default prior
    sums = B.normal_sums(spark.createDataFrame(pdf), ["p0", "p1"], ["channel", "cycle"])
    got = {(r["channel"], r["cycle"], r["predictor"]): r["beta"] for r in B.train_sequential(sums, ["p0", "p1"], ["channel"]).collect()}
    for ch in (1, 2):
        beta, err, last = np.zeros(2), np.full(2, 1e20), None
        for c, g in pdf[(pdf.channel == ch)].groupby("cycle"):
            g = g[g.qc0 == 0]
            if last is None or c - last != pd.Timedelta(hours=6):
                beta, err = np.zeros(2), np.full(2, 1e20)
            else:
                err = err * 1.1
            beta, err = reference_solve(g, beta, err)
            beta, err = beta.astype(np.float32).astype(float), err.astype(np.float32).astype(float)
            last = c
            assert np.allclose([got[ch, c.to_pydatetime(), p] for p in ("p0", "p1")], beta, rtol=1e-5)


def test_unknown_predictor(spark):
    with pytest.raises(ValueError, match="sensor"):
        B.normal_sums(spark.createDataFrame(training_rows()), ["p0", "sensor"], ["channel"])


def test_recentre_without_used_rows(spark):
    df = spark.createDataFrame([(1, 0, 2.0), (1, 0, 4.0), (1, 1, 100.0), (2, 1, 7.0)], "channel int, qc0 int, x double")
    old = spark.createDataFrame([(1, 10.0)], "channel int, mean double")
    out, means = B.recentre(df, old, ["channel"], "x", "x2")
    assert rows(means) == [(1, 13.0), (2, 0.0)]
    assert rows(out.select("channel", "x", "x2")) == [(1, -1., 1.), (1, 1., 1.), (1, 97., 9409.), (2, 7., 49.)]


def test_first_rejecting_rule_is_kept(spark):
    df = spark.createDataFrame([(0, 4, 50.0, 1.0, 1.0), (1, 4, None, 1.0, 1.0), (2, 5, 1.2, 1.0, 1.0), (3, 4, 5.0, 1.0, 1.0)], "loc_id int, channel int, obs double, hofx double, err0 double")
    rules = [Q.Rule("range", "bounds", options={"min": 0, "max": 10}), Q.Rule("gross", "background", options={"threshold": 3.0}), Q.Rule("watch", "list", "passivate", "5")]
    out = Q.apply_rules(df, rules)
    assert rows(out.select("loc_id", "qc_flag", "qc_reason")) == [(0, 2, "range"), (1, 2, "range"), (2, 1, None), (3, 2, "gross")]


def test_thinning_keeps_all_channels_of_one_location(spark):
    df = spark.createDataFrame([(k, c, 10.0 + 0.01 * k, 20.0, 1.0, 1.0, 1.0) for k in range(5) for c in (1, 2)] + [(9, 1, -40.0, 20.0, 1.0, 1.0, 1.0)],
                               "loc_id int, channel int, lat double, lon double, obs double, hofx double, err0 double")
    out = Q.apply_rules(df, [Q.Rule("thin", "thinning", options={"mesh_km": 1000.0})])
    assert out.select("loc_id").distinct().count() == 2 and out.count() == 3


def test_floors(spark):
    df = spark.createDataFrame([("qv", 0, -.25), ("qv", 1, 5.), ("qso4", 0, -3.), ("qso4", 1, 5.), ("theta", 0, -7.)], "variable string, cell_id int, value float")
    out, report = ST.floor_values(df)
    got = {(r["variable"], r["cell_id"]): r["value"] for r in out.collect()}
    assert got["qv", 0] == np.float32(1e-12) and got["qso4", 0] == 0 and got["theta", 0] == -7 and got["qv", 1] == 5
    assert rows(report.select("variable", "n_raised", "min_before")) == [("qso4", 1, -3.0), ("qv", 1, -.25)]
    assert ST.floor_values(out)[1].count() == 0


def test_carry_over(spark):
    schema = "variable string, cell_id int, value double"
    every = ST.AEROSOLS + ST.NOT_ANALYSED + ST.PERSISTENT
    cold = spark.createDataFrame([(v, c, 2.0) for v in every + ["qc", "background_hno3"] for c in (0, 1)], schema)
    warm = spark.createDataFrame([(v, c, 7.0) for v in every + ST.HYDROMETEORS + ["background_hno3"] for c in (0, 1)], schema)
    out, report = ST.carry_state(cold, warm, ["variable", "cell_id"], carry_persistent=False, include_hydrometeors=True)
    got = {r["variable"]: r["value"] for r in out.collect()}
    assert {v: x for v, x in got.items() if x != 7.0} == {"background_hno3": 2.0, "persistent_hno3": 2.0}
    assert set(ST.HYDROMETEORS) <= set(got) and report.filter("fatal").count() == 0
    _, report = ST.carry_state(cold.filter("variable <> 'qni1'"), warm.filter("variable <> 'qg'"), ["variable", "cell_id"], include_hydrometeors=True)
    assert {(r["variable"], r["status"]) for r in report.filter("fatal").collect()} == {("qni1", "missing_in_destination"), ("qg", "missing_in_origin")}


def test_zero_error_and_passive(spark):
    df = spark.createDataFrame([("a", 1.0, 1.0, 0, 0, 1.0), ("a", 2.0, 2.0, 1, 1, 1.0), ("b", 1.0, .5, 0, 0, 0.0), ("c", 1e30, 1e30, 0, 0, 1.0)],
                               "observer string, ombg double, oman double, qc0 int, qc1 int, err0 double")
    s = {r["observer"]: r for r in D.departure_stats(df, ["observer"]).collect()}
    assert s["a"]["passive"] and not s["b"]["passive"] and not s["c"]["passive"]
    assert s["a"]["n"] == 2 and s["b"]["jo_b"] == float("inf") and s["c"]["n_file"] == 0


def test_stream_batches_add_up(spark, tmp_path):
    """Rows arriving in two files, some late, give the sums of one batch over the closed cycles."""
    pdf = training_rows(200)
    pdf["obs_time"] = pdf.cycle + pd.to_timedelta(np.arange(200) % 100, unit="min")
    src = str(tmp_path / "in")
    for part in (pdf.iloc[:100], pdf.iloc[100:]):
        spark.createDataFrame(part.drop(columns="cycle")).coalesce(1).write.mode("append").parquet(src)
    stream = spark.readStream.schema(spark.read.parquet(src).schema).option("maxFilesPerTrigger", 1).parquet(src)
    got = []

    def keep(coef, _):
        got.extend(r.asDict() for r in coef.collect())

    q = SD.stream_normal_sums(stream, ["p0", "p1"], ["channel"], "2 days").writeStream.outputMode("update").option(
        "checkpointLocation", str(tmp_path / "state")).foreachBatch(SD.solve_each_batch(["p0", "p1"], ["channel"], keep)).trigger(availableNow=True).start()
    q.awaitTermination()
    last = {(r["cycle"], r["channel"], r["predictor"]): r["beta"] for r in got}
    want = B.solve_bias(B.normal_sums(spark.createDataFrame(pdf), ["p0", "p1"], ["cycle", "channel"]), ["p0", "p1"], ["cycle", "channel"])
    assert all(last[r["cycle"], r["channel"], r["predictor"]] == pytest.approx(r["beta"]) for r in want.collect()) and len(last) == want.count()


def test_rules_without_a_violation_are_counted(spark):
    df = spark.createDataFrame([("a", "f0", 1.0), ("a", "f1", float("nan"))], "step string, field string, value double")
    checks = {"nonfinite": PR.finite_violations(df, ["step"]), "incomplete": PR.incomplete_steps(df, ["f0", "f1"], ["step"])}
    assert rows(PR.violation_counts(checks)) == [("incomplete", 0), ("nonfinite", 1)]


def test_product_round_trip(spark, tmp_path):
    path = str(tmp_path / "product")
    df = spark.createDataFrame([("p", "a", 0, 1.1), ("p", "b", 0, 2.2)], "product string, field string, cell_id int, value double")
    facts = spark.createDataFrame([("s", -24.0)], "series_id string, source_time_offset_hours double")
    assert PR.reuse_decision(spark, path, 0.0) == "build"
    PR.write_product(df, path, facts, PR.violation_table({"nonfinite": PR.finite_violations(df, ["field"])}))
    PR.write_product(df.filter("field = 'a'").withColumn("value", F.lit(9.0)), path)
    back = PR.read_product(spark, path)
    assert dict(back.dtypes)["value"] == "float"
    assert {r["field"]: round(r["value"], 3) for r in back.collect()} == {"a": 9.0, "b": 2.2}
    assert PR.reuse_decision(spark, path, -24.0) == "reuse" and PR.reuse_decision(spark, path, 0.0) == "rebuild"


def test_path_choice(spark, tmp_path):
    (tmp_path / "b_2024.nc").write_text("x")
    assert GR.first_available(spark, ["$NOT_SET_ANYWHERE/a", str(tmp_path / "a_{year}.nc"), str(tmp_path / "b_{year}.nc")], year=2024)[0].endswith("b_2024.nc")
    with pytest.raises(FileNotFoundError, match="a_2024"):
        GR.first_available(spark, [str(tmp_path / "a_{year}.nc")], year=2024)
    with pytest.raises(KeyError):
        GR.resolve_alias(["x"], ["lat", "latitude"])
    with pytest.raises(ValueError):
        IP.single_field(["a", "b"])


def test_migration_reports_problems(spark):
    df = spark.createDataFrame([(1, 2, 3)], "old int, new int, other int")
    out, problems = FB.migrate_schema(df, [{"name": "new", "type": "int", "deprecated": ["old"]}])
    assert out.columns == ["new", "other"] and len(problems) == 2


def test_conservation_stops_a_bad_inventory(spark):
    wide = spark.createDataFrame([("s", "r", k, 1.0) for k in range(4)], "series_id string, record_id string, src_id bigint, a double")
    rec = spark.createDataFrame([("s", "r", dt.datetime(2024, 1, 1))], "series_id string, record_id string, valid_time timestamp")
    links = spark.createDataFrame([(0, 0, .5), (0, 1, .5), (1, 2, .5), (1, 3, .5)], "dst_id bigint, src_id bigint, s double")
    src = spark.createDataFrame([(k, 1.0) for k in range(4)], "src_id bigint, area double")
    for area, bad in ((2.0, 0), (2.1, 1)):
        dst = spark.createDataFrame([(k, area) for k in range(2)], "dst_id bigint, area double")
        out = IP.regular_inventory(wide, rec, links, src, dst, [IP.FieldSpec("f", (("a", 1.0),))], IP.TimeSpec("2024-01-01 00:00:00", "2024-01-01 00:00:00"))
        assert out.violations.filter("rule = 'conservation'").count() == bad
        assert [r["value"] for r in out.values.collect()] == [1.0, 1.0]
