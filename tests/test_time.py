import datetime as dt

import pytest
from conftest import rows
from pyspark.sql import functions as F

from gridspark.operators import days as DY
from gridspark.operators import timeaxis as TA

T = dt.datetime


def records(spark, times, series="s"):
    return spark.createDataFrame([(series, str(t), t) for t in times], "series_id string, record_id string, valid_time timestamp")


def targets(spark, times, series="s"):
    return spark.createDataFrame([(series, t) for t in times], "series_id string, target timestamp")


def test_daily_records_serve_their_day(spark):
    r = records(spark, [T(2024, 10, 1, 12), T(2024, 10, 2, 12)])
    out = TA.day_brackets(r, targets(spark, [T(2024, 10, 1, h) for h in (0, 6, 12, 23)]))
    assert {(x["before_id"], x["after_id"], x["alpha"], x["kind"]) for x in out.collect()} == {("2024-10-01 12:00:00", "2024-10-01 12:00:00", 0.0, "exact")}


def test_missing_day_uses_whole_days(spark):
    out = TA.day_brackets(records(spark, [T(2024, 10, 1), T(2024, 10, 3)]), targets(spark, [T(2024, 10, 2, 18)])).first()
    assert out["alpha"] == 0.5 and out["kind"] == "interpolated"
    wide = TA.day_brackets(records(spark, [T(2024, 10, 1), T(2024, 10, 3)]), targets(spark, [T(2024, 10, 2)]), max_gap_days=1).first()
    assert wide["kind"] == "gap" and wide["before_id"] is None


def test_bracket_rules(spark):
    r = records(spark, [T(2024, 1, 1), T(2024, 1, 5), T(2024, 1, 6)])
    q = targets(spark, [T(2024, 1, 1), T(2024, 1, 2), T(2024, 1, 5, 12), T(2023, 12, 31), T(2024, 2, 1)])

    def kinds(**o):
        return {str(x["target"]): (x["kind"], x["alpha"]) for x in TA.time_brackets(r, q, **o).collect()}

    k = kinds(max_gap_seconds=2 * 86400.0)
    assert k["2024-01-01 00:00:00"] == ("exact", 0.0) and k["2024-01-02 00:00:00"] == ("gap", None)
    assert k["2024-01-05 12:00:00"] == ("interpolated", 0.5)
    assert k["2023-12-31 00:00:00"][0] == k["2024-02-01 00:00:00"][0] == "outside"
    k = kinds(method="hold", max_gap_seconds=2 * 86400.0, extrapolate=True)
    assert k["2024-01-02 00:00:00"][0] == "gap" and k["2024-02-01 00:00:00"] == ("extrapolated", 0.0)
    near = {str(x["target"]): x["before_id"] for x in TA.time_brackets(r, q, method="nearest").collect()}
    assert near["2024-01-05 12:00:00"] == "2024-01-05 00:00:00"  # a tie goes to the earlier record
    with pytest.raises(ValueError):
        TA.time_brackets(r, q, method="cubic")


def test_empty_series_is_reported(spark):
    out = TA.time_brackets(records(spark, [T(2024, 1, 1)], "a"), targets(spark, [T(2024, 1, 1)], "b")).first()
    assert out["kind"] == "no_records"


def test_monthly_targets_sit_on_mid_month_records(spark):
    times = [T(2024, m, 16) for m in range(1, 13)]
    r = records(spark, times)
    q = TA.target_schedule(r, "2024-01-01 00:00:00", "2024-12-31 23:00:00", "monthly")
    assert sorted(x["target"] for x in q.collect()) == times
    assert {x["kind"] for x in TA.time_brackets(r, q).collect()} == {"exact"}
    two = r.union(records(spark, [T(2024, 3, 20)]))
    q = TA.target_schedule(two, "2024-01-01 00:00:00", "2024-12-31 23:00:00", "monthly")
    assert sorted(x["target"] for x in q.collect()) == [T(2024, m, 1) for m in range(1, 13)]


def test_schedule_needs_a_positive_step():
    with pytest.raises(ValueError):
        TA.schedule("2024-01-01", "2024-01-02", 0)


@pytest.mark.parametrize("times,token", [
    ([T(2024, m, 16) for m in range(1, 13)], "2024"), ([T(2024, m, 1) for m in range(1, 13)] + [T(2025, 1, 1)], "2024"),
    ([T(2024, 7, 1), T(2024, 9, 30)], "20240701-20240930"), ([T(2024, 1, 1) + dt.timedelta(days=k) for k in range(366)], "2024"),
    ([T(2024, 1, 1) + dt.timedelta(days=k) for k in range(350)], "20240101-20241215")])
def test_period_token(spark, times, token):
    assert TA.period_token(targets(spark, times), 2024).first()["period"] == token


def test_interpolation_of_sparse_values(spark):
    r = records(spark, [T(2024, 1, 1), T(2024, 1, 2)])
    v = spark.createDataFrame([("s", "2024-01-01 00:00:00", 0, 4.0), ("s", "2024-01-02 00:00:00", 0, 8.0), ("s", "2024-01-02 00:00:00", 1, 8.0)],
                              "series_id string, record_id string, cell_id bigint, value double")
    b = TA.time_brackets(r, targets(spark, [T(2024, 1, 1), T(2024, 1, 1, 6), T(2024, 1, 2)]))
    out = rows(TA.interpolate(v, b, ["cell_id"]).select("target", "cell_id", "value"))
    assert out == [(T(2024, 1, 1), 0, 4.), (T(2024, 1, 1, 6), 0, 5.), (T(2024, 1, 1, 6), 1, 2.), (T(2024, 1, 2), 0, 8.), (T(2024, 1, 2), 1, 8.)]


def day(n):
    return dt.date(2024, 1, n)


def status(df):
    return {r["day"].day: r["status"] for r in df.collect()}


def test_day_policies(spark):
    have = [("s", day(d), "primary") for d in (1, 2, 4, 8)] + [("s", day(d), "fallback") for d in (2, 3, 6)]
    available = spark.createDataFrame(have, "series_id string, day date, source string")
    calendar = DY.day_calendar("2024-01-01", "2024-01-08", available.select("series_id").distinct())
    got = status(DY.resolve_days(calendar, available, max_missing=1, forced=[("2024-01-02", "2024-01-02"), ("2024-01-08", "2024-01-08")]))
    assert got == {1: "primary", 2: "fallback-forced", 3: "linear:2024-01-02->2024-01-04", 4: "primary", 5: "missing", 6: "fallback", 7: "missing", 8: "missing-forced"}
    size = status(DY.resolve_fire_size_days(calendar, available, max_missing=1, forced=[("2024-01-08", "2024-01-08")]))
    assert size == {1: "primary-area", 2: "primary-area", 3: "fallback-area", 4: "primary-area", 5: "missing", 6: "fallback-area", 7: "missing", 8: "primary-area"}
    assert status(DY.resolve_fire_size_days(calendar, available, max_missing=1, prefer_linear=True))[3] == "linear:2024-01-02->2024-01-04"


def test_fallback_factor_methods(spark):
    schema = "day date, field string, cell_id bigint, value double"
    p = spark.createDataFrame([(day(d), "f", 0, 2.0 * d) for d in (1, 2, 3)], schema)
    f = spark.createDataFrame([(day(d), "f", 0, 0.1 * d) for d in (1, 2, 3)], schema)
    mesh = spark.createDataFrame([(0, 1.0)], "cell_id bigint, area_m2 double")

    def factor(**o):
        return DY.fallback_factors(p, f, mesh, ["f"], **o).first()["factor"]

    assert factor() == 4.0 and factor(clip=(0.0, 100.0)) == pytest.approx(20.0) and factor(min_days=4) == 1.0
    assert factor(method="none") == 1.0 and factor(method="fixed", fixed={"default": 1.5}) == 1.5
