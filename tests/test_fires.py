import datetime as dt
import gzip

import pytest
from conftest import rows
from pyspark.sql import functions as F

from gridspark.functions.dates import date_from_name, parse_time
from gridspark.functions.numbers import is_unparsed, parse_double
from gridspark.operators import points as P
from gridspark.operators import vegetation as V
from gridspark.plans import fires as FP
from gridspark.sources import fire_text as FT
from gridspark.sources import products as PR

COLS = {"day": FT.DAY_NAMES, "lat": FT.LAT_NAMES, "lon": FT.LON_NAMES, "area": FT.AREA_NAMES, "genveg": ["GENVEG"]}


def fortran(x: float) -> str:
    """``x`` as Fortran writes it: 0.ddddddD+ee."""
    digits, power = f"{abs(x):.5E}".split("E")
    return f"{'-' if x < 0 else ''}0.{digits.replace('.', '')}D{int(power) + 1:+03d}"


@pytest.mark.parametrize("x", [31.25, -0.0078125, 6.4e9, -1.0, 123456.0])
def test_fortran_tokens(spark, x):
    df = spark.createDataFrame([(fortran(x),), (f"{x:E}",), (" " + fortran(x).lower(),)], "t string")
    out = df.select(parse_double(F.col("t")).alias("v"), is_unparsed(F.col("t")).alias("bad")).collect()
    assert [r["v"] for r in out] == [pytest.approx(x)] * 3 and not any(r["bad"] for r in out)


def test_null_tokens(spark):
    out = spark.createDataFrame([("",), ("nan",), ("  ",)], "t string").select(parse_double(F.col("t")).alias("v"), is_unparsed(F.col("t")).alias("bad")).collect()
    assert [tuple(r) for r in out] == [(None, False)] * 3


@pytest.mark.parametrize("day", [dt.date(2016, 1, 1), dt.date(2016, 2, 29), dt.date(2016, 12, 31), dt.date(2019, 7, 4)])
def test_name_dates(spark, day):
    names = [f"burns_{day:%Y%j}.txt", f"/x/burns_{day:%Y%j}.txt.gz", f"burns_{day:%Y%m%d}_v2.txt", f"burns_{day.year + 1 if day.year % 4 else day.year + 1}366.txt", "burns.txt"]
    got = [r[0] for r in spark.createDataFrame([(n,) for n in names], "n string").select(date_from_name(F.col("n"))).collect()]
    assert got[:3] == [day] * 3 and got[4] is None
    assert got[3] == (dt.date(day.year + 1, 12, 31) if (day.year + 1) % 4 == 0 else None)


def test_read_both_dialects(spark, tmp_path):
    day, later = dt.date(2016, 3, 1), dt.date(2016, 3, 2)
    records = [(12.5, -3.25, 4, 640.0, 8.0), (-33.0, 151.5, 1, None, 16.0)]
    a = tmp_path / f"burns_{day:%Y%j}.txt"
    lines = [",".join([f"{day:%j}", str(veg), fortran(lat), fortran(lon), "?" if area is None else fortran(area), fortran(co)]) + "," for lat, lon, veg, area, co in records]
    a.write_text("\n".join(["# made for this test", "", "DAY,GENVEG,LATI,LONGI,AREA,CO", *lines]) + "\n")
    b = tmp_path / f"burns_{later:%Y%m%d}.txt.gz"
    with gzip.open(b, "wt") as f:
        f.write("LAT, LON,GENVEG,DAY,FIRE_AREA\n7.75 8.5 3 62 2E3\n")
    out = FT.read_fire_text(spark, [str(a), str(b)], {**COLS, "co": ["CO"]})
    got = {(r["file_date"], r["lat"]): r for r in out.collect()}
    for lat, lon, veg, area, co in records:
        r = got[day, pytest.approx(lat)] if (day, lat) not in got else got[day, lat]
        assert (r["lon"], r["genveg"], r["co"]) == (lon, veg, co) and r["area"] == area and r["bad_area"] == (area is None)
    assert got[later, 7.75]["area"] == 2000.0 and got[later, 7.75]["co"] is None and len(got) == 3


@pytest.mark.parametrize("values,rule", [([None] * 1000, "no_usable_value"), ([None] * 50 + [1.0] * 950, "too_many_unparsed"), ([None] * 10 + [1.0] * 990, None)])
def test_parse_guard(spark, values, rule):
    df = spark.createDataFrame([("f", v, v is None) for v in values], "file string, area double, bad_area boolean")
    got = [r["rule"] for r in FT.parse_guard(df, ["area"]).collect()]
    assert got == ([rule] if rule else [])


@pytest.mark.parametrize("file,days,first,last", [("burns_2018_c20190305.txt", range(1, 32), "2018-01-01", "2018-01-31"), ("burns_201904_c20200101.txt", range(91, 121), "2019-04-01", "2019-04-30"),
                                                  ("burns_201905.txt", range(1, 32), "2019-05-01", "2019-05-31")])
def test_container_dates(spark, file, days, first, last):
    df = spark.createDataFrame([(file, str(d)) for d in days], "file string, day string")
    got = FT.container_dates(df).agg(F.min("file_date"), F.max("file_date")).first()
    assert tuple(map(str, got)) == (first, last)


def test_stage_days_reports_two_containers(spark):
    d = dt.date(2024, 1, 2)
    df = spark.createDataFrame([("a", d), ("b", d), ("a", dt.date(2024, 1, 9))], "file string, file_date date")
    kept, repeated = FT.stage_days(df, "2024-01-01", "2024-01-05")
    assert kept.count() == 2 and rows(repeated) == [(d, 2)]


def test_parse_time(spark):
    for text in ("2024-09-01T06:00:00Z", "2024-09-01_06:00:00", "2024-09-01 06:00", "2024090106"):
        assert spark.createDataFrame([(text,)], "t string").select(parse_time(F.col("t")).cast("string")).first()[0] == "2024-09-01 06:00:00"
    assert spark.createDataFrame([("yesterday",)], "t string").select(parse_time(F.col("t"))).first()[0] is None


def test_moments_without_radiative_power(spark):
    df = spark.createDataFrame([(0, 1e6), (0, 3e6), (0, -5.0), (0, float("nan"))], "cell_id bigint, area double")
    assert rows(P.fire_moments(df, ["cell_id"])) == [(0, 2e6, 1e6, 0.0, 0.0)]
    with pytest.raises(ValueError):
        P.fire_moments(df, ["cell_id"], require_frp=True)


def test_profile_rules():
    assert sum(P.check_profile([1.0] * 24)) == 24
    for bad in ([1.0] * 23, [0.0] * 24, [-1.0] + [1.0] * 23, [float("nan")] + [1.0] * 23):
        with pytest.raises(ValueError):
            P.check_profile(bad)


def test_crosswalk(spark):
    df = spark.createDataFrame([(c,) for c in (0, 1, 2, 3, 4, 5, 6, 9, 7)], "c int")
    assert [r[0] for r in df.select(V.crosswalk(F.col("c"))).collect()] == [0, 4, 3, 1, 2, 2, 2, 4, None]


def veg(spark, cell, code, area):
    df = spark.createDataFrame(list(zip(cell, code, map(float, area))), "cell_id bigint, genveg int, area double")
    return V.dominant_category(df, ["cell_id"])


def test_dominant_category(spark):
    out = rows(veg(spark, [0, 0, 0, 1, 1], [2, 2, 3, 4, 5], [1, 1, 8, 3, 4]).select("cell_id", "category", "share", "mean_area"))
    assert out == [(0, 1, 0.8, pytest.approx(10 / 3)), (1, 2, 1.0, 3.5)]
    assert rows(veg(spark, [0, 0, 1], [0, 2, 2], [9, 1, 0]).select("cell_id", "category", "known_frac")) == [(0, 3, .1), (1, 0, 0.)]
    assert rows(veg(spark, [0, 0], [3, 2], [5, 5]).select("category")) == [(1,)]


def test_negative_area_is_counted(spark):
    df = spark.createDataFrame([(dt.date(2024, 1, 1), 0., 0., 2, a) for a in (-999., 1e6)], "file_date date, lat double, lon double, genveg int, area double")
    kept, rejected = V.validate_fires(df)
    assert kept.count() == 1 and rows(rejected.select("reason", "n", "fatal")) == [("negative_area", 1, False)]


def test_footprint_support(spark):
    d = dt.date(2024, 9, 1)
    size = spark.createDataFrame([(d, 0, 0.), (d, 1, 77.), (d, 2, 0.)], "day date, cell_id bigint, value double")
    old = spark.createDataFrame([(d, 0, 0, 0., 0., 0), (d, 1, 2, 1., 1., 5), (d, 2, 0, 0., 0., 0)], "day date, cell_id bigint, category int, share double, known_frac double, n_records bigint")
    target = spark.createDataFrame([(d, 0, 1.), (d, 1, 1.), (d, 2, 0.)], "day date, cell_id bigint, value double")
    eligible = V.eligible_cells(size, target)
    assert rows(eligible) == [(d, 0)]
    records = spark.createDataFrame([(d, 1, 0, 0, 2, 100.), (d, 2, 0, 1, 4, 50.)], "day date, record_id bigint, iy int, ix int, genveg int, area double")
    matches = spark.createDataFrame([(0, 0, 0), (0, 0, 1), (2, 0, 0), (0, 0, 0)], "cell_id bigint, iy int, ix int")
    new_size, new_veg = V.footprint_support(eligible, matches, records, size, old)
    assert rows(new_size.select("cell_id", "value")) == [(0, 75.), (1, 77.), (2, 0.)]
    assert rows(new_veg.select("cell_id", "category", "share", "n_records")) == [(0, 3, pytest.approx(2 / 3), 2), (1, 2, 1., 5), (2, 0, 0., 0)]


@pytest.mark.parametrize("own,factor", [(None, 0.5), ({"e_nh3": 0.25}, 0.25)])
def test_fallback_takes_the_product_scaling(spark, own, factor):
    d = dt.date(2024, 1, 1)
    df = spark.createDataFrame([("primary", d, 0., 0., 86400.0, 1.0), ("fallback", d + dt.timedelta(1), 0., 0., 86400.0, 1.0)], "source string, day date, lat double, lon double, nh3 double, area double")
    mesh = spark.createDataFrame([(0, 0., 0., 1e8), (1, 1., 1., 1e8)], "cell_id bigint, lat double, lon double, area_m2 double")
    plan = FP.FirePlan("2024-01-01", "2024-01-02", {"nh3": "e_nh3"}, {"e_nh3": "gas"}, factors={"e_nh3": 0.5}, fallback_factors=own)
    out = FP.fire_emissions(df, mesh, plan)
    got = dict(rows(out["hourly"].values.filter("hour(valid_time) = 3").select(F.dayofmonth("valid_time"), "value")))
    unit = 6.022e23 / 1e12
    assert got == {1: pytest.approx(0.5 * unit), 2: pytest.approx(factor * unit)}
    assert out["hourly"].violations.count() == 0
    assert out["hourly"].values.count() == 48


def test_missing_day_and_lost_fires_stop_the_write(spark, tmp_path):
    d = dt.date(2024, 1, 1)
    df = spark.createDataFrame([("primary", d, 95., 0., 1.0, 1.0)], "source string, day date, lat double, lon double, co double, area double")
    mesh = spark.createDataFrame([(0, 0., 0., 1e8)], "cell_id bigint, lat double, lon double, area_m2 double")
    out = FP.fire_emissions(df, mesh, FP.FirePlan("2024-01-01", "2024-01-02", {"co": "e_co"}, {"e_co": "gas"}))["hourly"]
    assert {r["rule"] for r in out.violations.collect()} == {"missing_day", "silent_zero"}
    with pytest.raises(PR.ProductRejected):
        PR.write_product(out.values, str(tmp_path / "p"), violations=out.violations)
    assert not (tmp_path / "p").exists()


def test_plans_share_located_records(spark):
    d = dt.date(2024, 1, 1)
    days = [d + dt.timedelta(k) for k in range(3)]
    located = spark.createDataFrame([(s, day, 0, v, 1.0) for day in days for s, v in (("primary", 6.0), ("fallback", 2.0))], "source string, day date, cell_id bigint, co double, area double")
    mesh = spark.createDataFrame([(0, 0., 0., 1e8)], "cell_id bigint, lat double, lon double, area_m2 double")
    for method, factor in (("robust_median_ratio", 3.0), ("fixed", 1.25)):
        plan = FP.FirePlan("2024-01-01", "2024-01-03", {"co": "e_co"}, {"e_co": "gas"}, scale_method=method, fixed_factors={"e_co": 1.25})
        factors = FP.fire_emissions(located, mesh, plan, located=located)["hourly"].extras["factors"]
        assert rows(factors) == [("e_co", factor)]
        # the factors are a written table, so what uses them does not aggregate the fires again
        assert "Aggregate" not in factors._jdf.queryExecution().executedPlan().toString()


def test_published_hours_are_not_joined(spark, tmp_path, monkeypatch):
    d = dt.date(2024, 1, 1)
    located = spark.createDataFrame([("primary", d + dt.timedelta(k), 0, 6.0, 1.0) for k in range(2)], "source string, day date, cell_id bigint, co double, area double")
    mesh = spark.createDataFrame([(0, 0., 1., 1e8), (1, 0., -2., 1e8)], "cell_id bigint, lat double, lon double, area_m2 double")
    plan = FP.FirePlan("2024-01-01", "2024-01-02", {"co": "e_co"}, {"e_co": "gas"}, profile=tuple(range(1, 25)))
    out = FP.fire_emissions(located, mesh, plan, located=located)["hourly"]
    plans, write = [], PR.write_product

    def watched(values, *args, **kwargs):
        plans.append(values._jdf.queryExecution().executedPlan().toString())
        return write(values, *args, **kwargs)

    for module in (PR, FP):
        monkeypatch.setattr(module, "write_product", watched, raising=False)
    FP.publish_hourly(out, mesh, plan, str(tmp_path / "p"))
    # the hours are exploded above every join and exchange of the plan
    assert all(p.index("Generate") < min(p.index("Join"), p.index("Exchange")) for p in plans) and plans
    dense = FP.dense_hourly(out.values, mesh, ["e_co"], plan.start, plan.end).withColumn("value", F.col("value").cast("float"))
    columns = ["valid_time", "field", "cell_id", "value"]
    got = rows(PR.read_product(spark, str(tmp_path / "p")).select(*columns).orderBy(*columns))
    assert got == rows(dense.select(*columns).orderBy(*columns)) and len(got) == 96


def test_container_dates_without_a_parser(spark):
    texts = {"20240229": "2024-02-29", "2023-02-29": None, "1997/03/04": "1997-03-04", "1997-03/04": None, "2024-3-4": None, "20241301": None, " 2024-01-31 ": "2024-01-31",
             "2024061": "2024-03-01", "٢٠٢٤٠١٠١": None, "202401011": None, None: None}
    df = spark.createDataFrame([("dated.txt", t) for t in texts], "file string, day string")
    found = FT.container_dates(df)
    assert {r["day"]: r["d"] for r in found.select("day", F.col("file_date").cast("string").alias("d")).collect()} == texts
    month = spark.createDataFrame([("F_199702.txt", t) for t in ("28", "29", "0", "-5", "7.9")], "file string, day string")
    assert [r["d"] for r in FT.container_dates(month).select(F.col("file_date").cast("string").alias("d")).collect()] == ["1997-02-28", None, None, None, "1997-02-07"]
    # a parser builds an exception for every text it does not match, and every reader of the period would run it again
    assert "gettimestamp" not in found._jdf.queryExecution().optimizedPlan().toString().lower()
    kept, _ = FT.stage_days(found, "2024-01-01", "2024-12-31")
    assert "Join" not in kept._jdf.queryExecution().optimizedPlan().toString() and kept.count() == 3
