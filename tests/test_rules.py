"""Rules that the jobs must enforce on bad input."""
import math

import numpy as np
import pytest
from conftest import rows
from pyspark.sql import functions as F

from gridspark import session
from gridspark.operators import days as DY
from gridspark.operators import departures as D
from gridspark.operators import ensemble as E
from gridspark.operators import quantiles
from gridspark.operators import scaling as S
from gridspark.operators import weights as W
from gridspark.operators.chem import species_weights
from gridspark.plans import fires as FP
from gridspark.plans import inventories as IP
from gridspark.sources import fire_text as FT
from gridspark.sources import files, products


def rules(result):
    return sorted({r.rule for r in result.violations.collect()})


def test_regular_inventory_refuses_missing_and_short_records(spark):
    records = spark.createDataFrame([("s", "r1", "2024-01-01"), ("s", "r2", "2024-01-02")], "series_id string, record_id string, d string").select("series_id", "record_id", F.col("d").cast("timestamp").alias("valid_time"))
    links = spark.createDataFrame([(0, 0, 0.5), (0, 1, 0.5)], "dst_id bigint, src_id bigint, s double")
    time = IP.TimeSpec("2024-01-01", "2024-01-02", "source")
    spec = [IP.FieldSpec("a", (("v", 1.0),))]

    def run(values, **more):
        wide = spark.createDataFrame(values, "series_id string, record_id string, src_id bigint, v double")
        return IP.regular_inventory(wide, records, links, None, None, spec, time, n_src=2, **more)

    good = [("s", "r1", 0, 1.0), ("s", "r1", 1, 2.0), ("s", "r2", 0, 3.0), ("s", "r2", 1, 4.0)]
    assert rules(run(good)) == [] and [r[-1] for r in rows(run(good).values.select("valid_time", "value"))] == [1.5, 3.5]
    assert rules(run([(*r[:3], math.nan if r[2] and r[1] == "r1" else r[3]) for r in good])) == ["missing_value"]
    assert rules(run([(*r[:3], None if r[2] and r[1] == "r1" else r[3]) for r in good])) == ["missing_value"]
    assert rules(run(good[1:])) == ["source_length"]


def test_conservation_reports_cells_without_area(spark):
    src = spark.createDataFrame([(1, 0, 2.0), (1, 1, 4.0)], "k int, src_id bigint, value double")
    dst = spark.createDataFrame([(1, 0, 3.0)], "k int, dst_id bigint, value double")
    area = spark.createDataFrame([(0, 1.0), (1, 1.0)], "src_id bigint, area double")
    two = spark.createDataFrame([(0, 2.0)], "dst_id bigint, area double")
    assert rows(W.check_conservation(src, dst, area, two, ["k"]).select("ok", "n_no_area")) == [(True, 0)]
    assert rows(W.check_conservation(src, dst, area.where("src_id = 0"), two, ["k"]).select("ok", "n_no_area")) == [(False, 1)]


def test_recenter_gives_every_member_the_variables_only_the_centre_has(spark):
    ens = spark.createDataFrame([(1, "t", 0, 1.0), (2, "t", 0, 3.0), (1, "q", 0, 9.0), (2, "q", 0, 9.0), (1, "t", 7, 1.0)], "member int, variable string, cell_id int, value double")
    centre = spark.createDataFrame([("t", 0, 10.0), ("q", 0, 5.0), ("soil", 0, 0.3)], "variable string, cell_id int, value double")
    out, means = E.recenter(ens, centre, ["t"], ["variable", "cell_id"])
    assert rows(out, "member", "variable") == [(1, "q", 0, 5.0), (1, "soil", 0, 0.3), (1, "t", 0, 9.0), (2, "q", 0, 5.0), (2, "soil", 0, 0.3), (2, "t", 0, 11.0)]
    assert ("t", 0, 2.0) in rows(means)
    assert rows(E.centre_gaps(ens, centre, ["t"], ["variable", "cell_id"])) == [("t", 7)]


def test_fallback_ratio_takes_all_days_unless_told(spark):
    mesh = spark.createDataFrame([(0, 1.0)], "cell_id int, area_m2 double")
    base = spark.range(100).selectExpr("date_add(date'2024-01-01', cast(id as int)) AS day", "'f' AS field", "0 AS cell_id", "id")
    primary = base.select("day", "field", "cell_id", F.when(F.col("id") % 2 == 0, 1.0).otherwise(3.0).alias("value"))
    fallback = base.select("day", "field", "cell_id", F.lit(1.0).alias("value"))
    assert DY.fallback_factors(primary, fallback, mesh, ["f"]).first()["factor"] == 2.0
    assert DY.fallback_factors(primary, fallback, mesh, ["f"], max_days=1).first()["factor"] == 1.0  # fewer than min_days


@pytest.mark.parametrize(("header", "record", "comma", "names"), [
    ('"DAY","LATI","AREA"', "1,2.0,3.0", True, ["day", "lati", "area"]),
    ("CO,LATI,AREA", "nan 2.0 3.0", False, ["co", "lati", "area"]),
    ("CO,LATI,AREA", "nan,2.0,3.0,", True, ["co", "lati", "area"]),
    ("CO LATI AREA", "x 2.0 3.0", False, ["co", "lati", "area"]),
])
def test_delimiter_follows_header_and_second_line(spark, header, record, comma, names):
    lines = spark.createDataFrame([("f", 5, "# note"), ("f", 9, header), ("f", 11, ""), ("f", 12, record), ("f", 20, "7,8,9")], "file string, pos int, line string")
    got = FT.file_layouts(FT.content_lines(lines)).first()
    assert (got["comma"], got["names"], got["head_pos"]) == (comma, names, 9)


def test_vegetation_checks_days_and_manifest(spark):
    mesh = spark.createDataFrame([(0, 0.1, 0.1, 1e9, 0)], "cell_id bigint, lat double, lon double, area_m2 double, bdy_mask int")
    fires = spark.createDataFrame([("2024-01-05", 77, 5.7, 5.7, 1, 2.0), ("2024-01-05", 5, 5.7, 5.7, 1, 2.0), ("2024-01-07", 7, 5.7, 5.7, 1, 2.0)], "d string, day_number int, lat double, lon double, genveg int, area double")
    fires = fires.withColumn("file_date", F.col("d").cast("date")).drop("d")
    size = spark.createDataFrame([("2024-01-05", 0, 2.0), ("2024-01-07", 0, 2.0)], "d string, cell_id bigint, value double").select(F.col("d").cast("date").alias("day"), "cell_id", "value")
    assert rules(FP.point_vegetation(fires, mesh, size)) == ["fatal_record", "manifest"]
    assert rules(FP.point_vegetation(fires.where("day_number = 5"), mesh, size.where("day = '2024-01-05'"))) == []


def test_error_profile_by_hand(spark):
    obs = spark.createDataFrame([(2.0, 1.0, 4.0), (4.0, 2.0, 8.0), (1.0, -3.0, 2.0)], "oman double, ombg double, obs double").withColumn("b", F.when(F.col("ombg") < 0, "n").otherwise("s"))
    got = D.band_error_profile(obs, F.col("b"), F.lit(0), ["s", "n"], [0])
    assert rows(got) == [("n", 0, 999.0, 1), ("s", 0, 0.75, 2)]  # (2*1/4 + 4*2/8) / 2; a negative mean is a failed diagnosis
    assert rows(D.band_error_profile(obs, F.col("b"), F.lit(0), ["s"], [0], percent=True)) == [("s", 0, 0.0075, 2)]


def test_error_profile_of_a_zero_value(spark):
    obs = spark.createDataFrame([(2.0, 1.0, 4.0, "s"), (-0.9, -1.5, 0.0, "s"), (2.0, -1.0, 0.0, "n"), (1.0, 1.0, 0.5, "m")], "oman double, ombg double, obs double, b string")
    got = D.band_error_profile(obs, F.col("b"), F.lit(0), ["s", "n", "m"], [0])
    assert rows(got) == [("m", 0, 2.0, 1), ("n", 0, 999.0, 1), ("s", 0, float("inf"), 2)]


def test_records_without_a_date_are_reported(spark):
    df = spark.createDataFrame([("/d/X_2021.txt", "40"), ("/d/X_2021.txt", "41"), ("/d/Y_202102.txt", "3")], "file string, day string")
    assert rows(FT.undated(FT.container_dates(df, mode="dom"))) == [("/d/X_2021.txt", 2)]
    assert rows(FT.undated(FT.container_dates(df, mode="auto"))) == []


def test_products_are_all_or_nothing(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "p")
    make = lambda x, f="a": spark.createDataFrame([("q", f, 0, x), ("q", f, 1, 2.0)], "product string, field string, cell_id int, value double")
    facts = spark.createDataFrame([(1.0,)], "source_time_offset_hours double")
    assert products.write_product(make(1.0), path, facts) == 1
    assert products.write_product(make(5.0, "b"), path, facts) == 2
    values = lambda v=None: [r[-1] for r in rows(products.read_product(spark, path, v).select("field", "cell_id", "value"))]
    assert values() == [1.0, 2.0, 5.0, 2.0] and values(1) == [1.0, 2.0]
    with pytest.raises(products.ProductRejected, match="not finite"):
        products.write_product(make(1e39), path, facts.selectExpr("9.0 AS source_time_offset_hours"))
    with pytest.raises(products.ProductRejected, match="rule"):
        products.write_product(make(3.0), path, facts, violations=spark.createDataFrame([("rule", "x")], "rule string, detail string"))
    broken = make(3.0).withColumn("value", F.raise_error(F.lit("lost")).cast("double"))
    with pytest.raises(Exception, match="lost"):
        products.write_product(broken, path, facts)
    # a writer that is stopped at any step of publishing: the older product stays whole
    for step in ("publish", "_rename", "file_system"):
        calls = [0]

        def stop(*a, own=getattr(files, step), **k):
            calls[0] += 1
            if step != "file_system" or calls[0] == 7:
                raise KeyboardInterrupt
            return own(*a, **k)

        monkeypatch.setattr(files, step, stop)
        with pytest.raises(KeyboardInterrupt):
            products.write_product(make(7.0), path, facts)
        monkeypatch.undo()
        assert values() == [1.0, 2.0, 5.0, 2.0]
    assert products.reuse_decision(spark, path, 1.0) == "reuse" and products.reuse_decision(spark, path, 2.0) == "rebuild"
    # of two writers that began at one version the later one fails, and its values are seen by nobody
    own = products._partitions

    def meanwhile(*a):
        monkeypatch.setattr(products, "_partitions", own)
        products.write_product(make(8.0, "c"), path)
        return own(*a)

    monkeypatch.setattr(products, "_partitions", meanwhile)
    with pytest.raises(files.Conflict):
        products.write_product(make(9.0), path)
    assert values() == [1.0, 2.0, 5.0, 2.0, 8.0, 2.0]
    assert products.write_product(make(4.0), path, drop=["/product=q/field=b"]) == 4 and values() == [4.0, 2.0, 8.0, 2.0]
    assert len(products.vacuum(spark, path, 1)) >= 4 and values() == [4.0, 2.0, 8.0, 2.0]
    with pytest.raises(products.ProductRejected, match="partitioned"):
        products.write_product(make(4.0), path, partition_by=("field",))


@pytest.mark.parametrize("at_once", [3, 50, 10**6])
def test_quantiles_in_steps(spark, monkeypatch, at_once):
    monkeypatch.setattr(quantiles, "AT_ONCE", at_once)
    x = np.random.default_rng(2).normal(size=300).round(2).tolist() + [0.25] * 60 + [1e6, -1e6]
    probs = [0.0, 0.1, 0.37, 0.5, 0.99, 1.0]
    df = spark.createDataFrame([(v,) for v in x] + [(None,)], "v double").repartition(3)
    got = dict(rows(quantiles.exact_quantiles(df, "v", probs, bins=16)))
    assert got == {p: pytest.approx(np.quantile(x, p)) for p in probs}
    odd = spark.createDataFrame([(math.inf,), (-math.inf,), (1.0,), (math.nan,), (2.0,)], "v double")
    assert dict(rows(quantiles.exact_quantiles(odd, "v", [0.0, 0.25, 0.5, 0.75], bins=4))) == {0.0: -math.inf, 0.25: 1.0, 0.5: 2.0, 0.75: math.inf}
    assert quantiles.exact_quantiles(df.where("v > 1e7"), "v", probs).count() == 0


def test_settled_tables_can_be_discarded(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(session, "work_dir", lambda spark: str(tmp_path))
    assert session.settle(spark.range(5)).count() == 5 and any(tmp_path.rglob("*.parquet"))
    session.discard(spark)
    assert not any(tmp_path.rglob("*.parquet"))
    first, second = session.settle(spark.range(5)), session.settle(spark.range(6))
    assert [first.settled_at, second.settled_at] == session.settled(spark)[-2:]
    session.discard(spark, [first.settled_at])
    assert session.settled(spark)[-1] == second.settled_at and first.settled_at not in session.settled(spark) and second.count() == 6


def test_factor_table(spark):
    df = spark.createDataFrame([("BC_x", "bc", "awb")], "field string, sp string, sec string")
    block = {"default": 2.0, "species": {"Black_Carbon": 3.0, "BC": 5.0}, "sectors": {"awb": 0.0, "ene": 7.0}}
    one = lambda *a: df.select(S.scaling_factor(*a).alias("f")).first()["f"]
    assert one(block, [F.lit("none"), F.lit(" black-carbon "), F.col("sp")]) == 6.0
    assert one(block, [F.col("sp")], None, F.col("sec")) == 0.0
    assert one(block, [F.lit("x")], F.col("field"), F.lit("other")) == 2.0
    assert one(0.25, [F.lit("x")]) == 0.25 and one(None, [F.lit("x")]) == 1.0


def test_species_weights_table(spark):
    got = species_weights(spark, [{"source": "SO2", "target": "so2", "weight": 2.0}, {"source": "NH3", "target": "q"}], {"so2": 3.0, "Q": 5.0, "nh3": 0.5})
    assert rows(got) == [("NH3", "q", 2.5), ("SO2", "so2", 6.0)]
