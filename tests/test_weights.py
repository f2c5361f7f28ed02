import numpy as np
import pandas as pd
import pytest
from conftest import rows
from pyspark.sql import functions as F

from gridspark.operators import scaling as S
from gridspark.operators import weights as W
from gridspark.operators.quantiles import exact_quantiles
from gridspark.operators.skew import hot_keys, lookup_join, salted_join
from gridspark.session import PARTITION_KEY, keep_partitions, settle


@pytest.fixture
def links(spark):
    data = [(0, 1, 1, .5), (1, 2, 3, .5), (2, 1, 2, .5), (3, 2, 4, .5)]
    return spark.createDataFrame(data, "link_no bigint, row bigint, col bigint, s double")


def test_apply(spark, links):
    v = spark.createDataFrame([("t", i, float(x)) for i, x in enumerate([10, 20, 30, 40])], "k string, src_id bigint, value double")
    out = W.apply_weights(v, W.zero_based(links), ["k"])
    assert rows(out, "dst_id") == [("t", 0, 15.0), ("t", 1, 35.0)]


def test_sector_exclusion(spark, links):
    data = []
    for t in range(12):
        for i in range(4):
            data += [(t, i, "sum", 10.0 * (i + 1) + t), (t, i, "awb", float(i + 1))]
    v = spark.createDataFrame(data, "month int, src_id bigint, sector string, value double")
    adjusted, bad = S.adjust_sector_sum(v, ["month", "src_id"], ["awb"], {}, None, [F.lit("co")])
    out = W.apply_weights(adjusted, W.zero_based(links), ["month", "sector"]).filter("month = 0")
    assert rows(out, "sector", "dst_id") == [(0, "awb", 0, 0.0), (0, "awb", 1, 0.0), (0, "sum", 0, 13.5), (0, "sum", 1, 31.5)]
    assert bad.count() == 0


def test_negative_sum_is_reported(spark):
    v = spark.createDataFrame([(0, 0, "sum", 1.0), (0, 0, "awb", 2.0)], "month int, src_id bigint, sector string, value double")
    out, bad = S.adjust_sector_sum(v, ["month", "src_id"], ["awb"], {}, None, [F.lit("co")])
    assert bad.count() == 1
    assert out.filter("sector = 'sum'").first()["value"] == 0.0


def test_validation_of_regional_weights(spark):
    w = spark.createDataFrame([(0, 0, .5), (0, 1, .5), (1, 2, 1.)], "dst_id bigint, src_id bigint, s double")
    assert W.validate_weights(w, 2, 4).count() == 0
    assert rows(W.validate_weights(w, 2, 4, True, True).select("rule", "n")) == [("missing_source", 1)]
    assert rows(W.validate_weights(w, 3, 4).select("rule", "n")) == [("missing_destination", 1)]
    outside = w.union(spark.createDataFrame([(5, 0, float("nan"))], w.schema))
    assert {r["rule"] for r in W.validate_weights(outside, 2, 4).collect()} == {"index_outside", "nonfinite"}
    assert {r["rule"] for r in W.validate_weights(w.limit(0), 2, 4).collect()} >= {"empty"}


def test_link_statistics_match_numpy(spark):
    rng = np.random.default_rng(1)
    dst = rng.integers(0, 40, 500)
    w = spark.createDataFrame([(int(d), int(i), 1.0) for i, d in enumerate(dst)], "dst_id bigint, src_id bigint, s double")
    n = np.bincount(dst, minlength=50)
    r = W.link_statistics(w, "dst_id", 50).first()
    want = (n.min(), np.median(n), n.mean(), np.percentile(n, 95), np.percentile(n, 99), n.max())
    assert np.allclose([r["min"], r["median"], r["mean"], r["p95"], r["p99"], r["max"]], want)


def test_order_resets(spark):
    l = spark.createDataFrame([(i, r) for i, r in enumerate([1, 2, 2, 1, 5, 4])], "link_no bigint, row bigint")
    assert tuple(W.order_resets(l).first()) == (2, 3)


@pytest.mark.parametrize("values", [[3.0, 1.0, 2.0, 2.0, 2.0, 9.0], [5.0], [float(i % 7) for i in range(400)]])
def test_exact_quantiles(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v double")
    got = {r["prob"]: r["value"] for r in exact_quantiles(df, "v", [0.0, 0.25, 0.5, 0.99, 1.0], bins=5).collect()}
    for p, v in got.items():
        assert v == pytest.approx(np.percentile(values, 100 * p))
    assert len(got) == 5


def test_hot_key_join_is_whole(spark):
    """One key with a third of the rows gives the same result as the plain join."""
    left = spark.range(3000).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("k"), "id")
    right = spark.range(3000).select(F.col("id").alias("k"), (F.col("id") * 2).alias("x"))
    assert hot_keys(left, ["k"]) == [(7,)]
    a = salted_join(left, right, ["k"], salts=8)
    b = left.join(right, "k")
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    c = lookup_join(left, right, ["k"])
    assert c.exceptAll(left.join(right, "k", "left")).count() == 0
    assert salted_join(left, right, ["k"], "left_semi").count() == 3000


def test_hot_weights_and_partition_count(spark):
    w = spark.range(4000).select((F.col("id") % 50).alias("dst_id"), F.when(F.col("id") % 2 == 0, 3).otherwise(F.col("id") % 97).alias("src_id"),
                                 (F.col("id") / 100.0).alias("s"))
    v = spark.range(97).select(F.lit("f").alias("k"), F.col("id").alias("src_id"), (F.col("id") * 1.5).alias("value"))
    results = []
    for n in ("1", "64"):
        spark.conf.set("spark.sql.shuffle.partitions", n)
        results.append(rows(W.apply_weights(v, w, ["k"]), "dst_id"))
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert np.allclose([r[2] for r in results[0]], [r[2] for r in results[1]], rtol=1e-12)
    assert len(results[0]) == 50


def test_densify(spark):
    cells = spark.range(3).select(F.col("id").alias("cell_id"))
    v = spark.createDataFrame([("a", 1, 5.0)], "field string, cell_id bigint, value double")
    out = W.densify(v, cells, {"field": F.array(F.lit("a"), F.lit("b"))})
    assert rows(out.select("field", "cell_id", "value")) == [("a", 0, 0.), ("a", 1, 5.), ("a", 2, 0.), ("b", 0, 0.), ("b", 1, 0.), ("b", 2, 0.)]


def test_scaling_aliases_and_negative(spark):
    df = spark.createDataFrame([("NH3", "nh3_anth_sum", "awb", 2.0), ("co", "x", "ene", 2.0)], "sp string, f string, s string, value double")
    block = {"default": 2.0, "species": {"nh3": 0.5}, "fields": {"NH3-anth_sum": 3.0}, "sectors": {"ene": -1.0}}
    out = S.apply_scaling(df, [block], [F.lit("ammonia"), F.col("sp")], F.col("f"), F.col("s"))
    assert [r["value"] for r in out.orderBy("sp").collect()] == [6.0, -4.0]
    assert S.negative_factors(out).count() == 1


def test_routing_of_nh3(spark):
    cases = [("cntl", "", "", "cams"), ("pert03", "", "", "cams"), ("pert03", "", "follow-anth", "ceds"), ("pert06", "", "follow-anth", "cams"),
             ("cntl", "ceds", "follow-anth", "ceds"), ("pert03", "", "ceds", "ceds")]
    df = spark.createDataFrame([(i, v, a, "", "", n) for i, (v, a, n, _) in enumerate(cases)],
                               "request_id int, variant string, anth string, biob string, biog string, nh3 string")
    out = S.route_inventories(df).filter("dimension = 'anth' AND species = 'nh3'").orderBy("request_id").collect()
    assert [r["inventory"] for r in out] == [c[3] for c in cases]
    unknown = spark.createDataFrame([(0, "nope", "", "", "", "")], df.schema)
    assert S.route_inventories(unknown).filter("NOT known AND species <> 'nh3'").count() > 0


def test_member_table(spark):
    schema = "member int, anth string, biob string, biog string, dust_relative double, seasalt_relative double"
    good = [(m, "cams", "gfas", "cams", 1.0 + m, 0.5) for m in range(1, 13)]
    out, bad = S.member_factors(spark.createDataFrame(good, schema), {"dust": 2.0, "seasalt": 1.0}, 12)
    assert bad.count() == 0 and out.filter("member = 3").first()["dust_factor"] == 8.0
    for broken in ([(1, "cams", "gfas", "cams", float("nan"), 1.0)], [(1, "cams", "gfas", "cams", -1.0, 1.0)], [(1, "cams", "gfas", "cams", float("inf"), 1.0)]):
        assert S.member_factors(spark.createDataFrame(broken + good[1:], schema), {"dust": 2.0, "seasalt": 1.0}, 12)[1].count() == 1
    assert S.member_factors(spark.createDataFrame(good, schema), {"dust": 2.0, "seasalt": 1.0}, 13)[1].count() == 1


def test_blocks_of_the_product(spark):
    rng = np.random.default_rng(3)
    v = pd.DataFrame({"r": rng.integers(0, 40, 3000).astype(str), "src_id": rng.integers(0, 50, 3000)}).drop_duplicates()
    v["a"], v["b"] = rng.random(len(v)), rng.random(len(v))
    w = pd.DataFrame({"dst_id": rng.integers(0, 300, 4000), "src_id": rng.integers(0, 50, 4000)}).drop_duplicates()
    w["s"] = rng.random(len(w))
    values, links = settle(spark.createDataFrame(v)), settle(spark.createDataFrame(w))
    m = v.merge(w, on="src_id")
    for c in "ab":
        m[c] *= m.s
    want = m.groupby(["r", "dst_id"])[["a", "b"]].sum()
    before = spark.conf.get(PARTITION_KEY)
    spark.conf.set(PARTITION_KEY, "true")  # a plain session
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        with keep_partitions(spark):
            out = W.apply_weights_packed(values, links, ["r"], {"a": "x", "b": "y"}, blocks=3)
            got = {(r.r, r.dst_id, r.field): r.value for r in out.collect()}
            # both sides are dealt once; neither the join nor the sums move a row again
            assert out._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0].count("Exchange hashpartitioning") == 2
        assert spark.conf.get(PARTITION_KEY) == "true"
    finally:
        spark.conf.set(PARTITION_KEY, before)
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert len(got) == 2 * len(want)
    assert all(abs(got[(r, d, f)] - row[c]) < 1e-9 for (r, d), row in want.iterrows() for c, f in (("a", "x"), ("b", "y")))
    # sparse records do not combine on their way, a few dense ones do
    fan = spark.range(6000).selectExpr("id % 1999 as dst_id", "id % 300 as src_id")
    many, few = (spark.range(60000).selectExpr(f"cast(id % {n} as string) as r", "id % 301 as src_id") for n in (1000, 2))
    assert W.use_blocks(many, fan, ["r"], pairs_from=1) and not W.use_blocks(few, fan, ["r"], pairs_from=1)
    assert not W.use_blocks(many, fan, ["r"])


def test_passes_of_the_product_make_it_whole(spark):
    values = spark.createDataFrame([(r, c, float(r * c % 7), float(c)) for r in range(30) for c in range(40) if (r + c) % 3], "r long, src_id long, a double, b double")
    links = spark.createDataFrame([(d, c, 0.5) for c in range(40) for d in range(c % 5, 12, 3)], "dst_id long, src_id long, s double")
    for blocks in (1, 5, 6):
        whole = rows(W.apply_weights_packed(values, links, ["r"], {"a": "x", "b": "y"}, blocks))
        parts = [rows(W.apply_weights_packed(values, links, ["r"], {"a": "x", "b": "y"}, blocks, p)) for p in W.passes(blocks)]
        assert [g for p in W.passes(blocks) for g in p] == list(range(blocks))
        assert all(len(p) <= W.AT_ONCE for p in W.passes(blocks)) and len(whole) == sum(map(len, parts))
        assert sorted(x for p in parts for x in p) == whole
