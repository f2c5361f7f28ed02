import math
import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from gridspark.operators import audit, identity


def tree(df, bits=2):
    return identity.digest_tree(df, "k", identity.row_text(["k", "v"]), bits)


def test_one_change_names_its_range(spark):
    df = spark.createDataFrame([(k, k * 0.5) for k in range(-9, 200)] + [(None, 1.0), (7, 3.5)], "k long, v double").repartition(3)
    before = tree(df)
    top = before.agg(F.max("level")).first()[0]
    assert before.where(F.col("level") == top).count() == 1 and before.where(F.col("level") == top).first()["n_rows"] == 211
    same = tree(df.repartition(5))
    assert identity.root(before).collect() == identity.root(same).collect() and identity.changed_ranges(before, same, 2).count() == 0
    moved = tree(df.withColumn("v", F.when(F.col("k") == 41, 0.0).otherwise(F.col("v"))))
    assert [r.range_id for r in identity.changed_ranges(before, moved, 2).collect()] == [41 >> 2]
    # two changes whose numbers cancel out are two ranges
    swapped = tree(df.withColumn("v", F.expr("case k when 20 then v + 1 when 100 then v - 1 else v end")))
    assert sorted(r.range_id for r in identity.changed_ranges(before, swapped, 2).collect()) == [5, 25]
    gone = tree(df.where("k is not null and k <> 0"))
    assert {(r.range_id, r.n_before, r.n_after) for r in identity.changed_ranges(before, gone, 2).collect()} == {(None, 1, None), (0, 4, 3)}


def test_a_growing_table_keeps_its_nodes(spark):
    df = spark.createDataFrame([(k, float(k)) for k in range(300)], "k long, v double")
    small, large = tree(df.where("k < 64")), tree(df)
    kept = small.where("level = 0").join(large.where("level = 0"), ["range_id", "digest"], "left_semi")
    assert kept.count() == 16
    assert sorted(r.range_id for r in identity.changed_ranges(small, large, 2).collect()) == list(range(16, 75))
    assert tree(df.where("false")).where("n_rows > 0").count() == 0


@pytest.mark.parametrize("ranges", [1, 16, 4096])
def test_difference_of_ranges_is_that_of_rows(spark, ranges):
    rnd = random.Random(ranges)
    some = [None, math.nan, math.inf, 0.0, -0.0, 1.5]
    a = [(i, f"x{i % 3}", rnd.choice(some[3:]), i * 1.0) for i in range(400)]
    b = [(k, x, rnd.choice(some) if k % 90 == 4 else v, w + (k % 50 == 7)) for k, x, v, w in a if k % 40 != 3] + [(1000, "y", 1.0, 2.0)]
    schema = "k long, x string, v double, w double"
    left, right = spark.createDataFrame(a, schema).repartition(3), spark.createDataFrame(b, schema).repartition(2)

    def facts(df):
        return [tuple("nan" if isinstance(x, float) and math.isnan(x) else round(x, 9) if isinstance(x, float) else x for x in r) for r in rows(df)]

    for x, y in ((left, right), (left, left), (left.where("false"), right), (right, right.withColumn("v", F.lit(math.nan)))):
        assert facts(audit.diff_large(x, y, ["k", "x"], ["v", "w"], ranges)) == facts(audit.diff_tables(x, y, ["k", "x"], ["v", "w"]))
    odd = left.withColumn("v", F.when(F.col("k") == 5, math.inf).otherwise(F.col("v")))
    assert facts(audit.diff_large(odd, odd, ["k"], ["v"], ranges)) == facts(audit.diff_tables(odd, odd, ["k"], ["v"]))
