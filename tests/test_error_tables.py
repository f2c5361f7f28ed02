import math
import random

import pytest

from gridspark.operators import error_tables as T


def curve(knots, x):
    knots = sorted(knots)
    if x <= knots[0][0]:
        return knots[0][1]
    for (a, ea), (b, eb) in zip(knots, knots[1:]):
        if x <= b:
            return ea if a == b else ea + (x - a) * (eb - ea) / (b - a)
    return knots[-1][1]


@pytest.mark.parametrize("buckets", [1, 256])
def test_every_observation_takes_its_winning_rule(spark, monkeypatch, buckets):
    monkeypatch.setattr(T, "BUCKETS", buckets)
    rnd = random.Random(buckets)
    params = []
    for p in range(30):
        n = rnd.randint(2, 6)
        xs = rnd.sample([v * 2.5 for v in range(40)], n)
        lo, hi = sorted(rnd.sample([-90.0, -60.0, -30.0, 0.0, 30.0, 60.0, 90.0], 2))
        params.append((rnd.choice([None, "1", "2", "7"]), rnd.choice([None, "sea"]), *rnd.choice([(lo, hi), (None, hi), (None, None)]), rnd.choice([None, "refrac"]), p, xs, [rnd.random() for _ in xs]))
    schema = "channel string, surface string, lat_min double, lat_max double, scale string, priority int, xvals array<double>, errors array<double>"
    rules = T.stepwise_rules(spark.createDataFrame(params, schema))
    obs = [(i, rnd.choice([1, 2, 3, 7, None]), rnd.choice(["sea", "land", None]), rnd.choice([-90.0, -60.0, -45.5, 0.0, 12.0, 30.0, 90.0, None]), rnd.choice([None, math.nan, -5.0, 0.0, 2.5, 50.0, 97.5, 1000.0, rnd.random() * 100]), rnd.random() * 300) for i in range(600)]
    df = spark.createDataFrame(obs, "id int, channel int, surface string, lat double, height double, refrac double")
    got = {r["id"]: r["error"] for r in T.assign_errors(df, rules, "height", "lat", "channel", "surface", ("refrac",)).collect()}
    assert len(got) == 600
    some = 0
    for i, ch, sf, la, x, scale in obs:
        fit = [p for p in params if la is not None and x is not None and not math.isnan(x) and (p[0] is None or p[0] == str(ch)) and (p[1] is None or p[1] == sf)
               and (p[2] is None or la >= p[2]) and (p[3] is None or la <= p[3])]
        want = None if not fit else curve(list(zip(fit[-1][6], fit[-1][7])), x) * (scale if fit[-1][4] else 1.0)
        assert got[i] is None if want is None else got[i] == pytest.approx(want), (i, fit[-1:])
        some += want is not None
    assert some > 200


def test_ramps_by_channel_and_empty_tables(spark):
    params = spark.createDataFrame([(1, 0.1, 1.0, 0.05, 0.32), (2, 0.0, 0.0, 1.0, 2.0)], "channel int, x0 double, x1 double, err0 double, err1 double")
    df = spark.createDataFrame([(1, 0.0), (1, 0.55), (1, 3.0), (2, -1.0), (2, 0.5), (3, 0.5)], "channel int, x double")
    got = sorted((r["channel"], r["x"], r["error"]) for r in T.assign_errors(df, T.ramp_rules(params), "x", channel="channel").collect())
    assert [g[2] if g[2] is None else round(g[2], 6) for g in got] == [0.05, 0.185, 0.32, 1.0, 2.0, None]
    none = T.ramp_rules(params.where("false"))
    assert [r["error"] for r in T.assign_errors(df, none, "x", channel="channel").collect()] == [None] * 6
    assert T.assign_errors(df.where("false"), T.ramp_rules(params), "x", channel="channel").count() == 0
