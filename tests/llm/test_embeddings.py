import duckdb
import numpy as np
import pandas as pd
from conftest import rows

from gridspark.llm import embeddings


def made(seed=1, dim=16):
    draw = np.random.default_rng(seed)
    out = []
    for label in (0, 1, 2):
        for _ in range(25):
            base = draw.normal(size=dim)
            for _ in range(draw.choice([1, 1, 3, 9])):
                out.append((len(out), label, (draw.uniform(0.2, 5) * (base + draw.normal(size=dim) * draw.choice([0, 0.05, 0.15]))).tolist()))
    hot = draw.normal(size=dim)
    out += [(len(out) + i, 1, (hot + draw.normal(size=dim) * 0.02).tolist()) for i in range(150)]
    return out


def brute(data, least=0.98):
    link = {i: set() for i, _, _ in data}
    for i, a, x in data:
        for j, b, y in data:
            if i < j and a is not None and a == b and x and y and len(x) == len(y):
                x_, y_ = np.array(x, float), np.array(y, float)
                if np.isfinite(x_).all() and np.isfinite(y_).all() and x_.any() and y_.any() and x_ @ y_ / np.linalg.norm(x_) / np.linalg.norm(y_) >= least:
                    link[i].add(j)
                    link[j].add(i)
    comp = {}
    for i in sorted(link):
        todo = [i]
        while todo:
            k = todo.pop()
            if k not in comp:
                comp[k] = i
                todo += link[k]
    return [(i, len(link[i]), comp[i], comp[i] == i) for i in sorted(link)]


def test_against_brute_force_and_sql(spark, monkeypatch):
    data = made()
    df = spark.createDataFrame(data, "vec_id long, label int, embedding array<float>").repartition(4)
    data = [(r.vec_id, r.label, list(r.embedding)) for r in df.collect()]
    want = brute(data)
    assert rows(embeddings.near_duplicates(df)) == want
    monkeypatch.setattr(embeddings, "TILE", 7)
    assert rows(embeddings.near_duplicates(df)) == want
    table = pd.DataFrame(data, columns=["vec_id", "label", "embedding"])
    con = duckdb.connect()
    con.register("t", table)
    con.execute("create table embeddings as select vec_id, label, cast(embedding as float[]) as embedding from t")
    assert sorted(con.execute(embeddings.SQL).fetchall()) == want


def test_unusable_vectors(spark):
    nan, inf = float("nan"), float("inf")
    one = [1.0, 0.0, 0.0]
    data = [(0, 1, one), (1, 1, [2.0, 0.0, 0.0]), (2, None, one), (3, 1, None), (4, 1, [0.0, 0.0, 0.0]), (5, 1, [1.0, None, 0.0]), (6, 1, [1.0, nan, 0.0]),
            (7, 1, [inf, 0.0, 0.0]), (8, 2, one), (9, 1, [1.0, 0.0]), (10, 1, []), (11, 1, [-1.0, 0.0, 0.0]), (12, 1, [1e300, 1e290, 0.0]), (13, 1, [1e-300, 0.0, 0.0])]
    df = spark.createDataFrame([(*d, 0, "k") for d in data], "vec_id long, label int, embedding array<double>, cell int, side string")
    linked = {0: 0, 1: 0, 12: 0, 13: 0}
    assert rows(embeddings.near_duplicates(df)) == [(i, 3 if i in linked else 0, linked.get(i, i), linked.get(i, i) == i) for i, *_ in data]
    again = df.unionAll(df.where("vec_id < 2")).unionAll(spark.createDataFrame([(None, 1, one, 0, "k")], df.schema))
    assert rows(embeddings.near_duplicates(again))[:5] == [(None, 0, None, True), (0, 3, 0, True), (0, 3, 0, True), (1, 3, 0, False), (1, 3, 0, False)]
    assert embeddings.near_duplicates(df.where("false")).count() == 0


def test_count_is_calibrated():
    need = embeddings.least_collisions()
    draw = np.random.default_rng(0)
    gaps = np.abs(draw.normal(size=(200_000, embeddings.PROJECTIONS)))
    assert ((gaps <= embeddings.WIDTH).sum(axis=1) >= need).mean() >= 0.99999
    assert need >= embeddings.PROJECTIONS // 2
