import math

import duckdb
import numpy as np
import pandas as pd
import pytest
from conftest import rows
from pyspark.sql import functions as F

from gridspark.llm import topk


def brute(data, every=10, k=5):
    fine = {i: [math.floor(256 * float(c)) for c in x] for i, x in data if i is not None and x and all(c is not None and math.isfinite(c) for c in x)}
    out = []
    for q in sorted(fine):
        if q % every == 0:
            got = sorted((-sum(a * b for a, b in zip(fine[q], x, strict=True)), i) for i, x in fine.items() if i != q and len(x) == len(fine[q]))[:k]
            out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(got)]
    return out


@pytest.mark.parametrize(("block", "n"), [(1024, 300), (16, 300), (4, 3), (1024, 1)])
def test_against_brute_force_and_sql(spark, monkeypatch, block, n):
    monkeypatch.setattr(topk, "BLOCK", block)
    monkeypatch.setattr(topk, "SAMPLE", 100)
    draw = np.random.default_rng(n)
    centres = draw.normal(size=(6, 12)) * 2
    data = [(i, (centres[draw.integers(6)] + draw.normal(size=12) * draw.choice([0.05, 0.5, 2])).astype(np.float32).tolist()) for i in range(n)]
    hot = data[0][1]
    data += [(1000 + i, hot) for i in range(40)] if n > 1 else []  # many ties
    df = spark.createDataFrame(data, "vec_id long, embedding array<float>").repartition(5)
    got = rows(topk.top_k(df, F.col("vec_id") % 10 == 0))
    assert got == brute(data)
    con = duckdb.connect()
    con.register("t", pd.DataFrame(data, columns=["vec_id", "embedding"]))
    con.execute("create table embeddings as select vec_id, cast(embedding as float[]) as embedding from t")
    assert rows(topk.top_k(df, F.col("vec_id") % 50 == 0)) == sorted(con.execute(topk.SQL).fetchall())


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    data = [(0, [1.0, 2.0]), (1, None), (2, [nan, 1.0]), (3, [1.0, None]), (4, [inf, 0.0]), (5, [0.0, 0.0]), (6, [-3.0, 1.0]), (10, [1.0]), (20, [2.0]), (30, []), (40, [1e15, 1e15]), (50, [-1e15, 2.0])]
    df = spark.createDataFrame([(*d, 1, 1.0) for d in data], "vec_id long, embedding array<double>, ring int, score double")
    got = rows(topk.top_k(df, F.col("vec_id") % 10 == 0))
    want = [(q, r, i, max(-(2**63), min(2**63 - 1, s))) for q, r, i, s in brute(data)]
    assert [g[:3] for g in got] == [w[:3] for w in want] and [g[3] for g in got] == [w[3] for w in want]
    again = df.unionAll(df).unionAll(spark.createDataFrame([(None, [9.0, 9.0], 1, 1.0)], df.schema))
    assert rows(topk.top_k(again, F.col("vec_id") % 10 == 0)) == got
    assert topk.top_k(df.where("false"), F.col("vec_id") % 10 == 0).count() == 0
    assert topk.top_k(df, F.col("vec_id") == 7).count() == 0


def test_rings_are_skipped(spark):
    """The radius of a good first score leaves most rings out."""
    draw = np.random.default_rng(0)
    v = draw.normal(size=(200, 3))
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    index = topk.Index(v * 256, ((v * 256) ** 2).sum(axis=1), 256.0**2)
    pivot, ring, d = index.place(index.lifted(v * 256, ((v * 256) ** 2).sum(axis=1)))
    q = index.distances(np.column_stack([v * 256, np.zeros(200)]))
    exact = np.linalg.norm(v[:, None] - v[None, :], axis=2) * 256
    assert (np.abs(q[:, pivot] - d[None, :]) <= exact + 1e-3).all()
