import math
import random
import re
from collections import Counter

import duckdb
import numpy as np
import pandas as pd
import pytest
from conftest import rows

from gridspark.llm import ranked

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
order = lambda r: [(x is not None, x) for x in r]


def terms(t):
    return [re.sub("[A-Z]", lambda m: m[0].lower(), x) for x in TERM.findall(t or "")]


def brute(docs, items, k):
    got = [(i, terms(t)) for i, t in docs]
    n, words = sum(bool(w) for _, w in got), sum(len(w) for _, w in got)
    df, out = Counter(x for _, w in got for x in set(w)), []
    for item, t in items:
        asked, found = set(terms(t)), []
        for i, w in got:
            tf, score = Counter(w), 0
            for x in asked & tf.keys():
                m = 100 - 90 + 90 * len(w) * n // words
                score += math.floor(1000 * math.log((2 * n + 2) / (2 * df[x] + 1))) * (10**9 * tf[x] // (1000 * tf[x] + 8 * m))
            if score > 0:
                found.append((-score, (i is not None, i)))
        out += [(item, r + 1, i, -s) for r, (s, (_, i)) in enumerate(sorted(found)[:k])]
    return sorted(out, key=order)


def made(seed):
    rnd = random.Random(seed)
    words = [f"w{i}" for i in range(60)] + ["É", "é", "日本", "X9", "x9", "it's", "a-b"]
    text = lambda n: rnd.choice([" ", "\n", ". "]).join(rnd.choice(words[: rnd.choice([5, 20, 67])]) for _ in range(n))
    docs = [(i, text(rnd.choice([0, 1, 5, 30, 200]))) for i in range(400)] + [(500, None), (501, "..."), (None, "w1 w2"), (None, "w1 w2"), (None, None)]
    docs += [(600 + i, docs[7][1]) for i in range(30)] + [docs[9]] * 3 + [(800, "w3 " * 20_000)]
    items = [(i, text(rnd.randint(1, 25))) for i in range(12)] + [(20, None), (21, ""), (22, "unknown words"), (None, "w5 w6"), (0, "w5 w5 W6"), (23, "w1 w2 w3 w4")]
    return docs, items


@pytest.mark.parametrize("small", [False, True])
def test_search_against_brute_force_and_sql(spark, monkeypatch, small):
    docs, items = made(int(small))
    if small:  # many shards, rounds and blocks
        for name, value in (("SHARD_DOCS", 7), ("SHARD_POSTINGS", 60), ("BLOCK_TERMS", 30), ("_PIECE", 50), ("FIRST_READ", 1)):
            monkeypatch.setattr(ranked, name, value)
    d = spark.createDataFrame([(*x, 1, "z") for x in docs], "doc_id long, text string, score int, item_id string").repartition(5)
    i = spark.createDataFrame([(*x, 1) for x in items], "item_id long, text string, doc_id int")
    got = sorted((tuple(r) for r in ranked.search(d, i).collect()), key=order)
    assert got == brute(docs, items, 10)
    documents = pd.DataFrame(docs, columns=["doc_id", "text"]).astype({"doc_id": "Int64"})  # noqa: F841
    benchmark = pd.DataFrame(items, columns=["item_id", "text"]).astype({"item_id": "Int64"})  # noqa: F841
    assert sorted(duckdb.connect().execute(ranked.SQL).fetchall(), key=order) == got
    assert [tuple(r) for r in ranked.search(d, i.where("item_id = 23"), k=3).select("rank").orderBy("rank").collect()] == [(1,), (2,), (3,)]
    assert ranked.search(d.where("false"), i).count() == 0 and ranked.search(d, i.where("false")).count() == 0


def test_text_ids(spark):
    d = spark.createDataFrame([("b", "x y"), ("a", "x y"), ("é", "x"), (None, "x y"), ("c", "z z"), ("d", "q")], "doc_id string, text string")
    i = spark.createDataFrame([("q", "x y")], "item_id string, text string")
    assert [r.doc_id for r in ranked.search(d, i).orderBy("rank").collect()] == [None, "a", "b", "é"]


def test_reads_stop_when_all_is_resolved():
    rnd = np.random.default_rng(1)
    lists = []
    for _ in range(3):
        docs = rnd.permutation(5000)
        impact = np.sort(rnd.integers(1, 100, 5000))[::-1].copy()
        impact[:2] = 10_000
        docs = np.concatenate([[1, 2], docs[(docs != 1) & (docs != 2)]])
        lists.append((docs, impact[: len(docs)]))
    found, scores, read = ranked.nra(lists, 5000, 2, [], first=8)
    assert sorted(found.tolist()) == [1, 2] and scores.tolist() == [30_000, 30_000] and read < 100
    found, scores, read = ranked.nra(lists, 5000, 2, [50_000, 40_000], first=8)
    assert not len(found) and read < 100
