import hashlib
import random

import duckdb
import pandas as pd
import pytest
from conftest import rows

from gridspark.llm import mixing


def brute(data, weights=(3, 1, 2), share=1.5, most=2.0):
    size = lambda t: len("".join(" " if c in "\t\n\x0b\x0c\r" else c for c in t or "").replace(" ", "\0").split("\0")) - "".join(" " if c in "\t\n\x0b\x0c\r" else c for c in t or "").split(" ").count("")
    total, order = {}, sorted({s for _, s, _ in data}, key=lambda s: (s is None, (s or "").encode()))
    for _, s, t in data:
        total[s] = total.get(s, 0) + size(t)
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    target, open_ = {}, set(order)
    while True:  # share, stop those above, share again
        left = share * sum(total.values()) - sum(target.get(s, 0) for s in order if s not in open_)
        level = left / sum(weight[s] for s in open_) if open_ else 0
        over = [s for s in open_ if level * weight[s] > most * total[s]]
        if not over:
            break
        for s in over:
            target[s] = most * total[s]
            open_.discard(s)
    target |= {s: level * weight[s] for s in open_}
    out = []
    for s in order:
        mine = sorted((hashlib.md5(f"mix:{'' if i is None else i}".encode()).hexdigest(), i, size(t)) for i, x, t in data if x == s)
        epochs = int(target[s] // total[s]) if total[s] else 0
        budget, seen = target[s] - epochs * total[s], 0
        for _, i, n in mine:
            out.append((i, n, total[s], pytest.approx(target[s]), n * (epochs + (seen + n / 2 <= budget))))
            seen += n
    return sorted(out, key=lambda r: (r[0] is not None, r[0]))


def test_against_brute_force_and_sql(spark):
    rnd = random.Random(1)
    names = ["a"] * 30 + ["é", "b", "Z", None, "zz", "c", "empty"]
    data = [(i, s := rnd.choice(names), None if s == "empty" else rnd.choice(["\t", " ", "\n\x0b"]).join(["x", "é y"] * rnd.choice([0, 1, 5, 30]))) for i in range(400)]
    data += [(400, "b", None), (401, None, ""), (402, "a", "w " * 3000), (403, "tiny", "one")]
    df = spark.createDataFrame(data, "doc_id long, source string, text string").repartition(7)
    got = rows(mixing.mix(df).select("doc_id", "size", "source_size", "target", "taken"), "doc_id")
    assert got == brute(data)
    documents = pd.DataFrame(data, columns=["doc_id", "source", "text"])  # noqa: F841
    want = duckdb.connect().execute(mixing.SQL).fetchall()
    assert got == sorted(want)
    assert got == rows(mixing.mix(df.repartition(3)).select("doc_id", "size", "source_size", "target", "taken"), "doc_id")
    for _, n, _, _, taken in got:
        assert taken <= 2 * n
    copies = mixing.mixed_rows(df).groupBy("doc_id").count()
    assert {i: n for i, n in rows(copies)} == {r[0]: r[4] // r[1] for r in got if r[4]} | {i: n for i, n in rows(copies) if not next(r for r in got if r[0] == i)[1]}


def test_nulls_repeats_empty_and_clashing_names(spark):
    data = [(None, None, "a b"), (1, "s", "a"), (1, "s", "a"), (2, "s", None), (3, "s", "a b c d e f g")]
    df = spark.createDataFrame([(*r, 0.0, "x") for r in data], "doc_id long, source string, text string, target double, rk string")
    got = rows(mixing.mix(df).select("doc_id", "size", "source_size", "taken"))
    assert len(got) == 5 and sum(r[1] for r in got) == 11 and got[1] == got[2]
    assert mixing.mixed_rows(df).columns == df.columns
    assert mixing.mix(df.where("false")).count() == 0 and mixing.mixed_rows(df.where("false")).count() == 0
    blank = spark.createDataFrame([(1, "s", " "), (2, None, None)], "doc_id long, source string, text string")
    assert [r[-1] for r in rows(mixing.mix(blank))] == [0, 0]
