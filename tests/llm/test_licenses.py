import random
import re

import duckdb
import pandas as pd
import pytest
from conftest import rows

from gridspark.llm import licenses

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(t):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))


def brute(t, templates, phrases, threshold):
    w = words(t)
    places, base, labels, score, n = [], set(), set(), 0.0, 0
    for p, label in phrases:
        pw = words(p)
        got = [i for i in range(len(w) - len(pw) + 1) if w[i:i + len(pw)] == pw]
        places += got
        if got:
            base.add(label)
            score = 1.0
    for x, label, *rules in templates:
        listed, (required, excluded) = words(x), (set(words(r)) for r in (*rules, "", "")[:2])
        wanted, width, last = set(listed), len(listed) + len(listed) // 4, None
        for i in range(len(w)):
            block = set(w[i:i + width])
            share = len(block & wanted) / len(wanted)
            if w[i] in wanted and share >= threshold - 1e-9 and required <= block and not excluded & block:
                labels.add(label)
                score = max(score, share)
                n += last is None or i >= last + width
                last = i
    return (len(w), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(base)), ",".join(sorted(base | labels)), score, n)


@pytest.mark.parametrize("threshold", [0.5, 0.8, 1.0])
def test_join_against_all_pairs(spark, threshold):
    rnd = random.Random(int(threshold * 10))
    vocab = ["a", "b", "c", "d", "e", "f", "g", "é", "日本", "x1"]
    templates = [(" ".join(rnd.sample(vocab, rnd.randint(1, 7))), f"t{i}", *rnd.choice([(), (), (rnd.choice(vocab), ""), ("", rnd.choice(vocab)), ("a b", "g")])) for i in range(9)]
    phrases = [("a b", "ab"), ("c d e", "cde"), ("a a", "aa"), ("x1", "x")]
    data = [(i, "".join(rnd.choice(vocab) + rnd.choice([" ", " ", "\n", "-", "\x7f"]) for _ in range(rnd.choice([0, 2, 8, 25])))) for i in range(150)] + [(500, None), (501, "\n\n"), (None, "A B\nC d E")]
    data += [data[5], data[5]]
    df = spark.createDataFrame([(*d, 0, "x") for d in data], "doc_id long, text string, row int, labels string").repartition(3)
    got = [(r[0], *r[1:7], round(r[7], 9), r[8]) for r in rows(licenses.license_scan(df, templates, phrases, threshold))]
    want = [(i, *(b := brute(t, templates, phrases, threshold))[:6], round(b[6], 9), b[7]) for i, t in data]
    order = lambda r: [(x is not None, x) for x in r]
    assert sorted(got, key=order) == sorted(want, key=order)


def test_notices_and_sql(spark):
    texts = ["Text.\nLicensed under the Apache License, Version 2.0.", "ALL RIGHTS\nreserved and all rights reserved", "this work is licenced under GNU general public license version 3",
             "CC-BY or cc  by; cc/by", "the license", None, "", "Released, under the M.I.T. license", "\xc9all rights reserved", "word " * 30_000 + "cc by",
             "Released under the BSD License", "Licensed under the Mozilla Public License, Version 2.0", "x\nPermission is hereby granted, free of charge, to any person obtaining\na copy of this software and associated documentation files (the",
             "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License", "This work is licensed under a Creative Commons\n# Attribution 4.0 International License.", "GNU Lesser General Public License, this work is licensed under the version 3"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = rows(licenses.license_scan(df))
    assert [r[6] for r in got] == ["apache-2.0", "reserved", "gpl,gpl-3.0", "cc-by", "", "", "", "", "", "cc-by", "bsd", "mpl-2.0", "mit", "", "cc-by-4.0", "gpl"]
    assert [r[2] for r in got[:10]] == [0, 2, 1, 3, 0, 0, 0, 0, 0, 1] and got[9][3] == 30_000
    documents = pd.DataFrame(list(enumerate(texts)), columns=["doc_id", "text"])  # noqa: F841
    want = duckdb.connect().execute(licenses.sql()).fetchall()
    assert [(*r[:7], round(r[7], 9), r[8]) for r in got] == sorted((*r[:7], round(r[7], 9), r[8]) for r in want)
    assert licenses.license_scan(df.where("false")).count() == 0
