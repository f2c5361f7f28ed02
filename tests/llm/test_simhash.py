import random

import pytest
import xxhash
from conftest import rows

from gridspark.llm import simhash
from gridspark.llm.graph import components


def brute_fingerprint(text, k):
    words = [w for w in "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").replace("\x0b", " ").replace("\f", " ").replace("\t", " ").replace("\r", " ").replace("\n", " ").split(" ") if w]
    if not words:
        return 0
    runs = [" ".join(words[i:i + k]) for i in range(len(words) - k + 1)] or [" ".join(words)]
    h = [xxhash.xxh64_intdigest(r.encode(), seed=42) for r in runs]
    return sum(1 << i for i in range(64) if 2 * sum(x >> i & 1 for x in h) > len(h))


def brute_classes(prints, bits):
    root = dict.fromkeys(prints, None)
    ids = sorted(prints)
    comp = {i: i for i in ids}

    def find(x):
        while comp[x] != x:
            x = comp[x]
        return x

    for i in ids:
        for j in ids:
            if i < j and (prints[i] ^ prints[j]).bit_count() <= bits:
                a, b = sorted((find(i), find(j)))
                comp[b] = a
    return {i: find(i) for i in root}


@pytest.mark.parametrize(("words", "bits", "blocks", "keep"), [(3, 2, 5, 3), (5, 4, 6, 2), (1, 1, 3, 2)])
def test_against_brute_force(spark, words, bits, blocks, keep):
    rnd = random.Random(3)
    vocab = [f"w{i}" for i in range(60)] + ["É", "Ünd", "\x1c", "日本"]
    texts = []
    for _ in range(70):
        base = [rnd.choice(vocab) for _ in range(rnd.choice([0, 1, 2, 3, 40, 120]))]
        texts.append(base)
        for _ in range(rnd.choice([0, 1, 3])):
            texts.append([rnd.choice(vocab) if rnd.random() < 0.02 else w for w in base])
    data = [(i, rnd.choice([" ", "\n", "\t "]).join(t)) for i, t in enumerate(texts)] + [(900, None), (901, ""), (902, " \n")]
    got = simhash.near_duplicates(spark.createDataFrame(data, "doc_id long, text string").repartition(5), words, bits, blocks, keep)
    prints = {i: brute_fingerprint(t, words) for i, t in data}
    want = brute_classes(prints, bits)
    out = rows(got, "doc_id")
    assert [(d, f & (2**64 - 1), c) for d, f, c in out] == [(i, prints[i], want[i]) for i in sorted(prints)]


def test_crowded_keys_are_split(spark, monkeypatch):
    monkeypatch.setattr(simhash, "CROWD", 3)
    rnd = random.Random(5)
    seeds = [rnd.getrandbits(63) for _ in range(6)]
    values = {s ^ (1 << rnd.randrange(63)) ^ (1 << rnd.randrange(63)) for s in seeds for _ in range(40)} | set(seeds)
    got = components(simhash.close_pairs(spark.createDataFrame([(v,) for v in values], "fp long")))
    named = {n: c for n, c in rows(got)}
    want = brute_classes({v: v for v in values}, 2)
    assert {v: named.get(v, v) for v in values} == want


def test_repeats_nulls_and_clashing_names(spark):
    data = [(1, "a b c d", 1, 2, "k"), (1, "a b c d", 1, 2, "k"), (None, "a b c d", 0, 0, "k"), (5, "a B  c\nd", 0, 0, "k"), (7, "x", 0, 0, "k")]
    docs = spark.createDataFrame(data, "doc_id long, text string, fp long, component_id long, part string")
    got = rows(simhash.near_duplicates(docs).select("doc_id", "component_id"))
    assert got == [(None, 1), (1, 1), (1, 1), (5, 1), (7, 7)]
    assert simhash.near_duplicates(docs.where("false")).count() == 0


def test_components_follow_long_chains(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 101), (101, 102), (5, 5), (None, 4)]
    got = rows(components(spark.createDataFrame(edges, "a long, b long")))
    assert got == [(i, 0) for i in range(41)] + [(100, 100), (101, 100), (102, 100)]
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
