import hashlib
import random
import zlib
from collections import defaultdict

import duckdb
import pandas as pd
import pytest
from conftest import rows

from gridspark.llm import trie

order = lambda r: [(x is not None, x) for x in r]


def rebuilt(data):
    turns = defaultdict(list)
    for c, t, role, text in data:
        if c is not None:
            role, text = role or "", text or ""
            turns[c].append(((t is not None, t), hashlib.sha256(f"{len(role)}:{role}{text}".encode()).hexdigest(), (role, text)))
    turns = {c: [x[2] for x in sorted(v)] for c, v in turns.items()}
    out = {}
    for c in turns:
        h = zlib.crc32(str(c).encode()) % 9
        base = c - (c % 5 if c >= 0 else -(-c % 5))
        out[c] = turns.get(base, [])[:h] + turns[c][h:]
    return out


def brute(convs):
    members = defaultdict(list)
    for c, s in convs.items():
        for d in range(len(s) + 1):
            members[tuple(s[:d])].append(c)
    out = []
    for p, cs in members.items():
        below = [q for q in members if q[: len(p)] == p]
        kids = lambda q: sum(len(x) == len(q) + 1 and x[: len(q)] == q for x in below)
        saved = sum((len(members[q]) - 1) * len(q[-1][1].encode()) for q in below if q)
        ends = ",".join(str(c) for c in sorted(cs) if len(convs[c]) == len(p))
        out.append((min(cs), len(p), min(members[p[:-1]]) if p else None, len(cs), kids(p), sum(not kids(q) for q in below), saved, hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=order)


def made(seed):
    rnd = random.Random(seed)
    said, data = ["hello", "é", "", None, "long answer", "b"], []
    for c in rnd.sample(range(-40, 120), 70):
        n = rnd.choice([1, 2, 3, 8, 14])
        data += [(c, i if rnd.random() < 0.9 else rnd.choice([None, 3]), rnd.choice(["user", "bot", None]), said[0] if i < 2 and rnd.random() < 0.8 else rnd.choice(said)) for i in range(n)]
    data += [(200 + c, i, "user", "same") for c in range(40) for i in range(9)]  # copies
    return data + [(None, 0, "user", "x"), (300, 1, "a", "y"), (300, 1, "a", "y")]


SCHEMA = "conv_id long, turn long, role string, text string, id int, n string"


@pytest.mark.parametrize("segment", [4096, 3])
def test_trie_against_brute_force_and_sql(spark, monkeypatch, segment):
    data = made(segment)
    monkeypatch.setattr(trie, "SHARD_TURNS", 9)
    monkeypatch.setattr(trie, "IDS", 2)
    df = spark.createDataFrame([(*x, 1, "z") for x in data], SCHEMA).repartition(3)
    got = rows(trie.prefix_trie(*trie.rebuilt(trie.sequences(df)), segment=segment))
    assert sorted(got, key=order) == brute(rebuilt(data))
    if segment == 3:
        return
    conversations = pd.DataFrame(data, columns=["conv_id", "turn", "role", "text"]).astype({"conv_id": "Int64", "turn": "Int64"})  # noqa: F841
    assert sorted(duckdb.connect().execute(trie.SQL).fetchall(), key=order) == brute(rebuilt(data))


def test_many_ranges(spark):
    rnd = random.Random(5)
    data = [(c, i, "u", rnd.choice("ab")) for c in range(60) for i in range(rnd.randint(1, 12))]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = rows(trie.prefix_trie(*trie.rebuilt(trie.sequences(spark.createDataFrame(data, "conv_id long, turn long, role string, text string"))), segment=4))
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert sorted(got, key=order) == brute(rebuilt(data))


def test_empty_and_turnless(spark):
    df = spark.createDataFrame([(1, 0, "u", "x")], "conv_id long, turn long, role string, text string")  # crc32("1") % 9 > 0 and no conversation 0
    assert zlib.crc32(b"1") % 9 > 0
    assert rows(trie.prefix_trie(*trie.rebuilt(trie.sequences(df)))) == [(1, 0, None, 1, 0, 1, 0, hashlib.sha256(b"1").hexdigest())]
    assert trie.prefix_trie(*trie.rebuilt(trie.sequences(df.where("false")))).count() == 0


def test_balanced_tree():
    tree = trie.Tst()
    ends = tree.insert_sorted([([i, 7], [1, 1]) for i in range(1023)])
    assert len(set(ends)) == 1023 and tree.number[0] == 511

    def height(at):
        return 0 if at < 0 else 1 + max(height(tree.lower[at]), height(tree.higher[at]))

    assert height(tree.top) == 10
    seen = set()
    for at in tree.places():
        assert tree.parent[at] < 0 or tree.parent[at] in seen
        seen.add(at)
    assert len(seen) == 2046
