import random
import zlib

from conftest import rows

from gridspark.llm import quality


def corpus(n=600):
    rnd = random.Random(2)
    word = lambda: "".join(rnd.choice(["an", "re", "ti", "on", "é", "st"]) for _ in range(rnd.randint(1, 4)))
    data = []
    for i in range(n):
        w = [word() for _ in range(rnd.randint(5, 90))]
        bad = i % 3 == 0
        if bad:
            w = [x.upper() + "!!" for x in w] if i % 2 else [y for x in w for y in (x, x, x)]
        data.append((i, " ".join(w), 0 if bad else 1))
    return data


def test_held_out_accuracy_and_contract(spark):
    data = corpus()
    docs = spark.createDataFrame([d[:2] for d in data] + [(9001, ""), (9002, None), (None, "on the re")], "doc_id long, text string")
    labels = spark.createDataFrame([(i, q) for i, _, q in data], "doc_id long, quality int")
    got = rows(quality.classify(docs, labels))
    assert len(got) == len(data) + 3
    truth = {i: q for i, _, q in data}
    for i, out, score, pred in got:
        assert out == (zlib.crc32(str("" if i is None else i).encode()) % 5 == 0)
        assert 0 <= score <= 1 and pred == int(score >= 0.3)
    held = [(truth[i], pred) for i, out, _, pred in got if out and i in truth]
    assert sum(a == b for a, b in held) >= 0.97 * len(held)
    # labels of held-out rows have no influence
    flipped = spark.createDataFrame([(i, 1 - q if zlib.crc32(str(i).encode()) % 5 == 0 else q) for i, _, q in data], "doc_id long, quality int")
    assert rows(quality.classify(docs, flipped)) == got
    kept = rows(quality.keep_good(docs.withColumn("score", docs.doc_id * 2), quality.train(docs, labels)))
    assert [r[0] for r in kept] == [r[0] for r in got if r[3]] and len(kept[0]) == 3


def test_without_labels_and_empty(spark):
    docs = spark.createDataFrame([(1, "a b", 5, 1.0), (1, "a b", 5, 1.0), (2, None, 6, 2.0)], "doc_id long, text string, q int, score double")
    labels = spark.createDataFrame([(1, None), (None, 0), (7, 1)], "doc_id long, quality int")
    assert [r[2:] for r in rows(quality.classify(docs, labels))] == [(0.5, 1)] * 3
    both = spark.createDataFrame([(1, 0), (1, 1)], "doc_id long, quality int")
    assert [r[2] for r in rows(quality.classify(docs, both))] == [0.5] * 3
    assert quality.classify(docs.where("false"), labels).count() == 0
    assert quality.keep_good(docs, quality.Model()).count() == 3


def test_pairs_rank_better_over_worse():
    import numpy as np

    draw = np.random.default_rng(1)
    good, bad = draw.normal(1, 1, (300, len(quality.NAMES))), draw.normal(-1, 1, (300, len(quality.NAMES)))
    model = quality.fit(good, bad)
    assert np.mean(model.score(good) >= 0.3) > 0.99 and np.mean(model.score(bad) < 0.3) > 0.99
