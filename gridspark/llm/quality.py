"""Quality classifier: Bradley-Terry scores learned from preference pairs, cut at a score quantile.

A document's features are shares and rates counted over its whole text. From labelled documents, pairs (better, worse)
are drawn and a linear score is fitted so that the logistic of the score difference explains the
preference. The score is then cut at the quantile of training scores that mislabels the fewest training
documents. Training uses a bounded sample (``MAX_PER_CLASS`` documents of each label, ``MAX_PAIRS`` pairs); everything
else covers all rows, one pass over the texts, without a shuffle.
"""
from __future__ import annotations

import operator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: labelled documents used per class, and preference pairs drawn from them
MAX_PER_CLASS = 8_000
MAX_PAIRS = 160_000
#: score at the cut
CUT_SCORE = 0.3
SYMBOLS = b"#$%&*+<=>@[\\]^_`{}~"
QUIET = b".,;:'\"-()/?"


def features(text: bytes) -> list[float]:
    """Shares of letters, marks, repeated words and repeated lines of one text; zeros for an empty text."""
    size = len(text)
    if not size:
        return [0.0] * len(NAMES)
    at = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    words, lines = text.split(), [x for x in text.split(b"\n") if x.strip()]
    n = max(1, len(words))
    upper, lower = int(at[65:91].sum()), int(at[97:123].sum())
    shares = [
        upper / max(1, upper + lower),
        sum(int(at[c]) for c in SYMBOLS) / size,
        int(at[33]) / size,
        int(at[124]) / size,
        int(at[48:58].sum()) / size,
        sum(int(at[c]) for c in QUIET) / size,
        int(at[:32].sum()) / size,
        sum(map(operator.eq, words, words[1:])) / n,
        sum(map(operator.eq, words, words[2:])) / n,
        1 - len(set(lines)) / max(1, len(lines)),
    ]
    rates = [min(1.0, len(words) / 50), min(1.0, (size - int(at[128:192].sum())) / n / 12), len(set(words)) / n]
    return [x**0.5 for x in shares] + rates


NAMES = ["upper", "symbols", "bangs", "bars", "digits", "quiet marks", "control", "repeat next", "repeat second", "repeated lines",
         "length", "word length", "distinct words"]


@dataclass(frozen=True)
class Model:
    """Linear score and the cut that makes score 0.3; without labels of both kinds every text scores 0.5."""

    weights: tuple[float, ...] = (0.0,) * len(NAMES)
    cut: float = 0.0
    fitted: bool = False

    def score(self, rows: np.ndarray) -> np.ndarray:
        if not self.fitted:
            return np.full(len(rows), 0.5)
        raw = rows @ np.array(self.weights) - self.cut + np.log(CUT_SCORE / (1 - CUT_SCORE))
        return 1 / (1 + np.exp(-np.clip(raw, -35, 35)))


def fit(good: np.ndarray, bad: np.ndarray, ridge: float = 1e-4, rounds: int = 25) -> Model:
    """Bradley-Terry weights by Newton steps on sum(log(1 + exp(-w (x_good - x_bad)))) over drawn pairs."""
    if not len(good) or not len(bad):
        return Model()
    draw = np.random.default_rng(7)
    n = min(MAX_PAIRS, 20 * max(len(good), len(bad)))
    diff = good[draw.integers(0, len(good), n)] - bad[draw.integers(0, len(bad), n)]
    w = np.zeros(diff.shape[1])
    for _ in range(rounds):
        miss = 1 / (1 + np.exp(np.clip(diff @ w, -35, 35)))
        slope = ridge * w - diff.T @ miss / n
        bend = (diff * (miss * (1 - miss))[:, None]).T @ diff / n + ridge * np.eye(len(w))
        step = np.linalg.solve(bend, slope)
        w = w - step * min(1.0, 4.0 / max(1e-12, float(np.abs(step).max())))
        if np.abs(step).max() < 1e-6:
            break
    raw = np.concatenate([good @ w, bad @ w])
    is_good = np.r_[np.ones(len(good)), np.zeros(len(bad))]
    order = np.argsort(raw, kind="stable")
    # cut below rank k: good documents under it and bad ones above it are errors, each class weighing the same
    wrong = np.r_[0, np.cumsum(is_good[order])] / len(good) + (len(bad) - np.r_[0, np.cumsum(1 - is_good[order])]) / len(bad)
    best = np.flatnonzero(wrong <= wrong.min() + 1e-12)
    k = int(best[len(best) // 2])
    level = raw[order]
    cut = level[0] - 1 if k == 0 else level[-1] + 1 if k == len(level) else (level[k - 1] + level[k]) / 2
    return Model(tuple(w.tolist()), float(cut), True)


def held_out(doc_id: Column) -> Column:
    """Rows kept from training: crc32 of the id as text is divisible by five (a null id counts as empty text)."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 5 == 0


def train(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text") -> Model:
    """Fit on ``labels`` (doc_id, quality 0/1) of rows that are not held out.

    Ids labelled both ways, null ids and null labels teach nothing; an id with several rows counts once per row. The sample
    takes the smallest id hashes of each class; its size is bounded, so it is broadcast to the documents and its
    features come to the driver.
    """
    clean = labels.where("doc_id is not null and quality in (0, 1)").where(~held_out(F.col("doc_id")))
    clean = clean.groupBy("doc_id").agg(F.min("quality").alias("quality"), F.max("quality").alias("q2")).where("quality = q2")
    pick = [clean.where(F.col("quality") == q).orderBy(F.xxhash64("doc_id"), "doc_id").limit(MAX_PER_CLASS) for q in (0, 1)]
    sample = F.broadcast(pick[0].unionAll(pick[1]).select(F.col("doc_id").alias("labelled"), F.col("quality").cast("int").alias("q")))
    found = docs.select(F.col(key).alias("id"), F.col(text).cast("binary").alias("text")).join(sample, F.col("id") == F.col("labelled"))
    def rows(batches):
        for batch in batches:
            feats = [features(t or b"") for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(feats, pa.list_(pa.float64()))], ["q", "f"])

    got = found.select("q", "text").mapInArrow(rows, "q int, f array<double>").limit(4 * MAX_PER_CLASS).toPandas()
    got = got.sort_values("q", kind="stable")
    table = {q: np.array(sorted(map(tuple, got["f"][got["q"] == q]))).reshape(-1, len(NAMES)) for q in (0, 1)}
    return fit(table[1], table[0])


def scores(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows (doc_id, score, predicted) for every row of ``docs``; null texts score as empty ones."""
    kind = docs.schema[key].dataType.simpleString()

    def rows(batches):
        for batch in batches:
            feats = np.array([features(t or b"") for t in batch.column(1).to_pylist()]).reshape(-1, len(NAMES))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(model.score(feats))], ["doc_id", "score"])

    got = docs.select(F.col(key), F.col(text).cast("binary").alias("text")).mapInArrow(rows, f"doc_id {kind}, score double")
    return got.withColumn("predicted", (F.col("score") >= CUT_SCORE).cast("int"))


def keep_good(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """Rows of ``docs`` predicted good, all columns as they are. No join: null and repeated ids keep their own decision."""
    at = docs.columns.index(text)

    def rows(batches):
        for batch in batches:
            feats = np.array([features((t or "").encode()) for t in batch.column(at).to_pylist()]).reshape(-1, len(NAMES))
            yield batch.filter(pa.array(model.score(feats) >= CUT_SCORE))

    return docs.mapInArrow(rows, docs.schema)


def classify(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows (doc_id, held_out, score, predicted), one per row of ``docs``.

    Only id and text are read; other columns, whatever their names, are no inputs. Repeated rows get equal scores,
    null and empty texts the score of an empty text. An empty table gives no rows; without usable labels all
    score 0.5 and are predicted good.
    """
    got = scores(docs, train(docs, labels, key, text), key, text)
    return got.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")
