"""Ranked lexical search by NRA: sequential reads of impact-sorted lists, without random access.

The query items are a stated set, taken in blocks of a bounded number of terms. For a block one pass over the documents counts
the block's terms in every whole text; the counts are written, and the corpus statistics come from them. Then tasks work through
their documents in shards of a bounded number of postings. A shard holds one list per term, sorted by impact (the whole score
that a term gives a document). An item reads its lists from the top, a run of each per round. A document's lower bound is
what was read of it, its upper bound adds the next unread impact of every list in which it was not met. Reading ends when each document whose upper
bound reaches the k-th best lower bound (or a tie with it) is resolved, i.e. both its bounds are equal; so membership, ties and scores
are exact. A task keeps k documents an item, which raises the bound of its next shards, and returns no others.
"""
from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridspark.session import settle

TOP = 10
#: query terms that one pass over the documents looks for; a single item may have more
BLOCK_TERMS = 50_000
SHARD_POSTINGS, SHARD_DOCS = 1_000_000, 8192
#: postings of each list in the first round; every round doubles them
FIRST_READ = 128
_PIECE = 1 << 20
#: lower-cases A-Z; every other ASCII character that is no digit or letter becomes a blank
_TABLE = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def terms_of(text: bytes | None) -> Iterator[list[bytes]]:
    """The terms of a text in order, in lists of bounded length."""
    text = (text or b"").translate(_TABLE)
    at = 0
    while at < len(text):
        end = len(text) if at + _PIECE >= len(text) else text.find(b" ", at + _PIECE)
        end = len(text) if end < 0 else end
        yield text[at:end].split()
        at = end


def _counted(docs: DataFrame, vocabulary: dict[bytes, int], key: str, text: str) -> DataFrame:
    """Rows (doc_id, n, terms, tfs): all terms of a text with repeats, and the counts of those of the vocabulary."""
    kind = docs.schema[key].dataType.simpleString()
    ints = pa.list_(pa.int32())

    def rows(batches):
        for batch in batches:
            ns, terms, tfs = [], [], []
            for value in batch.column(1):
                n, held = 0, Counter()
                for words in terms_of(value.as_py()):
                    n += len(words)
                    held.update(filter(vocabulary.__contains__, words))
                ns.append(n)
                terms.append([vocabulary[w] for w in held])
                tfs.append(list(held.values()))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ns, pa.int64()), pa.array(terms, ints), pa.array(tfs, ints)], ["doc_id", "n", "terms", "tfs"])

    source = docs.select(F.col(key).alias("doc_id"), F.col(text).cast("binary").alias("text"))
    return source.mapInArrow(rows, f"doc_id {kind}, n long, terms array<int>, tfs array<int>")


def nra(lists: list[tuple[np.ndarray, np.ndarray]], n: int, k: int, others: list[int], first: int | None = None) -> tuple[np.ndarray, np.ndarray, int]:
    """Documents of a shard that may be among the k best, with their scores, and the postings read.

    ``lists`` are (documents, impacts) by falling impact; ``others`` are the scores of documents met elsewhere. All returned
    scores are above 0 and exact; no document that reaches the k-th best score is missing.
    """
    lower, seen = np.zeros(n, np.int64), np.zeros((len(lists), n), bool)
    at, step, read = 0, first or FIRST_READ, 0
    while True:
        bounds = np.zeros(len(lists), np.int64)  # what a document not yet met in a list can still get from it
        for i, (docs, impacts) in enumerate(lists):
            now = docs[at:at + step]
            if len(now):
                lower[now] += impacts[at:at + step]
                seen[i, now] = True
                read += len(now)
            if at + step < len(impacts):
                bounds[i] = impacts[at + step]
        at, step = at + step, step * 2
        left = int(bounds.sum())
        best = lower if n <= k else np.partition(lower, n - k)[n - k:]
        best = np.concatenate([best, np.asarray(others, np.int64)])
        floor = max(1, int(np.partition(best, len(best) - k)[len(best) - k])) if len(best) >= k else 1
        alive = np.flatnonzero(lower + left >= floor)
        upper = lower[alive] + left - bounds @ seen[:, alive]
        alive, upper = alive[upper >= floor], upper[upper >= floor]
        if (upper == lower[alive]).all():
            return alive, lower[alive], read


class Shard:
    """Documents with their impact-sorted lists."""

    def __init__(self, ids: list, ns: list[int], sizes: np.ndarray, terms: np.ndarray, tfs: np.ndarray, weights: np.ndarray, total: int, words: int):
        self.ids = ids
        m = np.array([10 + 90 * n * total // max(words, 1) for n in ns], np.int64)  # whole numbers of any size
        docs = np.repeat(np.arange(len(ids)), sizes)
        impact = weights[terms] * ((1_000_000_000 * tfs) // (1000 * tfs + 8 * m[docs]))
        order = np.lexsort((-impact, terms))
        self.docs, self.impact, sorted_terms = docs[order], impact[order], terms[order]
        present, starts = np.unique(sorted_terms, return_index=True)
        ends = [*starts[1:].tolist(), len(order)][: len(starts)]
        self.spans = dict(zip(present.tolist(), zip(starts.tolist(), ends, strict=True), strict=True))

    def lists(self, terms: list[int]) -> list[tuple[np.ndarray, np.ndarray]]:
        spans = [self.spans[t] for t in terms if t in self.spans]
        return [(self.docs[a:b], self.impact[a:b]) for a, b in spans if self.impact[a] > 0]


def _shards(batches, weights: np.ndarray, total: int, words: int) -> Iterator[Shard]:
    ids, ns, sizes, terms, tfs, held = [], [], [], [], [], 0

    def close():
        return Shard(ids, ns, np.concatenate(sizes), np.concatenate(terms).astype(np.int64), np.concatenate(tfs).astype(np.int64), weights, total, words)

    for batch in batches:
        if not batch.num_rows:
            continue
        ends = np.cumsum(size := np.asarray(batch.column(2).value_lengths()).astype(np.int64))
        flat, counts = np.asarray(batch.column(2).flatten()), np.asarray(batch.column(3).flatten())
        id_list, n_list, a = batch.column(0).to_pylist(), batch.column(1).to_pylist(), 0
        while a < len(size):
            before = int(ends[a - 1]) if a else 0
            b = min(len(size), a + SHARD_DOCS - len(ids), max(a + 1, int(np.searchsorted(ends, before + SHARD_POSTINGS - held, "right"))))
            till = int(ends[b - 1])
            ids, ns, sizes = ids + id_list[a:b], ns + n_list[a:b], [*sizes, size[a:b]]
            terms, tfs, held, a = [*terms, flat[before:till]], [*tfs, counts[before:till]], held + till - before, b
            if len(ids) >= SHARD_DOCS or held >= SHARD_POSTINGS:
                yield close()
                ids, ns, sizes, terms, tfs, held = [], [], [], [], [], 0
    if ids:
        yield close()


def _block(docs: DataFrame, items: list[tuple[int, list[bytes]]], k: int, key: str, text: str) -> DataFrame:
    """Rows (item, doc_id, score): the k best documents of each task for each item of the block."""
    vocabulary = {w: i for i, w in enumerate(sorted({w for _, ws in items for w in ws}))}
    counted = settle(_counted(docs, vocabulary, key, text))
    total, words = counted.agg(F.count(F.when(F.col("n") > 0, 1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    df = dict(counted.select(F.explode("terms").alias("term")).groupBy("term").count().collect())  # bounded by the block's terms
    weights = np.array([math.floor(1000 * math.log((2 * total + 2) / (2 * df.get(t, 0) + 1))) for t in range(len(vocabulary))] or [0], np.int64)
    asked = [(item, [vocabulary[w] for w in ws]) for item, ws in items]
    kind = docs.schema[key].dataType.simpleString()

    def rows(batches):
        best: dict[int, list[tuple]] = {item: [] for item, _ in asked}
        id_kind = None
        for shard in _shards(_typed(batches, seen := []), weights, total, words):
            id_kind = seen[0]
            for item, terms in asked:
                lists = shard.lists(terms)
                if lists:
                    found, scores, _ = nra(lists, len(shard.ids), k, [-x[0] for x in best[item]])
                    mine = [(-s, (shard.ids[d] is not None, shard.ids[d])) for d, s in zip(found.tolist(), scores.tolist(), strict=True)]
                    best[item] = sorted(best[item] + mine)[:k]
        out = [(item, i, -s) for item, top in best.items() for s, (_, i) in top]
        if out:
            columns = list(zip(*out, strict=True))
            yield pa.RecordBatch.from_arrays([pa.array(columns[0], pa.int64()), pa.array(columns[1], id_kind), pa.array(columns[2], pa.int64())], ["item", "doc_id", "score"])

    return counted.mapInArrow(rows, f"item long, doc_id {kind}, score long")


def _typed(batches, seen: list):
    for batch in batches:
        seen.append(batch.schema.field(0).type) if not seen else None
        yield batch


def search(docs: DataFrame, items: DataFrame, k: int = TOP, key: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text") -> DataFrame:
    """Rows (item_id, rank, doc_id, score): the k best documents of every row of ``items`` with a score above 0.

    Equal scores rank by ascending id, null ids first. Null and empty texts have no terms: such items have no rows, such
    documents are found by none and do not count. Repeated documents are found each, repeated items get a list each, ids
    may be null. Empty tables give no rows. Extra columns are not read.
    """
    def rows(batches):
        for batch in batches:
            terms = [sorted({w for words in terms_of(v.as_py()) for w in words}) for v in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(terms, pa.list_(pa.binary()))], ["item_id", "terms"])

    kind = items.schema[item].dataType.simpleString()
    asked = items.select(F.col(item).alias("item_id"), F.col(item_text).cast("binary").alias("text"))
    asked = settle(asked.mapInArrow(rows, f"item_id {kind}, terms array<binary>").withColumn("item", F.monotonically_increasing_id()))
    found: DataFrame | None = None
    for block in _blocks(asked):
        part = _block(docs, block, k, key, text)
        found = part if found is None else found.unionAll(part)
    if found is None:
        found = docs.limit(0).select(F.lit(0).cast("long").alias("item"), F.col(key).alias("doc_id"), F.lit(0).cast("long").alias("score"))
    order = Window.partitionBy("item").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_first())
    top = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return top.join(asked.select("item", "item_id"), "item").select("item_id", "rank", "doc_id", "score")


def _blocks(asked: DataFrame) -> Iterator[list[tuple[int, list[bytes]]]]:
    """Items in blocks of a bounded number of terms; the driver holds one block and one partition of items."""
    block, held = [], 0
    for r in asked.where(F.size("terms") > 0).select("item", "terms").toLocalIterator():
        terms = [bytes(t) for t in r.terms]
        if block and held + len(terms) > BLOCK_TERMS:
            yield block
            block, held = [], 0
        block.append((r.item, terms))
        held += len(terms)
    if block:
        yield block


SQL = r"""
WITH w AS (
  SELECT row_number() OVER () AS row, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
i AS (
  SELECT row_number() OVER () AS item, item_id,
         list_distinct(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS w
  FROM benchmark),
asked AS (SELECT item, item_id, unnest(w) AS term FROM i),
total AS (SELECT count(*) FILTER (len(w) > 0) AS N, CAST(sum(len(w)) AS BIGINT) AS L FROM w),
docs AS (SELECT row, doc_id, 10 + (90 * len(w) * N) // L AS m, w FROM w, total WHERE len(w) > 0),
tf AS (SELECT row, doc_id, m, term, count(*) AS tf FROM (SELECT row, doc_id, m, unnest(w) AS term FROM docs) GROUP BY ALL),
weight AS (
  SELECT term, CAST(floor(1000 * ln((2 * N + 2) / (2 * df + 1))) AS BIGINT) AS w
  FROM (SELECT term, count(*) AS df FROM tf GROUP BY term), total),
score AS (
  SELECT item, item_id, row, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * m))) AS BIGINT) AS score
  FROM asked JOIN tf USING (term) JOIN weight USING (term) GROUP BY ALL),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id NULLS FIRST) AS rank FROM score WHERE score > 0)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM ranked WHERE rank <= 10
"""
