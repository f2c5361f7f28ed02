"""Byte-level BPE: encoding by a corpus-level replay of the merges, decoding by table.

Texts are split by the pattern; merges never cross a split, so equal words have equal ids. A task collects the distinct words
of its rows and encodes all of them at once: an inverted index from the rank of a token pair to the places
where the pair stands is worked off in rank order, every merge is applied at all its places together, and
only the pairs beside a merge are looked up and filed anew. Word ids are kept between batches of a task, up to
``MAX_WORDS``, then forgotten. Texts need no shuffle.
"""
from __future__ import annotations

import base64
import hashlib
import heapq
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: distinct words a task remembers, and the text length from which words are streamed
MAX_WORDS = 1_000_000
LONG_TEXT = 1 << 20
NONE = np.int32(2**31 - 1)


def read_ranks(path: str) -> list[bytes]:
    """Token bytes by rank from a rank file: lines of base64 token and rank."""
    with open(path, "rb") as lines:
        pairs = [(base64.b64decode(t), int(r)) for t, r in (x.split() for x in lines if x.strip())]
    tokens = [b""] * (max(r for _, r in pairs) + 1)
    for t, r in pairs:
        tokens[r] = t
    return tokens


class Merges:
    """Ranks of token pairs as sorted arrays; the id of a merged token is its rank."""

    def __init__(self, tokens: list[bytes]):
        rank = {t: r for r, t in enumerate(tokens) if t}
        self.tokens = tokens
        self.byte = np.array([rank[bytes([b])] for b in range(256)], np.int32)
        found = [(rank[t[:i]] << 32 | rank[t[i:]], r) for t, r in rank.items() for i in range(1, len(t)) if t[:i] in rank and t[i:] in rank]
        found.sort()
        self.pairs = np.array([k for k, _ in found], np.int64)
        self.ranks = np.array([r for _, r in found], np.int32)

    def of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        if not len(self.pairs):
            return np.full(len(left), NONE)
        key = left.astype(np.int64) << 32 | right
        at = np.minimum(np.searchsorted(self.pairs, key), len(self.pairs) - 1)
        return np.where(self.pairs[at] == key, self.ranks[at], NONE)

    def one_word(self, word: bytes) -> list[int]:
        """Ids of one word by repeated lowest-rank merging: for words that the replay sets aside."""
        ids = self.byte[np.frombuffer(word, np.uint8)]
        while len(ids) > 1:
            ranks = self.of(ids[:-1], ids[1:])
            i = int(ranks.argmin())
            if ranks[i] == NONE:
                break
            ids = np.r_[ids[:i], ranks[i], ids[i + 2:]]
        return ids.tolist()

    def replay(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all ``words``, joined, and the number of ids of each."""
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        n = int(sizes.sum())
        token = self.byte[np.frombuffer(b"".join(words), np.uint8)]
        ends = np.cumsum(sizes)
        # links to the place before and after; place n stands for the end of a word
        after, before = np.arange(1, n + 2, dtype=np.int32), np.arange(-1, n, dtype=np.int32)
        after[ends[sizes > 0] - 1] = n
        before[(ends - sizes)[sizes > 0]] = n
        token = np.append(token, np.int32(-1))
        alive = np.ones(n + 1, bool)
        pair = np.full(n + 1, NONE)  # rank of the pair that starts at a place
        inner = np.flatnonzero(after[:n] < n)
        pair[inner] = self.of(token[inner], token[after[inner]])
        waiting: dict[int, list[np.ndarray]] = {}
        heap: list[int] = []
        odd: list[np.ndarray] = []  # places in words where a merge made a pair of lower rank

        def file(places: np.ndarray) -> None:
            ranks = pair[places]
            places, ranks = places[ranks != NONE], ranks[ranks != NONE]
            if not len(places):
                return
            order = np.argsort(ranks, kind="stable")
            places, ranks = places[order], ranks[order]
            cut = np.flatnonzero(ranks[1:] != ranks[:-1]) + 1
            firsts = [0, *cut.tolist()]
            for a, b, r in zip(firsts, [*firsts[1:], len(places)], ranks[firsts].tolist(), strict=True):
                if r not in waiting:
                    waiting[r] = []
                    heapq.heappush(heap, r)
                waiting[r].append(places[a:b])

        file(inner)
        while heap:
            rank = heapq.heappop(heap)
            filed = waiting.pop(rank)
            at = filed[0] if len(filed) == 1 else np.unique(np.concatenate(filed))
            at = at[(pair[at] == rank) & alive[at]]
            if not len(at):
                continue
            chained = after[at[:-1]] == at[1:]
            if chained.any():  # overlapping places, as in "aaa": every other one from the left
                start = np.r_[True, ~chained]
                nth = np.arange(len(at)) - np.maximum.accumulate(np.where(start, np.arange(len(at)), 0))
                at = at[nth % 2 == 0]
            gone = after[at]
            token[at] = rank
            alive[gone] = False
            right = after[gone]
            after[at] = right
            before[right] = at  # place n collects writes that are never read
            left = before[at]
            pair[at] = np.where(right < n, self.of(token[at], token[right]), NONE)
            has = left < n
            left = left[has]
            pair[left] = self.of(token[left], token[at[has]])
            touched = np.unique(np.concatenate([at, left])) if len(left) else at
            low = touched[pair[touched] < rank]
            if len(low):
                odd.append(low)
            file(touched)
        alive[n] = False
        ids = token[:n][alive[:n]]
        counts = np.add.reduceat(np.append(alive[:n], False).astype(np.int64), np.minimum(ends - sizes, n)) * (sizes > 0) if len(words) else sizes
        if odd:
            ids, counts = self._again(words, ids, counts, np.unique(np.searchsorted(ends, np.concatenate(odd), side="right")))
        return ids, counts

    def _again(self, words, ids, counts, which):
        parts = np.split(ids, np.cumsum(counts)[:-1])
        for i in which.tolist():
            parts[i] = np.array(self.one_word(words[i]), np.int32)
        return np.concatenate(parts).astype(np.int32), np.fromiter(map(len, parts), np.int64, len(parts))


class Encoder:
    """Encodes batches of texts and remembers the ids of words."""

    def __init__(self, merges: Merges, pattern: str):
        import regex

        self.merges, self.pattern = merges, regex.compile(pattern)
        self._forget()

    def _forget(self) -> None:
        self.place = defaultdict()
        self.place.default_factory = self.place.__len__
        self.ids, self.start, self.count = np.zeros(0, np.int32), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def batch(self, texts: list[str]) -> list[np.ndarray]:
        """Token ids of each text."""
        if len(self.place) > MAX_WORDS:
            self._forget()
        known = len(self.place)
        place = self.place.__getitem__
        words = [np.fromiter(map(place, self.pattern.findall(t) if len(t) < LONG_TEXT else (m.group() for m in self.pattern.finditer(t))), np.int32) for t in texts]
        if len(self.place) > known:
            fresh = [w.encode() for w in list(self.place)[known:]]
            ids, counts = self.merges.replay(fresh)
            self.start = np.append(self.start, len(self.ids) + np.cumsum(counts) - counts)
            self.count, self.ids = np.append(self.count, counts), np.append(self.ids, ids)
        out = []
        for w in words:
            n = self.count[w]
            shift = np.repeat(self.start[w] - np.cumsum(n) + n, n)
            out.append(self.ids[shift + np.arange(len(shift))] if len(w) else np.zeros(0, np.int32))
        return out


def _texts(column) -> list[str]:
    return [(t or b"").decode("utf-8", "replace") for t in column.to_pylist()]


def _source(docs: DataFrame, key: str, text: str) -> tuple[DataFrame, str]:
    return docs.select(F.col(key).alias("doc_id"), F.col(text).cast("binary").alias("text")), docs.schema[key].dataType.simpleString()


def encode(docs: DataFrame, ranks_path: str, pattern: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows (doc_id, ids array<int>), one per row of ``docs``; ordinary text only, no special tokens.

    Null and empty texts have no ids. Repeated rows and null doc_ids are encoded like any other; an empty table gives no
    rows. Only key and text are read, so other column names cannot clash. ``ranks_path`` is read on the driver and broadcast.
    """
    source, kind = _source(docs, key, text)
    shared = docs.sparkSession.sparkContext.broadcast(read_ranks(ranks_path))

    def rows(batches):
        encoder = Encoder(Merges(shared.value), pattern)
        for batch in batches:
            got = encoder.batch(_texts(batch.column(1)))
            ends = np.cumsum([0, *map(len, got)])
            flat = pa.array(np.concatenate([*got, np.zeros(0, np.int32)]).astype(np.int32))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), flat)], ["doc_id", "ids"])

    return source.mapInArrow(rows, f"doc_id {kind}, ids array<int>")


def decode(encoded: DataFrame, ranks_path: str, key: str = "doc_id") -> DataFrame:
    """Rows (doc_id, bytes) from rows (doc_id, ids); null ids give null, an id outside the table is an error."""
    kind = encoded.schema[key].dataType.simpleString()
    shared = encoded.sparkSession.sparkContext.broadcast(read_ranks(ranks_path))

    def rows(batches):
        tokens = shared.value
        for batch in batches:
            got = [None if x is None else b"".join(map(tokens.__getitem__, x)) for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(got, pa.binary())], ["doc_id", "bytes"])

    return encoded.select(F.col(key).alias("doc_id"), "ids").mapInArrow(rows, f"doc_id {kind}, bytes binary")


def round_trip(docs: DataFrame, ranks_path: str, pattern: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows (doc_id, n_tokens, ids_sha256, decoded_sha256): ``encode`` and then ``decode`` in one pass over the texts, with
    the digest of the decimal ids joined by commas and that of the decoded bytes. Cases as in ``encode``."""
    source, kind = _source(docs, key, text)
    shared = docs.sparkSession.sparkContext.broadcast(read_ranks(ranks_path))

    def rows(batches):
        tokens = shared.value
        encoder, decimal = Encoder(Merges(tokens), pattern), [b"%d," % i for i in range(len(tokens))]
        for batch in batches:
            counts, of_ids, of_bytes = [], [], []
            for ids in encoder.batch(_texts(batch.column(1))):
                ids = ids.tolist()
                counts.append(len(ids))
                of_ids.append(hashlib.sha256(b"".join(map(decimal.__getitem__, ids))[:-1]).hexdigest())
                of_bytes.append(hashlib.sha256(b"".join(map(tokens.__getitem__, ids))).hexdigest())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(counts, pa.int64()), pa.array(of_ids, pa.string()), pa.array(of_bytes, pa.string())], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return source.mapInArrow(rows, f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")
