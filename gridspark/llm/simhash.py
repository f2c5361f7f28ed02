"""SimHash near-duplicates: pigeonhole blocks, a join on blocks, verified Hamming distances.

Fingerprints are collapsed to distinct values first, so a group of exact copies is one value however large.
A value is sent to one block key for every choice of ``keep`` blocks out of ``blocks``: two values that
differ in at most ``blocks - keep`` bits agree on one such choice. Keys with more than ``CROWD`` values are
split once more by the same principle on all 64 bits in finer blocks, which leaves few free bits and
so bounds a group whatever the data. Within a group only the edges of a spanning forest are returned, each a
verified pair.
"""
from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridspark.llm.graph import components
from gridspark.session import settle

#: distinct values of one block key that are compared without splitting the key
CROWD = 4096


def shingle_hashes(text: bytes, words: int) -> np.ndarray:
    """XXH64 values (seed 42) of the word shingles, repeats included; of an empty one for a text without words."""
    from xxhash import xxh64_intdigest

    tokens = text.lower().split()  # bytes: only A-Z change, only ASCII white space splits
    line = b" ".join(tokens)
    if len(tokens) <= words:
        return np.array([xxh64_intdigest(line, 42)], "<u8")
    sizes = np.fromiter(map(len, tokens), np.int64, len(tokens))
    ends = np.cumsum(sizes + 1) - 1
    last = ends[words - 1:].tolist()
    first = (ends - sizes)[: len(last)].tolist()
    return np.array([xxh64_intdigest(line[a:b], 42) for a, b in zip(first, last, strict=True)], "<u8")


def majority(hashes: np.ndarray) -> int:
    """The bits that are set in over half of the hashes."""
    slots = hashes.view(np.uint8).reshape(-1, 8).astype(np.int64) + np.arange(0, 2048, 256)
    counts = np.bincount(slots.ravel(), minlength=2048).reshape(8, 256)
    bits = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little")
    ones = (counts @ bits.astype(np.int64)).ravel()  # bit i of the value at place i
    return sum(1 << i for i in np.flatnonzero(2 * ones > len(hashes)).tolist())


def _fingerprint(text: bytes, words: int) -> int:
    return majority(shingle_hashes(text, words)) if text.strip() else 0


def fingerprints(docs: DataFrame, words: int = 3, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows (doc_id, fp): the 64-bit fingerprint of each whole text as a signed long.

    A bit is set if it is set in over half of the XXH64 values (seed 42) of the word shingles, repeats
    included. A text of fewer words is one shingle; null, empty and blank texts give zero.
    """
    key_type = docs.schema[key].dataType.simpleString()

    def rows(batches):
        for batch in batches:
            got = [_fingerprint(t or b"", words) for t in batch.column(1).to_pylist()]
            fp = np.array(got, np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fp)], ["doc_id", "fp"])

    source = docs.select(F.col(key).alias("doc_id"), F.col(text).cast("binary").alias("text"))
    return source.mapInArrow(rows, f"doc_id {key_type}, fp long")


def _masks(blocks: int, keep: int) -> list[int]:
    """Signed masks of every choice of ``keep`` of ``blocks`` near-equal runs of the 64 bits."""
    cut = [round(64 * i / blocks) for i in range(blocks + 1)]
    runs = [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in zip(cut, cut[1:], strict=False)]
    return [m - (1 << 64) if m >> 63 else m for c in combinations(runs, keep) for m in [sum(c)]]


def _keyed(values: DataFrame, masks: list[int]) -> DataFrame:
    keys = F.array(*[F.struct(F.lit(i).alias("choice"), F.col("fp").bitwiseAND(F.lit(m)).alias("part")) for i, m in enumerate(masks)])
    return values.select("*", F.explode(keys).alias("k")).select("*", "k.choice", "k.part").drop("k")


def _forest(values: np.ndarray, bits: int) -> list[tuple[int, int]]:
    """Edges (value, first value of its part) of the graph of values within ``bits``; values ascend."""
    edges, left = [], values
    while len(left) > 1:
        root, left, front = int(left[0]), left[1:], left[:1]
        while len(front) and len(left):
            near = np.zeros(len(left), bool)
            for at in range(0, len(front), 256):
                gap = np.bitwise_count((front[at:at + 256, None] ^ left[None, :]).view(np.uint64))
                near |= (gap <= bits).any(axis=0)
            front, left = left[near], left[~near]
            edges += [(int(x), root) for x in front]
    return edges


def _group_edges(grouped: DataFrame, keys: list[str], bits: int) -> DataFrame:
    """Forest edges (a, b) of each bounded group of ``keys``; a group is a run of its sorted partition."""

    def rows(batches):
        held = None
        for batch in batches:
            now = np.stack([np.asarray(batch.column(i)) for i in range(len(keys) + 1)])
            now = now if held is None else np.concatenate([held, now], axis=1)
            starts = np.flatnonzero(np.r_[True, (now[:-1, 1:] != now[:-1, :-1]).any(axis=0)]) if now.shape[1] else np.zeros(1, int)
            held = now[:, starts[-1]:]
            yield table(now, starts)
        if held is not None:
            yield table(held, np.array([0, held.shape[1]]))

    def table(now, starts):
        edges = []
        for a, b in zip(starts[:-1].tolist(), starts[1:].tolist(), strict=True):
            if b - a == 2:
                x, y = int(now[-1, a]), int(now[-1, a + 1])
                if ((x ^ y) & (2**64 - 1)).bit_count() <= bits:
                    edges.append((y, x))
            elif b - a > 2:
                edges += _forest(now[-1, a:b], bits)
        got = np.array(edges, np.int64).reshape(-1, 2)
        return pa.RecordBatch.from_arrays([pa.array(got[:, 0]), pa.array(got[:, 1])], ["a", "b"])

    longs = [F.col(k).cast("long").alias(k) for k in keys]
    ready = grouped.repartition(*keys).sortWithinPartitions(*keys, "fp").select(*longs, "fp")
    return ready.mapInArrow(rows, "a long, b long")


def close_pairs(values: DataFrame, bits: int = 2, blocks: int = 5, keep: int = 3) -> DataFrame:
    """Edges (a, b) that span every component of distinct ``fp`` values within ``bits`` differing bits.

    Every edge is a verified pair, and any two values within ``bits`` are joined by a path of edges.
    """
    if blocks - keep < bits:
        raise ValueError(f"blocks - keep must be at least bits ({bits}), got {blocks} - {keep}")
    keyed = _keyed(values.select("fp"), _masks(blocks, keep))
    # written, so that the join of a crowded key can be split
    shared = settle(keyed.groupBy("choice", "part").agg(F.count(F.lit(1)).alias("n")).where("n > 1"))
    tagged = settle(keyed.join(shared, ["choice", "part"]))
    calm = _group_edges(tagged.where(F.col("n") <= CROWD).select("choice", "part", "fp"), ["choice", "part"], bits)
    # a finer choice of 8-bit runs, within the key: at most 8 * bits bits stay free
    finer = _keyed(tagged.where(F.col("n") > CROWD).select(F.col("choice").alias("c"), F.col("part").alias("p"), "fp"), _masks(8, 8 - bits))
    crowded = _group_edges(finer.select("c", "p", "choice", "part", "fp").where("p is not null"), ["c", "p", "choice", "part"], bits)
    return calm.unionAll(crowded)


def near_duplicates(docs: DataFrame, words: int = 3, bits: int = 2, blocks: int = 5, keep: int = 3, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows (doc_id, fp, component_id): one per row of ``docs``, with the smallest doc_id reachable over
    fingerprints within ``bits`` differing bits, itself included.

    Texts that are null, empty or blank share fingerprint zero and link like any other. Repeated rows each get a
    row; a null doc_id is kept and counts as larger than any other. An empty table gives no rows. Other columns are
    not read, so their names cannot clash.
    """
    prints = settle(fingerprints(docs, words, key, text))
    values = settle(prints.groupBy("fp").agg(F.min("doc_id").alias("rep")))
    linked = components(close_pairs(values, bits, blocks, keep)).select(F.col("node").alias("fp"), "component")
    named = values.join(linked, "fp", "left").select("fp", "rep", F.coalesce("component", "fp").alias("component"))
    named = settle(named)
    smallest = settle(named.groupBy("component").agg(F.min("rep").alias("component_id")))
    classes = settle(named.join(smallest, "component").select("fp", "component_id"))
    return prints.join(classes, "fp").select("doc_id", "fp", "component_id")
