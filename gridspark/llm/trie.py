"""Prefix trie of conversations: ternary search trees over dictionary-encoded turns, one per range shard.

Turns get numbers in the order of their digests, so a conversation is a list of numbers. Equal lists are counted first, then the
distinct ones are sorted and cut into shards of a bounded number of turns. A shard builds a ternary search tree by inserting the median
of each range before its halves, which balances it, and one iterative traversal adds up members, leaves and savings from
the bottom. Only nodes on the first or last path of a shard can occur in another one. A shard knows the lists just
before and after it, so it can tell which those are, which of them began before it and whether its last list goes on;
so counts of shared nodes are plain sums, and merging the boundary nodes is one grouping by their prefix digest.

Conversations longer than ``SEGMENT`` turns are cut into segments. The trie of a segment hangs below the node at which the segment before it
ends, named by a chained digest; levels of segments are built from the deepest, and each passes its totals up.
"""
from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridspark.operators.skew import lookup_join
from gridspark.session import settle

#: turns of a conversation that one tree holds; longer ones take a level of trees for each such part
SEGMENT = 4096
#: a shard ends after so many turns
SHARD_TURNS = 100_000
#: decimal ids that one row of a list to be hashed holds
IDS = 4000
EMPTY = hashlib.sha256(b"").hexdigest()
_PARTS = 33  # bits of monotonically_increasing_id below the partition


def sequences(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Rows (conv_id, at, id, size): the turns of each conversation in order, from zero, as numbers of distinct (role, text).

    ``size`` is the text's length in bytes of UTF-8. Turns follow ``turn``, null first; turns of one place follow the digest of role
    and text. Null roles and texts are empty; rows without a conversation are left out. A conversation may be spread over many tasks:
    rows are range-sorted and their places come from the counts of the ranges before.
    """
    said, who = F.coalesce(F.col(text), F.lit("")), F.coalesce(F.col(role), F.lit(""))
    token = F.unhex(F.sha2(F.concat(F.length(who).cast("string"), F.lit(":"), who, said), 256))
    kept = turns.where(F.col(conv).isNotNull()).select(
        F.col(conv).alias("conv_id"), F.col(turn).alias("turn"), token.alias("token"), F.octet_length(said).cast("long").alias("size"))
    kept = settle(kept)
    tokens = kept.select("token").distinct().repartitionByRange("token").sortWithinPartitions("token")
    coded = lookup_join(kept, tokens.withColumn("id", F.monotonically_increasing_id()), ["token"], "inner").select("conv_id", "turn", "id", "size")
    order = ["conv_id", "turn", "id"]
    ordered = settle(coded.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("row", F.monotonically_increasing_id()))
    ordered = ordered.withColumn("part", F.shiftright("row", _PARTS))
    parts = ordered.groupBy("conv_id", "part").agg(F.min("row").alias("first"), F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("conv_id", "part", (F.col("first") - F.coalesce(F.sum("n").over(before), F.lit(0))).alias("zero"))
    placed = ordered.join(parts, ["conv_id", "part"]).select("conv_id", (F.col("row") - F.col("zero")).alias("at"), "id", "size")
    return settle(placed)


def rebuilt(steps: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Conversations c that begin with the first h turns of c - c % 5 and go on with their own after h; h = crc32(c) % 9.

    Returns the steps and the table of all conversations, as some may have no turn left.
    """
    base, h = F.col("conv_id") - F.col("conv_id") % 5, (F.crc32(F.col("conv_id").cast("string").cast("binary")) % 9)
    convs = settle(steps.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n")))
    leads = convs.select("conv_id", h.alias("h"), base.alias("base")).join(
        convs.select(F.col("conv_id").alias("base"), F.col("n").alias("n_base")), "base", "left")
    leads = settle(leads.select("conv_id", "h", F.least("h", F.coalesce("n_base", F.lit(0))).alias("lead")))
    own = steps.join(leads, "conv_id").where("at >= h").select("conv_id", (F.col("at") - F.col("h") + F.col("lead")).alias("at"), "id", "size")
    near = F.filter(F.transform(F.sequence(F.lit(-4), F.lit(4)), lambda i: F.try_add("conv_id", i)), lambda c: c - c % 5 == F.col("conv_id"))
    heads = steps.where((F.col("at") < 8) & (F.col("conv_id") % 5 == 0)).select(F.explode(near).alias("conv_id"), "at", "id", "size")
    heads = heads.join(leads, "conv_id").where("at < h").select("conv_id", "at", "id", "size")
    return own.unionAll(heads), convs.select("conv_id")


class Tst:
    """A ternary search tree whose nodes are places in lists: number, lower, equal and higher link, trie parent, depth, bytes."""

    def __init__(self):
        self.number: list[int] = []
        self.lower: list[int] = []
        self.equal: list[int] = []
        self.higher: list[int] = []
        self.parent: list[int] = []
        self.depth: list[int] = []
        self.size: list[int] = []
        self.top = -1

    def insert(self, ids: list[int], sizes: list[int]) -> int:
        """The node at which the list ends."""
        number, lower, equal, higher = self.number, self.lower, self.equal, self.higher
        parent, at = -1, self.top
        for depth, x in enumerate(ids):
            before, links = parent, equal
            while at >= 0 and number[at] != x:
                before, links = at, lower if x < number[at] else higher
                at = links[at]
            if at < 0:
                at = len(number)
                if before < 0:
                    self.top = at
                else:
                    links[before] = at
                number.append(x)
                for links in (lower, equal, higher):
                    links.append(-1)
                self.parent.append(parent)
                self.depth.append(depth + 1)
                self.size.append(sizes[depth])
            parent, at = at, equal[at]
        return parent

    def insert_sorted(self, lists: list[tuple[list[int], list[int]]]) -> list[int]:
        """Inserts the median of each range before its halves; the nodes at which the lists end."""
        ends, ranges = [-1] * len(lists), [(0, len(lists))]
        while ranges:
            a, b = ranges.pop()
            if a < b:
                mid = (a + b) // 2
                ends[mid] = self.insert(*lists[mid])
                ranges += [(a, mid), (mid + 1, b)]
        return ends

    def places(self) -> list[int]:
        """All nodes, each behind its trie parent."""
        out, stack = [], [self.top] if self.top >= 0 else []
        while stack:
            at = stack.pop()
            out.append(at)
            stack += [x for x in (self.lower[at], self.equal[at], self.higher[at]) if x >= 0]
        return out


def _shared(a: list[int] | None, b: list[int]) -> int:
    """Length of the common prefix."""
    if a is None:
        return 0
    n = min(len(a), len(b))
    return next((i for i in range(n) if a[i] != b[i]), n)


def _nodes_of(entry: str, strings: list[tuple], ahead: list[int] | None, behind: list[int] | None) -> Iterator[tuple]:
    """Nodes of a shard as rows (kind, key, parent_key, depth, low, parent_low, n, children, leaves, saved, ended); kind 0 is a whole node, 1 a part
    of a boundary node, 2 the totals of the shard, to be added up for the trie of ``entry``.

    A string is (ids, sizes, n, low, till, ended, children, leaves, saved), the last three of the tries below it.
    ``ahead`` and ``behind`` are the lists just before and after the shard.
    """
    tree = Tst()
    ends = tree.insert_sorted([(s[0], s[1]) for s in strings])
    m = len(tree.number)
    n, low, children, leaves, saved, till = [0] * m, [None] * m, [0] * m, [0] * m, [0] * m, [None] * m
    for i, (end, s) in enumerate(zip(ends, strings, strict=True)):
        follows = strings[i + 1][0] if i + 1 < len(strings) else behind
        goes_on = s[2] > s[5] or follows is not None and len(follows) > len(s[0]) and follows[: len(s[0])] == s[0]
        n[end], low[end], children[end], leaves[end], saved[end] = s[2], s[3], s[6], s[7] + (not goes_on), s[8]
        till[end] = s[4] if s[5] else None
    # nodes of the first and last path that other shards have, too
    keys: dict[int, str] = {}
    began = _shared(ahead, strings[0][0])
    for s, end, depth in ((strings[0], ends[0], began), (strings[-1], ends[-1], _shared(behind, strings[-1][0]))):
        path, at = [], end
        while at >= 0:
            path.append(at)
            at = tree.parent[at]
        chain = hashlib.sha256(entry.encode())
        for x, at in zip(s[0][:depth], path[::-1][:depth], strict=True):
            chain.update(b"%d," % x)
            keys[at] = chain.hexdigest()
    first, at = set(), ends[0]
    while at >= 0:
        if tree.depth[at] <= began:
            first.add(at)  # began in an earlier shard
        at = tree.parent[at]
    total, lowest, tops, top_leaves, top_saved = 0, None, 0, 0, 0
    for at in reversed(tree.places()):
        own = at not in first
        saved[at] += (n[at] - own) * tree.size[at]
        up = tree.parent[at]
        if up < 0:
            total, tops, top_leaves, top_saved = total + n[at], tops + own, top_leaves + leaves[at], top_saved + saved[at]
            lowest = low[at] if lowest is None else min(lowest, low[at])
        else:
            n[up] += n[at]
            children[up] += own
            leaves[up] += leaves[at]
            saved[up] += saved[at]
            low[up] = low[at] if low[up] is None else min(low[up], low[at])
    for at in range(m):
        up = tree.parent[at]
        key = keys.get(at)
        parent_key = entry if up < 0 else keys.get(up)
        yield int(key is not None), key, parent_key, tree.depth[at], low[at], None if parent_key is not None else low[up], n[at], children[at], leaves[at], saved[at], till[at]
    yield 2, entry, None, 0, lowest, None, total, tops, top_leaves, top_saved, None


def _edges(strings: DataFrame) -> DataFrame:
    """The lists just before and after each range of the sorted ``strings``, as rows of side 0 and 2; a row or two for each range."""
    ends = strings.groupBy("part").agg(F.min(F.struct("entry", "ids")).alias("first"), F.max(F.struct("entry", "ids")).alias("last"))
    order = Window.orderBy("part")
    ends = settle(ends).select("part", F.lag("last").over(order).alias("ahead"), F.lead("first").over(order).alias("behind"))
    sides = F.explode(F.array(F.struct(F.lit(0).alias("side"), F.col("ahead").alias("s")), F.struct(F.lit(2).alias("side"), F.col("behind").alias("s"))))
    return ends.select("part", sides.alias("x")).where("x.s is not null").select("part", "x.side", "x.s.entry", "x.s.ids")


def _level(strings: DataFrame, kind: str) -> DataFrame:
    """The rows of ``_nodes_of`` for all shards of one level of segments, written."""
    columns = ["entry", "ids", "sizes", "n", "low", "till", "ended", "children", "leaves", "saved"]
    ranged = strings.select(columns).repartitionByRange("entry", "ids").withColumn("part", F.spark_partition_id())
    ranged = settle(ranged)
    every = ranged.withColumn("side", F.lit(1)).unionByName(_edges(ranged), allowMissingColumns=True)
    every = every.select("part", "side", *columns).repartition("part").sortWithinPartitions("part", "side", "entry", "ids")
    names = ["kind", "key", "parent_key", "depth", "low", "parent_low", "n", "children", "leaves", "saved", "till"]

    def rows(batches):
        def strings_of():
            for batch in batches:
                yield from zip(*(batch.column(i).to_pylist() for i in range(batch.num_columns)), strict=True)

        def shards():
            part, ahead, entry, held, turns, last = None, None, None, [], 0, None  # last: the list before, and its entry
            for p, side, e, ids, *rest in strings_of():
                if held and (p != part or e != entry or side == 2 or turns >= SHARD_TURNS):
                    yield entry, held, ahead, ids if p == part and e == entry else None
                    held, turns = [], 0
                if p != part:
                    part, last = p, None
                if side == 1:
                    if not held:
                        entry, ahead = e, last[1] if last and last[0] == e else None
                    held.append((ids, *rest))
                    turns += len(ids)
                last = (e, ids)
            if held:
                yield entry, held, ahead, None

        low_kind, text, long = types[0], pa.string(), pa.int64()
        kinds = [pa.int32(), text, text, long, low_kind, low_kind, long, long, long, long, text]
        out: list[tuple] = []
        for shard in shards():
            out += _nodes_of(*shard)
            if len(out) >= 20_000:
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out, strict=True), kinds, strict=True)], names)
                out = []
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out, strict=True), kinds, strict=True)], names)

    types = [pa.string() if kind == "string" else pa.int64()]
    schema = f"kind int, key string, parent_key string, depth long, low {kind}, parent_low {kind}, n long, children long, leaves long, saved long, till string"
    return settle(every.mapInArrow(rows, schema))


def _chained(segments: DataFrame, kind: str) -> DataFrame:
    """Adds entry and till, the names of the node at which a segment begins and ends: digests chained along the conversation.

    Conversations of one segment begin at the root, named by an empty text. Of longer ones, only a digest per segment is sorted and
    streamed in order.
    """
    mark = F.sha2(F.array_join("ids", ","), 256)
    segments = settle(segments.withColumn("mark", mark))
    single = F.sha2(F.col("mark"), 256)
    many = segments.where("seg > 0").select("conv_id").distinct()
    long = segments.select("conv_id", "seg", "mark").join(many, "conv_id", "left_semi")

    def rows(batches):
        held = entry = None
        for batch in batches:
            convs, marks = batch.column(0).to_pylist(), batch.column(2).to_pylist()
            entries, tills = [], []
            for c, x in zip(convs, marks, strict=True):
                entry = "" if held is None or c != held[0] else entry
                held = (c,)
                entries.append(entry)
                entry = hashlib.sha256((entry + x).encode()).hexdigest()
                tills.append(entry)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(entries, pa.string()), pa.array(tills, pa.string())], ["conv_id", "seg", "entry", "till"])

    chain = long.repartition("conv_id").sortWithinPartitions("conv_id", "seg").mapInArrow(rows, f"conv_id {kind}, seg long, entry string, till string")
    short = segments.join(many, "conv_id", "left_anti").select("conv_id", "seg", "ids", "sizes", F.lit("").alias("entry"), single.alias("till"))
    return short.unionByName(lookup_join(segments.drop("mark"), chain, ["conv_id", "seg"], "inner"))


def id_digests(ends: DataFrame, kind: str) -> DataFrame:
    """Rows (till, sha): SHA-256 of the ascending ids of each name, joined by commas.

    Ids are range-sorted and joined in pieces where they lie, so a name that many conversations share is many tasks; its digest, which
    is sequential by definition, then streams over the pieces.
    """
    ends = settle(ends)

    def pieces(batches):
        held, ids = None, []
        out: list[tuple] = []
        for batch in batches:
            for till, c in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if ids and (till != held or len(ids) >= IDS):
                    out.append((held, ids[0], ",".join(map(str, ids))))
                    ids = []
                held = till
                ids.append(c)
                if len(out) >= 1000:
                    yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out, strict=True), types, strict=True)], ["till", "first", "ids"])
                    out = []
        if ids:
            out.append((held, ids[0], ",".join(map(str, ids))))
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out, strict=True), types, strict=True)], ["till", "first", "ids"])

    def digests(batches):
        held, digest = None, None
        for batch in batches:
            tills, shas = [], []
            for till, ids in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), strict=True):
                if till != held:
                    if digest is not None:
                        tills.append(held)
                        shas.append(digest.hexdigest())
                    held, digest = till, hashlib.sha256(ids.encode())
                else:
                    digest.update(b"," + ids.encode())
            yield pa.RecordBatch.from_arrays([pa.array(tills, pa.string()), pa.array(shas, pa.string())], ["till", "sha"])
        if digest is not None:
            yield pa.RecordBatch.from_arrays([pa.array([held]), pa.array([digest.hexdigest()])], ["till", "sha"])

    types = [pa.string(), pa.string() if kind == "string" else pa.int64(), pa.string()]
    joined = ends.repartitionByRange("till", "conv_id").sortWithinPartitions("till", "conv_id").mapInArrow(pieces, f"till string, first {kind}, ids string")
    return joined.repartition("till").sortWithinPartitions("till", "first").mapInArrow(digests, "till string, sha string")


def prefix_trie(steps: DataFrame, convs: DataFrame, segment: int | None = None) -> DataFrame:
    """One row per node of the trie: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    ``steps`` are rows (conv_id, at, id, size) with places from zero, ``convs`` all conversations (conv_id), also those without steps, which
    are members of the root alone. A node is named by its smallest member and its depth; its leaves, and the bytes saved by
    keeping each of its turns once, count its whole subtree; ``ends_sha256`` is the digest of the members that end there.
    Without conversations there is no root and no row. Equal conversations are counted, never paired.
    """
    segment = segment or SEGMENT
    kind = "string" if convs.schema["conv_id"].dataType.simpleString() == "string" else "long"
    convs = settle(convs.select(F.col("conv_id").cast(kind)).distinct())
    steps = steps.select(F.col("conv_id").cast(kind), "at", "id", "size", F.floor(F.col("at") / segment).alias("seg"))
    cut = steps.groupBy("conv_id", "seg").agg(F.array_sort(F.collect_list(F.struct("at", "id", "size"))).alias("s"))
    cut = _chained(cut.select("conv_id", "seg", F.col("s.id").alias("ids"), F.col("s.size").alias("sizes")), kind)
    cut = settle(cut)
    last = cut.groupBy("conv_id").agg(F.max(F.struct("seg", "till")).alias("x")).select("conv_id", "x.seg", "x.till")
    ends = settle(convs.join(last, "conv_id", "left").select("conv_id", "seg", F.coalesce("till", F.lit("")).alias("till")))
    ended = ends.groupBy("till").agg(F.count(F.lit(1)).alias("ended"))
    strings = cut.groupBy("seg", "entry", "till", "ids", "sizes").agg(F.count(F.lit(1)).alias("n"), F.min("conv_id").alias("low"))
    strings = settle(lookup_join(strings, ended, ["till"]).withColumn("ended", F.coalesce("ended", F.lit(0))))
    deepest = strings.agg(F.max("seg")).first()[0]
    nodes, below = [], None
    zero = F.lit(0).cast("long")
    for seg in range(-1 if deepest is None else deepest, -1, -1):
        mine = strings.where(F.col("seg") == seg)
        if below is None:
            mine = mine.select("*", zero.alias("children"), zero.alias("leaves"), zero.alias("saved"))
        else:
            mine = lookup_join(mine, below, ["till"])
            mine = mine.withColumns({c: F.coalesce(c, zero) for c in ("children", "leaves", "saved")})
        got = _level(mine, kind)
        added = [F.sum(c).alias(c) for c in ("n", "children", "leaves", "saved")]
        shared = settle(got.where("kind = 1").groupBy("key").agg(F.min("parent_key").alias("parent_key"), F.min("depth").alias("depth"), F.min("low").alias("low"), F.max("till").alias("till"), *added))
        below = settle(got.where("kind = 2").groupBy(F.col("key").alias("till")).agg(*added[1:]))
        # smallest members of the nodes that others name as parents: shared nodes, and where segments begin
        tops = convs.agg(F.min("conv_id").alias("low")).select(F.lit("").alias("key"), "low") if seg == 0 else strings.where((F.col("seg") == seg - 1) & (F.col("n") > F.col("ended"))).select(F.col("till").alias("key"), "low")
        named = shared.select("key", "low").unionAll(tops).select(F.col("key").alias("parent_key"), F.col("low").alias("parent_low"))
        columns = ["low", "depth", "parent_low", "n", "children", "leaves", "saved", "till"]
        hanging = got.where("kind = 0 and parent_key is not null").drop("parent_low").unionByName(shared, allowMissingColumns=True)
        for part in (got.where("kind = 0 and parent_key is null"), lookup_join(hanging, named, ["parent_key"])):
            nodes.append(part.select(columns).withColumn("depth", F.col("depth") + seg * segment))
    root = convs.agg(F.min("conv_id").alias("low"), F.count(F.lit(1)).alias("n"))
    # the root is what all conversations and the first level of tries add up to
    totals = root.select("low", "n", zero.alias("children"), zero.alias("leaves"), zero.alias("saved"))
    if below is not None:
        totals = totals.unionAll(below.select(F.lit(None).cast(kind).alias("low"), zero.alias("n"), "children", "leaves", "saved"))
    top = totals.agg(F.min("low").alias("low"), *(F.sum(c).alias(c) for c in ("n", "children", "leaves", "saved"))).where("n > 0")
    top = top.withColumn("leaves", F.greatest("leaves", F.lit(1)))
    nodes.append(top.select("low", zero.alias("depth"), F.lit(None).cast(kind).alias("parent_low"), "n", "children", "leaves", "saved", F.lit("").alias("till")))
    every = nodes[0]
    for part in nodes[1:]:
        every = every.unionAll(part)
    every = settle(every)
    digest = every.where("till is not null").join(id_digests(ends.select("till", "conv_id"), kind), "till", "left")
    plain = every.where("till is null").withColumn("sha", F.lit(EMPTY))
    out = digest.select(*plain.columns).unionAll(plain)
    return out.select(F.col("low").alias("conv_id"), "depth", F.col("parent_low").alias("parent_conv_id"), F.col("n").alias("n_convs"), F.col("children").alias("n_children"),
                      F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"), F.coalesce("sha", F.lit(EMPTY)).alias("ends_sha256"))


SQL = """
WITH crc AS (
  SELECT DISTINCT conv_id AS c, CAST(conv_id AS VARCHAR) AS name FROM conversations WHERE conv_id IS NOT NULL),
convs AS (
  SELECT c, c - c % 5 AS base, xor(4294967295, list_reduce(flatten(list_transform(string_split(name, ''), lambda x: list_concat([CAST(ascii(x) AS BIGINT)], list_value(-1, -1, -1, -1, -1, -1, -1, -1)))),
    lambda acc, x: CASE WHEN x >= 0 THEN xor(acc, x) ELSE xor(acc >> 1, (acc & 1) * 3988292384) END, CAST(4294967295 AS BIGINT))) % 9 AS h
  FROM crc),
said AS (
  SELECT conv_id AS c, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
turns AS (
  SELECT c, row_number() OVER (PARTITION BY c ORDER BY turn NULLS FIRST, sha256(length(role) || ':' || role || text)) - 1 AS at_, {'role': role, 'text': text} AS t
  FROM said),
steps AS (
  SELECT convs.c, 0 AS own, at_, t FROM convs JOIN turns ON turns.c = convs.base AND at_ < h
  UNION ALL SELECT convs.c, 1, at_, t FROM convs JOIN turns ON turns.c = convs.c AND at_ >= h),
rebuilt AS (SELECT convs.c, coalesce(list(t ORDER BY own, at_) FILTER (t IS NOT NULL), []) AS s FROM convs LEFT JOIN steps USING (c) GROUP BY convs.c),
prefixes AS (SELECT c, d, len(s) = d AS ends, s[1:d] AS p, strlen(s[d].text) AS bytes FROM (SELECT c, s, unnest(range(len(s) + 1)) AS d FROM rebuilt)),
named AS (SELECT *, sha256(to_json(p)) AS key, sha256(to_json(p[1:greatest(d - 1, 0)])) AS up FROM prefixes),
nodes AS (
  SELECT key, min(up) AS up, d, min(c) AS conv_id, count(*) AS n, (count(*) - 1) * coalesce(max(bytes), 0) AS saved,
         coalesce(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (ends), '') AS ids
  FROM named GROUP BY key, d),
kids AS (SELECT up, count(*) AS n_children FROM nodes WHERE d > 0 GROUP BY up),
full_ AS (SELECT nodes.*, coalesce(n_children, 0) AS n_children FROM nodes LEFT JOIN kids ON kids.up = nodes.key),
above AS (
  SELECT DISTINCT a.key AS top, b.key FROM named a JOIN named b ON a.c = b.c AND a.d <= b.d),
totals AS (
  SELECT top, count(*) FILTER (n_children = 0) AS n_leaves, CAST(sum(saved) AS BIGINT) AS saved_tokens FROM above JOIN full_ USING (key) GROUP BY top)
SELECT f.conv_id, CAST(f.d AS BIGINT) AS depth, p.conv_id AS parent_conv_id, f.n AS n_convs, f.n_children, n_leaves, saved_tokens, sha256(f.ids) AS ends_sha256
FROM full_ f JOIN totals ON totals.top = f.key LEFT JOIN nodes p ON f.d > 0 AND p.key = f.up
"""
