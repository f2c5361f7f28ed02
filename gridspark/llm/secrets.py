"""Secret scans: sliding-window entropy per character class, with allow-list suppression.

A text is scanned once for named patterns (the base) and once for candidates: maximal runs of at least ``WIDTH`` characters
that credentials are made of. Within a candidate, every maximal run of one character class is a string over which a
window of the class's width slides. The window's Shannon entropy is kept by incremental counts: a character that enters or
leaves changes one count and so one term of the sum, in whole numbers (units of 2**-20 bit per window), so no rounding decides a
window and a run of n characters costs n steps. Windows that reach the class's entropy and hold each of its needed kinds of
characters are hot; overlapping and touching hot windows form a span. A span is suppressed if its candidate is on the
allow-list (placeholders, sequences, keyboard runs, prefixes of public digests) or if it lies in a base span.
All patterns are ASCII, so a text is scanned as one byte per code point and every offset is one of code points.
"""
from __future__ import annotations

import hashlib
import math
import re
from bisect import bisect_right
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WIDTH = 16
#: units of an entropy of one bit
UNIT = 1 << 20
# fixed values: the base patterns (keywords in either case) and the least lengths of what they find
KEYWORDS = ["password", "passwd", "secret", "token", "api_?key"]
ASSIGN_TAIL = r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ASSIGN_LEAST, ACCESS, HEX = 12, "AKIA[A-Z0-9]{14,}", "[0-9a-f]{16,}"
KINDS = ["assign", "access", "hex"]


class CharClass(NamedTuple):
    """A class of characters; ``needs`` are sets of characters of which a hot window holds one each."""

    kind: str
    chars: str
    width: int
    bits: float
    needs: tuple[str, ...]


# fixed values: classes by their usual encodings; the entropies lie below those of random strings and above those of names and paths
CLASSES = [
    CharClass("entropy16", "0-9A-Fa-f", 16, 2.9, ("0-9", "A-Fa-f")),
    CharClass("entropy36", "0-9a-z", 20, 3.65, ("0-9", "a-z")),
    CharClass("entropy36u", "0-9A-Z", 20, 3.65, ("0-9", "A-Z")),
    CharClass("entropy64", "0-9A-Za-z+/_-", 24, 4.0, ("0-9", "A-Z", "a-z")),
]
# fixed values: what a candidate holds (in any case) or follows if it is no secret
ALLOWED = ["example", "sample", "placeholder", "changeme", "change_me", "dummy", "redacted", "your_", "xxxx", "0000", "0123456", "1234567", "abcdef", "qwerty", "deadbeef", "sha1-", "sha256-", "sha384-", "sha512-"]
ALLOWED_BEFORE = r"(sha1|sha224|sha256|sha384|sha512|md5|crc32|etag|checksum|integrity|commit|uuid)[\"']?\x20?[-:=]?\x20?[\"']?"
_BEFORE = 24


def _term(count: int) -> int:
    """The share of a character with ``count`` places in the entropy sum."""
    return math.floor(UNIT * count * math.log2(count)) if count else 0


def needed(c: CharClass) -> int:
    """Largest sum of terms at which a window of the class still has its entropy: H = log2(w) - sum / w."""
    return math.floor(UNIT * c.width * (math.log2(c.width) - c.bits))


def _members(spec: str) -> frozenset[int]:
    return frozenset(x for x in range(128) if re.match(f"[{spec}]", chr(x)))


def hot_spans(run: bytes, c: CharClass, terms: list[int], most: int, needs: list[frozenset[int]]) -> Iterator[tuple[int, int]]:
    """Merged hot windows of a run of one class; counts, sum of terms and kinds follow the window character by character."""
    counts, total, kinds = [0] * 128, 0, [0] * len(needs)
    begin = end = -1
    for i, x in enumerate(run):
        n = counts[x]
        counts[x] = n + 1
        total += terms[n + 1] - terms[n]
        for k, members in enumerate(needs):
            kinds[k] += x in members
        if i >= c.width:
            y = run[i - c.width]
            n = counts[y]
            counts[y] = n - 1
            total += terms[n - 1] - terms[n]
            for k, members in enumerate(needs):
                kinds[k] -= y in members
        if i >= c.width - 1 and total <= most and all(kinds):
            start = i - c.width + 1
            if begin >= 0 and start > end:
                yield begin, end
                begin = start
            elif begin < 0:
                begin = start
            end = i + 1
    if begin >= 0:
        yield begin, end


class Scanner:
    """The compiled patterns of a scan; ``spans`` gives (start, place of the kind, end, kind) of one text."""

    def __init__(self, classes: list[CharClass], allowed: list[str], before: str):
        self.assign = re.compile(("(?:" + "|".join(KEYWORDS) + ")" + ASSIGN_TAIL.replace("A-Za-z", "a-z")).encode())
        self.access, self.hex = re.compile(ACCESS.encode()), re.compile(HEX.encode())
        self.order = {k: i for i, k in enumerate([*KINDS, *(c.kind for c in classes)])}
        every = "".join(c.chars.replace("-", "\\-") if c.chars.endswith("-") else c.chars for c in classes)
        self.wide = re.compile(f"(?<![{every}])[{every}]{{{WIDTH},}}".encode())
        self.classes = [(c, re.compile(f"[{c.chars}]{{{c.width},}}".encode()), [_term(n) for n in range(c.width + 2)], needed(c), [_members(s) for s in c.needs]) for c in classes]
        self.allowed = re.compile("|".join(map(re.escape, allowed)).encode()) if allowed else None
        self.before = re.compile(rf"(?:{before})\Z".encode()) if before else None

    def base(self, raw: bytes, low: bytes) -> list[tuple[int, int, int, str]]:
        got = []
        if b":" in raw or b"=" in raw:
            got = [(m.start(), m.end(), "assign") for m in self.assign.finditer(low) if m.end(1) - m.start(1) >= ASSIGN_LEAST]
        if b"AKIA" in raw:
            got += [(*m.span(), "access") for m in self.access.finditer(raw)]
        got += [(*m.span(), "hex") for m in self.hex.finditer(raw)]
        return [(a, self.order[k], b, k) for a, b, k in got]

    def spans(self, text: str) -> tuple[list[tuple[int, int, int, str]], list[tuple[int, int, int, str]]]:
        """Base spans and the method's own, each in order."""
        raw = text.encode("ascii", "replace")
        low = raw.lower()
        base, more = sorted(self.base(raw, low)), []
        for m in self.wide.finditer(raw):
            at, end = m.span()
            if self.allowed and self.allowed.search(low, at, end) or self.before and self.before.search(low[max(0, at - _BEFORE):at]):
                continue
            for c, runs, terms, most, needs in self.classes:
                for r in runs.finditer(raw, at, end):
                    more += [(r.start() + a, self.order[c.kind], r.start() + b, c.kind) for a, b in hot_spans(r.group(), c, terms, most, needs)]
        if more and base:
            # the furthest end of a base span that begins at or before a place
            reach, starts = [], []
            for a, _, b, _ in base:
                starts.append(a)
                reach.append(max(b, reach[-1] if reach else 0))
            more = [x for x in more if not ((i := bisect_right(starts, x[0])) and reach[i - 1] >= x[2])]
        return base, sorted(more)


def _listed(spans: list[tuple[int, int, int, str]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for a, _, b, k in spans)


def secret_scan(docs: DataFrame, classes: list[CharClass] | None = None, allowed: list[str] | None = None, before: str | None = None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows (doc_id, n_assign, n_access, n_hex, base_sha256, n_entropy, spans), one per row of ``docs``.

    Spans are kind:start:end in code points, end exclusive, ordered by start, then by the place of the kind, joined
    by commas; ``base_sha256`` is the digest of the base ones alone. ``classes``, ``allowed`` (lower-case parts of candidates) and
    ``before`` (a pattern of what stands before a candidate) default to the fixed ones. Null and empty texts have no spans.
    Repeated rows and null ids get a row each; an empty table gives none. A text of any length takes one pass per pattern. Only
    key and text are read, so extra columns do not matter.
    """
    classes = CLASSES if classes is None else classes
    allowed, before = ALLOWED if allowed is None else allowed, ALLOWED_BEFORE if before is None else before
    kind = docs.schema[key].dataType.simpleString()
    names = ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "n_entropy", "spans"]

    def rows(batches):
        scanner = Scanner(classes, allowed, before)
        for batch in batches:
            got: list[list] = [[] for _ in names[1:]]
            for value in batch.column(1):
                base, more = scanner.spans(value.as_py() or "")
                found = [x[3] for x in base]
                line = [*(found.count(k) for k in KINDS), hashlib.sha256(_listed(base).encode()).hexdigest(), len(more), _listed(sorted(base + more))]
                for column, x in zip(got, line, strict=True):
                    column.append(x)
            kinds = [pa.int64()] * 3 + [pa.string(), pa.int64(), pa.string()]
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(x, t) for x, t in zip(got, kinds, strict=True))], names)

    source = docs.select(F.col(key).alias("doc_id"), F.col(text).cast("string").alias("text"))
    return source.mapInArrow(rows, f"doc_id {kind}, n_assign long, n_access long, n_hex long, base_sha256 string, n_entropy long, spans string")


def secrets_found(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The spans as rows (doc_id, kind, start, end, value) in the order of each text, for rewriting or review.

    Rows without a secret have none here; nulls, repeats and empty tables as in ``secret_scan``.
    """
    kind = docs.schema[key].dataType.simpleString()

    def rows(batches):
        scanner = Scanner(CLASSES, ALLOWED, ALLOWED_BEFORE)
        for batch in batches:
            ids, got = batch.column(0).to_pylist(), []
            for i, value in enumerate(batch.column(1)):
                t = value.as_py() or ""
                base, more = scanner.spans(t)
                got += [(ids[i], k, a, b, t[a:b]) for a, _, b, k in sorted(base + more)]
            columns = list(zip(*got, strict=True)) or [[]] * 5
            kinds = [batch.schema.field(0).type, pa.string(), pa.int64(), pa.int64(), pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(columns, kinds, strict=True)], ["doc_id", "kind", "start", "end", "value"])

    source = docs.select(F.col(key).alias("doc_id"), F.col(text).cast("string").alias("text"))
    return source.mapInArrow(rows, f"doc_id {kind}, kind string, start long, end long, value string")


def sql() -> str:
    """The same scan as DuckDB SQL: every window of every candidate, its entropy from the counts of its characters."""
    quoted = lambda s: s.replace("'", "''")
    either = "|".join(re.sub("[a-z]", lambda m: f"[{m[0].upper()}{m[0]}]", k) for k in KEYWORDS)
    assign = quoted(f"(?:{either})" + ASSIGN_TAIL.replace(r"\x20", " "))
    every = "0-9A-Za-z+/_-"
    classes = ", ".join(f"('{c.kind}', {i + len(KINDS)}, '[{c.chars}]{{{c.width},}}', {c.width}, {needed(c)}, [{', '.join(repr(f'[{s}]') for s in c.needs)}])" for i, c in enumerate(CLASSES))
    terms = f"CAST(floor({UNIT}.0 * n * log2(n)) AS BIGINT)"
    before = quoted(ALLOWED_BEFORE.replace(r"\x20", " ").replace('\\"', '"'))
    allowed = " OR ".join(f"contains(lower(cand), '{a}')" for a in ALLOWED)
    return f"""
WITH d AS (SELECT row_number() OVER () AS row, doc_id, coalesce(text, '') AS text FROM documents),
found AS (
  SELECT row, kind, ord, m, gaps FROM d, LATERAL (VALUES
    ('assign', 0, regexp_extract_all(text, '{assign}'), string_split_regex(text, '{assign}')),
    ('access', 1, regexp_extract_all(text, '{ACCESS}'), string_split_regex(text, '{ACCESS}')),
    ('hex', 2, regexp_extract_all(text, '{HEX}'), string_split_regex(text, '{HEX}')),
    ('wide', 9, regexp_extract_all(text, '[{every}]{{{WIDTH},}}'), string_split_regex(text, '[{every}]{{{WIDTH},}}'))) x(kind, ord, m, gaps)
  WHERE len(m) > 0),
each AS (SELECT row, kind, ord, unnest(m) AS m, unnest(gaps[:len(m)]) AS gap, generate_subscripts(m, 1) AS i FROM found),
placed AS (
  SELECT row, kind, ord, m, CAST(sum(length(gap) + length(m)) OVER (PARTITION BY row, kind ORDER BY i) - length(m) AS BIGINT) AS spot FROM each),
base AS (
  SELECT row, kind, ord, spot, spot + length(m) AS till FROM placed
  WHERE kind IN ('access', 'hex') OR kind = 'assign' AND length(regexp_extract(m, '{assign}', 1)) >= {ASSIGN_LEAST}),
cands AS (
  SELECT row, spot, m AS cand FROM (SELECT p.*, lower(substr(text, 1 + greatest(0, spot - {_BEFORE}), least(spot, {_BEFORE}))) AS before, m AS cand
    FROM placed p JOIN d USING (row) WHERE kind = 'wide') WHERE NOT ({allowed}) AND NOT regexp_matches(before, '({before})$')),
classes(kind, ord, pattern, width, most, needs) AS (VALUES {classes}),
runs AS (
  SELECT row, kind, ord, width, most, needs, spot + sum(length(gap) + length(r)) OVER (PARTITION BY row, spot, kind ORDER BY i) - length(r) AS spot, r
  FROM (SELECT row, spot, c.*, unnest(regexp_extract_all(cand, pattern)) AS r, unnest(string_split_regex(cand, pattern)) AS gap,
    unnest(range(len(regexp_extract_all(cand, pattern)))) AS i FROM cands, classes c) WHERE r IS NOT NULL),
windows AS (
  SELECT row, kind, ord, width, most, spot + i AS spot, substr(r, CAST(i + 1 AS BIGINT), width) AS w
  FROM (SELECT *, unnest(range(length(r) - width + 1)) AS i FROM runs)
  WHERE list_aggregate(list_transform(needs, lambda x: regexp_matches(substr(r, CAST(i + 1 AS BIGINT), width), x)), 'bool_and')),
counts AS (SELECT row, kind, ord, width, most, spot, ch, count(*) AS n FROM (SELECT *, unnest(string_split(w, '')) AS ch FROM windows) GROUP BY ALL),
hot AS (SELECT row, kind, ord, width, spot FROM counts GROUP BY row, kind, ord, width, most, spot HAVING sum({terms}) <= most),
steps AS (
  SELECT *, CASE WHEN spot > lag(spot) OVER w + width THEN 1 ELSE 0 END AS cut FROM hot WINDOW w AS (PARTITION BY row, kind ORDER BY spot)),
islands AS (SELECT *, sum(cut) OVER (PARTITION BY row, kind ORDER BY spot) AS island FROM steps),
more AS (SELECT row, kind, ord, min(spot) AS spot, max(spot + width) AS till FROM islands GROUP BY row, kind, ord, island),
own AS (SELECT * FROM more m WHERE NOT EXISTS (SELECT 1 FROM base b WHERE b.row = m.row AND b.spot <= m.spot AND b.till >= m.till)),
spans AS (SELECT *, true AS base FROM base UNION ALL SELECT *, false FROM own),
listed AS (
  SELECT row, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access, count(*) FILTER (kind = 'hex') AS n_hex,
         count(*) FILTER (NOT base) AS n_entropy,
         coalesce(string_agg(kind || ':' || spot::BIGINT || ':' || till::BIGINT, ',' ORDER BY spot, ord) FILTER (base), '') AS base,
         string_agg(kind || ':' || spot::BIGINT || ':' || till::BIGINT, ',' ORDER BY spot, ord) AS spans
  FROM spans GROUP BY row)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(n_entropy, 0) AS n_entropy, coalesce(spans, '') AS spans
FROM d LEFT JOIN listed USING (row)
"""
