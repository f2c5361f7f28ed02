"""WARC archives: one gzip member per record, written in parts and read back as a sequential stream.

An archive is a sequence of byte parts, rows (archive, part, data) of a table in any store Spark can read, so neither
writing nor reading needs a local file or a whole archive in memory. The reader feeds parts in order to
one incremental inflater per member, cuts the inflated bytes by content length, and verifies digests. Records that have
the same payload as an earlier one are written as revisits that refer to it.
"""
from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridspark.session import settle

#: payloads of fewer bytes are never revisits
LEAST_BYTES = 100
PART_BYTES = 1 << 20
ARCHIVE_BYTES = 64 << 20
READ_BYTES = 1 << 16
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
PARTS = "archive string, part long, data binary"


def with_revisits(pages: DataFrame, key: str = "page_id", url: str = "url", payload: str = "html") -> DataFrame:
    """Rows (page_id, url, payload binary, digest, refers_to, revisit) of every page.

    Of pages with equal payloads of ``LEAST_BYTES`` or more, that with the smallest id is the response and the others
    refer to it. Rows that repeat the smallest id are responses too; a null id is larger than any other, and if all ids of
    a payload are null all its rows are responses. A null payload is empty.
    """
    body = F.coalesce(F.col(payload).cast("binary"), F.lit(b""))
    rows = pages.select(F.col(key).alias("page_id"), F.col(url).cast("string").alias("url"), body.alias("payload")).withColumn("digest", F.sha2("payload", 256))
    large = F.octet_length("payload") >= LEAST_BYTES
    first = rows.where(large).groupBy("digest").agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    first = settle(first.select(F.col("digest").alias("same"), "first"))  # written: the join of a hot payload can be split
    joined = rows.join(first, (rows["digest"] == first["same"]) & large, "left")
    again = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    return joined.select("page_id", "url", "payload", "digest", F.when(again, F.col("first")).alias("refers_to"), again.alias("revisit"))


def _member(page: str | None, url: str | None, payload: bytes, digest: str, refers_to: str | None, revisit: bool) -> bytes:
    """One gzip member with one record; a revisit has no block."""
    block = b"" if revisit else payload
    name = lambda p: f"<urn:page:{p}>"
    fields = [("WARC-Type", "revisit" if revisit else "response"), ("WARC-Date", DATE), ("WARC-Payload-Digest", f"sha256:{digest}")]
    if page is not None:
        fields.append(("WARC-Record-ID", name(page)))
    if url is not None:
        fields.append(("WARC-Target-URI", "".join(c if 32 < ord(c) < 127 and c != "%" else "".join(f"%{b:02X}" for b in c.encode()) for c in url)))
    if revisit:
        fields += [("WARC-Profile", PROFILE), ("WARC-Refers-To", name(refers_to))]
    fields += [("Content-Type", "text/html; charset=utf-8"), ("Content-Length", str(len(block)))]
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields) + "\r\n"
    squeeze = zlib.compressobj(6, zlib.DEFLATED, 31)
    return squeeze.compress(head.encode()) + squeeze.compress(block) + squeeze.compress(b"\r\n\r\n") + squeeze.flush()


def write_archives(records: DataFrame) -> DataFrame:
    """Archive parts (archive, part, data) of the rows of ``with_revisits``.

    Every task writes archives of its own and starts a new one at ``ARCHIVE_BYTES``; parts hold up to ``PART_BYTES``, so a
    record may stand in several parts. The names depend on the task only, so a repeated task writes the same.
    """

    def rows(batches):
        task, number, part, held, size = TaskContext.get().partitionId(), 0, 0, bytearray(), 0

        def table(data):
            return pa.RecordBatch.from_arrays([pa.array([f"{task:06d}-{number:05d}"]), pa.array([part], pa.int64()), pa.array([bytes(data)], pa.binary())], ["archive", "part", "data"])

        for batch in batches:
            for record in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                held += _member(*record)
                while len(held) >= PART_BYTES:
                    yield table(held[:PART_BYTES])
                    del held[:PART_BYTES]
                    size, part = size + PART_BYTES, part + 1
                if size + len(held) >= ARCHIVE_BYTES:
                    if held:
                        yield table(held)
                    number, part, held, size = number + 1, 0, bytearray(), 0
        if held:
            yield table(held)

    ids = [F.col(c).cast("string").alias(c) if c in ("page_id", "refers_to") else F.col(c) for c in ("page_id", "url", "payload", "digest", "refers_to", "revisit")]
    return records.select(*ids).mapInArrow(rows, PARTS)


def open_archives(spark: SparkSession, path: str) -> DataFrame:
    """Archive parts of ``.warc.gz`` files: one row per file, so a single file must fit in a row of Spark (2 GB)."""
    files = spark.read.format("binaryFile").load(path)
    return files.select(F.col("path").alias("archive"), F.lit(0).cast("long").alias("part"), F.col("content").alias("data"))


class _Inflated:
    """Bytes of one gzip member after another, taken from parts as they are needed."""

    def __init__(self, parts: Iterable[bytes]):
        self.parts, self.raw, self.out, self.zip = iter(parts), b"", bytearray(), None

    def more(self) -> bool:
        """Adds inflated bytes of the member; false at its end or that of the archive."""
        while True:
            if self.zip is None or self.zip.eof:
                return False
            if self.raw or self.zip.unconsumed_tail:
                got = self.zip.decompress(self.zip.unconsumed_tail + self.raw if self.zip.unconsumed_tail else self.raw, READ_BYTES)
                self.raw = b""
                if self.zip.eof:
                    self.raw = self.zip.unused_data
                self.out += got
                if got:
                    return True
                if self.zip.eof:
                    return False
            elif (data := next(self.parts, None)) is not None:
                self.raw = data
            else:
                raise ValueError("archive ends inside a record")

    def next_member(self) -> bool:
        while not self.raw:
            if (data := next(self.parts, None)) is None:
                return False
            self.raw = data
        self.zip, self.out = zlib.decompressobj(31), bytearray()
        return True

    def until(self, mark: bytes) -> bytes:
        seen = 0
        while (at := self.out.find(mark, max(0, seen - len(mark)))) < 0:
            seen = len(self.out)
            if not self.more():
                raise ValueError("record header is not closed")
        got = bytes(self.out[:at])
        del self.out[: at + len(mark)]
        return got

    def take(self, size: int) -> Iterator[bytes]:
        while size:
            if not self.out and not self.more():
                raise ValueError("record is shorter than its content length")
            got = bytes(self.out[:size])
            del self.out[:size]
            size -= len(got)
            yield got


def records(parts: Iterable[bytes]) -> Iterator[tuple[dict[str, str], bytes]]:
    """(header fields by lower-case name, block) of every record of one archive, in order."""
    stream = _Inflated(parts)
    while stream.next_member():
        lines = stream.until(b"\r\n\r\n").decode("utf-8").split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise ValueError(f"not a WARC record: {lines[0][:40]!r}")
        fields = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
        yield fields, b"".join(stream.take(int(fields["content-length"])))
        if b"".join(stream.take(4)) != b"\r\n\r\n" or stream.out or stream.more():
            raise ValueError("a record is followed by other bytes in its member")


def read_archives(parts: DataFrame, id_type: str = "long") -> DataFrame:
    """Rows (page_id, url, record_type, payload, payload_digest, refers_to) of every record.

    Parts of an archive are sorted and streamed; a task holds one part and one record. Responses are checked
    against their digest; a revisit has a null payload and the digest of the payload it refers to.
    """
    id_of = lambda x: x.removeprefix("<urn:page:").removesuffix(">") if x else None

    def rows(batches):
        def flow():
            for batch in batches:
                yield from zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True)

        rows_, head = flow(), None
        head = next(rows_, None)
        while head is not None:
            name, expected = head[0], 0

            def own():
                nonlocal head, expected
                while head is not None and head[0] == name:
                    if head[1] != expected:
                        raise ValueError(f"archive {name}: part {expected} is missing or repeated")
                    expected += 1
                    data = head[2]
                    head = next(rows_, None)
                    yield data

            got, size = [], 0
            for fields, block in records(own()):
                kind, digest = fields["warc-type"], fields["warc-payload-digest"].removeprefix("sha256:")
                if kind == "response" and hashlib.sha256(block).hexdigest() != digest:
                    raise ValueError(f"archive {name}: payload of {fields.get('warc-record-id')} does not match its digest")
                got.append((id_of(fields.get("warc-record-id")), fields.get("warc-target-uri"), kind, block if kind == "response" else None, digest, id_of(fields.get("warc-refers-to"))))
                size += len(block)
                if size > PART_BYTES or len(got) >= 1000:
                    yield table(got)
                    got, size = [], 0
            if got:
                yield table(got)

    names = ["page_id", "url", "record_type", "payload", "payload_digest", "refers_to"]

    def table(got):
        kinds = [pa.string(), pa.string(), pa.string(), pa.binary(), pa.string(), pa.string()]
        return pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*got, strict=True), kinds, strict=True)], names)

    ready = parts.select("archive", "part", "data").repartition("archive").sortWithinPartitions("archive", "part")
    got = ready.mapInArrow(rows, "page_id string, url string, record_type string, payload binary, payload_digest string, refers_to string")
    return got.select(F.col("page_id").cast(id_type).alias("page_id"), "url", "record_type", "payload", "payload_digest", F.col("refers_to").cast(id_type).alias("refers_to"))


def archive_summary(pages: DataFrame, key: str = "page_id", url: str = "url", payload: str = "html") -> DataFrame:
    """Rows (page_id, payload_bytes, payload_digest, record_type, refers_to): all pages written to archives and read back.

    The size of a revisit is that of the response with its digest. Nulls and repeats as in ``with_revisits``; an
    empty table gives no rows; other columns are not read.
    """
    archives = settle(write_archives(with_revisits(pages, key, url, payload)))
    kind = pages.schema[key].dataType.simpleString()
    read = read_archives(archives, kind).select("page_id", "record_type", "payload_digest", "refers_to", F.octet_length("payload").cast("long").alias("bytes"))
    read = settle(read)
    sizes = read.where("record_type = 'response'").groupBy(F.col("payload_digest").alias("d")).agg(F.max("bytes").alias("size"))
    plain = read.where("record_type = 'response'").select("page_id", F.col("bytes").alias("payload_bytes"), "payload_digest", "record_type", "refers_to")
    again = read.where("record_type = 'revisit'").join(sizes, F.col("payload_digest") == F.col("d"))
    return plain.unionAll(again.select("page_id", F.col("size").alias("payload_bytes"), "payload_digest", "record_type", "refers_to"))


SQL = """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS html, CAST(strlen(coalesce(html, '')) AS BIGINT) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest
  FROM pages),
g AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first FROM p)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 100 AND page_id IS DISTINCT FROM first THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 100 AND page_id IS DISTINCT FROM first THEN first END AS refers_to
FROM g
"""
