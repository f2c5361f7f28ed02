import gzip
import hashlib
import random

import pytest
from conftest import rows

from gridspark.llm import warc


def brute(data):
    first = {}
    for i, _, h in data:
        b = (h or "").encode()
        if len(b) >= 100 and i is not None:
            first[b] = min(first.get(b, i), i)
    out = []
    for i, _, h in data:
        b = (h or "").encode()
        again = b in first and first[b] != i
        out.append((i, len(b), hashlib.sha256(b).hexdigest(), "revisit" if again else "response", first[b] if again else None))
    return sorted(out, key=lambda r: [(x is not None, x) for x in r])


def pages():
    rnd = random.Random(6)
    some = ["é" * 50, "x" * 99, "x" * 100, "", "\r\n\r\nWARC/1.1\r\n" * 20, "".join(chr(rnd.randrange(1, 0xD800)) for _ in range(30_000))]
    data = [(i, rnd.choice([None, "http://a.example/ü?q=1 2%", "http://b.example/\r\nX: y"]), rnd.choice([*some, f"page {i} " * 30])) for i in range(150)]
    return [*data, (500, "u", None), (None, "u", "x" * 100), (None, None, "null ids only " * 20), (None, None, "null ids only " * 20), (3, "u", data[3][2])]


def test_round_trip(spark, monkeypatch):
    data = pages()
    df = spark.createDataFrame([(*d, "k", 0) for d in data], "page_id long, url string, html string, digest string, payload_bytes int").repartition(3)
    assert rows(warc.archive_summary(df)) == brute(data)
    monkeypatch.setattr(warc, "PART_BYTES", 700)
    monkeypatch.setattr(warc, "ARCHIVE_BYTES", 5000)
    monkeypatch.setattr(warc, "READ_BYTES", 50)
    parts = warc.write_archives(warc.with_revisits(df)).cache()
    assert parts.select("archive").distinct().count() > 3 and parts.where("octet_length(data) > 700").count() == 0
    back = warc.read_archives(parts)
    texts = {i: h for i, _, h in data if i is not None}
    for i, url, kind, payload, digest, _ in back.collect():
        assert (payload is None) == (kind == "revisit")
        if payload is not None:
            assert hashlib.sha256(payload).hexdigest() == digest and (i is None or bytes(payload) == (texts[i] or "").encode())
        assert url is None or all(32 < ord(c) < 127 for c in url)
    assert warc.archive_summary(df.where("false")).count() == 0


def test_files_and_broken_archives(spark, tmp_path):
    df = spark.createDataFrame([(i, "u", f"text {i} " * 40) for i in range(20)], "page_id long, url string, html string").coalesce(1)
    parts = warc.write_archives(warc.with_revisits(df)).collect()
    data = b"".join(p.data for p in parts)
    (tmp_path / "a.warc.gz").write_bytes(data)
    assert gzip.decompress(data).count(b"WARC/1.1\r\n") == 20
    assert warc.read_archives(warc.open_archives(spark, str(tmp_path))).count() == 20
    with pytest.raises(ValueError, match="ends inside"):
        list(warc.records([data[:-30]]))
    with pytest.raises(Exception, match="missing"):
        warc.read_archives(spark.createDataFrame([("a", 1, data)], warc.PARTS)).count()
    plain = gzip.decompress(data).replace(b"text 3 ", b"test 3 ", 1)
    with pytest.raises(Exception, match="digest|other bytes"):
        warc.read_archives(spark.createDataFrame([("a", 0, gzip.compress(plain))], warc.PARTS)).count()
    with pytest.raises(ValueError, match="content length"):
        list(warc.records([gzip.compress(b"WARC/1.1\r\nContent-Length: 50\r\n\r\nshort")]))
