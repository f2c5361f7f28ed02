import hashlib
import random

import public_tokenizers as public
import pytest
import tiktoken
from conftest import rows

from gridspark.llm import bpe

PATH = public.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def tokens():
    return bpe.read_ranks(PATH)


@pytest.fixture(scope="module")
def reference(tokens):
    return tiktoken.Encoding("own", pat_str=public.PATTERN, mergeable_ranks={t: i for i, t in enumerate(tokens)}, special_tokens={})


def odd_texts():
    rnd = random.Random(4)
    some = [97, 97, 32, 10, 0xE9, 0x4E2D, 0x1F600, 33, 49, 0x300, 0x200B, 0xA0, 0x1C]
    made = ["".join(chr(rnd.choice([*some, rnd.randrange(0xD800)])) for _ in range(rnd.randrange(120))) for _ in range(300)]
    return [*made, "", " ", "\n\n  x", "a" * 4000, "ab" * 3000, "don't I'll WE'VE", "<|endoftext|>", "x " * 9000]


def test_round_trip_against_the_library(spark, reference):
    data = [(i, t) for i, t in enumerate(odd_texts())] + [(9000, None), (None, "null id"), (7, "a repeated id")]
    docs = spark.createDataFrame([(*d, 0, 0) for d in data], "doc_id long, text string, ids int, n_tokens int").repartition(3)
    sha = lambda b: hashlib.sha256(b).hexdigest()
    want = []
    for i, t in data:
        ids = reference.encode_ordinary(t or "")
        want.append((i, len(ids), sha(",".join(map(str, ids)).encode()), sha((t or "").encode())))
    assert rows(bpe.round_trip(docs, PATH, public.PATTERN)) == sorted(want, key=lambda r: [(x is not None, x) for x in r])
    encoded = bpe.encode(docs, PATH, public.PATTERN)
    assert {i: list(x) for i, x in rows(encoded, "doc_id") if i and i != 7} == {i: reference.encode_ordinary(t or "") for i, t in data if i and i != 7}
    assert {i: bytes(b) for i, b in rows(bpe.decode(encoded, PATH), "doc_id") if i and i != 7} == {i: (t or "").encode() for i, t in data if i and i != 7}
    assert bpe.round_trip(docs.where("false"), PATH, public.PATTERN).count() == 0


def test_forgetting_words_between_batches(tokens, reference, monkeypatch):
    monkeypatch.setattr(bpe, "MAX_WORDS", 5)
    monkeypatch.setattr(bpe, "LONG_TEXT", 50)
    encoder = bpe.Encoder(bpe.Merges(tokens), public.PATTERN)
    for _ in range(2):
        for t in odd_texts()[-60:]:
            assert encoder.batch([t, t])[1].tolist() == reference.encode_ordinary(t)


def test_merges_that_open_a_lower_rank():
    # "ab" has a higher rank than "abc": a merge makes a pair that must come first
    tokens = [bytes([b]) for b in range(256)] + [b"abc", b"xx", b"ab", b"cab", b"xxx", b"ca"]
    merges = bpe.Merges(tokens)
    reference = tiktoken.Encoding("t", pat_str=r"\w+", mergeable_ranks={t: i for i, t in enumerate(tokens)}, special_tokens={})
    rnd = random.Random(0)
    words = ["".join(rnd.choice("abcx") for _ in range(rnd.randrange(1, 14))) for _ in range(500)]
    ids, counts = merges.replay([w.encode() for w in words])
    at = 0
    for w, n in zip(words, counts.tolist(), strict=True):
        assert ids[at:at + n].tolist() == reference.encode_ordinary(w), w
        at += n
