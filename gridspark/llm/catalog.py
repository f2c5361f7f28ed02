"""Registered queries of the training-data operators and their DuckDB SQL."""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridspark.llm import bpe, embeddings, licenses, lines, mixing, pii, quality, ranked, secrets, simhash, topk, trie, warc

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def _query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


@_query
def op5_simhash(spark: SparkSession, folder: str) -> DataFrame:
    """SimHash classes of all documents: three-word shingles, two bits."""
    got = simhash.near_duplicates(_table(spark, folder, "documents"))
    return got.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


@_query
def op4_mixing(spark: SparkSession, folder: str) -> DataFrame:
    """All documents mixed to 150 percent of their words, weights 3, 1, 2 by source."""
    return mixing.mix(_table(spark, folder, "documents")).select("doc_id", "size", "source_size", "target", "taken")


ORACLES["op4_mixing"] = mixing.SQL


@_query
def op10_quality(spark: SparkSession, folder: str) -> DataFrame:
    """Quality score and prediction of every document, learned from the labels that are not held out."""
    return quality.classify(_table(spark, folder, "documents"), _table(spark, folder, "labels"))


@_query
def op7_bpe(spark: SparkSession, folder: str) -> DataFrame:
    """Every document encoded with the multilingual 50k ranks and decoded again."""
    import public_tokenizers as public

    return bpe.round_trip(_table(spark, folder, "documents"), public.path("byte_bpe_multi_50k.tiktoken"), public.PATTERN)


@_query
def op1_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Every line of every document with its class of near copies and whether it stays."""
    return lines.line_dedup(_table(spark, folder, "documents"))


@_query
def op3_warc(spark: SparkSession, folder: str) -> DataFrame:
    """All pages written as WARC records and read back from the archives."""
    return warc.archive_summary(_table(spark, folder, "pages"))


ORACLES["op3_warc"] = warc.SQL


@_query
def op2_licenses(spark: SparkSession, folder: str) -> DataFrame:
    """License phrases and notices in every document."""
    return licenses.license_scan(_table(spark, folder, "documents"))


ORACLES["op2_licenses"] = licenses.sql()


@_query
def op6_embeddings(spark: SparkSession, folder: str) -> DataFrame:
    """Near-duplicate vectors of equal labels among all embeddings."""
    return embeddings.near_duplicates(_table(spark, folder, "embeddings"))


ORACLES["op6_embeddings"] = embeddings.SQL


@_query
def op8_topk(spark: SparkSession, folder: str) -> DataFrame:
    """The five best inner products of every fiftieth vector against all others."""
    return topk.top_k(_table(spark, folder, "embeddings"), F.col("vec_id") % 50 == 0)


ORACLES["op8_topk"] = topk.SQL


@_query
def op9_pii(spark: SparkSession, folder: str) -> DataFrame:
    """All documents with personal data and secrets replaced by surrogates."""
    got = pii.replace_pii(_table(spark, folder, "documents"), "a key that is kept with the corpus")
    return got.select("doc_id", "text", "n_entities", "kinds")


@_query
def op11_secrets(spark: SparkSession, folder: str) -> DataFrame:
    """Named secrets and strings of high entropy in every document."""
    return secrets.secret_scan(_table(spark, folder, "documents"))


ORACLES["op11_secrets"] = secrets.sql()


@_query
def op13_ranked(spark: SparkSession, folder: str) -> DataFrame:
    """The ten best documents of every benchmark item."""
    return ranked.search(_table(spark, folder, "documents"), _table(spark, folder, "benchmark"))


ORACLES["op13_ranked"] = ranked.SQL


@_query
def op12_trie(spark: SparkSession, folder: str) -> DataFrame:
    """Prefix trie of all conversations, each rebuilt on the first turns of another."""
    return trie.prefix_trie(*trie.rebuilt(trie.sequences(_table(spark, folder, "conversations"))))


ORACLES["op12_trie"] = trie.SQL
