"""Registration of queries and derivation of their inputs.

An input is SQL text valid in Spark and DuckDB alike, so both engines see the same rows. Doubles are made
by one IEEE division of integers to keep them bit-identical.
"""
from __future__ import annotations

import hashlib
import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
          "embeddings", "pages", "benchmark", "labels", "conversations"]
INPUTS: dict[str, tuple[tuple[str, ...], str]] = {}
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def define(name: str, sql: str, needs: tuple[str, ...] = ()) -> None:
    """Add an input."""
    INPUTS[name] = (needs, sql)


def _closure(names, seen=None) -> list[str]:
    seen = [] if seen is None else seen
    for n in names:
        if n in seen:
            continue
        _closure(INPUTS[n][0], seen)
        seen.append(n)
    return seen


def _parts(names) -> list[str]:
    return [f"{n} AS ({INPUTS[n][1]})" for n in _closure(names)]


def ctes(*names: str) -> str:
    """WITH clause that defines the named inputs and what they need."""
    return "WITH " + ",\n".join(_parts(names))


_opened: set[tuple[str, str]] = set()


class Inputs:
    """DataFrames of the inputs over one folder of tables; a table is opened when a text names it.

    Tables get view names of their own per folder and are aliased inside each text, so views that others
    register under the plain names are neither used nor replaced.
    """

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")
        self.tag = hashlib.md5(self.folder.encode()).hexdigest()[:10]
        spark.conf.set("spark.sql.session.timeZone", "UTC")

    def _view(self, table: str) -> str:
        name = f"catalog_{self.tag}_{table}"
        key = (self.spark.sparkContext.applicationId, name)
        if key not in _opened:
            self.spark.read.parquet(f"{self.folder}/{table}.parquet").createOrReplaceTempView(name)
            _opened.add(key)
        return name

    def table(self, name: str) -> DataFrame:
        return self.spark.table(self._view(name))

    def __call__(self, name: str) -> DataFrame:
        return self.sql(f"SELECT * FROM {name}", name)

    def span(self, text: str, column: str, *names: str) -> tuple[str, str]:
        """Smallest and largest value of a column as text: a period taken from the data."""
        row = self.sql(f"SELECT CAST(min({column}) AS STRING) AS a, CAST(max({column}) AS STRING) AS b FROM ({text}) t", *names).first()
        return row["a"], row["b"]

    def sql(self, text: str, *names: str) -> DataFrame:
        parts = _parts(names)
        used = [t for t in TABLES if re.search(rf"\b{t}\b", " ".join([text, *parts]))]
        heads = [f"{t} AS (SELECT * FROM {self._view(t)})" for t in used] + parts
        return self.spark.sql(f"WITH {', '.join(heads)} {text}" if heads else text)


def query(name: str, cols: list[str], sql: str | None = None, needs: tuple[str, ...] = ()):
    """Register ``fn(inputs) -> DataFrame``; both sides end in the same projection ``cols``."""

    def add(fn):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return fn(Inputs(spark, folder)).selectExpr(*cols)

        QUERIES[name] = run
        if sql is not None:
            head = ctes(*needs) + ",\n" if needs else "WITH "
            ORACLES[name] = f"{head}result_ AS ({sql})\nSELECT {', '.join(cols)} FROM result_"
        return fn

    return add
