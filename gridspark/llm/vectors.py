"""Cleaning of vector tables, shared by the vector operators."""
from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def one_per_id(rows: DataFrame, key: str, *others: str) -> DataFrame:
    """One row per id that is not null: the smallest of rows that repeat it."""
    least = rows.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("vec_id")).agg(F.min(F.struct(*others)).alias("s"))
    return least.select("vec_id", *[F.col("s")[c].alias(c) for c in others])


def usable(vector: str) -> F.Column:
    """Vectors that are not null or empty and hold no null, NaN or infinite component."""
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return F.col(vector).isNotNull() & (F.size(vector) > 0) & fine


def matrix(column: pa.Array, dtype=np.float64) -> np.ndarray:
    """Equal-length lists as rows of a matrix."""
    flat = column.flatten()
    return np.asarray(flat, dtype).reshape(len(column), -1) if len(column) else np.zeros((0, 0), dtype)
