"""Numeric text, sentinels, floors and repairs as Column expressions."""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Tokens that mean "no value" in numeric text.
NULL_TOKENS = ["", "nan", "none", "na", "n/a", "--", "*"]
# Fill constants of the two feedback file kinds, and the magnitude
# from which any number counts as fill.
FEEDBACK_FILL = -3.3687953e38
DIAGNOSTIC_FILL = 9.969209968386869e36
FILL_MAGNITUDE = 1e29

_PLAIN_NUMBER = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"


def _plain_double(text: Column) -> Column:
    # Java would also accept a trailing type letter ("1.5D"), hence the explicit pattern.
    return F.when(text.rlike(_PLAIN_NUMBER), text.try_cast("double"))


def parse_double(text: Column) -> Column:
    """Number from text; only text that fails a plain cast is retried with D exponents."""
    t = F.trim(text)
    # fixed value: a D that stands for the exponent
    retried = F.regexp_replace(t, r"(?<=[0-9.])[Dd](?=[-+]?\d)", "E")
    return F.coalesce(_plain_double(t), _plain_double(retried))


def is_unparsed(text: Column) -> Column:
    """True for a token that carries text other than a null token yet yields no number."""
    t = F.trim(text)
    return t.isNotNull() & ~F.lower(t).isin(NULL_TOKENS) & parse_double(t).isNull()


def is_finite(value: Column) -> Column:
    """Not null, not NaN, not infinite; never null itself."""
    inf = F.lit(float("inf"))
    return value.isNotNull() & ~F.isnan(value) & (value < inf) & (value > -inf)


def is_valid(value: Column) -> Column:
    """Finite and below the fill magnitude."""
    return F.coalesce(is_finite(value) & (F.abs(value) < FILL_MAGNITUDE), F.lit(False))


def clear_fill(value: Column, fill: float = FEEDBACK_FILL) -> Column:
    """NULL where the value equals the fill constant in single or double precision, or is NaN."""
    as_float = F.lit(fill).cast("float")
    hit = (value == F.lit(fill)) | (value.cast("float") == as_float) | F.isnan(value)
    return F.when(~hit, value)


def to_int(value: Column, fill: float = FEEDBACK_FILL) -> Column:
    """Truncating integer repair of a float column; fill becomes NULL."""
    return clear_fill(value, fill).cast("int")


def missing_policy(value: Column, policy: str = "error") -> Column:
    """``zero`` replaces non-finite values; ``error`` leaves NULL for the quality check."""
    if policy not in ("error", "zero"):
        raise ValueError(f"unknown missing value policy {policy!r}")
    kept = F.when(is_finite(value), value)
    return F.coalesce(kept, F.lit(0.0)) if policy == "zero" else kept
