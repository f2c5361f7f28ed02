"""Joins that stay balanced when one key holds a large share of the rows."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from gridspark.session import settle

HOT_SHARE = 0.01
SALTS = 64


def _match(keys: list[str], hot: list) -> Column:
    if not hot:
        return F.lit(False)
    hit = F.lit(False)
    for row in hot:
        same = F.lit(True)
        for key, value in zip(keys, row):
            same = same & F.col(key).eqNullSafe(F.lit(value))
        hit = hit | same
    return hit


def hot_keys(df: DataFrame, keys: list[str], share: float = HOT_SHARE) -> list:
    """Keys holding more than ``share`` of the rows.

    There can be at most ``1 / share`` of them, so the result fits the driver at any
    data size. One job reads only the key columns, counts combine before the shuffle, and
    the total is observed on the way.
    """
    seen = Observation()
    counts = df.observe(seen, F.count(F.lit(1)).alias("rows")).groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    top = counts.orderBy(F.col("_n").desc()).limit(int(1 / share)).collect()
    if not top:
        return []
    return [tuple(r[k] for k in keys) for r in top if r["_n"] > seen.get["rows"] * share]


def salted_join(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner",
                share: float = HOT_SHARE, salts: int = SALTS) -> DataFrame:
    """Equi-join whose hot ``left`` keys are spread over ``salts`` tasks.

    Rows of a hot key, null included, get a salt from a hash of the row and its number within its partition, so
    repeated rows spread as well; the matching right rows are repeated once per salt, so any salt finds them. All
    other keys take the ordinary path, and without hot keys this is the plain join. ``how`` must keep the left side (inner, left, left_semi).
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError("salting repeats right rows, so the left side must lead the join")
    hot = hot_keys(left, keys, share)
    if not hot:
        return left.join(right, keys, how)
    row_hash = F.pmod(F.xxhash64(F.monotonically_increasing_id(), *[F.col(c) for c in left.columns]), F.lit(salts)).cast("int")
    spread = left.withColumn("_salt", F.when(_match(keys, hot), row_hash).otherwise(F.lit(0)))
    copies = F.when(_match(keys, hot), F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
    repeated = right.withColumn("_salt", F.explode(copies))
    return spread.join(repeated, keys + ["_salt"], how).drop("_salt")


def lookup_join(big: DataFrame, small: DataFrame, keys: list[str], how: str = "left") -> DataFrame:
    """Attach a keyed table to a data-sized one.

    ``small`` is written once, so its bytes are known without a pass to count it: below
    ``spark.sql.autoBroadcastJoinThreshold`` it is broadcast, beyond that both sides are shuffled plainly
    and adaptive execution splits the keys that hold too much, null ones included.
    """
    return big.join(settle(small), keys, how)
