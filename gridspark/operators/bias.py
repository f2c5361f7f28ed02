"""Training and applying linear bias corrections per channel.

Rows are reduced to p(p+1)/2 + p + 1 sums per channel in one shuffle; only these sums reach the small
dense solve. Deliberate conventions: observations weigh ``1/err`` (not its square), and the prior "error"
is used as a variance.
"""
from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridspark.operators.skew import lookup_join

# Default prior and its inflation, and the pseudo-inverse cut-off.
PRIOR_BETA, PRIOR_ERR, PRIOR_INFLATION = 0.0, 1e20, 1.1
PINV_RCOND = 1e-15


def check_predictors(obs: DataFrame, predictors: list[str]) -> None:
    """Fail with the valid names when a predictor column is absent."""
    absent = [p for p in predictors if p not in obs.columns]
    if absent:
        raise ValueError(f"predictors {absent} not in the data; columns are {obs.columns}")


def departure() -> Column:
    """Observation minus equivalent, with the applied bias put back."""
    return F.col("obs") - F.col("hofx") + F.col("bias")


def sum_names(predictors: list[str]) -> tuple[dict[tuple[int, int], str], list[str]]:
    """Column names of the symmetric matrix and the right-hand side."""
    n = len(predictors)
    return ({(i, j): f"h_{i}_{j}" for i in range(n) for j in range(i, n)}, [f"r_{i}" for i in range(n)])


def normal_aggregates(predictors: list[str], used: Column | None = None) -> list[Column]:
    """Sums of ``p_i p_j / err`` and ``p_i y / err``, and the count, over rows with flag 0."""
    used = F.col("qc0") == 0 if used is None else used
    h, r = sum_names(predictors)
    inv = F.when(used, F.try_divide(F.lit(1.0), F.col("err0")))
    p = [F.col(c) for c in predictors]
    out = [F.sum(p[i] * p[j] * inv).alias(name) for (i, j), name in h.items()]
    out += [F.sum(p[i] * departure() * inv).alias(name) for i, name in enumerate(r)]
    return out + [F.sum(used.cast("bigint")).alias("n_obs")]


def normal_sums(obs: DataFrame, predictors: list[str], by: list[str]) -> DataFrame:
    """Normal-equation sums per group; additive over any split of the rows.

    Filtering before the aggregation keeps groups without a used row out; add them from the channel list
    when their prior must be carried.
    """
    check_predictors(obs, predictors)
    return obs.groupBy(*by).agg(*normal_aggregates(predictors))


def _solve(h: np.ndarray, r: np.ndarray, beta0: np.ndarray, err0: np.ndarray):
    b_inv = np.linalg.pinv(np.diag(err0), rcond=PINV_RCOND)
    a = np.linalg.pinv(b_inv + h, rcond=PINV_RCOND)
    return a @ (b_inv @ beta0 + r), np.diag(a).copy()


def _matrices(row, predictors):
    h_names, r_names = sum_names(predictors)
    n = len(predictors)
    h = np.zeros((n, n))
    for (i, j), name in h_names.items():
        h[i, j] = h[j, i] = np.nan_to_num(float(row[name] if row[name] is not None else 0.0))
    return h, np.array([np.nan_to_num(float(row[c] if row[c] is not None else 0.0)) for c in r_names])


def prior_lists(prior: DataFrame, predictors: list[str], by: list[str]) -> DataFrame:
    """Coefficient rows (by, predictor, beta, err) to two maps per group, a row per predictor gathered."""
    known = prior.filter(F.col("predictor").isin(predictors))
    return known.groupBy(*by).agg(
        F.map_from_entries(F.collect_list(F.struct("predictor", "beta"))).alias("b0"),
        F.map_from_entries(F.collect_list(F.struct("predictor", "err"))).alias("e0"))


def solve_bias(sums: DataFrame, predictors: list[str], by: list[str], prior: DataFrame | None = None,
               inflation: float = PRIOR_INFLATION) -> DataFrame:
    """(by, predictor, beta, err, n_obs): one small pseudo-inverse per group.

    Without a prior row a coefficient starts at 0 with error 1e20; prior errors are inflated first.
    """
    table = sums
    if prior is not None:
        table = table.join(prior_lists(prior, predictors, by), by, "left")
    else:
        table = table.withColumn("b0", F.lit(None).cast("map<string,double>")).withColumn(
            "e0", F.lit(None).cast("map<string,double>"))

    def start(m, default, factor=1.0):
        return F.array(*[F.coalesce(F.col(m)[F.lit(p)] * factor, F.lit(default)) for p in predictors])

    table = table.withColumn("b0", start("b0", PRIOR_BETA)).withColumn("e0", start("e0", PRIOR_ERR, inflation))
    keys = table.select(*by).schema.simpleString()[len("struct<"):-1]

    def run(batches):
        for pdf in batches:
            rows = []
            for row in pdf.to_dict("records"):
                h, r = _matrices(row, predictors)
                beta, err = _solve(h, r, np.asarray(row["b0"]), np.asarray(row["e0"]))
                rows += [{**{k: row[k] for k in by}, "predictor": p, "beta": beta[i], "err": err[i],
                          "n_obs": row["n_obs"]} for i, p in enumerate(predictors)]
            yield pd.DataFrame(rows, columns=[*by, "predictor", "beta", "err", "n_obs"])

    return table.mapInPandas(run, f"{keys},predictor string,beta double,err double,n_obs bigint")


def train_sequential(sums: DataFrame, predictors: list[str], by: list[str], cycle: str = "cycle",
                     step_seconds: int = 21600, inflation: float = PRIOR_INFLATION) -> DataFrame:
    """Coefficients after every cycle, each cycle starting from the one ``step_seconds`` before.

    A group holds one row of sums per cycle. Coefficients pass between cycles in single precision; a cycle
    whose predecessor is absent starts from the default prior.
    """
    keys = sums.select(*by).schema.simpleString()[len("struct<"):-1]
    timed = sums.withColumn("_s", F.unix_timestamp(cycle))

    def fold(pdf: pd.DataFrame) -> pd.DataFrame:
        n = len(predictors)
        last, out = None, []
        for row in pdf.sort_values("_s").to_dict("records"):
            if last is not None and row["_s"] - last[0] == step_seconds:
                beta0, err0 = last[1], last[2] * inflation
            else:
                beta0, err0 = np.full(n, PRIOR_BETA), np.full(n, PRIOR_ERR)
            h, r = _matrices(row, predictors)
            beta, err = _solve(h, r, beta0, err0)
            last = (row["_s"], beta.astype(np.float32).astype(float), err.astype(np.float32).astype(float))
            out += [{**{k: row[k] for k in by}, cycle: row[cycle], "predictor": p, "beta": last[1][i],
                     "err": last[2][i], "n_obs": row["n_obs"]} for i, p in enumerate(predictors)]
        return pd.DataFrame(out)

    return timed.groupBy(*by).applyInPandas(
        fold, f"{keys},{cycle} timestamp,predictor string,beta double,err double,n_obs bigint")


def recentre(obs: DataFrame, old_means: DataFrame | None, by: list[str], column: str = "lapse_rate",
             squared: str | None = "lapse_rate_2") -> tuple[DataFrame, DataFrame]:
    """(obs with the predictor recentred, new means): old mean added back, new mean over flag-0 rows removed.

    The mean is one aggregate per channel joined back, so no window ever spans the rows of a channel; a
    channel without used rows has mean 0. ``squared`` receives the square of the recentred value.
    """
    x = obs
    if old_means is not None:
        x = lookup_join(x, old_means.select(*by, F.col("mean").alias("_old")), by)
        x = x.withColumn(column, F.col(column) + F.coalesce("_old", F.lit(0.0))).drop("_old")
    means = x.groupBy(*by).agg(
        F.coalesce(F.avg(F.when(F.col("qc0") == 0, F.col(column))), F.lit(0.0)).alias("mean"))
    out = lookup_join(x, means.withColumnRenamed("mean", "_new"), by)
    out = out.withColumn(column, F.col(column) - F.col("_new")).drop("_new")
    if squared:
        out = out.withColumn(squared, F.col(column) * F.col(column))
    return out, means


def widen_coefficients(coef: DataFrame, predictors: list[str], by: list[str]) -> DataFrame:
    """One row per group with a column per predictor."""
    return coef.groupBy(*by).pivot("predictor", predictors).agg(F.first("beta")).select(
        *by, *[F.coalesce(p, F.lit(0.0)).alias(f"beta_{p}") for p in predictors])


def apply_bias(obs: DataFrame, coef: DataFrame, predictors: list[str], by: list[str]) -> DataFrame:
    """obs gain obsbias (sum of coefficient x predictor) and the corrected departure."""
    out = lookup_join(obs, widen_coefficients(coef, predictors, by), by)
    total = None
    for p in predictors:
        part = F.coalesce(F.col(f"beta_{p}"), F.lit(0.0)) * F.col(p)
        total = part if total is None else total + part
    out = out.withColumn("obsbias", total).withColumn("omb_corrected", departure() - F.col("obsbias"))
    return out.drop(*[f"beta_{p}" for p in predictors])


def power_predictors(obs: DataFrame, column: str, orders: list[int]) -> DataFrame:
    """Powers of a predictor as further predictors, ``<column>_<order>``."""
    for k in orders:
        if k > 1:
            obs = obs.withColumn(f"{column}_{k}", F.pow(F.col(column), k))
    return obs


def bias_residuals(obs: DataFrame, coef: DataFrame, predictors: list[str], by: list[str]) -> DataFrame:
    """RMS and mean of the corrected departure, mean bias, and mean part per predictor, over flag-0 rows."""
    used = obs.filter(F.col("qc0") == 0)
    wide = widen_coefficients(coef, predictors, by)
    x = lookup_join(used, wide, by)
    parts = {p: F.coalesce(F.col(f"beta_{p}"), F.lit(0.0)) * F.col(p) for p in predictors}
    total = None
    for c in parts.values():
        total = c if total is None else total + c
    res = departure() - total
    return x.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_obs"), F.sqrt(F.avg(res * res)).alias("rms"), F.avg(res).alias("mean"),
        F.avg(total).alias("mean_bias"), *[F.avg(c).alias(f"mean_{p}") for p, c in parts.items()])


def training_guards(sums: DataFrame, coef: DataFrame, by: list[str], min_obs: int = 20,
                    variance: tuple[float, float] = (1e-6, 10.0)) -> DataFrame:
    """Coefficients with the declared guards applied: too few observations flagged, error kept in a range."""
    lo, hi = variance
    return coef.withColumn("enough", F.col("n_obs") >= min_obs).withColumn(
        "err", F.least(F.greatest(F.col("err"), F.lit(lo)), F.lit(hi)))
