"""Bias training, cycle diagnostics, observation checks."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridspark.operators import bias, departures, qc
from gridspark.session import settle


def train_bias(obs: DataFrame, predictors: list[str], by: list[str], prior: DataFrame | None = None,
               old_means: DataFrame | None = None, lapse: str | None = None, lapse_squared: str | None = None) -> dict[str, DataFrame]:
    """Recentre, sum, solve, report: coefficients, new means and residuals of all samples together."""
    out = {}
    if lapse:
        obs, means = bias.recentre(obs, old_means, by, lapse, lapse_squared)
        out["means"] = means
    sums = settle(bias.normal_sums(obs, predictors, by))
    coef = settle(bias.solve_bias(sums, predictors, by, prior))
    out.update(coefficients=coef, sums=sums, residuals=bias.bias_residuals(obs, coef, predictors, by))
    return out


def train_bias_by_cycle(obs: DataFrame, predictors: list[str], by: list[str], cycle: str = "cycle", step_seconds: int = 21600) -> DataFrame:
    """Sums of every cycle in one distributed pass, then one small fold per channel."""
    sums = bias.normal_sums(obs, predictors, [*by, cycle])
    return bias.train_sequential(sums, predictors, by, cycle, step_seconds)


def cycle_diagnostics(obs: DataFrame, hofx: DataFrame | None, by: list[str], monitors: list[str]) -> dict[str, DataFrame]:
    """Statistics per (cycle, key), assimilated or passive per key, and one document per cycle.

    ``by`` starts with the cycle; the rest names the observer key.
    """
    stats = departures.departure_stats(obs, by)
    if hofx is not None:
        stats = departures.prefer_analysis(departures.departure_stats(hofx, by, "hofx"), stats, by)
    stats = settle(stats.withColumn("key", F.concat_ws(":", *[F.col(c).cast("string") for c in by[1:]])))
    passive = departures.passive_flags(stats.withColumn("observer", F.col(by[1])), monitors)
    return {"stats": stats, "passive": passive, "documents": departures.cycle_document(
        stats.select(by[0], "key", "n", "n_file", "omb_rms", "omb_mean", "jo_b", "oma_rms", "oma_mean", "jo_a", "passive"), by[0])}


def check_observations(obs: DataFrame, rules: list[qc.Rule], monitors: list[str], by: list[str]) -> dict[str, DataFrame]:
    """Rules in order, monitors made passive, and a count per reason."""
    checked = qc.mark_monitors(qc.apply_rules(obs, rules), monitors)
    return {"obs": checked, "summary": qc.rule_summary(checked, by)}
