"""Declarative observation quality control.

A rule is data: which rows it looks at (``where`` ranges or sets, ``channels``), what it tests and what it
does. Rules run in order as projections over one scan; only thinning needs a shuffle. Flags: 0 pass,
1 passive, 2 rejected. The first rule that rejects a row is kept as its reason.

The physics functions some rules refer to are computed elsewhere and enter as columns. A missing tested
value fails a bounds check, and a missing departure or error fails a background check.
"""
from __future__ import annotations

import math
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridspark.functions.errors import error_ramp, error_stepwise, parse_channels
from gridspark.functions.geometry import chord2, unit_xyz
from gridspark.functions.numbers import is_valid

PASS, PASSIVE, REJECTED = 0, 1, 2
DEFAULT_MESH_KM = 145.0
EARTH_KM = 6371.229


@dataclass(frozen=True)
class Rule:
    """``check`` is prequality, domain, bounds, background, background_absolute, difference, list or use_flag."""

    name: str
    check: str
    action: str = "reject"  # reject, passivate, inflate, assign, reduce
    channels: str | None = None
    where: tuple[tuple[str, Any, Any], ...] = ()  # (column, min, max); None is open
    where_in: tuple[tuple[str, tuple], ...] = ()
    options: dict = field(default_factory=dict)


def _where(rule: Rule) -> Column:
    hit = F.lit(True)
    if rule.channels is not None:
        hit = hit & F.col("channel").isin(parse_channels(rule.channels))
    for column, lo, hi in rule.where:
        c = F.col(column)
        if lo is not None:
            hit = hit & (c >= lo)
        if hi is not None:
            hit = hit & (c <= hi)
    for column, allowed in rule.where_in:
        hit = hit & F.col(column).isin(list(allowed))
    return F.coalesce(hit, F.lit(False))


def _test(rule: Rule) -> Column:
    """True for rows the rule acts on."""
    o = rule.options
    if rule.check == "prequality":
        return F.coalesce(F.col(o.get("column", "prequality")) > o["max"], F.lit(False))
    if rule.check == "domain":  # acts on rows outside the region the ranges describe
        return ~_where(rule)
    scope = _where(rule)
    if rule.check == "bounds":
        x = F.col(o.get("column", "obs"))
        good = is_valid(x)
        if o.get("min") is not None:
            good = good & (x >= o["min"])
        if o.get("max") is not None:
            good = good & (x <= o["max"])
        return scope & ~F.coalesce(good, F.lit(False))
    if rule.check in ("background", "background_absolute"):
        departure = F.abs(F.col("obs") - F.col("hofx"))
        if rule.check == "background":
            limit = F.lit(float(o["threshold"])) * F.col("err_eff")
        else:
            limit = F.col(o["threshold_column"])
        return scope & ~F.coalesce(departure <= limit, F.lit(False))
    if rule.check == "difference":
        return scope & F.coalesce(F.abs(F.col(o["value"]) - F.col(o["reference"])) > o["threshold"], F.lit(False))
    if rule.check == "list":
        return scope
    if rule.check == "use_flag":
        flags = F.create_map(*[F.lit(v) for kv in o["flags"].items() for v in kv])
        return scope & F.coalesce(flags[F.col("channel")] == -1, F.lit(False))
    raise ValueError(f"unknown check {rule.check!r}")


def _assigned(options: dict) -> Column:
    """Error value of an ``assign`` action: constant, column, ramp or stepwise."""
    if "value" in options:
        return F.lit(float(options["value"]))
    if "column" in options:
        return F.col(options["column"])
    x = F.col(options["xvar"])
    if "xvals" in options:
        scale = F.col(options["scale"]) if options.get("scale") else None
        return error_stepwise(x, options["xvals"], options["errors"], scale)
    return error_ramp(x, options["x0"], options["x1"], options["err0"], options["err1"])


def _apply(df: DataFrame, rule: Rule) -> DataFrame:
    hit = _test(rule)
    flag = F.col("qc_flag")
    if rule.action == "reject":
        new = hit & (flag < REJECTED)
        df = df.withColumn("_hit", new).withColumn("qc_reason", F.when(F.col("_hit"), rule.name).otherwise(F.col("qc_reason")))
        return df.withColumn("qc_flag", F.when(F.col("_hit"), REJECTED).otherwise(flag)).drop("_hit")
    if rule.action == "passivate":
        return df.withColumn("qc_flag", F.when(hit & (flag == PASS), PASSIVE).otherwise(flag))
    if rule.action == "inflate":
        f = rule.options.get("factor", 1.0)
        factor = F.col(f) if isinstance(f, str) else F.lit(float(f))
        return df.withColumn("err_eff", F.when(hit, F.col("err_eff") * factor).otherwise(F.col("err_eff")))
    if rule.action == "assign":
        return df.withColumn("err_eff", F.when(hit, _assigned(rule.options)).otherwise(F.col("err_eff")))
    if rule.action == "reduce":
        return df.filter(~hit)
    raise ValueError(f"unknown action {rule.action!r}")


def apply_rules(obs: DataFrame, rules: list[Rule], error: str = "err0") -> DataFrame:
    """obs gain qc_flag, qc_reason and err_eff after all rules in order.

    A rule with check ``thinning`` keeps one location per bin among rows not yet rejected.
    """
    out = obs.withColumn("qc_flag", F.lit(PASS)).withColumn("qc_reason", F.lit(None).cast("string")).withColumn(
        "err_eff", F.col(error).cast("double"))
    for rule in rules:
        if rule.check == "thinning":
            o = rule.options
            out = thin(out.filter(F.col("qc_flag") < REJECTED), o.get("mesh_km", DEFAULT_MESH_KM), o.get("keys", []),
                       o.get("id", "loc_id"))
        else:
            out = _apply(out, rule)
    return out


def rule_summary(checked: DataFrame, by: list[str]) -> DataFrame:
    """Rows per group, flag and reason."""
    return checked.groupBy(*by, "qc_flag", "qc_reason").agg(F.count(F.lit(1)).alias("n"))


def thinning_bin(lat: Column, lon: Column, mesh_km: float) -> tuple[Column, Column, Column]:
    """(row, column, squared chord to the bin centre) of near-square bins about ``mesh_km`` wide.

    Rows are equal latitude bands; a row has as many columns as fit its middle latitude. The geometry is
    ours: it depends on nothing but the position and the mesh width.
    """
    n_rows = max(1, round(180.0 / math.degrees(mesh_km / EARTH_KM)))
    height = 180.0 / n_rows
    row = F.least(F.floor((lat + 90.0) / height), F.lit(n_rows - 1))
    mid = (row + 0.5) * height - 90.0
    n_cols = F.greatest(F.floor(F.cos(F.radians(mid)) * (360.0 / height)), F.lit(1))
    # every longitude takes the same two steps: a positive one is rounded by the turn as well
    turn = (lon % 360.0 + 360.0) % 360.0 / 360.0
    col = F.least(F.floor(turn * n_cols), n_cols - 1)
    centre = unit_xyz(F.radians(mid), F.radians((col + 0.5) * 360.0 / n_cols))
    here = unit_xyz(F.radians(lat), F.radians(lon))
    return row, col, chord2(here["x"], here["y"], here["z"], centre["x"], centre["y"], centre["z"])


def thin(obs: DataFrame, mesh_km: float = DEFAULT_MESH_KM, keys: list[str] | None = None, id_col: str = "loc_id") -> DataFrame:
    """Keep the location nearest to the centre of each bin (ties: lowest id); others leave the space.

    The winner per bin is an aggregate that combines before the shuffle, so a crowded bin is one row per
    task; all channels of a winning location stay.
    """
    keys = keys or []
    row, col, dist = thinning_bin(F.col("lat"), F.col("lon"), mesh_km)
    binned = obs.select(*keys, id_col, row.alias("_r"), col.alias("_c"), dist.alias("_d"))
    winners = binned.groupBy(*keys, "_r", "_c").agg(F.min(F.struct("_d", id_col)).alias("_w")).select(
        *keys, F.col(f"_w.{id_col}").alias(id_col))
    return obs.join(winners, [*keys, id_col], "left_semi")


def superob(obs: DataFrame, mesh_km: float, keys: list[str], values: list[str]) -> DataFrame:
    """Mean per bin of the values and the position count."""
    row, col, _ = thinning_bin(F.col("lat"), F.col("lon"), mesh_km)
    return obs.withColumn("bin_row", row).withColumn("bin_col", col).groupBy(*keys, "bin_row", "bin_col").agg(
        *[F.avg(v).alias(v) for v in values], F.count(F.lit(1)).alias("n_obs"))


def mark_monitors(obs: DataFrame, monitors: list[str], observer: str = "observer") -> DataFrame:
    """Observers on the monitor list become passive."""
    hit = F.col(observer).isin(monitors) & (F.col("qc_flag") == PASS)
    return obs.withColumn("qc_flag", F.when(hit, PASSIVE).otherwise(F.col("qc_flag")))


def in_window(obs: DataFrame, analysis_time: Column, window_hours: float, cycle_hours: float, time: str = "obs_time") -> DataFrame:
    """Rows of the window that begins half a cycle before the analysis time."""
    begin = analysis_time - F.make_dt_interval(secs=F.lit(cycle_hours * 1800.0))
    end = begin + F.make_dt_interval(secs=F.lit(window_hours * 3600.0))
    return obs.filter((F.col(time) >= begin) & (F.col(time) < end))
