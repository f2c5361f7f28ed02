"""Point records to cell values: sums, means, moments, fluxes, hourly expansion."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridspark.functions.geometry import local_hour_offset
from gridspark.functions.numbers import is_finite
from gridspark.functions.units import point_flux


def accepted(points: DataFrame) -> DataFrame:
    """Points that were given a cell."""
    return points.filter(F.col("cell_id") >= 0)


def aggregate_points(points: DataFrame, keys: list[str], species: dict[str, str], how: dict[str, str] | None = None) -> DataFrame:
    """Sum (default) or mean per ``keys`` of each species column, finite values of accepted points only.

    ``species`` maps a source column to an output name; source columns that are absent are skipped.
    All species share one shuffle, which combines per task first. A key without points is 0 after
    densifying.
    """
    how = how or {}
    aggs = []
    for src, dst in species.items():
        if src not in points.columns:
            continue
        good = F.when(is_finite(F.col(src)), F.col(src))
        mean = how.get(src, "sum") == "mean"
        aggs.append(F.coalesce(F.avg(good) if mean else F.sum(good), F.lit(0.0)).alias(dst))
    if not aggs:
        raise ValueError(f"none of {list(species)} found in {points.columns}")
    return accepted(points).groupBy(*keys).agg(*aggs)


def points_to_flux(cells: DataFrame, mesh: DataFrame, kinds: dict[str, str], factors: dict[str, float] | None = None,
                   cell: str = "cell_id") -> DataFrame:
    """Daily totals per cell to fluxes: ``gas``, ``aerosol`` or unchanged, times a scaling factor."""
    factors = factors or {}
    out = cells.join(mesh.select(F.col("cell_id").alias(cell), "area_m2"), cell)
    for name, kind in kinds.items():
        flux = point_flux(F.col(name), F.col("area_m2"), kind)
        # a scalar is a mean of a property, not an emission, so it is not scaled
        out = out.withColumn(name, flux if kind == "scalar" else flux * F.lit(float(factors.get(name, 1.0))))
    return out.drop("area_m2")


def to_long(cells: DataFrame, keys: list[str], fields: list[str]) -> DataFrame:
    """Wide species columns to (keys, field, value)."""
    return cells.unpivot([*keys], fields, "field", "value")


def fire_moments(points: DataFrame, keys: list[str], area: str = "area", frp: str | None = "frp",
                 require_frp: bool = False) -> DataFrame:
    """Mean and population deviation of fire size and radiative power per ``keys``.

    Only finite values >= 0 count, for each property on its own. Without a radiative power column
    its two fields are 0, or it is an error when required.
    """
    has_frp = frp is not None and frp in points.columns
    if require_frp and not has_frp:
        raise ValueError("a radiative power column is required but absent")

    def both(column, name):
        good = F.when(is_finite(F.col(column)) & (F.col(column) >= 0), F.col(column))
        return [F.coalesce(F.avg(good), F.lit(0.0)).alias(f"{name}_avg"),
                F.coalesce(F.stddev_pop(good), F.lit(0.0)).alias(f"{name}_std")]

    aggs = both(area, "fire_size") + (both(frp, "frp") if has_frp else [])
    out = accepted(points).groupBy(*keys).agg(*aggs)
    if not has_frp:
        out = out.withColumn("frp_avg", F.lit(0.0)).withColumn("frp_std", F.lit(0.0))
    return out


def check_profile(profile: list[float]) -> list[float]:
    """Hourly weights with mean 1."""
    if len(profile) != 24 or any(not (p >= 0) or p == float("inf") for p in profile) or sum(profile) <= 0:
        raise ValueError("profile must hold 24 finite nonnegative weights with a positive sum")
    return [p / sum(profile) * 24.0 for p in profile]


def expand_diurnal(daily: DataFrame, mesh: DataFrame, profile: list[float], fields: list[str], day: str = "day",
                   cell: str = "cell_id") -> DataFrame:
    """Daily cell values to 24 hourly ones with a local-solar-time profile.

    mesh(cell_id, lon in radians). The profile is a literal array, so hours are exploded in place.
    """
    weights = F.array(*[F.lit(w) for w in check_profile(profile)])
    shifted = mesh.select(F.col("cell_id").alias(cell), local_hour_offset(F.degrees("lon")).alias("_off"))
    hourly = daily.join(shifted, cell).withColumn("hour", F.explode(F.sequence(F.lit(0), F.lit(23))))
    w = F.element_at(weights, F.pmod(F.col("hour") + F.col("_off"), F.lit(24)) + 1)
    at = F.col(day).cast("timestamp") + F.make_dt_interval(hours=F.col("hour"))
    for name in fields:
        hourly = hourly.withColumn(name, F.col(name) * w)
    return hourly.withColumn("valid_time", at).drop("_off", "hour", day)


def silent_zero(points: DataFrame, keys: list[str]) -> DataFrame:
    """Groups that have records but none on the mesh: publishing them would write zeros."""
    n = points.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_read"),
                                  F.sum((F.col("cell_id") >= 0).cast("bigint")).alias("n_accepted"))
    return n.filter("n_read > 0 AND n_accepted = 0")


def default_optional(daily: DataFrame, optional: list[str], by: list[str]) -> tuple[DataFrame, DataFrame]:
    """(values with absent optional fields as 0, one warning per group and field that was filled).

    A column the table lacks altogether is added; the warnings are a small aggregate, not one per row.
    """
    out = daily
    for name in optional:
        if name not in out.columns:
            out = out.withColumn(name, F.lit(None).cast("double"))
    lost = F.array_compact(F.array(*[F.when(F.col(n).isNull(), F.lit(n)) for n in optional]))
    warnings = out.select(*by, F.explode(lost).alias("field")).distinct()
    return out.withColumns({n: F.coalesce(F.col(n), F.lit(0.0)) for n in optional}), warnings
