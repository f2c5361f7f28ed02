"""Gridded inventories to the mesh: regular (any time axis) and sectoral monthly."""
from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridspark.functions.numbers import missing_policy
from gridspark.functions.units import convert_units
from gridspark.operators import scaling, timeaxis, weights
from gridspark.operators.skew import lookup_join
from gridspark.session import keep_partitions, settle
from gridspark.sources.products import finite_violations, violation_table


@dataclass(frozen=True)
class FieldSpec:
    """How one output field is made: source terms, units, scale and species aliases."""

    name: str
    terms: tuple[tuple[str, float], ...]
    source_units: str = ""
    target_units: str = ""
    mol_weight: float | None = None
    scale: float = 1.0
    species: tuple[str, ...] = ()
    missing: str = "error"


@dataclass(frozen=True)
class TimeSpec:
    """Target schedule and how missing times are filled; ``daily_mean`` records stand for their day."""

    start: str
    end: str
    frequency: str = "hourly"
    step: float = 1.0
    method: str = "linear"
    max_gap: float | None = None  # hours, or days for daily means
    extrapolate: bool = False
    daily_mean: bool = False


@dataclass
class Result:
    """Values ready for the sink, their checks and their facts."""

    values: DataFrame
    violations: DataFrame
    extras: dict[str, DataFrame] = field(default_factory=dict)


def source_columns(specs: list[FieldSpec], blocks: list) -> list[Column]:
    """One struct (field, value, factor) per field: terms, missing policy, units and scaling of wide source columns."""
    fields = []
    for s in specs:
        total = None
        for column, factor in s.terms:
            part = missing_policy(F.col(column).cast("double"), s.missing) * F.lit(float(factor))
            total = part if total is None else total + part
        mw = F.lit(None).cast("double") if s.mol_weight is None else F.lit(float(s.mol_weight))
        value = convert_units(total, F.lit(s.source_units), F.lit(s.target_units), mw, F.lit(float(s.scale)))
        names = [F.lit(n) for n in (s.name, s.name.split("_", 1)[0], *s.species, *[t[0] for t in s.terms])]
        factor = F.lit(1.0)
        for b in blocks:
            factor = factor * scaling.scaling_factor(b, names, F.lit(s.name))
        fields.append(F.struct(F.lit(s.name).alias("field"), (value * factor).alias("value"), factor.alias("factor")))
    return fields


def source_fields(wide: DataFrame, keys: list[str], specs: list[FieldSpec], blocks: list) -> DataFrame:
    """Wide source columns to long (keys, field, value, factor) in one projection."""
    return wide.select(*keys, F.explode(F.array(*source_columns(specs, blocks))).alias("f")).select(*keys, "f.*")


@dataclass(frozen=True)
class Guard:
    """What weights, grids and mesh must agree on before anything is remapped.

    ``grids``(grid_id, fingerprint) names the source grid of every file or product, ``src_identity`` the one the weights were made
    for and ``dst_identity`` the mesh at hand; stored weights bring their own sizes and identities. For a global mesh every source
    cell must have a link and areas must be given.
    """

    n_src: int | None = None
    n_dst: int | None = None
    grids: DataFrame | None = None
    src_identity: str | None = None
    dst_identity: str | None = None
    is_global: bool = False

    def checks(self, links, areas: bool) -> dict[str, DataFrame]:
        out = {}
        stored = hasattr(links, "links")
        n_src, n_dst = (links.n_src, links.n_dst) if stored else (self.n_src, self.n_dst)
        table = links.links if stored else links
        spark = table.sparkSession
        if n_src is not None and n_dst is not None and (not stored or self.is_global):
            out["weights"] = weights.validate_weights(table, n_dst, n_src, True, self.is_global)
        expected = links.src_identity if stored and links.src_identity else self.src_identity
        if self.grids is not None:
            # the grid of the weights, or else the first one, must be that of every file
            if expected is None:
                first = self.grids.agg(F.min_by("fingerprint", "grid_id")).first()
                expected = first[0] if first else None
            wrong = self.grids.select("grid_id", "fingerprint", F.lit(expected).cast("string").alias("expected")).distinct()
            out["source_grid"] = wrong.where("fingerprint <> expected")
        facts = []
        if stored and links.dst_identity and self.dst_identity and links.dst_identity != self.dst_identity:
            facts.append(("mesh", links.dst_identity, self.dst_identity))
        if stored and links.src_identity and self.src_identity and links.src_identity != self.src_identity:
            facts.append(("source_grid", links.src_identity, self.src_identity))
        if stored and self.n_src not in (None, n_src):
            facts.append(("n_src", str(n_src), str(self.n_src)))
        if facts:
            out["weights_identity"] = spark.createDataFrame(facts, "what string, recorded string, given string")
        if self.is_global and not areas:
            out["conservation_unchecked"] = spark.createDataFrame([("a global mesh needs the areas of both sides",)], "reason string")
        return out


def target_brackets(records: DataFrame, time: TimeSpec, series: str = "series_id") -> DataFrame:
    """The records that every target of the schedule lies between."""
    targets = timeaxis.target_schedule(records, time.start, time.end, time.frequency, time.step, series)
    if time.daily_mean:
        return timeaxis.day_brackets(records, targets, series, time.method, time.max_gap, time.extrapolate)
    gap = None if not time.max_gap else time.max_gap * 3600.0
    return timeaxis.time_brackets(records, targets, series, time.method, gap, time.extrapolate)


def regular_inventory(wide: DataFrame, records: DataFrame, links, src_area: DataFrame | None,
                      dst_area: DataFrame | None, specs: list[FieldSpec], time: TimeSpec, blocks: list = (),
                      series: str = "series_id", n_src: int | None = None, guard: Guard = Guard(),
                      only: DataFrame | None = None) -> Result:
    """Source slabs to mesh fields at the target times.

    wide(series, record_id, src_id, columns...), records(series, record_id, valid_time). Only records the
    brackets use are read and remapped, each once; the remapped table is written, then checked for
    conservation when both areas are given, and blended to every target. A missing value under the policy
    ``error``, a record that does not hold ``n_src`` source cells (by default as many as the guard or stored weights declare) and a
    cell without area are violations, and so is all that ``guard`` finds. ``only``(series, target) restricts the run to these targets
    and the records they need.
    """
    stored = hasattr(links, "links")
    n_src = n_src if n_src is not None else links.n_src if stored else guard.n_src
    brackets = target_brackets(records, time, series)
    brackets = settle(brackets if only is None else brackets.join(only, [series, "target"], "left_semi"))
    used = timeaxis.needed_records(brackets, series)
    keys = [series, "record_id"]
    packed = [f.alias(f"_{i}") for i, f in enumerate(source_columns(specs, list(blocks)))]
    # read by the remapping and by every check; a link meets a source cell once, not once per field
    packed = settle(lookup_join(wide, used, keys, "left_semi").select(*keys, "src_id", *packed))
    src = packed.select(*keys, "src_id", F.explode(F.array(*[f"_{i}" for i in range(len(specs))])).alias("f")).select(*keys, "src_id", "f.*")
    values = packed.select(*keys, "src_id", *[F.col(f"_{i}")["value"].alias(f"_{i}") for i in range(len(specs))])
    table = weights.laid_out(links)
    blocks = weights.BLOCKS if weights.use_blocks(values, table, keys) else 1
    with keep_partitions(wide.sparkSession):
        names, product = {f"_{i}": s.name for i, s in enumerate(specs)}, links if stored else table
        on_mesh = reduce(DataFrame.unionAll, [settle(weights.apply_weights_packed(values, product, keys, names, blocks, p)) for p in weights.passes(blocks)])
    out = timeaxis.interpolate(on_mesh, brackets, ["field", "dst_id"], series=series).withColumnRenamed("dst_id", "cell_id")
    checks = guard.checks(links if stored else table, src_area is not None and dst_area is not None) | {
        "duplicate_time": timeaxis.duplicate_times(records, series, time.daily_mean),
        "bracket": brackets.filter(F.col("kind").isin("outside", "gap", "no_records")),
        "negative_factor": scaling.negative_factors(src).select("field", "factor").distinct(),
        "missing_value": finite_violations(src, [*keys, "field"]),
        "nonfinite": finite_violations(on_mesh, ["field", "record_id"]),
    }
    if n_src is not None:
        checks["source_length"] = weights.source_length_check(src, [*keys, "field"], n_src)
    extras = {"brackets": brackets, "remapped": on_mesh}
    if src_area is not None and dst_area is not None:
        balance = weights.check_conservation(src, on_mesh, src_area, dst_area, [*keys, "field"])
        checks["conservation"] = balance.filter(~F.col("ok"))
        extras["conservation"] = balance
    if not time.daily_mean:
        extras["summary"] = timeaxis.bracket_summary(brackets, series)
    return Result(out.withColumnRenamed("target", "valid_time"), violation_table(checks), extras)


def sectoral_inventory(long: DataFrame, links, exclude: list[str], sectors: dict[str, float], block: dict | None,
                       species: str, prefix: str, months: int = 12, src_area: DataFrame | None = None,
                       dst_area: DataFrame | None = None, guard: Guard = Guard()) -> Result:
    """Monthly sectors (month, src_id, sector, value) to mesh fields ``<prefix>_<sector>``.

    The supplied total is corrected for excluded and scaled sectors before remapping. There must be exactly
    ``months`` records, every value must be finite and ``guard`` must find nothing.
    """
    adjusted, negative = scaling.adjust_sector_sum(
        long, ["month", "src_id"], exclude, sectors, block, [F.lit(species)], f"{prefix}_")
    adjusted = adjusted.withColumn("field", F.concat(F.lit(f"{prefix}_"), F.col("sector"))).drop("sector")
    stored, table = hasattr(links, "links"), weights.laid_out(links)
    on_mesh = weights.apply_weights(adjusted, links if stored else table, ["month", "field"])
    n = long.agg(F.countDistinct("month").alias("n_months")).filter(F.col("n_months") != months)
    checks = guard.checks(links if stored else table, src_area is not None and dst_area is not None) | {"months": n, "negative_sum": negative, "nonfinite": finite_violations(long, ["month", "sector"])}
    extras = {}
    if src_area is not None and dst_area is not None:
        balance = weights.check_conservation(adjusted, on_mesh, src_area, dst_area, ["month", "field"])
        checks["conservation"] = balance.filter(~F.col("ok"))
        extras["conservation"] = balance
    return Result(on_mesh.withColumnRenamed("dst_id", "cell_id"), violation_table(checks), extras)


def single_field(columns: list[str], listed: list[str] | None = None) -> str:
    """The one field of a biogenic source; anything else is an error."""
    chosen = [c for c in (listed or columns) if c in columns]
    if len(chosen) != 1:
        raise ValueError(f"expected exactly one field, found {chosen} among {columns}")
    return chosen[0]
