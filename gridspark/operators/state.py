"""Cycling state carry-over and non-negative floors."""
from __future__ import annotations

from itertools import chain

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Variables carried between cycles.
AEROSOLS = [
    "qbcphobic", "qbcphilic", "qbrphobic", "qbrphilic", "qocphobic", "qocphilic", "qdust1", "qdust2", "qdust3",
    "qdust4", "qdust5", "qni1", "qni2", "qni3", "qso4", "qseas1", "qseas2", "qseas3", "qseas4", "qseas5",
]
NOT_ANALYSED = ["qso2", "qso2v", "qso4v", "qdms", "qmsa", "qnh3", "qnh4a", "qsoapa", "qsoapbb", "qsoapbg"]
PERSISTENT = ["persistent_hno3"]
LAND = ["smois", "tslb", "sh2o", "snow", "snowh", "snowc"]
HYDROMETEORS = ["qc", "qr", "qi", "qs", "qg", "ni", "nr", "nc"]
BACKGROUNDS = ["background_h2o2", "background_oh", "background_no3", "background_hno3"]
WATER_VAPOUR_FLOOR = 1.0e-12


def default_bounds() -> dict[str, float]:
    """Lower bound per variable: zero for amounts, a small positive one for water vapour."""
    zero = HYDROMETEORS + AEROSOLS + NOT_ANALYSED + PERSISTENT + BACKGROUNDS
    return {**dict.fromkeys(zero, 0.0), "qv": WATER_VAPOUR_FLOOR}


def floor_values(state: DataFrame, bounds: dict[str, float] | None = None, value: str = "value") -> tuple[DataFrame, DataFrame]:
    """(state with values raised to their bound, report per variable: n_raised, min_before, bound).

    The bound takes the precision of the value column before it is compared.
    """
    table = default_bounds() if bounds is None else bounds
    m = F.create_map(*[F.lit(x) for x in chain.from_iterable((k, float(v)) for k, v in table.items())])
    marked = state.withColumn("_bound", m[F.col("variable")].cast(state.schema[value].dataType))
    low = F.coalesce(F.col(value) < F.col("_bound"), F.lit(False))
    report = marked.filter(low).groupBy("variable").agg(
        F.count(F.lit(1)).alias("n_raised"), F.min(value).alias("min_before"), F.max("_bound").alias("bound"))
    return marked.withColumn(value, F.when(low, F.col("_bound")).otherwise(F.col(value))).drop("_bound"), report


def carry_state(cold: DataFrame, source: DataFrame, keys: list[str], aux: DataFrame | None = None,
                carry_persistent: bool = True, include_land: bool = False, include_hydrometeors: bool = False,
                value: str = "value") -> tuple[DataFrame, DataFrame]:
    """(cold state with cycled values, report of variable, status and whether fatal).

    Analysed aerosols come from ``source``; species outside the analysis, the persistent species, land and
    hydrometeors come from ``aux`` when it is given. A variable the origin lacks keeps the cold value;
    one the cold state lacks is fatal, except that requested hydrometeors are added, and must all exist in
    their origin. Land fields whose extent differs are skipped. ``keys`` include ``variable``.
    """
    second = source if aux is None else aux
    other = NOT_ANALYSED + (PERSISTENT if carry_persistent else [])
    optional = LAND if include_land else []
    added = HYDROMETEORS if include_hydrometeors else []
    incoming = source.filter(F.col("variable").isin(AEROSOLS)).unionByName(
        second.filter(F.col("variable").isin(other + optional + added)))
    # one row per variable name, so the extents table is bounded by the lists above
    have = incoming.groupBy("variable").agg(F.count(F.lit(1)).alias("n_in"))
    want = cold.filter(F.col("variable").isin(AEROSOLS + other + optional + added)).groupBy("variable").agg(
        F.count(F.lit(1)).alias("n_cold"))
    names = [(v, "required") for v in AEROSOLS + other] + [(v, "land") for v in optional] + [(v, "hydrometeor") for v in added]
    listed = cold.sparkSession.createDataFrame(names, "variable string, kind string")
    facts = listed.join(have, "variable", "left").join(want, "variable", "left")
    kind, lacks_in, lacks_cold = F.col("kind"), F.col("n_in").isNull(), F.col("n_cold").isNull()
    differs = F.col("n_in") != F.col("n_cold")
    status = (
        F.when((kind == "required") & lacks_cold, "missing_in_destination")
        .when((kind == "hydrometeor") & lacks_in, "missing_in_origin")
        .when((kind == "hydrometeor") & lacks_cold, "added")
        .when((kind != "land") & differs, "extent_differs")
        .when((kind == "land") & (lacks_in | lacks_cold | differs), "skipped")
        .when(lacks_in, "kept").otherwise("copied"))
    if aux is not None:
        status = F.when((kind == "required") & lacks_in & F.col("variable").isin(other), "missing_in_origin").otherwise(status)
    facts = facts.withColumn("status", status)
    fatal = F.col("status").isin("missing_in_destination", "missing_in_origin", "extent_differs")
    report = facts.select("variable", "kind", "status", fatal.alias("fatal"))
    usable = F.broadcast(facts.filter(F.col("status").isin("copied", "added")).select("variable"))
    taken = incoming.join(usable, "variable", "left_semi").select(*keys, F.col(value).alias("_in"))
    # extents agree for copied variables, so rows only the origin has belong to added ones
    out = cold.join(taken, keys, "full_outer").withColumn(value, F.coalesce(F.col("_in"), F.col(value))).drop("_in")
    return out, report
