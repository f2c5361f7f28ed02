"""Chemistry columns from a global analysis: mapping, levels, pressure, dates."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gridspark.functions.dates import source_date
from gridspark.operators.skew import lookup_join
from gridspark.session import settle

TOP_PRESSURE_PA = 1.0


def column_pressure(df: DataFrame, column: list[str], level: str = "lev", thickness: str = "dp",
                    p_top: float = TOP_PRESSURE_PA) -> DataFrame:
    """Layer-centre pressure: top plus all layers above plus half the own one.

    The window covers one column of levels, a bounded group.
    """
    above = Window.partitionBy(*column).orderBy(level).rowsBetween(Window.unboundedPreceding, -1)
    p = F.lit(p_top) + F.coalesce(F.sum(thickness).over(above), F.lit(0.0)) + 0.5 * F.col(thickness)
    return df.withColumn("pressure", p)


def species_weights(spark: SparkSession, species_map: list[dict], scaling: dict[str, float] | None = None) -> DataFrame:
    """Table (source, target, weight): the weight of each mapping times the factors listed for its source and its
    target name, letter case aside; a factor listed for both names counts once if they are one name."""
    mapping = spark.createDataFrame([(m["source"], m["target"], float(m.get("weight", 1.0))) for m in species_map], "source string, target string, w double")
    listed = spark.createDataFrame([(k, float(v)) for k, v in (scaling or {}).items()], "alias string, factor double").select(F.upper("alias").alias("alias"), "factor")
    names = mapping.withColumn("alias", F.explode(F.array_distinct(F.array(F.upper("source"), F.upper("target")))))
    factors = names.join(listed, "alias", "left").groupBy("source", "target", "w").agg(F.product(F.coalesce("factor", F.lit(1.0))).alias("f"))
    return factors.select("source", "target", (F.col("w") * F.col("f")).alias("weight"))


def map_species(chem: DataFrame, species_map: list[dict], scaling: dict[str, float] | None = None) -> DataFrame:
    """Mapped fields: (variable, value) becomes (target, weight x value); a source may feed several targets.

    The table of weights has a row per mapping, so it is broadcast."""
    table = F.broadcast(species_weights(chem.sparkSession, species_map, scaling))
    hit = chem.join(table, chem["variable"] == table["source"]).withColumn("value", F.col("value") * F.col("weight")).withColumn("variable", F.col("target"))
    return hit.select(*chem.columns)


def missing_fields(chem: DataFrame, species_map: list[dict], by: list[str]) -> DataFrame:
    """Required source fields a file lacks, all at once."""
    need = sorted({i["source"] for i in species_map})
    have = chem.groupBy(*by).agg(F.collect_set(F.when(F.col("variable").isin(need), F.col("variable"))).alias("have"))
    lost = F.array_except(F.array(*[F.lit(n) for n in need]), F.col("have"))
    return have.select(*by, F.explode(lost).alias("missing"))


def flip_levels(df: DataFrame, column: list[str], level: str = "lev") -> DataFrame:
    """Output level k+1 takes source level nlev-1-k: ``out_lev = nlev - lev`` for 0-based ``lev``.

    The number of levels is an aggregate over the fields, not a window over the rows.
    """
    n = df.groupBy(*column).agg((F.max(level) + 1).alias("_n"))
    return lookup_join(df, n, column, "inner").withColumn("out_lev", (F.col("_n") - F.col(level)).cast("int")).drop("_n")


def time_index(valid: Column, n_times: Column, interval_hours: int) -> Column:
    """Record within a file: hour // interval when the file has several times, else 0."""
    return F.when(n_times > 1, F.floor(F.hour(valid) / interval_hours)).otherwise(0).cast("int")


def chem_columns(chem: DataFrame, valid_times: DataFrame, species_map: list[dict], interval_hours: int,
                 source_year: int | None = None, scaling: dict[str, float] | None = None,
                 thickness: str = "DPRES") -> DataFrame:
    """Fields for each valid time: picked record, weights applied, levels flipped, pressure added as ``PRES``.

    chem(file_date, time_idx, variable, lev, src_id, value), valid_times(valid_time).
    """
    # one row per file, record and field: its number of levels; everything else is looked up from it
    facts = settle(chem.groupBy("file_date", "time_idx", "variable").agg((F.max("lev") + 1).alias("nlev")))
    n_times = facts.groupBy("file_date").agg((F.max("time_idx") + 1).alias("n_times"))
    want = valid_times.withColumn("file_date", source_date(F.col("valid_time"), source_year)).join(n_times, "file_date")
    want = want.withColumn("time_idx", time_index(F.col("valid_time"), F.col("n_times"), interval_hours))
    want = want.select("valid_time", "file_date", "time_idx").join(facts, ["file_date", "time_idx"])
    picked = lookup_join(chem, want, ["file_date", "time_idx", "variable"], "inner")
    mapped = map_species(picked.drop("file_date", "time_idx"), species_map, scaling)
    dp = mapped.filter(F.col("variable") == thickness)
    pres = column_pressure(dp, ["valid_time", "src_id"], "lev", "value").withColumn(
        "value", F.col("pressure")).withColumn("variable", F.lit("PRES")).drop("pressure")
    every = mapped.unionByName(pres)
    return every.withColumn("out_lev", (F.col("nlev") - F.col("lev")).cast("int")).drop("nlev")
