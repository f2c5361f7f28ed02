"""Sparse conservative weights: application, validation, audit, conservation."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridspark.operators.quantiles import exact_quantiles
from gridspark.session import settle

# Contract tolerances.
ROW_SUM_TOLERANCE = 5.0e-10
CONSERVATION_TOLERANCE = 5.0e-5


def zero_based(links: DataFrame) -> DataFrame:
    """Weight links (row, col, s), 1-based, to (dst_id, src_id, s), 0-based BIGINT."""
    return links.select(
        (F.col("row").cast("bigint") - 1).alias("dst_id"),
        (F.col("col").cast("bigint") - 1).alias("src_id"),
        F.col("s").cast("double").alias("s"),
    )


# groups of keys and of destinations, and the pairs of value and link from which blocks are worth their two passes
BLOCKS = 6
BLOCK_PAIRS = 2e7
# groups of keys whose blocks are shuffled at a time
AT_ONCE = 2


def laid_out(weights) -> DataFrame:
    """Links as a table that needs no pass to know its size: stored weights as they lie, others written once."""
    if hasattr(weights, "links"):
        return weights.links
    return weights if hasattr(weights, "settled_at") else settle(weights)


def apply_weights(values: DataFrame, weights, keys: list[str], value: str = "value") -> DataFrame:
    """``dst = sum(s * src)`` per ``keys``: values(keys, src_id, value) x weights(dst_id, src_id, s).

    One shuffle of both sides on the source cell, in which adaptive execution may split a hot cell of
    either side, and one on (keys, destination), which combines before it shuffles. Weights are written
    once, or are :class:`gridspark.sources.weight_store.StoredWeights`: those lie in buckets of the source cell, so only
    values are shuffled. Pass distinct source records only; blending in time happens after this.
    """
    pairs = values.select(*keys, "src_id", value).join(laid_out(weights), "src_id")
    return pairs.groupBy(*keys, "dst_id").agg(F.sum(F.col("s") * F.col(value)).alias(value))


def use_blocks(values: DataFrame, weights: DataFrame, keys: list[str], pairs_from: float = BLOCK_PAIRS) -> bool:
    """Whether :func:`apply_weights_packed` moves fewer rows in blocks: one pass each over the key columns of two written tables.

    Without blocks it moves a partial sum per pair of value and link, or per task and (keys, destination) where those are fewer; with
    blocks every value and every link ``BLOCKS`` times. Few dense records combine well, many sparse ones do not.
    """
    v = values.agg(F.count(F.lit(1)).alias("n"), F.approx_count_distinct(F.struct(*keys)).alias("k")).first()
    w = weights.agg(F.count(F.lit(1)).alias("n"), F.approx_count_distinct("dst_id").alias("d"), F.approx_count_distinct("src_id").alias("s")).first()
    pairs = v["n"] * w["n"] / max(w["s"], 1)
    tasks = int(values.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return pairs >= pairs_from and 2 * BLOCKS * (v["n"] + w["n"]) < min(pairs, tasks * v["k"] * w["d"])


def passes(blocks: int) -> list[range]:
    """The groups of keys of each pass of a product in ``blocks``: every group is in one pass."""
    return [range(a, min(a + AT_ONCE, blocks)) for a in range(0, blocks, AT_ONCE)]


def apply_weights_packed(values: DataFrame, weights, keys: list[str], fields: dict[str, str], blocks: int = 1, only: range | None = None) -> DataFrame:
    """:func:`apply_weights` of several fields at once: values(keys, src_id, a column per field) to (keys, field, dst_id, value).

    ``fields`` maps the columns to field names. Links meet a source cell once for all fields. With ``blocks`` keys and destinations
    are dealt to so many groups each, and every pair of groups is one block of the product: values go to the blocks of their keys, links
    to those of their destination, and a block's sums are finished where it lies, under :func:`gridspark.session.keep_partitions`.
    ``only`` restricts the result to these groups of keys. A caller that writes one of :func:`passes` after the other moves the same
    rows, but only those of one pass lie on disk at a time.
    """
    links, values, block = laid_out(weights), values.select(*keys, "src_id", *fields), []
    if blocks > 1:
        only = range(blocks) if only is None else only
        block, every = ["_row", "_col"], F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))
        some = F.explode(F.sequence(F.lit(only[0]), F.lit(only[-1])))
        # a hash deals the blocks to partitions: with a few times as many, two seldom meet in one
        deal = lambda df: df.repartition(8 * blocks**2, *block)
        values = values.withColumn("_row", F.pmod(F.xxhash64(*keys), F.lit(blocks)).cast("int"))
        values = deal(values.where(F.col("_row").between(only[0], only[-1])).withColumn("_col", every))
        links = deal(links.withColumn("_col", F.pmod(F.xxhash64("dst_id"), F.lit(blocks)).cast("int")).withColumn("_row", some))
    pairs = values.join(links, [*block, "src_id"])
    sums = pairs.groupBy(*block, *keys, "dst_id").agg(*[F.sum(F.col("s") * F.col(c)).alias(c) for c in fields])
    each = F.explode(F.array(*[F.struct(F.lit(name).alias("field"), F.col(c).alias("value")) for c, name in fields.items()]))
    return sums.select(*keys, "dst_id", each.alias("f")).select(*keys, "f.field", "dst_id", "f.value")


def densify(values: DataFrame, cells: DataFrame, axes: dict[str, Column], value: str = "value",
            cell: str = "cell_id") -> DataFrame:
    """Every cell x every entry of ``axes``, zero where there is no value; for use right before the sink.

    ``axes`` maps a key column to an array expression (a date sequence, a field list). Cells and the
    sparse values are partitioned by cell; the dense frame is exploded from the cells in place and meets
    the values where it is, so under :func:`gridspark.session.keep_partitions` the dense rows themselves are not shuffled. The number
    of partitions is given: by their bytes, which are those of the cells, adaptive execution would join them to a few.
    """
    parts = int(cells.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    frame = cells.select(cell).repartition(parts, cell)
    for name, entries in axes.items():
        frame = frame.withColumn(name, F.explode(entries))
    dense = frame.join(values.repartition(parts, cell), [*axes, cell], "left")
    return dense.withColumn(value, F.coalesce(F.col(value), F.lit(0.0)))


def check_conservation(src: DataFrame, dst: DataFrame, src_area: DataFrame, dst_area: DataFrame, keys: list[str],
                       tol: float = CONSERVATION_TOLERANCE, value: str = "value") -> DataFrame:
    """Area integrals before and after remapping per ``keys``, their relative difference, and pass or fail.

    ``src_area``(src_id, area) and ``dst_area``(dst_id, area) use one common area unit. Cells without an area are
    counted as ``n_no_area`` and make the key fail.
    """
    def total(side, area, cell, name):
        both = side.join(area, cell, "left")
        return both.groupBy(*keys).agg(F.sum(F.col(value) * F.col("area")).alias(f"{name}_total"),
                                       F.sum(F.col("area").isNull().cast("bigint")).alias(f"{name}_bare"))

    s, d = total(src, src_area, "src_id", "src"), total(dst, dst_area, "dst_id", "dst")
    bare = F.coalesce("src_bare", F.lit(0)) + F.coalesce("dst_bare", F.lit(0))
    rel = F.abs(F.col("dst_total") - F.col("src_total")) / F.greatest(F.abs(F.col("src_total")), F.lit(1e-300))
    return s.join(d, keys, "full_outer").withColumn("rel_diff", rel).withColumn("n_no_area", bare).withColumn(
        "ok", F.coalesce(F.col("rel_diff") <= tol, F.lit(False)) & (F.col("n_no_area") == 0)).drop("src_bare", "dst_bare")


def source_length_check(values: DataFrame, keys: list[str], n_src: int) -> DataFrame:
    """Keys whose number of source cells differs from what the weights expect."""
    n = values.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_values"), F.max("src_id").alias("max_src"))
    return n.filter((F.col("n_values") != n_src) | (F.col("max_src") >= n_src))


def validate_weights(weights: DataFrame, n_dst: int, n_src: int, require_full_dst: bool = True,
                     require_full_src: bool = False, tol: float = ROW_SUM_TOLERANCE) -> DataFrame:
    """Violations (rule, n, worst) of a 0-based weight table; no rows means valid.

    Rows and columns are counted after one aggregation each; missing ids follow from the
    declared size minus the ids seen, so no id range has to be joined.
    """
    s = F.col("s")
    finite = s.isNotNull() & ~F.isnan(s) & (F.abs(s) < float("inf"))
    inside = (F.col("dst_id") >= 0) & (F.col("dst_id") < n_dst) & (F.col("src_id") >= 0) & (F.col("src_id") < n_src)
    links = weights.agg(
        F.count(F.lit(1)).alias("n"),
        F.coalesce(F.sum((~finite).cast("bigint")), F.lit(0)).alias("nonfinite"),
        F.coalesce(F.sum((~inside).cast("bigint")), F.lit(0)).alias("outside"),
    )
    rows = weights.filter(inside).groupBy("dst_id").agg(F.sum("s").alias("t"))
    rows = rows.agg(F.count(F.lit(1)).alias("rows"), F.max(F.abs(F.col("t") - 1.0)).alias("err"))
    cols = weights.filter(inside).groupBy("src_id").agg(F.lit(1).alias("one")).agg(F.count(F.lit(1)).alias("cols"))
    one = links.withColumn("k", F.lit(1)).join(rows.withColumn("k", F.lit(1)), "k").join(
        cols.withColumn("k", F.lit(1)), "k")
    none = F.lit(None).cast("double")

    def rule(name, n, worst=none):
        return F.struct(F.lit(name).alias("rule"), n.cast("bigint").alias("n"), worst.cast("double").alias("worst"))

    off = F.col("err") > tol
    rules = [
        rule("empty", F.when(F.col("n") == 0, 1).otherwise(0)),
        rule("nonfinite", F.col("nonfinite")),
        rule("index_outside", F.col("outside")),
        rule("row_sum", F.when(off, 1).otherwise(0), F.col("err")),
    ]
    if require_full_dst:
        rules.append(rule("missing_destination", F.lit(n_dst) - F.col("rows")))
    if require_full_src:
        rules.append(rule("missing_source", F.lit(n_src) - F.col("cols")))
    return one.select(F.explode(F.array(*rules)).alias("v")).select("v.*").filter(F.col("n") > 0)


def link_statistics(weights: DataFrame, side: str, n_ids: int) -> DataFrame:
    """min/median/mean/p95/p99/max of links per ``side`` id; ids without links count as 0.

    Counts of counts are a small table, so the percentiles read frequencies, not links.
    """
    per_id = weights.groupBy(side).agg(F.count(F.lit(1)).alias("links"))
    freq = per_id.groupBy("links").agg(F.count(F.lit(1)).alias("f"))
    empty = per_id.agg((F.lit(n_ids) - F.count(F.lit(1))).alias("f")).select(F.lit(0).cast("bigint").alias("links"), "f")
    freq = freq.unionByName(empty).filter(F.col("f") > 0)
    return freq.agg(
        F.min("links").alias("min"),
        F.expr("percentile(links, 0.5D, f)").alias("median"),
        (F.sum(F.col("links") * F.col("f")) / F.sum("f")).alias("mean"),
        F.expr("percentile(links, 0.95D, f)").alias("p95"),
        F.expr("percentile(links, 0.99D, f)").alias("p99"),
        F.max("links").alias("max"),
    )


def weight_statistics(weights: DataFrame) -> DataFrame:
    """min/mean/max and negative, zero and non-finite counts of the weights."""
    s = F.col("s")
    return weights.agg(
        F.count(F.lit(1)).alias("n_links"), F.min(s).alias("min"), F.avg(s).alias("mean"), F.max(s).alias("max"),
        F.sum((s < 0).cast("bigint")).alias("negative"), F.sum((s == 0).cast("bigint")).alias("zero"),
        F.sum((F.isnan(s) | (F.abs(s) == float("inf"))).cast("bigint")).alias("nonfinite"),
    )


def order_resets(links: DataFrame) -> DataFrame:
    """Count and first position of links whose row is below the row of the link before it.

    Neighbouring links meet by an equi-join on the link number, so no global window is used.
    """
    cur = links.select("link_no", "row")
    prev = links.select((F.col("link_no") + 1).alias("link_no"), F.col("row").alias("prev_row"))
    drop = cur.join(prev, "link_no").filter(F.col("row") < F.col("prev_row"))
    return drop.agg(F.count(F.lit(1)).alias("resets"), F.min("link_no").alias("first_reset"))


def five_sided(weights: DataFrame, mesh: DataFrame) -> DataFrame:
    """Links and row sum of the five-sided cells (mesh: cell_id, lat, lon in radians, n_edges)."""
    five = mesh.filter(F.col("n_edges") == 5).select(
        "cell_id", F.degrees("lat").alias("lat_deg"), F.pmod(F.degrees("lon"), F.lit(360.0)).alias("lon_deg"))
    sums = weights.groupBy(F.col("dst_id").alias("cell_id")).agg(
        F.count(F.lit(1)).alias("n_links"), F.sum("s").alias("row_sum"))
    return five.join(sums, "cell_id", "left").select(
        "cell_id", "lat_deg", "lon_deg", F.coalesce("n_links", F.lit(0)).alias("n_links"),
        F.coalesce("row_sum", F.lit(0.0)).alias("row_sum"))


def area_conservation(weights: DataFrame, dst_area: DataFrame) -> DataFrame:
    """Destination area, the source area the weights imply, and their difference."""
    implied = weights.join(dst_area, "dst_id").agg(F.sum(F.col("s") * F.col("area")).alias("implied_source_area"))
    total = dst_area.agg(F.sum("area").alias("destination_area"))
    return total.withColumn("k", F.lit(1)).join(implied.withColumn("k", F.lit(1)), "k").select(
        "destination_area", "implied_source_area",
        (F.col("implied_source_area") - F.col("destination_area")).alias("difference"))


def weight_percentiles(weights: DataFrame, probs=(0.5, 0.99)) -> DataFrame:
    """Exact percentiles of the weights."""
    return exact_quantiles(weights, "s", list(probs))
