"""Observation error parameters as tables: per channel, surface and latitude band, met by an index of intervals.

A rule is a row: the channel and surface it holds for (null for any), latitude bounds (both inclusive, null for none), a piece of
the error curve over x, an optional column that multiplies it, and a priority; of all rules that match an observation
the one with the highest priority counts, as if they were applied in that order. The bounds of all rules cut a line into points and
open intervals. The index resolves once which rule wins in each combination of those cells; an observation finds its cells by
its bucket and meets exactly one row by an equi-join. So the cost of an observation does not grow with the table.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridspark.operators.skew import lookup_join
from gridspark.session import settle

BUCKETS = 256
ANY = "*"
_INF = float("inf")


def ramp_rules(params: DataFrame) -> DataFrame:
    """Rules of ramps: params(channel, x0, x1, err0, err1[, surface, lat_min, lat_max, scale, priority])."""
    rules = _whole(params)
    pieces = F.array(_piece(F.lit(-_INF), F.col("x0"), F.col("err0"), F.col("err0")), _piece(F.col("x0"), F.col("x1"), F.col("err0"), F.col("err1")),
                     _piece(F.col("x1"), F.lit(_INF), F.col("err1"), F.col("err1")))
    return rules.select(*_KEYS, F.explode(pieces).alias("p")).select(*_KEYS, "p.*")


def stepwise_rules(params: DataFrame) -> DataFrame:
    """Rules of curves through (xvals, errors), flat outside, xvals in either order; other columns as for :func:`ramp_rules`."""
    knots = F.array_sort(F.arrays_zip(F.col("xvals").cast("array<double>").alias("x"), F.col("errors").cast("array<double>").alias("e")))
    rules = _whole(params).withColumn("k", knots)
    rules = rules.select(*_KEYS, "k", F.size("k").alias("n"))
    flat = lambda at, lo, hi: _piece(lo, hi, at["e"], at["e"])
    inner = F.transform(F.sequence(F.lit(1), F.col("n") - 1), lambda i: _piece(
        F.get("k", i - 1)["x"], F.get("k", i)["x"], F.get("k", i - 1)["e"], F.get("k", i)["e"]))
    first, last = F.get("k", F.lit(0)), F.get("k", F.col("n") - 1)
    ends = F.array(flat(first, F.lit(-_INF), first["x"]), flat(last, last["x"], F.lit(_INF)))
    return rules.where("n >= 2").select(*_KEYS, F.explode(F.concat(inner, ends)).alias("p")).select(*_KEYS, "p.*")


_KEYS = ["channel", "surface", "lat_min", "lat_max", "scale", "priority"]


def _whole(params: DataFrame) -> DataFrame:
    kinds = {"channel": "string", "surface": "string", "lat_min": "double", "lat_max": "double", "scale": "string", "priority": "int"}
    for name, kind in kinds.items():
        value = F.col(name) if name in params.columns else F.lit(0 if name == "priority" else None)
        params = params.withColumn(name, value.cast(kind))
    return params


def _piece(lo: Column, hi: Column, e_lo: Column, e_hi: Column) -> Column:
    return F.struct(*[c.cast("double").alias(n) for c, n in ((lo, "x_lo"), (hi, "x_hi"), (e_lo, "e_lo"), (e_hi, "e_hi"))])


def _bounds(rules: DataFrame, lo: str, hi: str) -> DataFrame:
    """The finite bounds b of all rules, numbered in order as n; as many as the table has rows, at most twice."""
    both = rules.select(F.explode(F.array(lo, hi)).alias("b")).where(f"b IS NOT NULL AND abs(b) < double('inf')").distinct()
    sorted_ = both.agg(F.array_sort(F.collect_list("b")).alias("bs"))
    return sorted_.select(F.posexplode("bs").alias("n", "b"))


class IntervalIndex:
    """Cells of a line cut at bounds: cell 2 k is open and has k bounds below it, cell 2 k + 1 is the bound number k itself."""

    def __init__(self, bounds: DataFrame):
        self.bounds = settle(bounds)
        lo, hi = self.bounds.agg(F.min("b"), F.max("b")).first()
        self.empty = lo is None
        self.low, self.width = lo or 0.0, max(((hi or 0.0) - (lo or 0.0)) / BUCKETS, 1e-300)
        held = self.bounds.groupBy(self._bucket(F.col("b")).alias("_k")).agg(F.min("n").alias("_n"), F.array_sort(F.collect_list("b")).alias("_bs"))
        self.table = held

    def _bucket(self, x: Column) -> Column:
        at = F.floor((x - F.lit(self.low)) / F.lit(self.width))
        return F.least(F.greatest(at, F.lit(-1)), F.lit(BUCKETS + 1)).cast("int")

    def locate(self, df: DataFrame, value: Column, name: str) -> DataFrame:
        """``df`` with the cell of ``value`` as column ``name``; null for null and NaN."""
        if self.empty:
            return df.withColumn(name, F.when(value.isNotNull() & ~F.isnan(value), F.lit(0)))
        # every bucket has a row: the number of the first bound in it, or of the next one after it
        every = self.table.sparkSession.range(-1, BUCKETS + 2).select(F.col("id").cast("int").alias("_k"))
        firsts = self.bounds.select("n", self._bucket(F.col("b")).alias("_kb"))
        base = every.join(firsts, F.col("_kb") < F.col("_k"), "left").groupBy("_k").agg(F.coalesce(F.max("n") + 1, F.lit(0)).alias("_n"))
        table = base.join(self.table.drop("_n"), "_k", "left").select("_k", "_n", F.coalesce("_bs", F.array().cast("array<double>")).alias("_bs"))
        ok = value.isNotNull() & ~F.isnan(value)
        out = df.withColumn("_v", F.when(ok, value.cast("double"))).withColumn("_k", F.coalesce(self._bucket(F.col("_v")), F.lit(-1)))
        out = lookup_join(out, table, ["_k"])
        below = F.size(F.filter("_bs", lambda b: b < F.col("_v")))
        on = F.array_contains("_bs", F.col("_v")).cast("int")
        return out.withColumn(name, F.when(F.col("_v").isNotNull(), 2 * (F.col("_n") + below) + on)).drop("_v", "_k", "_n", "_bs")

    def covered(self, rules: DataFrame, lo: str, hi: str, name: str, closed: bool) -> DataFrame:
        """A row of ``rules`` for every cell it covers; ``closed`` bounds belong to it, else the lower one only does not."""
        n = self.bounds.count()
        ends = self.bounds.select(F.col("b").alias("_b"), (2 * F.col("n") + 1).alias("_c"))
        out = rules
        for bound, edge, default in ((lo, "_from", 0), (hi, "_to", 2 * n)):
            side = ends.select(F.col("_b").alias(f"_{edge}"), F.col("_c").alias(edge))
            out = out.join(side, F.col(bound) == F.col(f"_{edge}"), "left").drop(f"_{edge}").withColumn(edge, F.coalesce(edge, F.lit(default)))
        first = F.col("_from") if closed else F.when(F.col("_from") > 0, F.col("_from") + 1).otherwise(F.lit(0))
        return out.where(first <= F.col("_to")).withColumn(name, F.explode(F.sequence(first, F.col("_to")))).drop("_from", "_to")


def assign_errors(obs: DataFrame, rules: DataFrame, x: str, lat: str | None = None, channel: str | None = None, surface: str | None = None,
                  scales: tuple[str, ...] = (), error: str = "error") -> DataFrame:
    """``obs`` with the error that the winning rule gives; null without a rule, without x, or without the scale it asks for.

    A piece of a curve holds for x_lo < x <= x_hi. ``scales`` are the columns that rules may name. Ties of priority go to the rule
    with the larger (lat_min, error at its start), so that a run can be repeated.
    """
    rules = settle(rules)
    xs, lats = IntervalIndex(_bounds(rules, "x_lo", "x_hi")), IntervalIndex(_bounds(rules, "lat_min", "lat_max"))
    cells = xs.covered(rules, "x_lo", "x_hi", "_x", False)
    cells = lats.covered(cells, "lat_min", "lat_max", "_y", True)
    out = obs
    names = []
    for column, rule in ((channel, "channel"), (surface, "surface")):
        own = f"_{rule}"
        known = rules.select(F.col(rule).alias(own)).where(F.col(own).isNotNull()).distinct()
        if column is None:
            cells = cells.where(F.col(rule).isNull()).withColumn(own, F.lit(ANY))
            out = out.withColumn(own, F.lit(ANY))
        else:
            # a rule for any value holds for each value that another rule names, and for all others
            named = known.agg(F.array_append(F.collect_list(own), F.lit(ANY)).alias("_all"))
            cells = cells.join(F.broadcast(named), F.lit(True)).withColumn(own, F.explode(F.when(F.col(rule).isNull(), F.col("_all")).otherwise(F.array(F.col(rule))))).drop("_all")
            out = lookup_join(out.withColumn(own, F.col(column).cast("string")), known.withColumn("_known", F.lit(True)), [own])
            out = out.withColumn(own, F.when(F.col("_known"), F.col(own)).otherwise(F.lit(ANY))).drop("_known")
        names.append(own)
    order = F.struct("priority", "lat_min", "e_lo")
    best = cells.groupBy(*names, "_x", "_y").agg(F.max_by(F.struct("x_lo", "x_hi", "e_lo", "e_hi", "scale"), order).alias("_r"))
    out = xs.locate(out, F.col(x).cast("double"), "_x")
    out = lats.locate(out, F.col(lat).cast("double") if lat else F.lit(0.0), "_y") if lat or not lats.empty else out.withColumn("_y", F.lit(0))
    out = lookup_join(out, best, [*names, "_x", "_y"])
    r = F.col("_r")
    flat = (F.abs(r["x_lo"]) == _INF) | (F.abs(r["x_hi"]) == _INF) | (r["x_lo"] == r["x_hi"])
    value = F.when(flat, r["e_lo"]).otherwise(r["e_lo"] + (F.col(x) - r["x_lo"]) * (r["e_hi"] - r["e_lo"]) / (r["x_hi"] - r["x_lo"]))
    factor = F.when(r["scale"].isNull(), F.lit(1.0))
    for s in scales:
        factor = factor.when(r["scale"] == s, F.col(s).cast("double"))
    return out.withColumn(error, value * factor).drop(*names, "_x", "_y", "_r")
