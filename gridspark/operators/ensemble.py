"""Ensemble and model-state arithmetic on long state(member, variable, cell_id, level, value)."""
from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridspark.session import settle

# Variables of an analysis increment, and its default window.
INCREMENT_VARIABLES = ["u", "rho", "theta", "qv", "qc", "qr", "qi", "qs", "qg"]
WINDOW_SECONDS = 21600


def ensemble_moments(state: DataFrame, keys: list[str], ddof: int = 1, value: str = "value") -> DataFrame:
    """Mean and variance over members; a single member passes through with variance 0.

    ``ddof`` 1 divides by n - 1, 0 by n. Members combine before the shuffle.
    """
    var = F.var_samp(value) if ddof else F.var_pop(value)
    return state.groupBy(*keys).agg(F.avg(value).alias("mean"), F.coalesce(var, F.lit(0.0)).alias("variance"),
                                    F.count(F.lit(1)).alias("n_members"))


def increment(a: DataFrame, b: DataFrame, keys: list[str], variables: list[str] | None = None,
              window_seconds: int = WINDOW_SECONDS, value: str = "value") -> DataFrame:
    """``a - b`` for the listed variables, valid half a window earlier; keys include ``variable``."""
    names = variables or INCREMENT_VARIABLES
    left = a.filter(F.col("variable").isin(names))
    right = b.filter(F.col("variable").isin(names)).select(*keys, F.col(value).alias("_b"))
    out = left.join(right, keys).withColumn(value, F.col(value) - F.col("_b")).drop("_b")
    if "valid_time" in out.columns:
        out = out.withColumn("valid_time", F.col("valid_time") - F.make_dt_interval(secs=F.lit(window_seconds / 2)))
    return out


def increment_summary(a: DataFrame, b: DataFrame, keys: list[str], value: str = "value") -> DataFrame:
    """min, max and mean of analysis, background and difference per variable."""
    both = a.select(*keys, F.col(value).alias("a")).join(b.select(*keys, F.col(value).alias("b")), keys)
    both = both.withColumn("d", F.col("a") - F.col("b"))
    return both.groupBy("variable").agg(*[
        f(c).alias(f"{c}_{n}") for c in "abd" for n, f in (("min", F.min), ("max", F.max), ("mean", F.avg))])


def _tagged(prior: DataFrame, post: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Both ensembles in one table, so that statistics and perturbations need a single shuffle on ``keys``."""
    a = post.select("member", *keys, F.col(value).alias("_v"), F.lit(True).alias("_post"))
    return a.unionByName(prior.select("member", *keys, F.col(value).alias("_v"), F.lit(False).alias("_post")))


def rtpp(prior: DataFrame, post: DataFrame, keys: list[str], factor: float, value: str = "value") -> DataFrame:
    """Relaxation to prior perturbations: ``mean_a + (1 - f) x_a' + f x_b'``; f in [0, 1].

    prior and post are (member, keys, value). Windows cover the members of one point, a group as large as
    the ensemble; both partition by ``keys``, so the rows move once.
    """
    if not 0.0 <= factor <= 1.0:
        raise ValueError("relaxation factor must lie in [0, 1]")
    point, own = Window.partitionBy(*keys), Window.partitionBy(*keys, "member")
    a, b = F.when(F.col("_post"), F.col("_v")), F.when(~F.col("_post"), F.col("_v"))
    x = _tagged(prior, post, keys, value).withColumn("_ma", F.avg(a).over(point)).withColumn("_mb", F.avg(b).over(point))
    x = x.withColumn("_b", F.max(b).over(own)).filter(F.col("_post") & F.col("_b").isNotNull())
    pert = (1.0 - factor) * (F.col("_v") - F.col("_ma")) + factor * (F.col("_b") - F.col("_mb"))
    return x.select("member", *keys, (F.col("_ma") + pert).alias(value))


def rtps(prior: DataFrame, post: DataFrame, keys: list[str], factor: float, value: str = "value") -> DataFrame:
    """Relaxation to prior spread: perturbations times ``1 + f (s_b - s_a) / s_a``; zero spread is left alone."""
    point = Window.partitionBy(*keys)
    a, b = F.when(F.col("_post"), F.col("_v")), F.when(~F.col("_post"), F.col("_v"))
    x = _tagged(prior, post, keys, value).withColumn("_m", F.avg(a).over(point)).withColumn(
        "_sa", F.stddev_samp(a).over(point)).withColumn("_sb", F.stddev_samp(b).over(point)).filter("_post")
    grow = F.when(F.col("_sa") > 0, 1.0 + factor * F.try_divide(F.col("_sb") - F.col("_sa"), F.col("_sa"))).otherwise(1.0)
    return x.select("member", *keys, (F.col("_m") + (F.col("_v") - F.col("_m")) * grow).alias(value))


def inflate(state: DataFrame, keys: list[str], factor: float, value: str = "value") -> DataFrame:
    """Multiplicative inflation of the perturbations about the mean."""
    x = state.withColumn("_m", F.avg(value).over(Window.partitionBy(*keys)))
    return x.select("member", *keys, (F.col("_m") + (F.col(value) - F.col("_m")) * factor).alias(value))


def recenter(ensemble: DataFrame, centre: DataFrame, variables: list[str], keys: list[str],
             value: str = "value") -> tuple[DataFrame, DataFrame]:
    """(recentred members, raw mean): member minus mean plus centre for the listed variables.

    Every other variable of the centre is given to each member as it is, whether or not the ensemble has it.
    ``keys`` include ``variable``. Listed points without a centre are left to :func:`centre_gaps`. The members of an
    ensemble are a short list, so the unlisted points are repeated by exploding it.
    """
    means = settle(ensemble.groupBy(*keys).agg(F.avg(value).alias(value)))
    shift = means.join(centre.select(*keys, F.col(value).alias("_c")), keys).select(*keys, (F.col("_c") - F.col(value)).alias("_s"))
    listed = F.col("variable").isin(variables)
    moved = ensemble.filter(listed).join(shift, keys).select("member", *keys, (F.col(value) + F.col("_s")).alias(value))
    members = [r["member"] for r in ensemble.select("member").distinct().collect()]
    each = F.explode(F.array(*[F.lit(m) for m in members])) if members else F.lit(None)
    rest = centre.filter(~listed).withColumn("member", each).select("member", *keys, value)
    return moved.unionByName(rest if members else rest.limit(0)), means


def centre_gaps(ensemble: DataFrame, centre: DataFrame, variables: list[str], keys: list[str]) -> DataFrame:
    """Points of listed variables that the ensemble has and the centre lacks; must be empty before recentring."""
    points = ensemble.filter(F.col("variable").isin(variables)).select(*keys).distinct()
    return points.join(centre.select(*keys), keys, "left_anti")
