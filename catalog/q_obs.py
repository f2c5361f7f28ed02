"""Departures, bias training, observation checks."""
from __future__ import annotations

from pyspark.sql import functions as F

from catalog.registry import query
from gridspark.functions.errors import BANDS_3, BANDS_7, error_ramp, error_stepwise, latitude_band, parse_channels
from gridspark.functions.numbers import is_valid
from gridspark.operators import bias as B
from gridspark.operators import departures as D
from gridspark.operators import error_tables as T
from gridspark.operators import qc as Q

STAT_COLS = ["CAST(cycle AS STRING) AS cycle", "observer", "channel", "CAST(n_file AS BIGINT) AS n_file", "CAST(n AS BIGINT) AS n",
             "ROUND(omb_rms, 7) AS omb_rms", "ROUND(omb_mean, 7) AS omb_mean", "ROUND(jo_b, 7) AS jo_b"]
BY = ["cycle", "observer", "channel"]
DA_SQL = """SELECT cycle, observer, channel, count(*) AS n_file, count(*) FILTER (qc0 <= 1) AS n,
 sqrt(avg(ombg*ombg) FILTER (qc0 <= 1))*1000 AS omb_rms, avg(ombg) FILTER (qc0 <= 1)*1000 AS omb_mean, avg(power(ombg/err0, 2)) FILTER (qc0 <= 1) AS jo_b,
 sqrt(avg(oman*oman) FILTER (qc1 <= 1))*1000 AS oma_rms, avg(oman) FILTER (qc1 <= 1)*1000 AS oma_mean, avg(power(oman/err0, 2)) FILTER (qc1 <= 1) AS jo_a,
 coalesce(bool_and(abs(ombg - oman) <= 1e-8 + 1e-5*abs(oman)) FILTER (qc0 <= 1 AND qc1 <= 1), false) AS passive
FROM obs GROUP BY cycle, observer, channel"""


@query("departure_stats", STAT_COLS + ["ROUND(oma_rms, 7) AS oma_rms", "ROUND(oma_mean, 7) AS oma_mean", "ROUND(jo_a, 7) AS jo_a", "passive"], DA_SQL, ("obs",))
def departure_stats(i):
    return D.departure_stats(i("obs"), BY, scale=1000.0)


@query("departure_stats_hofx", STAT_COLS + ["passive"], """SELECT cycle, observer, channel, count(o) AS n_file, count(*) FILTER (qc0 = 0 AND o IS NOT NULL) AS n,
 sqrt(avg(power(o - hofx, 2)) FILTER (qc0 = 0)) AS omb_rms, avg(o - hofx) FILTER (qc0 = 0) AS omb_mean,
 CASE WHEN min(e) FILTER (qc0 = 0 AND o IS NOT NULL) > 0 THEN avg(power((o - hofx)/e, 2)) FILTER (qc0 = 0) END AS jo_b, true AS passive
FROM (SELECT *, CASE WHEN loc_id % 23 <> 4 THEN obs END AS o, CASE WHEN loc_id % 211 = 0 THEN 0 ELSE err0 END AS e FROM obs) GROUP BY cycle, observer, channel""", ("obs",))
def departure_stats_hofx(i):
    o = i("obs").withColumn("obs", F.expr("CASE WHEN loc_id % 23 = 4 THEN 1e30D ELSE obs END")).withColumn(
        "err0", F.expr("CASE WHEN loc_id % 211 = 0 THEN 0D ELSE err0 END"))
    return D.departure_stats(o, BY, "hofx")


@query("passive_observers", ["observer", "passive"], f"""SELECT observer, observer = 'inst0' OR bool_and(passive) AS passive FROM ({DA_SQL}) GROUP BY observer""", ("obs",))
def passive_observers(i):
    return D.passive_flags(D.departure_stats(i("obs"), BY), ["inst0"])


@query("prefer_analysis", ["CAST(cycle AS STRING) AS cycle", "observer", "CAST(n AS BIGINT) AS n", "passive"], """
WITH h AS (SELECT cycle, observer, count(*) FILTER (qc0 = 0) AS n FROM obs GROUP BY 1, 2),
d AS (SELECT cycle, observer, count(*) FILTER (qc0 <= 1) AS n, coalesce(bool_and(abs(ombg - oman) <= 1e-8 + 1e-5*abs(oman)) FILTER (qc0 <= 1 AND qc1 <= 1), false) AS passive
 FROM obs WHERE day(obs_time) % 2 = 0 GROUP BY 1, 2)
SELECT cycle, observer, n, passive FROM d UNION ALL SELECT cycle, observer, n, true FROM h WHERE NOT EXISTS (SELECT 1 FROM d WHERE d.cycle = h.cycle AND d.observer = h.observer)""", ("obs",))
def prefer_analysis(i):
    o = i("obs")
    by = ["cycle", "observer"]
    return D.prefer_analysis(D.departure_stats(o, by, "hofx"), D.departure_stats(o.filter("day(obs_time) % 2 = 0"), by), by)


CHANNELS = """SELECT concat('o', CAST(s_nationkey AS STRING)) AS observer, CAST(s_suppkey AS INT) AS channel,
 CASE WHEN s_nationkey % 3 = 0 THEN 0.3E0 + CAST(s_suppkey % 97 AS DOUBLE)/100 WHEN s_nationkey % 3 = 1 THEN 300E0 + s_suppkey % 611 END AS wavelength,
 2.99792458E17/(350E0 + s_suppkey % 701) AS frequency FROM supplier"""


@query("nearest_channel", ["observer", "CAST(channel AS INT) AS channel", "ROUND(nm, 6) AS nm"], f"""
WITH c AS ({CHANNELS}), w AS (SELECT *, CASE WHEN max(wavelength) OVER (PARTITION BY observer) < 100 THEN wavelength*1000 WHEN wavelength IS NOT NULL THEN wavelength ELSE 2.99792458e17/frequency END AS nm FROM c)
SELECT observer, channel, nm FROM w QUALIFY row_number() OVER (PARTITION BY observer ORDER BY abs(nm - 550), channel) = 1""")
def nearest_channel(i):
    return D.nearest_channel(i.sql(CHANNELS))


@query("increment_rms", ["variable", "ROUND(inc_rms, 6) AS inc_rms", "CAST(n AS BIGINT) AS n"], """
SELECT a.variable, sqrt(avg(power(a.value - b.value, 2))) AS inc_rms, count(*) AS n FROM prior_state a JOIN state b ON a.member = b.member AND a.cell_id = b.cell_id GROUP BY a.variable""", ("state", "prior_state"))
def increment_rms(i):
    return D.increment_rms(i("prior_state"), i("state"), ["member", "variable", "cell_id"], ["variable"])


LOGS = """SELECT o_custkey % 50 AS cycle, o_orderkey AS line_no, CASE WHEN o_orderkey % 3 = 0 THEN concat('Cost: Nonlinear J = ', CAST(o_orderkey + 0.5E0 AS STRING))
 WHEN o_orderkey % 7 = 1 THEN concat('STATS Run end - Runtime: ', CAST(o_orderkey AS STRING), ' sec, Memory: total: ', CAST(o_custkey AS STRING), ' Gb') ELSE 'other text' END AS line FROM orders"""


@query("cost_summary", ["cycle", "ROUND(minutes, 8) AS minutes", "gb", "j0", "j1", "ROUND(j_ratio, 8) AS j_ratio"], """
SELECT o_custkey % 50 AS cycle, max(CASE WHEN o_orderkey % 3 <> 0 AND o_orderkey % 7 = 1 THEN o_orderkey END)/60.0 AS minutes,
 CAST(arg_max(o_custkey, CASE WHEN o_orderkey % 3 <> 0 AND o_orderkey % 7 = 1 THEN o_orderkey END) AS DOUBLE) AS gb,
 min(CASE WHEN o_orderkey % 3 = 0 THEN o_orderkey + 0.5e0 END) AS j0, max(CASE WHEN o_orderkey % 3 = 0 THEN o_orderkey + 0.5e0 END) AS j1, j1/j0 AS j_ratio FROM orders GROUP BY 1""")
def cost_summary(i):
    return D.cost_summary(i.sql(LOGS))


RUNS = """SELECT concat('run', CAST(o_custkey % 2 AS STRING)) AS run, CAST(o_orderdate AS DATE) AS cycle, o_orderpriority AS key, avg(o_totalprice) AS omb_rms, count(*) AS n
FROM orders GROUP BY 1, 2, 3"""


@query("compare_runs", ["CAST(cycle AS STRING) AS cycle", "key", "ROUND(run0_omb_rms, 4) AS run0", "ROUND(run1_omb_rms, 4) AS run1"], f"""
WITH r AS ({RUNS}), c AS (SELECT cycle FROM r GROUP BY cycle HAVING count(DISTINCT run) = 2)
SELECT cycle, key, max(CASE WHEN run = 'run0' THEN omb_rms END) AS run0_omb_rms, max(CASE WHEN run = 'run1' THEN omb_rms END) AS run1_omb_rms
FROM r WHERE cycle IN (FROM c) GROUP BY cycle, key""")
def compare_runs(i):
    return D.compare_runs(i.sql(RUNS), ["run0", "run1"], ["omb_rms", "n"])


@query("common_cycles_any", ["CAST(cycle AS STRING) AS cycle"], f"SELECT DISTINCT cycle FROM ({RUNS})")
def common_cycles_any(i):
    return D.common_cycles(i.sql(RUNS), ["run0", "run1"], every=True)


@query("cycle_documents", ["CAST(cycle AS STRING) AS cycle", "document"], """
SELECT cycle, '{"obs":{' || string_agg('"' || key || '":{"n":' || n || '}', ',' ORDER BY key) || '}}' AS document FROM (
SELECT cycle, observer || ':' || channel AS key, count(*) FILTER (qc0 <= 1) AS n FROM obs GROUP BY cycle, observer, channel) GROUP BY cycle""", ("obs",))
def cycle_documents(i):
    s = D.departure_stats(i("obs"), BY).select("cycle", F.concat_ws(":", "observer", F.col("channel").cast("string")).alias("key"), "n")
    return D.cycle_document(s)


BINS = list(range(0, 10))


@query("band_error_profile", ["band", "bin", "ROUND(error, 8) AS error", "CAST(n AS BIGINT) AS n"], """
WITH b AS (SELECT *, CASE WHEN lat < -60 THEN 'SPol' WHEN lat < -30 THEN 'SMid' WHEN lat < -5 THEN 'STro' WHEN lat < 5 THEN 'ITCZ' WHEN lat < 30 THEN 'NTro' WHEN lat < 60 THEN 'NMid' ELSE 'NPol' END AS band, CAST(station_height AS INT)//100 AS bin FROM obs),
f AS (SELECT band, unnest(range(10)) AS bin FROM (SELECT unnest(['SPol','SMid','STro','ITCZ','NTro','NMid','NPol']) AS band)),
s AS (SELECT band, bin, CASE WHEN avg(oman*ombg/obs) > 0 THEN avg(oman*ombg/obs) END AS e, count(*) AS n FROM b GROUP BY 1, 2)
SELECT f.band, CAST(f.bin AS INT) AS bin, coalesce(e, 999.0) AS error, coalesce(n, 0) AS n FROM f LEFT JOIN s ON s.band = f.band AND s.bin = f.bin""", ("obs",))
def band_error_profile(i):
    return D.band_error_profile(i("obs"), latitude_band(F.col("lat")), F.floor(F.col("station_height") / 100), [b[0] for b in BANDS_7], BINS)


@query("latitude_bands", ["loc_id", "band7", "band3"], """SELECT loc_id,
 CASE WHEN lat < -60 THEN 'SPol' WHEN lat < -30 THEN 'SMid' WHEN lat < -5 THEN 'STro' WHEN lat < 5 THEN 'ITCZ' WHEN lat < 30 THEN 'NTro' WHEN lat < 60 THEN 'NMid' ELSE 'NPol' END AS band7,
 CASE WHEN lat < -30 THEN 'SXTro' WHEN lat < 30 THEN 'Tro' ELSE 'NXTro' END AS band3 FROM obs""", ("obs",))
def latitude_bands(i):
    return i("obs").withColumn("band7", latitude_band(F.col("lat"))).withColumn("band3", latitude_band(F.col("lat"), BANDS_3))


@query("verify_state", ["variable", "member", "CAST(n AS BIGINT) AS n", "ROUND(mean, 6) AS mean", "ROUND(rms, 6) AS rms", "ROUND(std, 6) AS std"], """
SELECT a.variable, a.member, count(*) AS n, avg(a.value - b.value) AS mean, sqrt(avg(power(a.value - b.value, 2))) AS rms, stddev_pop(a.value - b.value) AS std
FROM prior_state a JOIN state b ON a.member = b.member AND a.cell_id = b.cell_id GROUP BY 1, 2""", ("state", "prior_state"))
def verify_state(i):
    return D.verify_state(i("prior_state"), i("state"), ["member", "variable", "cell_id"], ["variable", "member"])


PRED = ["p0", "p1"]
CH = ["observer", "channel"]
SUMS_SQL = """SELECT observer, channel, sum(1/err0) FILTER (qc0 = 0) AS h_0_0, sum(p1/err0) FILTER (qc0 = 0) AS h_0_1, sum(p1*p1/err0) FILTER (qc0 = 0) AS h_1_1,
 sum((obs - hofx + bias)/err0) FILTER (qc0 = 0) AS r_0, sum(p1*(obs - hofx + bias)/err0) FILTER (qc0 = 0) AS r_1, count(*) FILTER (qc0 = 0) AS n_obs FROM obs GROUP BY 1, 2"""


@query("bias_normal_sums", CH + [f"ROUND({c}, 6) AS {c}" for c in ("h_0_0", "h_0_1", "h_1_1", "r_0", "r_1")] + ["CAST(n_obs AS BIGINT) AS n_obs"], SUMS_SQL, ("obs",))
def bias_normal_sums(i):
    return B.normal_sums(i("obs"), PRED, CH)


def _solve_sql(h00="h_0_0", h11="h_1_1", r0="r_0", r1="r_1"):
    det = f"(({h00})*({h11}) - h_0_1*h_0_1)"
    return f"""SELECT observer, channel, predictor, CASE predictor WHEN 'p0' THEN (({h11})*({r0}) - h_0_1*({r1}))/{det} ELSE (({h00})*({r1}) - h_0_1*({r0}))/{det} END AS beta,
 CASE predictor WHEN 'p0' THEN ({h11})/{det} ELSE ({h00})/{det} END AS err, n_obs FROM s, (SELECT unnest(['p0','p1']) AS predictor)"""


COEF_COLS = CH + ["predictor", "ROUND(beta, 7) AS beta", "ROUND(err, 7) AS err", "CAST(n_obs AS BIGINT) AS n_obs"]
PRIOR = "SELECT concat('inst', CAST(n_nationkey % 3 AS STRING)) AS observer, CAST(n_nationkey % 15 AS INT) AS channel, concat('p', CAST(n_nationkey % 2 AS STRING)) AS predictor, 0.1E0*n_nationkey AS beta, 0.01E0*(1 + n_nationkey) AS err FROM nation"


@query("bias_solve", COEF_COLS, f"WITH s AS ({SUMS_SQL}) {_solve_sql()}", ("obs",))
def bias_solve(i):
    return B.solve_bias(B.normal_sums(i("obs"), PRED, CH), PRED, CH)


@query("bias_solve_prior", COEF_COLS, f"""WITH q AS ({PRIOR}), e AS (SELECT s.*, coalesce(a.beta, 0) AS b0, coalesce(a.err*1.1, 1e20) AS e0, coalesce(b.beta, 0) AS b1, coalesce(b.err*1.1, 1e20) AS e1
 FROM ({SUMS_SQL}) s LEFT JOIN q a ON a.observer = s.observer AND a.channel = s.channel AND a.predictor = 'p0' LEFT JOIN q b ON b.observer = s.observer AND b.channel = s.channel AND b.predictor = 'p1'),
s AS (SELECT *, CASE WHEN e0 < 1e-15*greatest(e0, e1) THEN 0 ELSE 1/e0 END AS i0, CASE WHEN e1 < 1e-15*greatest(e0, e1) THEN 0 ELSE 1/e1 END AS i1 FROM e)
{_solve_sql('h_0_0 + i0', 'h_1_1 + i1', 'r_0 + i0*b0', 'r_1 + i1*b1')}""", ("obs",))
def bias_solve_prior(i):
    # where only one predictor has a prior, the cut-off of the pseudo-inverse drops it beside the 1e20 default
    return B.solve_bias(B.normal_sums(i("obs"), PRED, CH), PRED, CH, i.sql(PRIOR))


@query("bias_training_cycles", ["CAST(cycle AS STRING) AS cycle", "observer", "channel", "predictor", "ROUND(beta, 3) AS beta", "CAST(n_obs AS BIGINT) AS n_obs"])
def bias_training_cycles(i):
    return B.train_sequential(B.normal_sums(i("obs"), PRED, [*CH, "cycle"]), PRED, CH, step_seconds=86400)


# per observer every cycle has enough rows for both predictors, so the fold has a closed form
CYCLE_SUMS = SUMS_SQL.replace("channel, ", "cycle, ")
CYCLE_STEP = """SELECT observer, cycle, k, n_obs, CAST((h1*(i0*b0 + r_0) - h_0_1*(i1*b1 + r_1))/d AS FLOAT) AS c0, CAST((h0*(i1*b1 + r_1) - h_0_1*(i0*b0 + r_0))/d AS FLOAT) AS c1,
 CAST(h1/d AS FLOAT) AS e0, CAST(h0/d AS FLOAT) AS e1 FROM (SELECT *, h0*h1 - h_0_1*h_0_1 AS d FROM (SELECT *, h_0_0 + i0 AS h0, h_1_1 + i1 AS h1 FROM ({})))"""
CYCLE_FOLD = f"""WITH RECURSIVE s AS (SELECT *, row_number() OVER (PARTITION BY observer ORDER BY cycle) AS k FROM ({CYCLE_SUMS})),
f AS ({CYCLE_STEP.format("SELECT *, 0e0 AS b0, 0e0 AS b1, 1e-20 AS i0, 1e-20 AS i1 FROM s WHERE k = 1")}
UNION ALL {CYCLE_STEP.format("""SELECT s.*, CASE WHEN n THEN CAST(c0 AS DOUBLE) ELSE 0 END AS b0, CASE WHEN n THEN CAST(c1 AS DOUBLE) ELSE 0 END AS b1,
 CASE WHEN n THEN 1/(1.1e0*CAST(e0 AS DOUBLE)) ELSE 1e-20 END AS i0, CASE WHEN n THEN 1/(1.1e0*CAST(e1 AS DOUBLE)) ELSE 1e-20 END AS i1
 FROM (SELECT s.*, f.c0, f.c1, f.e0, f.e1, epoch(s.cycle) - epoch(f.cycle) = 86400 AS n FROM f JOIN s ON s.observer = f.observer AND s.k = f.k + 1) s""")})
SELECT cycle, observer, 'p0' AS predictor, CAST(c0 AS DOUBLE) AS beta, n_obs FROM f UNION ALL SELECT cycle, observer, 'p1', CAST(c1 AS DOUBLE), n_obs FROM f"""


@query("bias_training_observers", ["CAST(cycle AS STRING) AS cycle", "observer", "predictor", "ROUND(beta, 5) AS beta", "CAST(n_obs AS BIGINT) AS n_obs"], CYCLE_FOLD, ("obs",))
def bias_training_observers(i):
    return B.train_sequential(B.normal_sums(i("obs"), PRED, ["observer", "cycle"]), PRED, ["observer"], step_seconds=86400)


OLD = "SELECT concat('inst', CAST(n_nationkey % 3 AS STRING)) AS observer, CAST(n_nationkey % 15 AS INT) AS channel, max(0.05E0*n_nationkey) AS mean FROM nation GROUP BY 1, 2"


@query("bias_recentre", ["loc_id", "ROUND(p1, 8) AS p1", "ROUND(p2, 8) AS p2"], f"""
WITH q AS ({OLD}), x AS (SELECT loc_id, o.observer, o.channel, qc0, p1 + coalesce(mean, 0) AS p1 FROM obs o LEFT JOIN q ON q.observer = o.observer AND q.channel = o.channel),
m AS (SELECT observer, channel, coalesce(avg(p1) FILTER (qc0 = 0), 0) AS mean FROM x GROUP BY 1, 2)
SELECT loc_id, p1 - mean AS p1, (p1 - mean)*(p1 - mean) AS p2 FROM x JOIN m ON m.observer = x.observer AND m.channel = x.channel""", ("obs",))
def bias_recentre(i):
    return B.recentre(i("obs"), i.sql(OLD), CH, "p1", "p2")[0]


@query("bias_new_means", CH + ["ROUND(mean, 8) AS mean"], "SELECT observer, channel, coalesce(avg(p1) FILTER (qc0 = 0), 0) AS mean FROM obs GROUP BY 1, 2", ("obs",))
def bias_new_means(i):
    return B.recentre(i("obs"), None, CH, "p1", "p2")[1]


COEF = "SELECT DISTINCT observer, channel, 'p0' AS predictor, 0.1E0*channel AS beta FROM obs UNION ALL SELECT DISTINCT observer, channel, 'p1' AS predictor, 0.1E0*channel - 0.3E0 AS beta FROM obs"


@query("bias_apply", ["loc_id", "ROUND(obsbias, 8) AS obsbias", "ROUND(omb_corrected, 8) AS omb_corrected"], """
SELECT loc_id, 0.1e0*channel + (0.1e0*channel - 0.3e0)*p1 AS obsbias, obs - hofx + bias - (0.1e0*channel + (0.1e0*channel - 0.3e0)*p1) AS omb_corrected FROM obs""", ("obs",))
def bias_apply(i):
    return B.apply_bias(i("obs"), i.sql(COEF, "obs"), PRED, CH)


@query("bias_residuals", CH + ["CAST(n_obs AS BIGINT) AS n_obs", "ROUND(rms, 8) AS rms", "ROUND(mean, 8) AS mean", "ROUND(mean_bias, 8) AS mean_bias", "ROUND(mean_p1, 8) + 0.0 AS mean_p1"], """
SELECT observer, channel, count(*) AS n_obs, sqrt(avg(power(obs - hofx + bias - b, 2))) AS rms, avg(obs - hofx + bias - b) AS mean, avg(b) AS mean_bias, avg((0.1e0*channel - 0.3e0)*p1) AS mean_p1
FROM (SELECT *, 0.1e0*channel + (0.1e0*channel - 0.3e0)*p1 AS b FROM obs WHERE qc0 = 0) GROUP BY 1, 2""", ("obs",))
def bias_residuals(i):
    return B.bias_residuals(i("obs"), i.sql(COEF, "obs"), PRED, CH)


@query("bias_power_predictors", ["loc_id", "ROUND(p1_2, 10) AS p1_2", "ROUND(p1_4, 10) AS p1_4"], "SELECT loc_id, power(p1, 2) AS p1_2, power(p1, 4) AS p1_4 FROM obs", ("obs",))
def bias_power_predictors(i):
    return B.power_predictors(i("obs"), "p1", [1, 2, 3, 4])


X, E = [0.0, 20.0, 60.0, 90.0], [1.0, 2.0, 8.0, 9.0]


@query("error_ramp", ["loc_id", "ROUND(e, 9) AS e"], "SELECT loc_id, CASE WHEN obs <= 10 THEN 0.05 WHEN obs >= 80 THEN 0.32 ELSE 0.05 + (obs - 10)/70*(0.32 - 0.05) END AS e FROM obs", ("obs",))
def error_ramp_query(i):
    return i("obs").withColumn("e", error_ramp(F.col("obs"), 10.0, 80.0, 0.05, 0.32))


STEP_SQL = "CASE WHEN {x} <= 0 THEN 1 WHEN {x} <= 20 THEN 1 + {x}/20 WHEN {x} <= 60 THEN 2 + ({x} - 20)*6/40 WHEN {x} <= 90 THEN 8 + ({x} - 60)/30 ELSE 9 END"


@query("error_stepwise", ["loc_id", "ROUND(e, 9) AS e", "ROUND(down, 9) AS down"], f"SELECT loc_id, {STEP_SQL.format(x='obs')}*hofx AS e, {STEP_SQL.format(x='obs')} AS down FROM obs", ("obs",))
def error_stepwise_query(i):
    return i("obs").withColumn("e", error_stepwise(F.col("obs"), X, E, F.col("hofx"))).withColumn(
        "down", error_stepwise(F.col("obs"), X[::-1], E[::-1]))


# a ramp per channel: as many channels as nations
RAMPS = "SELECT n_nationkey AS channel, 5E0 + n_nationkey AS x0, 40E0 + n_nationkey*2E0 AS x1, 0.05E0 + n_nationkey*0.01E0 AS e0, 0.3E0 + n_nationkey*0.02E0 AS e1 FROM nation WHERE n_nationkey % 4 <> 3"


@query("error_ramp_channels", ["loc_id", "ROUND(e, 9) AS e"], f"""
SELECT loc_id, CASE WHEN obs <= x0 THEN e0 WHEN obs >= x1 THEN e1 ELSE e0 + (obs - x0)/(x1 - x0)*(e1 - e0) END AS e FROM obs o LEFT JOIN ({RAMPS}) r ON r.channel = o.channel""", ("obs",))
def error_ramp_channels(i):
    return T.assign_errors(i("obs"), T.ramp_rules(i.sql(RAMPS).withColumnsRenamed({"e0": "err0", "e1": "err1"})), "obs", channel="channel", error="e")


# four bands of latitude with a curve of heights each, times the observed value; on a common bound the later band counts
CURVES = [(-90.0, -30.0, [0.0, 300.0, 600.0], [0.02, 0.05, 0.03]), (-30.0, 0.0, [900.0, 100.0], [0.4, 0.1]), (0.0, 45.5, [0.0, 50.0, 50.5, 700.0], [1.0, 2.0, 4.0, 5.0]), (45.5, 90.0, [10.0, 20.0], [0.5, 0.25])]


def _curve_sql(xs, es):
    pairs = sorted(zip(xs, es))
    steps = " ".join(f"WHEN station_height <= {b!r} THEN {ea!r} + (station_height - {a!r})*{eb - ea!r}/{b - a!r}" for (a, ea), (b, eb) in zip(pairs, pairs[1:]))
    return f"CASE WHEN station_height <= {pairs[0][0]!r} THEN {pairs[0][1]!r} {steps} ELSE {pairs[-1][1]!r} END"


@query("error_stepwise_bands", ["loc_id", "ROUND(e, 8) AS e"], "SELECT loc_id, obs*(CASE " + " ".join(
    f"WHEN lat >= {lo!r} AND lat <= {hi!r} THEN {_curve_sql(xs, es)}" for lo, hi, xs, es in CURVES[::-1]) + " END) AS e FROM obs", ("obs",))
def error_stepwise_bands(i):
    params = i.spark.createDataFrame([(lo, hi, xs, es, "obs", k) for k, (lo, hi, xs, es) in enumerate(CURVES)],
                                     "lat_min double, lat_max double, xvals array<double>, errors array<double>, scale string, priority int")
    return T.assign_errors(i("obs"), T.stepwise_rules(params), "station_height", "lat", scales=("obs",), error="e")


@query("valid_mask", ["loc_id", "ok"], "SELECT event_id AS loc_id, NOT (event_id % 13 IN (0, 5, 7)) AS ok FROM events")
def valid_mask(i):
    x = i.sql("SELECT event_id AS loc_id, CASE event_id % 13 WHEN 0 THEN -3.3687953E38 WHEN 5 THEN double('NaN') WHEN 7 THEN NULL ELSE value END AS v FROM events")
    return x.withColumn("ok", is_valid(F.col("v")))


@query("channel_subset", ["channel", "CAST(n AS BIGINT) AS n"], "SELECT channel, count(*) AS n FROM obs WHERE channel IN (1, 2, 3, 6, 9, 10, 11, 12) GROUP BY channel", ("obs",))
def channel_subset(i):
    return i("obs").filter(F.col("channel").isin(parse_channels("1-3, 6,9-12"))).groupBy("channel").agg(F.count(F.lit(1)).alias("n"))


RULES = [
    Q.Rule("quality", "prequality", options={"max": 1}),
    Q.Rule("region", "domain", where=(("lat", -70, 70), ("lon", -170.0, None))),
    Q.Rule("range", "bounds", options={"min": 5.0, "max": 95.0}, channels="0-13"),
    Q.Rule("height", "difference", options={"value": "model_height", "reference": "station_height", "threshold": 200}),
    Q.Rule("ramp", "list", "assign", "0-6", options={"xvar": "obs", "x0": 10.0, "x1": 80.0, "err0": 0.5, "err1": 1.5}),
    Q.Rule("steps", "list", "assign", "7-10", options={"xvar": "obs", "xvals": X, "errors": E}),
    Q.Rule("cloudy", "list", "assign", where_in=(("observer", ("inst1",)),), channels="11", options={"value": 7.0}),
    Q.Rule("gross", "background", options={"threshold": 4.0}),
    Q.Rule("loose", "background", "inflate", options={"threshold": 3.0, "factor": 2.0}),
    Q.Rule("fixed", "background_absolute", channels="12", options={"threshold_column": "err0"}),
    Q.Rule("blacklist", "list", where=(("station_height", 880, None),)),
    Q.Rule("use", "use_flag", options={"flags": {3: -1, 4: 1}}),
    Q.Rule("watch", "list", "passivate", "5"),
]
ERR = f"CASE WHEN channel <= 6 THEN CASE WHEN obs <= 10 THEN 0.5 WHEN obs >= 80 THEN 1.5 ELSE 0.5 + (obs - 10)/70 END WHEN channel <= 10 THEN {STEP_SQL.format(x='obs')} WHEN channel = 11 AND observer = 'inst1' THEN 7 ELSE err0 END"
QC_SQL = f"""WITH e AS (SELECT *, {ERR} AS e FROM obs),
r AS (SELECT *, CASE WHEN prequality > 1 THEN 'quality' WHEN NOT (lat BETWEEN -70 AND 70 AND lon >= -170) THEN 'region' WHEN channel <= 13 AND NOT (obs BETWEEN 5 AND 95) THEN 'range'
 WHEN abs(model_height - station_height) > 200 THEN 'height' WHEN NOT abs(obs - hofx) <= 4*e THEN 'gross' WHEN channel = 12 AND NOT abs(obs - hofx) <= err0 THEN 'fixed'
 WHEN station_height >= 880 THEN 'blacklist' WHEN channel = 3 THEN 'use' END AS qc_reason FROM e)
SELECT loc_id, observer, channel, lat, lon, qc_reason, CASE WHEN qc_reason IS NOT NULL THEN 2 WHEN channel = 5 THEN 1 ELSE 0 END AS qc_flag, CASE WHEN NOT abs(obs - hofx) <= 3*e THEN e*2 ELSE e END AS err_eff FROM r"""


@query("qc_rules", ["loc_id", "CAST(qc_flag AS INT) AS qc_flag", "qc_reason", "ROUND(err_eff, 8) AS err_eff"], QC_SQL, ("obs",))
def qc_rules(i):
    return Q.apply_rules(i("obs"), RULES)


@query("qc_reduce_space", ["channel", "CAST(n AS BIGINT) AS n"], "SELECT channel, count(*) AS n FROM obs WHERE prequality <= 1 GROUP BY channel", ("obs",))
def qc_reduce_space(i):
    out = Q.apply_rules(i("obs"), [Q.Rule("quality", "prequality", "reduce", options={"max": 1})])
    return out.groupBy("channel").agg(F.count(F.lit(1)).alias("n"))


@query("monitor_observers", ["observer", "CAST(qc_flag AS INT) AS qc_flag", "CAST(n AS BIGINT) AS n"], f"""
SELECT observer, CASE WHEN qc_flag = 0 AND observer = 'inst2' THEN 1 ELSE qc_flag END AS qc_flag, count(*) AS n FROM ({QC_SQL}) GROUP BY 1, 2""", ("obs",))
def monitor_observers(i):
    m = Q.mark_monitors(Q.apply_rules(i("obs"), RULES), ["inst2"])
    return m.groupBy("observer", "qc_flag").agg(F.count(F.lit(1)).alias("n"))


KM = 1500.0
N_ROWS = max(1, round(180.0 / (KM / 6371.229 * 57.29577951308232)))
BIN_SQL = f"""b AS (SELECT *, least(floor((lat + 90)/(180e0/{N_ROWS})), {N_ROWS - 1}) AS r FROM obs),
c AS (SELECT *, (r + 0.5)*(180e0/{N_ROWS}) - 90 AS mid, greatest(floor(cos(radians((r + 0.5)*(180e0/{N_ROWS}) - 90))*(360.0/(180e0/{N_ROWS}))), 1) AS nc FROM b),
d AS (SELECT *, least(floor((((lon % 360) + 360) % 360)/360*nc), nc - 1) AS k FROM c),
f AS (SELECT *, radians(mid) AS la, radians((k + 0.5)*360/nc) AS lo FROM d),
g AS (SELECT *, power(cos(radians(lat))*cos(radians(lon)) - cos(la)*cos(lo), 2) + power(cos(radians(lat))*sin(radians(lon)) - cos(la)*sin(lo), 2) + power(sin(radians(lat)) - sin(la), 2) AS dist FROM f)"""


@query("thinning", ["loc_id", "observer"], f"WITH {BIN_SQL} SELECT arg_min(loc_id, dist) AS loc_id, observer FROM g GROUP BY observer, r, k", ("obs",))
def thinning(i):
    return Q.thin(i("obs"), KM, ["observer"])


@query("superob", ["observer", "CAST(bin_row AS BIGINT) AS bin_row", "CAST(bin_col AS BIGINT) AS bin_col", "ROUND(obs, 8) AS obs", "CAST(n_obs AS BIGINT) AS n_obs"], f"""
WITH {BIN_SQL} SELECT observer, r AS bin_row, k AS bin_col, avg(obs) AS obs, count(*) AS n_obs FROM g GROUP BY 1, 2, 3""", ("obs",))
def superob(i):
    return Q.superob(i("obs"), KM, ["observer"], ["obs"])


@query("time_window", ["channel", "CAST(n AS BIGINT) AS n"], """SELECT channel, count(*) AS n FROM obs WHERE obs_time >= TIMESTAMP '2024-01-10 09:00:00' AND obs_time < TIMESTAMP '2024-01-10 15:00:00' GROUP BY channel""", ("obs",))
def time_window(i):
    w = Q.in_window(i("obs"), F.lit("2024-01-10 12:00:00").cast("timestamp"), 6.0, 6.0)
    return w.groupBy("channel").agg(F.count(F.lit(1)).alias("n"))


@query("bias_guards", [*CH, "predictor", "enough", "ROUND(err, 7) AS err"], f"""
WITH s AS ({SUMS_SQL}), c AS ({_solve_sql()}) SELECT observer, channel, predictor, n_obs >= 55 AS enough, least(greatest(err, 0.02), 0.05) AS err FROM c""", ("obs",))
def bias_guards(i):
    sums = B.normal_sums(i("obs"), PRED, CH)
    return B.training_guards(sums, B.solve_bias(sums, PRED, CH), CH, min_obs=55, variance=(0.02, 0.05))
