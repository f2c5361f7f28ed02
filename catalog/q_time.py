"""Schedules, brackets, filling, day resolution."""
from __future__ import annotations

from pyspark.sql import functions as F

from catalog.registry import query
from gridspark.functions import dates as DT
from gridspark.operators import days as DY
from gridspark.operators import timeaxis as TA

BRACKET_COLS = ["series_id", "CAST(target AS STRING) AS target", "before_id", "after_id", "ROUND(alpha, 9) AS alpha", "kind"]
ASOF = """a AS (SELECT t.series_id, t.target, r.record_id AS b_id, r.valid_time AS b FROM targets t ASOF LEFT JOIN records r ON t.series_id = r.series_id AND r.valid_time <= t.target),
z AS (SELECT t.series_id, t.target, r.record_id AS a_id, r.valid_time AS a FROM targets t ASOF LEFT JOIN records r ON t.series_id = r.series_id AND r.valid_time >= t.target),
n AS (SELECT a.*, a_id, z.a, epoch(a.target) - epoch(b) AS db, epoch(z.a) - epoch(a.target) AS da FROM a JOIN z ON a.series_id = z.series_id AND a.target = z.target)"""


def _bracket_sql(method, gap):
    inside = f"b = a OR (b IS NOT NULL AND a IS NOT NULL AND da + db <= {gap})"
    if method == "linear":
        lo, hi, alpha, kind = "b_id", "a_id", "CASE WHEN a = b THEN 0 ELSE db/(da + db) END", "interpolated"
    elif method == "nearest":
        lo = hi = "CASE WHEN db <= da THEN b_id ELSE a_id END"
        alpha, kind = "0", "held"
    else:
        lo = hi = "b_id"
        alpha, kind = "0", "held"
    return f"""WITH {ASOF} SELECT series_id, target, CASE WHEN {inside} THEN {lo} END AS before_id, CASE WHEN {inside} THEN {hi} END AS after_id,
CASE WHEN {inside} THEN CAST({alpha} AS DOUBLE) END AS alpha,
CASE WHEN a = b THEN 'exact' WHEN a IS NULL OR b IS NULL THEN 'outside' WHEN da + db > {gap} THEN 'gap' ELSE '{kind}' END AS kind FROM n"""


def _register(method, gap):
    @query(f"bracket_{method}", BRACKET_COLS, _bracket_sql(method, gap), ("records", "targets"))
    def bracket(i):
        return TA.time_brackets(i("records"), i("targets"), method=method, max_gap_seconds=float(gap))


for _m, _g in (("linear", 200000), ("nearest", 200000), ("hold", 100000)):
    _register(_m, _g)

DAY_SQL = """WITH t AS (SELECT DISTINCT series_id, target, CAST(target AS DATE) AS d FROM targets), r AS (SELECT series_id, record_id, CAST(valid_time AS DATE) AS d FROM records),
a AS (SELECT t.*, r.record_id AS b_id, r.d AS b FROM t ASOF LEFT JOIN r ON t.series_id = r.series_id AND r.d <= t.d),
z AS (SELECT t.series_id, t.target, r.record_id AS a_id, r.d AS a FROM t ASOF LEFT JOIN r ON t.series_id = r.series_id AND r.d >= t.d)
SELECT a.series_id, a.target, coalesce(b_id, a_id) AS before_id, coalesce(a_id, b_id) AS after_id,
 CASE WHEN a IS NULL OR b IS NULL OR a = b THEN 0 ELSE CAST(date_diff('day', b, d) AS DOUBLE)/date_diff('day', b, a) END AS alpha,
 CASE WHEN a = b THEN 'exact' WHEN a IS NULL OR b IS NULL THEN 'extrapolated' ELSE 'interpolated' END AS kind
FROM a JOIN z ON a.series_id = z.series_id AND a.target = z.target"""


@query("bracket_calendar_day", BRACKET_COLS, DAY_SQL, ("records", "targets"))
def bracket_calendar_day(i):
    return TA.day_brackets(i("records"), i("targets"), extrapolate=True)


VALUES = """SELECT concat('s', CAST(user_id % 4 AS STRING)) AS series_id, CAST(CAST(ts AS DATE) AS STRING) AS record_id,
 user_id AS cell_id, event_type AS field, sum(value) AS value FROM events GROUP BY 1, 2, 3, 4"""


@query("time_interpolate", ["series_id", "CAST(target AS STRING) AS target", "field", "ROUND(value, 6) AS value", "CAST(n AS BIGINT) AS n"], f"""
WITH b AS (SELECT * FROM ({_bracket_sql('linear', 200000)}) WHERE before_id IS NOT NULL),
v AS ({VALUES}),
p AS (SELECT series_id, target, before_id AS record_id, 1 - alpha AS w FROM b UNION ALL SELECT series_id, target, after_id, alpha FROM b WHERE alpha > 0),
o AS (SELECT p.series_id, target, field, cell_id, sum(w*value) AS value FROM p JOIN v ON p.series_id = v.series_id AND p.record_id = v.record_id GROUP BY 1, 2, 3, 4)
SELECT series_id, target, field, sum(value) AS value, count(*) AS n FROM o GROUP BY 1, 2, 3""", ("records", "targets"))
def time_interpolate(i):
    b = TA.time_brackets(i("records"), i("targets"), max_gap_seconds=200000.0)
    out = TA.interpolate(i.sql(VALUES), b, ["field", "cell_id"])
    return out.groupBy("series_id", "target", "field").agg(F.sum("value").alias("value"), F.count(F.lit(1)).alias("n"))


@query("bracket_summary", ["series_id", "CAST(target_count AS BIGINT) AS target_count", "CAST(exact AS BIGINT) AS exact",
                           "CAST(interpolated AS BIGINT) AS interpolated", "CAST(held_or_nearest AS BIGINT) AS held_or_nearest",
                           "ROUND(largest_gap_hours, 6) AS largest_gap_hours"], f"""
WITH {ASOF} SELECT series_id, count(*) AS target_count, count(*) FILTER (a = b) AS exact, count(*) FILTER (a <> b) AS interpolated,
 count(*) FILTER (a IS NULL OR b IS NULL) AS held_or_nearest, coalesce(max(CASE WHEN a <> b THEN da + db END)/3600.0, 0) AS largest_gap_hours FROM n GROUP BY series_id""", ("records", "targets"))
def bracket_summary(i):
    return TA.bracket_summary(TA.time_brackets(i("records"), i("targets"), extrapolate=True))


@query("needed_records", ["series_id", "record_id"], f"""
WITH b AS ({_bracket_sql('hold', 100000)}) SELECT DISTINCT series_id, before_id AS record_id FROM b WHERE before_id IS NOT NULL""", ("records", "targets"))
def needed_records(i):
    return TA.needed_records(TA.time_brackets(i("records"), i("targets"), method="hold", max_gap_seconds=100000.0))


@query("fill_times", ["series_id", "CAST(target AS STRING) AS target", "ROUND(value, 6) AS value"], """
WITH t AS (SELECT DISTINCT series_id, unnest(range((SELECT CAST(min(valid_time) AS TIMESTAMP) FROM records), (SELECT CAST(max(valid_time) AS TIMESTAMP) FROM records) + INTERVAL 1 SECOND, INTERVAL 6 HOUR)) AS target FROM records),
a AS (SELECT t.*, r.value AS bv, r.valid_time AS b FROM t ASOF JOIN records r ON t.series_id = r.series_id AND r.valid_time <= t.target),
z AS (SELECT t.*, r.value AS av, r.valid_time AS a FROM t ASOF JOIN records r ON t.series_id = r.series_id AND r.valid_time >= t.target)
SELECT a.series_id, a.target, CASE WHEN a = b THEN bv ELSE bv + (av - bv)*(epoch(a.target) - epoch(b))/(epoch(a) - epoch(b)) END AS value
FROM a JOIN z ON a.series_id = z.series_id AND a.target = z.target""", ("records",))
def fill_times(i):
    r = i("records")
    start, end = i.span("SELECT valid_time FROM records", "valid_time", "records")
    filled, _ = TA.fill_times(r.select("series_id", "record_id", F.lit(0).alias("cell_id"), "value"), r.drop("value"),
                              start, end, 21600, ["cell_id"])
    return filled


@query("target_schedule_hourly", ["series_id", "CAST(target AS STRING) AS target"], """
SELECT DISTINCT series_id, unnest(range((SELECT CAST(min(valid_time) AS TIMESTAMP) FROM records), (SELECT CAST(max(valid_time) AS TIMESTAMP) FROM records) + INTERVAL 1 SECOND, INTERVAL 3 HOUR)) AS target FROM records""", ("records",))
def target_schedule_hourly(i):
    return TA.target_schedule(i("records"), *i.span("SELECT valid_time FROM records", "valid_time", "records"), "hourly", 3)


@query("target_schedule_daily", ["series_id", "CAST(target AS STRING) AS target"], """
SELECT DISTINCT series_id, unnest(range((SELECT CAST(min(valid_time) AS TIMESTAMP) FROM records), (SELECT CAST(max(valid_time) AS TIMESTAMP) FROM records) + INTERVAL 1 SECOND, INTERVAL 2 DAY)) AS target FROM records""", ("records",))
def target_schedule_daily(i):
    return TA.target_schedule(i("records"), *i.span("SELECT valid_time FROM records", "valid_time", "records"), "daily", 2)


@query("target_schedule_source", ["series_id", "CAST(target AS STRING) AS target"], "SELECT series_id, valid_time AS target FROM records", ("records",))
def target_schedule_source(i):
    return TA.target_schedule(i("records"), *i.span("SELECT valid_time FROM records", "valid_time", "records"), "source")


MONTHLY = """SELECT concat('c', CAST(o_custkey % 8 AS STRING)) AS series_id, CAST(o_orderdate AS TIMESTAMP) AS valid_time
FROM orders WHERE (o_custkey % 8 < 4) UNION
SELECT DISTINCT concat('c', CAST(o_custkey % 8 AS STRING)) AS series_id, CAST(date_trunc('month', o_orderdate) AS TIMESTAMP) + INTERVAL '15' DAY AS valid_time
FROM orders WHERE (o_custkey % 8 >= 4)"""


@query("target_schedule_monthly", ["series_id", "CAST(target AS STRING) AS target"], f"""
WITH r AS ({MONTHLY}), e AS (SELECT min(valid_time) AS a, max(valid_time) AS b FROM r),
m AS (SELECT DISTINCT series_id, unnest(range(date_trunc('month', (SELECT CAST(a AS TIMESTAMP) FROM e)), (SELECT CAST(b AS TIMESTAMP) FROM e) + INTERVAL 1 SECOND, INTERVAL 1 MONTH)) AS m FROM r),
p AS (SELECT m.series_id, m.m, count(r.valid_time) AS n, min(valid_time) AS at_ FROM m LEFT JOIN r ON r.series_id = m.series_id AND date_trunc('month', r.valid_time) = m.m GROUP BY 1, 2),
k AS (SELECT series_id, bool_and(n = 1) AS anchored FROM p GROUP BY 1)
SELECT p.series_id, CASE WHEN anchored THEN at_ ELSE m END AS target FROM p JOIN k ON p.series_id = k.series_id
WHERE CASE WHEN anchored THEN true ELSE m >= (SELECT a FROM e) END""")
def target_schedule_monthly(i):
    return TA.target_schedule(i.sql(MONTHLY), *i.span(MONTHLY, "valid_time"), "monthly")


# one series per nation and year; a third of the nations have no May, and another third's January also closes the year before
TOKENS = """SELECT concat('c', CAST(c_nationkey AS STRING)) AS series_id, y AS year, CAST(date_trunc('month', o_orderdate) AS TIMESTAMP) AS target
FROM (SELECT *, CAST(extract(year FROM o_orderdate) AS INT) AS y FROM orders
      UNION ALL SELECT *, CAST(extract(year FROM o_orderdate) AS INT) - 1 AS y FROM orders WHERE extract(month FROM o_orderdate) = 1) o
JOIN customer ON o_custkey = c_custkey WHERE (c_nationkey % 3 <> 1 OR extract(month FROM o_orderdate) <> 5) AND (c_nationkey % 3 = 2 OR extract(year FROM o_orderdate) = y)
GROUP BY 1, 2, 3"""


@query("period_token", ["series_id", "year", "period"], f"""
SELECT series_id, year, CASE WHEN count(DISTINCT CASE WHEN year(target) = year THEN month(target) END) = 12 THEN CAST(year AS VARCHAR)
 ELSE strftime(min(target), '%Y%m%d') || '-' || strftime(max(target), '%Y%m%d') END AS period FROM ({TOKENS}) GROUP BY series_id, year""")
def period_token(i):
    return TA.period_token(i.sql(TOKENS), "year")


@query("duplicate_times", ["series_id", "CAST(claimed AS STRING) AS claimed", "CAST(n AS BIGINT) AS n"], """
SELECT o_orderpriority AS series_id, o_orderdate AS claimed, count(*) AS n FROM orders GROUP BY 1, 2 HAVING count(*) > 1""")
def duplicate_times(i):
    return TA.duplicate_times(i.sql("SELECT o_orderpriority AS series_id, CAST(o_orderdate AS TIMESTAMP) AS valid_time FROM orders"))


@query("date_helpers", ["o_orderkey", "plus6", "label", "CAST(n_back AS INT) AS n_back", "first_back", "prev_hour", "CAST(parsed AS STRING) AS parsed"], """
SELECT o_orderkey, strftime(d + INTERVAL 6 HOUR, '%Y%m%d%H') AS plus6, strftime(d, '%Y-%m-%d_%H') AS label, o_orderkey % 5 AS n_back,
 CASE WHEN o_orderkey % 5 > 0 THEN strftime(d + to_hours(CAST(6*(o_orderkey % 5) AS BIGINT)), '%Y%m%d%H') END AS first_back,
 'T' || lpad(CAST((o_orderkey % 24 + 18) % 24 AS VARCHAR), 2, '0') AS prev_hour, d AS parsed
FROM (SELECT o_orderkey, o_orderdate + to_hours(CAST(o_orderkey % 24 AS BIGINT)) AS d FROM orders)""")
def date_helpers(i):
    df = i.sql("SELECT o_orderkey, CAST(o_orderdate AS TIMESTAMP) + make_dt_interval(0, CAST(o_orderkey % 24 AS INT)) AS d FROM orders")
    stamp = F.date_format("d", "yyyyMMddHH")
    end = DT.stamp_hours(stamp, F.col("n") * 6)
    df = df.withColumn("n", (F.col("o_orderkey") % 5).cast("int")).withColumn("back", DT.stamps_back(stamp, end, 6))
    return df.select(
        "o_orderkey", DT.stamp_hours(stamp, 6).alias("plus6"), DT.reformat_stamp(stamp, "yyyyMMddHH", "yyyy-MM-dd_HH").alias("label"),
        F.size("back").alias("n_back"), F.get("back", F.lit(0)).alias("first_back"),
        DT.previous_hour_label(F.concat(F.lit("xT"), F.date_format("d", "HH")), 6).alias("prev_hour"),
        DT.parse_time(F.when(F.col("o_orderkey") % 2 == 0, F.date_format("d", "yyyy-MM-dd_HH:mm:ss")).otherwise(F.concat(F.date_format("d", "yyyy-MM-dd'T'HH:mm"), F.lit("Z")))).alias("parsed"))


@query("source_date", ["o_orderkey", "CAST(d AS STRING) AS d"], """
SELECT o_orderkey, CASE WHEN month(o_orderdate) = 2 AND day(o_orderdate) = 29 THEN DATE '2019-02-28' ELSE make_date(2019, month(o_orderdate), day(o_orderdate)) END AS d FROM orders""")
def source_date_query(i):
    return i.table("orders").withColumn("d", DT.source_date(F.col("o_orderdate"), 2019))


@query("restamp_state", ["member", "CAST(valid_time AS STRING) AS valid_time", "CAST(n AS BIGINT) AS n"], """
SELECT member, TIMESTAMP '2024-09-01 06:00:00' AS valid_time, count(*) AS n FROM state GROUP BY member""", ("state",))
def restamp_state(i):
    out = DT.restamp(i("state"), "2024-09-01 06:00:00")
    return out.groupBy("member", "valid_time").agg(F.count(F.lit(1)).alias("n"))


AVAILABLE = """SELECT DISTINCT concat('n', CAST(c_nationkey AS STRING)) AS series_id, CAST(o_orderdate AS DATE) AS day,
 CASE WHEN o_orderkey % 3 = 0 THEN 'fallback' ELSE 'primary' END AS source FROM orders JOIN customer ON o_custkey = c_custkey"""
CALENDAR = """c AS (SELECT DISTINCT series_id, CAST(unnest(range((SELECT CAST(min(day) AS TIMESTAMP) FROM a), (SELECT CAST(max(day) AS TIMESTAMP) FROM a) + INTERVAL 1 SECOND, INTERVAL 1 DAY)) AS DATE) AS day FROM a),
p AS (SELECT * FROM a WHERE source = 'primary'), f AS (SELECT * FROM a WHERE source = 'fallback'),
x AS (SELECT c.*, p.day IS NOT NULL AS p, f.day IS NOT NULL AS f FROM c LEFT JOIN p ON p.series_id = c.series_id AND p.day = c.day LEFT JOIN f ON f.series_id = c.series_id AND f.day = c.day),
y AS (SELECT x.*, q.day AS b FROM x ASOF LEFT JOIN p q ON q.series_id = x.series_id AND q.day < x.day),
w AS (SELECT y.*, q.day AS n FROM y ASOF LEFT JOIN p q ON q.series_id = y.series_id AND q.day > y.day)"""
DAY_COLS = ["series_id", "CAST(day AS STRING) AS day", "status", "CAST(before_day AS STRING) AS before_day", "CAST(after_day AS STRING) AS after_day", "ROUND(alpha, 9) AS alpha"]
RESOLVE = f"""WITH a AS ({AVAILABLE}), {CALENDAR},
s AS (SELECT *, CASE WHEN day BETWEEN DATE '1996-03-01' AND DATE '1996-03-10' THEN CASE WHEN f THEN 'fallback-forced' ELSE 'missing-forced' END
 WHEN p THEN 'primary' WHEN date_diff('day', b, n) - 1 <= 2 THEN 'linear:' || CAST(b AS VARCHAR) || '->' || CAST(n AS VARCHAR) WHEN f THEN 'fallback' ELSE 'missing' END AS status FROM w)
SELECT series_id, day, status, CASE WHEN status LIKE 'linear%' THEN b END AS before_day, CASE WHEN status LIKE 'linear%' THEN n END AS after_day,
 CASE WHEN status LIKE 'linear%' THEN CAST(date_diff('day', b, day) AS DOUBLE)/date_diff('day', b, n) END AS alpha FROM s"""


def _calendar(i, available):
    return DY.day_calendar(*i.span(AVAILABLE, "day"), available.select("series_id").distinct())


@query("day_resolution", DAY_COLS, RESOLVE)
def day_resolution(i):
    a = i.sql(AVAILABLE)
    return DY.resolve_days(_calendar(i, a), a, max_missing=2, forced=[("1996-03-01", "1996-03-10")])


SIZE_AVAILABLE = AVAILABLE.replace("WHEN o_orderkey % 3 = 0 THEN 'fallback'", "WHEN o_orderkey % 3 = 0 THEN 'fallback' WHEN o_orderkey % 3 = 1 THEN 'dedicated'")


@query("fire_size_day_resolution", DAY_COLS, f"""WITH a AS ({SIZE_AVAILABLE}), {CALENDAR.replace("p AS (SELECT * FROM a WHERE source = 'primary')", "p AS (SELECT DISTINCT series_id, day FROM a WHERE source <> 'fallback'), d AS (SELECT * FROM a WHERE source = 'dedicated')")},
s AS (SELECT w.*, CASE WHEN w.day BETWEEN DATE '1996-03-01' AND DATE '1996-03-10' AND f THEN 'fallback-area-forced' WHEN d.day IS NOT NULL THEN 'dedicated' WHEN p THEN 'primary-area' WHEN f THEN 'fallback-area'
 WHEN date_diff('day', b, n) - 1 <= 2 THEN 'linear:' || CAST(b AS VARCHAR) || '->' || CAST(n AS VARCHAR) ELSE 'missing' END AS status FROM w LEFT JOIN d ON d.series_id = w.series_id AND d.day = w.day)
SELECT series_id, day, status, CASE WHEN status LIKE 'linear%' THEN b END AS before_day, CASE WHEN status LIKE 'linear%' THEN n END AS after_day,
 CASE WHEN status LIKE 'linear%' THEN CAST(date_diff('day', b, day) AS DOUBLE)/date_diff('day', b, n) END AS alpha FROM s""")
def fire_size_day_resolution(i):
    a = i.sql(SIZE_AVAILABLE)
    return DY.resolve_fire_size_days(_calendar(i, a), a, max_missing=2, forced=[("1996-03-01", "1996-03-10")])


DAY_VALUES = """SELECT concat('n', CAST(c_nationkey AS STRING)) AS series_id, CAST(o_orderdate AS DATE) AS day,
 CASE WHEN o_orderkey % 3 = 0 THEN 'fallback' ELSE 'primary' END AS source, o_custkey AS cell_id, sum(o_totalprice) AS value
FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2, 3, 4"""


@query("day_fill", ["series_id", "CAST(day AS STRING) AS day", "CAST(cell_id AS BIGINT) AS cell_id", "ROUND(value, 4) AS value"], f"""
WITH r AS ({RESOLVE}), v AS ({DAY_VALUES}),
p AS (SELECT series_id, day, CASE WHEN status LIKE 'fallback%' THEN 'fallback' ELSE 'primary' END AS source, day AS sd, 1.0 AS w FROM r WHERE status IN ('primary', 'fallback', 'fallback-forced')
 UNION ALL SELECT series_id, day, 'primary', before_day, 1 - alpha FROM r WHERE alpha IS NOT NULL UNION ALL SELECT series_id, day, 'primary', after_day, alpha FROM r WHERE alpha IS NOT NULL)
SELECT p.series_id, p.day, cell_id, sum(w*value) AS value FROM p JOIN v ON v.series_id = p.series_id AND v.source = p.source AND v.day = p.sd GROUP BY 1, 2, 3""")
def day_fill(i):
    a = i.sql(AVAILABLE)
    r = DY.resolve_days(_calendar(i, a), a, max_missing=2, forced=[("1996-03-01", "1996-03-10")])
    return DY.fill_days(i.sql(DAY_VALUES), r, ["cell_id"])


@query("even_days", ["series_id", "CAST(day AS STRING) AS day"], f"""
WITH d AS (SELECT DISTINCT series_id, day FROM ({AVAILABLE})),
k AS (SELECT *, row_number() OVER (PARTITION BY series_id ORDER BY day) - 1 AS pos, count(*) OVER (PARTITION BY series_id) AS n FROM d)
SELECT series_id, day FROM k WHERE n <= 40 OR pos IN (SELECT CAST(round_even(i*(n - 1)/39.0, 0) AS BIGINT) FROM (SELECT unnest(range(40)) AS i))""")
def even_days(i):
    return DY.even_days(i.sql(AVAILABLE), 40)


FB = """SELECT day, concat('f', CAST(fire_id % 3 AS STRING)) AS field, cell_id, sum({}) AS value FROM located WHERE cell_id >= 0 AND fire_id % 5 {} GROUP BY 1, 2, 3"""


# orders span far more days than any limit on overlap days
FB_LONG = """SELECT CAST(o_orderdate AS DATE) AS day, concat('f', CAST(o_custkey % 3 AS STRING)) AS field, o_custkey % (SELECT count(*) FROM supplier) AS cell_id,
 sum(o_totalprice) AS value FROM orders WHERE o_orderkey % 2 = {} GROUP BY 1, 2, 3"""


@query("fallback_ratio_all_days", ["field", "ROUND(factor, 8) AS factor"], f"""
WITH p AS ({FB_LONG.format(0)}), f AS ({FB_LONG.format(1)}),
a AS (SELECT p.day, field, sum(value*area_m2) AS num FROM p JOIN mesh m ON m.cell_id = p.cell_id GROUP BY 1, 2),
b AS (SELECT f.day, field, sum(value*area_m2) AS den FROM f JOIN mesh m ON m.cell_id = f.cell_id GROUP BY 1, 2)
SELECT a.field, least(greatest(quantile_cont(num/den, 0.5), 0.25), 4.0) AS factor FROM a JOIN b ON a.day = b.day AND a.field = b.field WHERE den > 0 GROUP BY a.field""", ("mesh",))
def fallback_ratio_all_days(i):
    return DY.fallback_factors(i.sql(FB_LONG.format(0)), i.sql(FB_LONG.format(1)), i("mesh"), ["f0", "f1", "f2"])


@query("fallback_ratio", ["field", "ROUND(factor, 8) AS factor"], f"""
WITH p AS ({FB.format('co', '< 3')}), f AS ({FB.format('frp/4', '>= 3')}),
a AS (SELECT p.day, field, sum(value*area_m2) AS num FROM p JOIN mesh m ON m.cell_id = p.cell_id GROUP BY 1, 2),
b AS (SELECT f.day, field, sum(value*area_m2) AS den FROM f JOIN mesh m ON m.cell_id = f.cell_id GROUP BY 1, 2)
SELECT a.field, least(greatest(quantile_cont(num/den, 0.5), 0.25), 4.0) AS factor FROM a JOIN b ON a.day = b.day AND a.field = b.field WHERE den > 0 GROUP BY a.field""", ("located", "mesh"))
def fallback_ratio(i):
    p, f = i.sql(FB.format("co", "< 3"), "located"), i.sql(FB.format("frp/4", ">= 3"), "located")
    return DY.fallback_factors(p, f, i("mesh"), ["f0", "f1", "f2"])


@query("provenance", ["series_id", "CAST(target_count AS BIGINT) AS target_count", "CAST(exact AS BIGINT) AS exact", "inventory", "scaling", "offset_hours"], f"""
WITH {ASOF} SELECT series_id, count(*) AS target_count, count(*) FILTER (a = b) AS exact, 'blend' AS inventory, '{{"default": 0.5}}' AS scaling, -24e0 AS offset_hours FROM n GROUP BY series_id""", ("records", "targets"))
def provenance(i):
    from gridspark.sources.products import inventory_provenance
    summary = TA.bracket_summary(TA.time_brackets(i("records"), i("targets"), extrapolate=True))
    return inventory_provenance(summary, {"inventory": "blend", "scaling": {"default": 0.5}, "offset_hours": -24.0})
