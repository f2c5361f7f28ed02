"""End-to-end jobs and streams."""
from __future__ import annotations

import dataclasses
import uuid

from pyspark.sql import functions as F

from catalog.q_obs import CH, CHANNELS, DA_SQL, ERR, KM, PRED, QC_SQL, RULES, SUMS_SQL, _solve_sql  # noqa: F401
from catalog.q_points import AXIS, CAT, LAT_AXIS, LON_AXIS, TURNED, boxes, overlap_sql
from catalog.q_state import COLD, WARM
from catalog.q_weights import GRIDS, IDENT_SQL, PROFILE, SECTORS
from catalog.registry import query
from gridspark.operators import mesh as M
from gridspark.operators import weights as W
from gridspark.plans import fires as FP
from gridspark.plans import inventories as IP
from gridspark.plans import model_state as MP
from gridspark.plans import observations as OP
from gridspark.plans import refresh as RF
from gridspark.session import settle, work_dir
from gridspark.sources import products as PR
from gridspark.streaming import departures as SD
from gridspark.streaming import ledger as SL

# one record per ship date; the 11th of a month is left out so that there are gaps to fill
SLABS = """SELECT 's' AS series_id, CAST(CAST(l_shipdate AS DATE) AS STRING) AS record_id, l_partkey AS src_id, sum(l_quantity) AS a, CAST(sum(CAST(round(l_discount*100) AS BIGINT)) AS DOUBLE) AS b FROM lineitem
WHERE extract(day FROM l_shipdate) <> 11 GROUP BY 1, 2, 3"""
SLAB_RECORDS = """SELECT DISTINCT 's' AS series_id, CAST(CAST(l_shipdate AS DATE) AS STRING) AS record_id, CAST(CAST(l_shipdate AS DATE) AS TIMESTAMP) AS valid_time FROM lineitem
WHERE extract(day FROM l_shipdate) <> 11"""
SPECS = [IP.FieldSpec("bc_total", (("a", 1.0), ("b", 2.0))), IP.FieldSpec("nh3_total", (("b", 1.0),), "kg m-2 s-1", "kg m^-2 s^-1")]


# times pi: the values are short decimals, which would often lie halfway between two roundings
@query("job_regular_inventory", ["CAST(valid_time AS STRING) AS valid_time", "field", "CAST(cell_id AS BIGINT) AS cell_id", "ROUND(value*pi(), 9) AS value"], f"""
WITH v AS (SELECT record_id, src_id, a + 2e0*b AS x, b AS y FROM ({SLABS})), r AS (SELECT * FROM ({SLAB_RECORDS})),
t AS (SELECT unnest(range((SELECT min(valid_time) FROM r), (SELECT max(valid_time) FROM r) + INTERVAL 1 SECOND, INTERVAL 24 HOUR)) AS target),
p AS (SELECT t.target, r.record_id, r.valid_time AS b FROM t ASOF JOIN r ON r.valid_time <= t.target), n AS (SELECT t.target, r.record_id, r.valid_time AS a FROM t ASOF JOIN r ON r.valid_time >= t.target),
k AS (SELECT p.target, p.record_id AS lo, n.record_id AS hi, CASE WHEN a = b THEN 0 ELSE (epoch(p.target) - epoch(b))/(epoch(a) - epoch(b)) END AS al FROM p JOIN n ON p.target = n.target),
l AS (SELECT target, lo AS record_id, 1 - al AS w FROM k UNION ALL SELECT target, hi, al FROM k WHERE al > 0),
m AS (SELECT record_id, dst_id, sum(s*x)*0.37e0 AS fx, sum(s*y)*0.37e0*3 AS fy FROM v JOIN weights w ON w.src_id = v.src_id GROUP BY 1, 2),
o AS (SELECT target, dst_id, sum(w*fx) AS fx, sum(w*fy) AS fy FROM l JOIN m ON m.record_id = l.record_id GROUP BY 1, 2)
SELECT target AS valid_time, 'bc_total' AS field, dst_id AS cell_id, fx AS value FROM o UNION ALL SELECT target, 'nh3_total', dst_id, fy FROM o""", ("weights",))
def job_regular_inventory(i):
    time = IP.TimeSpec(*i.span(SLAB_RECORDS, "valid_time"), "hourly", 24.0)
    return IP.regular_inventory(i.sql(SLABS), i.sql(SLAB_RECORDS), i("weights"), None, None, SPECS, time,
                                [{"default": 0.37}, {"species": {"NH3": 3.0}}]).values


# a record per month that holds every part, but for NaN at one part in 41 and, in July, without one part in 37
FULL_SLABS = """SELECT m.series_id, m.record_id, p.p_partkey AS src_id, CASE WHEN (p.p_partkey + m.k) % 41 = 7 THEN CAST('NaN' AS DOUBLE) ELSE p.p_retailprice END AS a, CAST(p.p_size AS DOUBLE) AS b
FROM (SELECT DISTINCT 's' AS series_id, substring(CAST(CAST(l_shipdate AS DATE) AS STRING), 1, 7) AS record_id, CAST(extract(month FROM l_shipdate) AS INT) AS k FROM lineitem) m
JOIN part p ON m.k % 3 = 1 AND (m.k <> 7 OR p.p_partkey % 37 <> 5)"""
FULL_RECORDS = """SELECT DISTINCT 's' AS series_id, substring(CAST(CAST(l_shipdate AS DATE) AS STRING), 1, 7) AS record_id, CAST(date_trunc('month', l_shipdate) AS TIMESTAMP) AS valid_time FROM lineitem
WHERE extract(month FROM l_shipdate) % 3 = 1"""


@query("job_regular_inventory_violations", ["rule", "record_id", "field", "CAST(n AS BIGINT) AS n"], f"""
WITH s AS ({FULL_SLABS}), u AS (SELECT record_id, src_id, 'bc_total' AS field, a + 2e0*b AS v FROM s UNION ALL SELECT record_id, src_id, 'nh3_total', b FROM s)
SELECT 'missing_value' AS rule, record_id, field, count(*) FILTER (isnan(v)) AS n FROM u GROUP BY 2, 3 HAVING count(*) FILTER (isnan(v)) > 0
UNION ALL SELECT 'source_length', record_id, field, count(*) FROM u GROUP BY 2, 3 HAVING count(*) <> (SELECT count(*) FROM part)""", ("weights",))
def job_regular_inventory_violations(i):
    time = IP.TimeSpec(*i.span(FULL_RECORDS, "valid_time"), "source")
    found = IP.regular_inventory(i.sql(FULL_SLABS), i.sql(FULL_RECORDS), i("weights"), None, None, SPECS, time, n_src=i.table("part").count()).violations
    # a destination whose only source is missing is a nonfinite value as well; that rule has a query of its own
    fields = F.from_json("detail", "record_id string, field string, n_bad bigint, n_values bigint")
    return found.filter(F.col("rule").isin("missing_value", "source_length")).withColumn("d", fields).select("rule", "d.record_id", "d.field", F.coalesce("d.n_bad", "d.n_values").alias("n"))


# links of some cells are missing, some are one percent off, and the files of the inventory are not all on one grid
BAD_LINKS = "SELECT dst_id, src_id, CASE WHEN src_id % 5 = 0 THEN s*1.01E0 ELSE s END AS s FROM weights WHERE dst_id % 9 <> 4"
GUARD_COLS = ["rule", "what", "CAST(n AS BIGINT) AS n"]
GUARD_SQL = f"""WITH b AS ({BAD_LINKS}), g AS (SELECT grid_id, fingerprint FROM ({IDENT_SQL}))
SELECT 'weights' AS rule, 'row_sum' AS what, 1 AS n WHERE (SELECT max(abs(t - 1.0)) FROM (SELECT sum(s) AS t FROM b GROUP BY dst_id)) > 5e-10
UNION ALL SELECT 'weights', 'missing_destination', (SELECT count(*) FROM supplier) - count(DISTINCT dst_id) FROM b WHERE dst_id < (SELECT count(*) FROM supplier) HAVING (SELECT count(*) FROM supplier) > count(DISTINCT dst_id)
UNION ALL SELECT 'weights', 'index_outside', count(*) FROM b WHERE dst_id >= (SELECT count(*) FROM supplier) OR src_id >= (SELECT count(*) FROM part) HAVING count(*) > 0
UNION ALL SELECT 'source_grid', grid_id, NULL FROM g WHERE fingerprint <> (SELECT arg_min(fingerprint, grid_id) FROM g)"""


def _guarded(found):
    d = F.from_json("detail", "rule string, n bigint, grid_id string")
    return found.where(F.col("rule").isin("weights", "source_grid")).withColumn("d", d).select("rule", F.coalesce("d.rule", "d.grid_id").alias("what"), "d.n")


def _guard(i):
    return IP.Guard(n_src=i.table("part").count(), n_dst=i.table("supplier").count(), grids=M.grid_identity(i.sql(GRIDS)))


@query("job_regular_inventory_guard_violations", GUARD_COLS, GUARD_SQL, ("weights",))
def job_regular_inventory_guard_violations(i):
    time = IP.TimeSpec(*i.span(FULL_RECORDS, "valid_time"), "source")
    return _guarded(IP.regular_inventory(i.sql(FULL_SLABS), i.sql(FULL_RECORDS), i.sql(BAD_LINKS, "weights"), None, None, SPECS, time, guard=_guard(i)).violations)


@query("job_sectoral_inventory_guard_violations", GUARD_COLS, GUARD_SQL, ("weights",))
def job_sectoral_inventory_guard_violations(i):
    parts = i.sql(SECTORS)
    total = parts.groupBy("month", "src_id").agg(F.sum("value").alias("value")).withColumn("sector", F.lit("sum"))
    return _guarded(IP.sectoral_inventory(parts.unionByName(total), i.sql(BAD_LINKS, "weights"), ["awb"], {"ene": 1.5}, {"default": 0.5}, "nh3", "nh3_anth", guard=_guard(i)).violations)


# a record per year of shipping and a target every 50 days between them
YEAR_SLABS = """SELECT 's' AS series_id, CAST(y.k AS STRING) AS record_id, p.p_partkey AS src_id, p.p_retailprice + y.k AS a, CAST(p.p_size AS DOUBLE) AS b
FROM (SELECT DISTINCT CAST(extract(year FROM l_shipdate) AS INT) AS k FROM lineitem) y JOIN part p ON p.p_partkey >= 0"""
YEAR_RECORDS = """SELECT DISTINCT 's' AS series_id, CAST(CAST(extract(year FROM l_shipdate) AS INT) AS STRING) AS record_id, CAST(date_trunc('year', l_shipdate) AS TIMESTAMP) AS valid_time FROM lineitem"""


@query("job_inventory_refresh", ["CAST(valid_time AS STRING) AS valid_time", "field", "CAST(cell_id AS BIGINT) AS cell_id", "ROUND(CAST(value AS DOUBLE), 3) AS value", "CAST(n_computed AS BIGINT) AS n_computed", "CAST(n_kept AS BIGINT) AS n_kept"], f"""
WITH v AS (SELECT record_id, src_id, a + 2e0*b AS x, b AS y FROM ({YEAR_SLABS})), r AS (SELECT * FROM ({YEAR_RECORDS})),
t AS (SELECT unnest(range((SELECT min(valid_time) FROM r), (SELECT max(valid_time) FROM r) + INTERVAL 1 SECOND, INTERVAL 1200 HOUR)) AS target),
p AS (SELECT t.target, r.record_id, r.valid_time AS b FROM t ASOF JOIN r ON r.valid_time <= t.target), n AS (SELECT t.target, r.record_id, r.valid_time AS a FROM t ASOF JOIN r ON r.valid_time >= t.target),
k AS (SELECT p.target, p.record_id AS lo, n.record_id AS hi, CASE WHEN a = b THEN 0 ELSE (epoch(p.target) - epoch(b))/(epoch(a) - epoch(b)) END AS al FROM p JOIN n ON p.target = n.target),
l AS (SELECT target, lo AS record_id, 1 - al AS w FROM k UNION ALL SELECT target, hi, al FROM k WHERE al > 0),
m AS (SELECT record_id, dst_id, sum(s*x) AS fx, sum(s*y)*3 AS fy FROM v JOIN weights w ON w.src_id = v.src_id GROUP BY 1, 2),
o AS (SELECT target, dst_id, sum(w*fx) AS fx, sum(w*fy) AS fy FROM l JOIN m ON m.record_id = l.record_id GROUP BY 1, 2),
c AS (SELECT max(record_id) AS last FROM r), d AS (SELECT count(*) FILTER (lo = last OR hi = last) AS n_computed, count(*) FILTER (lo <> last AND hi <> last) AS n_kept FROM k, c)
SELECT target AS valid_time, 'bc_total' AS field, dst_id AS cell_id, CAST(fx AS FLOAT) AS value, n_computed, n_kept FROM o, d UNION ALL SELECT target, 'nh3_total', dst_id, CAST(fy AS FLOAT), n_computed, n_kept FROM o, d""", ("weights",))
def job_inventory_refresh(i):
    """A product made while the last record was another, then brought up to date: the targets beside that record are computed again, the others kept."""
    path = f"{work_dir(i.spark)}/gridspark/product/{uuid.uuid4().hex}"
    time = IP.TimeSpec(*i.span(YEAR_RECORDS, "valid_time"), "hourly", 1200.0)
    wide, records, links = i.sql(YEAR_SLABS), settle(i.sql(YEAR_RECORDS)), settle(i("weights"))  # both runs read them
    last = records.agg(F.max("record_id")).first()[0]
    older = wide.withColumn("a", F.when(F.col("record_id") == last, F.col("a") * 2).otherwise(F.col("a")))
    for source in (older, wide):
        done = RF.refresh_inventory(path, source, records, links, None, None, SPECS, time, [{"species": {"NH3": 3.0}}])
    return PR.read_product(i.spark, path).select("valid_time", "field", "cell_id", "value", F.lit(len(done.computed)).alias("n_computed"), F.lit(len(done.kept)).alias("n_kept"))


@query("job_sectoral_inventory", ["month", "field", "CAST(cell_id AS BIGINT) AS cell_id", "ROUND(value, 4) AS value"], f"""
WITH p AS (SELECT month, src_id, sector, value FROM ({SECTORS})),
a AS (SELECT month, src_id, 'nh3_anth_' || sector AS field, CASE sector WHEN 'awb' THEN 0 WHEN 'ene' THEN value*0.5*1.5 ELSE value*0.5 END AS value FROM p
 UNION ALL SELECT month, src_id, 'nh3_anth_sum', sum(CASE sector WHEN 'awb' THEN 0 WHEN 'ene' THEN value*1.5 ELSE value END)*0.5 FROM p GROUP BY 1, 2)
SELECT month, field, dst_id AS cell_id, sum(s*value) AS value FROM a JOIN weights w ON w.src_id = a.src_id GROUP BY 1, 2, 3""", ("weights",))
def job_sectoral_inventory(i):
    parts = i.sql(SECTORS)
    total = parts.groupBy("month", "src_id").agg(F.sum("value").alias("value")).withColumn("sector", F.lit("sum"))
    return IP.sectoral_inventory(parts.unionByName(total), i("weights"), ["awb"], {"ene": 1.5}, {"default": 0.5}, "nh3", "nh3_anth").values


FIRES = """SELECT *, CASE WHEN fire_id % 10 = 0 THEN 'fallback' WHEN fire_id % 10 = 1 THEN 'dedicated' ELSE 'primary' END AS source FROM fires
WHERE NOT (extract(day FROM day) IN (9, 17, 18, 19) AND fire_id % 10 <> 0)"""
# days 9 and 17 to 19 of the primary source are left out above so that there are gaps to resolve
PLAN = FP.FirePlan("", "", {"co": "e_co", "bc": "e_bc"}, {"e_co": "gas", "e_bc": "aerosol"}, tuple(PROFILE),
                   {"e_co": 0.7}, max_missing=1, forced=(("2024-01-05", "2024-01-06"),))


def _plan(i, **change):
    """The plan over the days of the fire records."""
    start, end = i.span("SELECT day FROM fires", "day", "fires")
    return dataclasses.replace(PLAN, start=start, end=end, **change)


NEAR = """p AS (SELECT f.*, cos(radians(lat))*cos(radians(lon)) AS x, cos(radians(lat))*sin(radians(lon)) AS y, sin(radians(lat)) AS z FROM ({}) f),
c AS (SELECT cell_id, cos(lat)*cos(lon) AS x, cos(lat)*sin(lon) AS y, sin(lat) AS z FROM mesh),
near AS (SELECT fire_id, arg_min(c.cell_id, power(p.x - c.x, 2) + power(p.y - c.y, 2) + power(p.z - c.z, 2)) AS cell_id FROM p CROSS JOIN c GROUP BY fire_id),
loc AS (SELECT p.*, near.cell_id FROM p JOIN near ON near.fire_id = p.fire_id)"""
DAY_OF = "CASE WHEN day(d) IN (5, 6, 17, 18, 19) THEN 'fallback' ELSE 'primary' END"


@query("job_fire_emissions", ["CAST(valid_time AS STRING) AS valid_time", "field", "cell_id", "ROUND(value/1e6, 5) AS value"], f"""
WITH {NEAR.format(FIRES)}, g AS (SELECT source, day, l.cell_id, sum(co)/86400*6.022e23/(area_m2*1e4)*0.7 AS e_co, sum(bc)*1000/12/86400*6.022e23/(area_m2*1e4) AS e_bc FROM loc l JOIN mesh m ON m.cell_id = l.cell_id
 WHERE source <> 'dedicated' GROUP BY source, day, l.cell_id, area_m2),
u AS (SELECT source, day, cell_id, 'e_co' AS field, e_co AS value FROM g UNION ALL SELECT source, day, cell_id, 'e_bc', e_bc FROM g),
d AS (SELECT CAST(unnest(range((SELECT CAST(min(day) AS TIMESTAMP) FROM fires), (SELECT CAST(max(day) AS TIMESTAMP) FROM fires) + INTERVAL 1 SECOND, INTERVAL 1 DAY)) AS DATE) AS d),
w AS (SELECT d, {DAY_OF} AS source, d AS sd, 1.0 AS w FROM d WHERE day(d) <> 9 UNION ALL SELECT d, 'primary', d + (k - 1)::INT, 0.5 FROM d, (SELECT unnest([0, 2]) AS k) WHERE day(d) = 9),
r AS (SELECT d, field, cell_id, sum(w*value) AS value FROM w JOIN u ON u.source = w.source AND u.day = w.sd GROUP BY 1, 2, 3)
SELECT CAST(d AS TIMESTAMP) + to_hours(CAST(h AS BIGINT)) AS valid_time, field, r.cell_id,
 value*list_extract({PROFILE}, CAST((h + ((CAST(round_even(degrees(lon)/15, 0) AS INT) % 24) + 24) % 24) % 24 AS INT) + 1)/{sum(PROFILE)!r}*24 AS value
FROM r JOIN mesh m ON m.cell_id = r.cell_id CROSS JOIN (SELECT unnest(range(24)) AS h)""", ("fires", "mesh"))
def job_fire_emissions(i):
    return FP.fire_emissions(i.sql(FIRES, "fires"), i("mesh"), _plan(i), boxes(i))["hourly"].values


@query("job_fire_emissions_ratio", ["method", "field", "ROUND(factor, 6) AS factor"], f"""
WITH {NEAR.format(FIRES)}, g AS (SELECT source, day, l.cell_id, sum(co)*0.7 AS e_co, sum(bc)*1000/12 AS e_bc FROM loc l JOIN mesh m ON m.cell_id = l.cell_id WHERE source <> 'dedicated' GROUP BY 1, 2, 3),
u AS (SELECT source, day, 'e_co' AS field, sum(e_co) AS value FROM g GROUP BY 1, 2 UNION ALL SELECT source, day, 'e_bc', sum(e_bc) FROM g GROUP BY 1, 2),
r AS (SELECT p.field, p.value/f.value AS ratio FROM u p JOIN u f ON p.day = f.day AND p.field = f.field WHERE p.source = 'primary' AND f.source = 'fallback' AND f.value > 0)
SELECT 'robust_median_ratio' AS method, field, least(greatest(quantile_cont(ratio, 0.5), 0.5), 6.0) AS factor FROM r GROUP BY field
UNION ALL SELECT 'fixed', 'e_co', 1.25e0 UNION ALL SELECT 'fixed', 'e_bc', 0.8e0""", ("fires", "mesh"))
def job_fire_emissions_ratio(i):
    out, fires, mesh = None, i.sql(FIRES, "fires"), i("mesh")
    located = FP.locate_fires(fires, mesh, _plan(i), boxes(i))
    for change in ({"scale_method": "robust_median_ratio", "ratio_clip": (0.5, 6.0)}, {"scale_method": "fixed", "fixed_factors": {"e_co": 1.25, "default": 0.8}}):
        factors = FP.fire_emissions(fires, mesh, _plan(i, **change), located=located)["hourly"].extras["factors"]
        part = factors.select(F.lit(change["scale_method"]).alias("method"), "field", "factor")
        out = part if out is None else out.unionByName(part)
    return out


@query("job_fire_size", ["CAST(day AS STRING) AS day", "field", "cell_id", "ROUND(value, 4) AS value"], f"""
WITH {NEAR.format(FIRES)}, g AS (SELECT source, day, cell_id, avg(area) AS fire_size_avg, stddev_pop(area) AS fire_size_std, avg(frp) AS frp_avg, stddev_pop(frp) AS frp_std FROM loc GROUP BY 1, 2, 3),
u AS (UNPIVOT g ON fire_size_avg, fire_size_std, frp_avg, frp_std INTO NAME field VALUE value)
SELECT day, field, cell_id, value FROM u WHERE source = CASE WHEN day(day) IN (5, 6, 9, 17, 18, 19) THEN 'fallback' ELSE 'dedicated' END""", ("fires", "mesh"))
def job_fire_size(i):
    return FP.fire_emissions(i.sql(FIRES, "fires"), i("mesh"), _plan(i), boxes(i))["daily"].values


@query("job_point_vegetation", ["CAST(day AS STRING) AS day", "cell_id", "CAST(category AS INT) AS category", "ROUND(mean_area, 4) AS mean_area"], f"""
WITH {NEAR.format('SELECT * FROM fires')}, k AS (SELECT day, cell_id, {CAT} AS c, sum(area) AS w, count(*) AS n FROM loc GROUP BY 1, 2, 3)
SELECT day, cell_id, CASE WHEN sum(CASE WHEN c > 0 THEN w ELSE 0 END) > 0 THEN arg_max(c, CASE WHEN c > 0 THEN w ELSE -1 END) ELSE 0 END AS category, sum(w)/sum(n) AS mean_area FROM k GROUP BY 1, 2""", ("fires", "mesh"))
def job_point_vegetation(i):
    from gridspark.operators import points as P
    from gridspark.operators.nearest import nearest_cell
    size = P.aggregate_points(nearest_cell(i("fires"), i("mesh"), index=boxes(i)), ["day", "cell_id"], {"area": "value"}, {"area": "mean"})
    fires = i("fires").withColumn("day_number", F.dayofyear("file_date"))
    return FP.point_vegetation(fires, i("mesh"), size, boxes(i)).values


# days 12 and 20 have no file, a record in 97 carries the day number of the next day, and day 5 has no reference
VEG_FIRES = """SELECT *, CAST(extract(doy FROM file_date) AS INT) + CASE WHEN fire_id % 97 = 3 THEN 1 ELSE 0 END AS day_number FROM fires WHERE extract(day FROM file_date) NOT IN (12, 20)"""


@query("job_point_vegetation_violations", ["rule", "day", "reason", "CAST(n AS BIGINT) AS n"], f"""
WITH f AS ({VEG_FIRES}), d AS (SELECT DISTINCT file_date AS day FROM f)
SELECT 'fatal_record' AS rule, CAST(file_date AS VARCHAR) AS day, 'day_mismatch' AS reason, count(*) AS n FROM f WHERE fire_id % 97 = 3 GROUP BY 2
UNION ALL SELECT 'manifest', CAST(day AS VARCHAR), CASE WHEN day + INTERVAL 1 DAY NOT IN (SELECT day FROM d) AND day <> (SELECT max(day) FROM d) THEN 'gap' ELSE 'reference_records' END, NULL FROM d
WHERE (day + INTERVAL 1 DAY NOT IN (SELECT day FROM d) AND day <> (SELECT max(day) FROM d)) OR day(day) = 5""", ("fires",))
def job_point_vegetation_violations(i):
    from gridspark.operators import points as P
    from gridspark.operators.nearest import nearest_cell
    fires = i.sql(VEG_FIRES, "fires")
    reference = nearest_cell(fires, i("mesh"), index=boxes(i)).filter("day_number = dayofyear(file_date) AND day(file_date) <> 5")
    size = P.aggregate_points(reference, ["day", "cell_id"], {"area": "value"}, {"area": "mean"})
    found = FP.point_vegetation(fires, i("mesh"), size, boxes(i)).violations.filter("rule <> 'mean_mismatch'")
    d = F.from_json("detail", "file_date string, day string, reason string, rule string, n bigint")
    return found.withColumn("d", d).select("rule", F.coalesce("d.file_date", "d.day").alias("day"), F.coalesce("d.reason", "d.rule").alias("reason"), "d.n")


@query("job_fire_support", ["CAST(day AS STRING) AS day", "cell_id", "ROUND(value, 3) AS value"], f"""
WITH {overlap_sql("0.3e0/sqrt((SELECT count(*) FROM supplier))", "(SELECT * FROM mesh WHERE cell_id % 2 = 0)")},
met AS (SELECT cell_id, iy, ix FROM met_areas WHERE fine > 1 AND coarse > 1),
placed AS (SELECT f.*, y.idx AS iy, x.idx AS ix FROM fires f JOIN ax_lat y ON y.lo <= f.lat AND f.lat < y.hi JOIN ax_lon x ON x.lo <= f.lon AND f.lon < x.hi),
hits AS (SELECT DISTINCT p.day, m.cell_id, p.fire_id, p.genveg, p.area FROM placed p JOIN met m ON m.iy = p.iy AND m.ix = p.ix WHERE p.area > 0),
found AS (SELECT day, cell_id, sum(area)/count(*) AS mean_area FROM hits GROUP BY 1, 2 HAVING sum(CASE WHEN {CAT} > 0 THEN area ELSE 0 END) > 0)
SELECT d.day, c.cell_id, coalesce(mean_area, CASE WHEN c.cell_id % 2 = 0 THEN 0e0 ELSE 25e0 END) AS value
FROM mesh c CROSS JOIN (SELECT DISTINCT day FROM fires) d LEFT JOIN found f ON f.day = d.day AND f.cell_id = c.cell_id""", ("fires", "mesh"))
def job_fire_support(i):
    h = 0.3 / i.table("supplier").count() ** 0.5  # cells shrink as they multiply
    cells = i("mesh").select("cell_id", "lat", "lon", F.array(*[F.col("lat") + h * s for s in (-1, -1, 1, 1)]).alias("corner_lat"),
                             F.array(*[F.col("lon") + h * s for s in (-1, 1, 1, -1)]).alias("corner_lon"))
    lat, lon = i.sql(LAT_AXIS), i.sql(LON_AXIS)
    from gridspark.operators.vegetation import assign_pixel
    flux = assign_pixel(i("fires"), lat, lon, wrap=False).select("day", "iy", "ix").distinct().withColumn("flux", F.lit(1.0) + F.col("ix"))
    days = i("fires").select("day").distinct()
    start, end = i.span("SELECT day FROM fires", "day", "fires")
    size = i("mesh").select("cell_id", F.explode(F.sequence(F.lit(start).cast("date"), F.lit(end).cast("date"))).alias("day"))
    size = size.join(days, "day", "left_semi").withColumn("value", F.when(F.col("cell_id") % 2 == 0, 0.0).otherwise(25.0))
    veg = size.select("day", "cell_id", F.lit(0).alias("category"), F.lit(0.0).alias("share"), F.lit(0.0).alias("known_frac"), F.lit(0).cast("bigint").alias("n_records"))
    fires = i.sql("SELECT day, fire_id AS record_id, lat, lon, genveg, area FROM fires", "fires")
    target = size.withColumn("value", F.lit(1.0))
    return FP.fire_support(cells, lat, lon, flux, fires, size, veg, target, wrap=False).values


@query("job_bias_training", [*CH, "predictor", "ROUND(beta, 7) AS beta", "CAST(n_obs AS BIGINT) AS n_obs"], f"""
WITH m AS (SELECT observer, channel, avg(p1) FILTER (qc0 = 0) AS mean FROM obs GROUP BY 1, 2),
x AS (SELECT o.* EXCLUDE (p1), p1 - mean AS p1 FROM obs o JOIN m ON m.observer = o.observer AND m.channel = o.channel),
s AS ({SUMS_SQL.replace('FROM obs', 'FROM x')}) {_solve_sql()}""", ("obs",))
def job_bias_training(i):
    return OP.train_bias(i("obs"), PRED, CH, lapse="p1")["coefficients"]


@query("job_cycle_diagnostics", ["CAST(cycle AS STRING) AS cycle", "key", "CAST(n AS BIGINT) AS n", "ROUND(omb_rms, 7) AS omb_rms", "ROUND(oma_rms, 7) AS oma_rms", "passive"], f"""
SELECT cycle, observer || ':' || channel AS key, n, omb_rms/1000 AS omb_rms, oma_rms/1000 AS oma_rms, passive FROM ({DA_SQL})""", ("obs",))
def job_cycle_diagnostics(i):
    return OP.cycle_diagnostics(i("obs"), None, ["cycle", "observer", "channel"], ["inst0"])["stats"]


@query("job_state_carry", ["variable", "cell_id", "ROUND(value, 4) AS value"], f"""
WITH c AS (SELECT variable, cell_id, value - 1000 AS value FROM ({COLD})), w AS (SELECT variable, cell_id, value - 2500 AS value FROM ({WARM})),
o AS (SELECT c.variable, c.cell_id, CASE WHEN c.variable IN ('qdust1', 'qso2', 'persistent_hno3') THEN coalesce(w.value, c.value) ELSE c.value END AS value FROM c LEFT JOIN w ON w.variable = c.variable AND w.cell_id = c.cell_id)
SELECT variable, cell_id, CASE WHEN variable = 'smois' THEN value ELSE greatest(value, 0) END AS value FROM o""")
def job_state_carry(i):
    cold = i.sql(COLD).withColumn("value", F.col("value") - 1000)
    return MP.carry_cycle(cold, i.sql(WARM).withColumn("value", F.col("value") - 2500), ["variable", "cell_id"]).values


@query("job_observation_checks", ["observer", "CAST(qc_flag AS INT) AS qc_flag", "qc_reason", "CAST(n AS BIGINT) AS n"], f"""
SELECT observer, CASE WHEN qc_flag = 0 AND observer = 'inst2' THEN 1 ELSE qc_flag END AS qc_flag, qc_reason, count(*) AS n FROM ({QC_SQL}) GROUP BY 1, 2, 3""", ("obs",))
def job_observation_checks(i):
    return OP.check_observations(i("obs"), RULES, ["inst2"], ["observer"])["summary"]


@query("job_time_repair", ["series_id", "CAST(target AS STRING) AS target", "ROUND(value, 6) AS value"], """
WITH t AS (SELECT DISTINCT series_id, unnest(range((SELECT min(valid_time) FROM records), (SELECT max(valid_time) FROM records) + INTERVAL 1 SECOND, INTERVAL 12 HOUR)) AS target FROM records)
SELECT t.series_id, t.target, r.value FROM t ASOF JOIN records r ON t.series_id = r.series_id AND r.valid_time <= t.target
WHERE t.target <= (SELECT max(x.valid_time) FROM records x WHERE x.series_id = t.series_id)""", ("records",))
def job_time_repair(i):
    r = i("records")
    return MP.repair_times(r.select("series_id", "record_id", F.lit(0).alias("cell_id"), "value"), r.drop("value"),
                           *i.span("SELECT valid_time FROM records", "valid_time", "records"), 43200, ["cell_id"], "hold").values


@query("job_weight_audit", ["CAST(n_links AS BIGINT) AS n_links", "CAST(missing AS BIGINT) AS missing", "ROUND(implied, 4) AS implied"], """
SELECT count(*) AS n_links, (SELECT count(*) FROM part) - count(DISTINCT src_id) AS missing, sum(s*area) AS implied FROM weights w JOIN dst_area a ON a.dst_id = w.dst_id""", ("weights", "dst_area"))
def job_weight_audit(i):
    links = i.sql("SELECT dst_id*1000000 + src_id AS link_no, dst_id + 1 AS row, src_id + 1 AS col, s FROM weights", "weights")
    a = MP.audit_weights(links, i.table("supplier").count(), i.table("part").count(), i("dst_area"), require_full_src=True)
    n = a["weights"].select("n_links", F.lit(1).alias("k"))
    gaps = a["violations"].agg(F.coalesce(F.sum(F.when(F.col("rule") == "missing_source", F.col("n"))), F.lit(0)).alias("missing")).withColumn("k", F.lit(1))
    area = a["area"].select(F.col("implied_source_area").alias("implied"), F.lit(1).alias("k"))
    return n.join(gaps, "k").join(area, "k")


DENSE_FIELDS = ["e_bc", "e_co"]


@query("dense_product", ["CAST(day AS STRING) AS day", "field", "cell_id", "ROUND(value, 4) AS value"], """
WITH d AS (SELECT CAST(unnest(range((SELECT CAST(min(day) AS TIMESTAMP) FROM located), (SELECT CAST(max(day) AS TIMESTAMP) FROM located) + INTERVAL 5 DAY, INTERVAL 1 DAY)) AS DATE) AS day), f AS (SELECT unnest(['e_bc', 'e_co']) AS field),
v AS (SELECT day, 'e_co' AS field, cell_id, sum(co) AS value FROM located WHERE cell_id >= 0 GROUP BY 1, 3)
SELECT d.day, f.field, m.cell_id, coalesce(v.value, 0) AS value FROM mesh m CROSS JOIN d CROSS JOIN f LEFT JOIN v ON v.day = d.day AND v.field = f.field AND v.cell_id = m.cell_id""", ("mesh", "located"))
def dense_product(i):
    v = i.sql("SELECT day, 'e_co' AS field, cell_id, sum(co) AS value FROM located WHERE cell_id >= 0 GROUP BY day, cell_id", "located")
    start, end = i.span("SELECT day FROM located", "day", "located")  # and four days after it without fires
    axes = {"day": F.sequence(F.lit(start).cast("date"), F.date_add(F.lit(end).cast("date"), 4)), "field": F.array(*[F.lit(f) for f in DENSE_FIELDS])}
    return W.densify(v, i("mesh"), axes)


@query("job_fire_emissions_published", ["CAST(valid_time AS STRING) AS valid_time", "field", "cell_id", "ROUND(CAST(value AS DOUBLE)/1e6, 3) AS value"], f"""
WITH {NEAR.format(FIRES)}, g AS (SELECT source, day, l.cell_id, sum(co)/86400*6.022e23/(area_m2*1e4)*0.7 AS e_co, sum(bc)*1000/12/86400*6.022e23/(area_m2*1e4) AS e_bc FROM loc l JOIN mesh m ON m.cell_id = l.cell_id
 WHERE source <> 'dedicated' GROUP BY source, day, l.cell_id, area_m2),
u AS (SELECT source, day, cell_id, 'e_co' AS field, e_co AS value FROM g UNION ALL SELECT source, day, cell_id, 'e_bc', e_bc FROM g),
d AS (SELECT CAST(unnest(range((SELECT CAST(min(day) AS TIMESTAMP) FROM fires), (SELECT CAST(max(day) AS TIMESTAMP) FROM fires) + INTERVAL 1 SECOND, INTERVAL 1 DAY)) AS DATE) AS d),
w AS (SELECT d, {DAY_OF} AS source, d AS sd, 1.0 AS w FROM d WHERE day(d) <> 9 UNION ALL SELECT d, 'primary', d + (k - 1)::INT, 0.5 FROM d, (SELECT unnest([0, 2]) AS k) WHERE day(d) = 9),
r AS (SELECT d, field, cell_id, sum(w*value) AS value FROM w JOIN u ON u.source = w.source AND u.day = w.sd GROUP BY 1, 2, 3)
SELECT CAST(d.d AS TIMESTAMP) + to_hours(CAST(h AS BIGINT)) AS valid_time, f.field, m.cell_id,
 CAST(coalesce(value*list_extract({PROFILE}, CAST((h + ((CAST(round_even(degrees(lon)/15, 0) AS INT) % 24) + 24) % 24) % 24 AS INT) + 1)/{sum(PROFILE)!r}*24, 0) AS FLOAT) AS value
FROM mesh m CROSS JOIN d CROSS JOIN (SELECT unnest(['e_bc', 'e_co']) AS field) f CROSS JOIN (SELECT unnest(range(24)) AS h)
LEFT JOIN r ON r.d = d.d AND r.field = f.field AND r.cell_id = m.cell_id""", ("fires", "mesh"))
def job_fire_emissions_published(i):
    """The job's product itself: every cell, hour and field, checked and published, then read back."""
    path = f"{work_dir(i.spark)}/gridspark/product/{uuid.uuid4().hex}"
    plan = _plan(i)
    FP.publish_hourly(FP.fire_emissions(i.sql(FIRES, "fires"), i("mesh"), plan, boxes(i))["hourly"], i("mesh"), plan, path)
    return PR.read_product(i.spark, path)


@query("product_written", ["product", "field", "CAST(cell_id AS BIGINT) AS cell_id", "CAST(value AS DOUBLE) AS value", "decision"], """
SELECT 'p' AS product, 'total' AS field, s_suppkey AS cell_id, CAST(CAST(s_acctbal + 1 AS FLOAT) AS DOUBLE) AS value, 'reuse rebuild' AS decision FROM supplier
UNION ALL SELECT 'p', 'part', s_suppkey, CAST(CAST(s_acctbal AS FLOAT) AS DOUBLE), 'reuse rebuild' FROM supplier""")
def product_written(i):
    """Two fields are written, one of them again with other values; then the product is read and its reuse decided."""
    path = f"{work_dir(i.spark)}/gridspark/product/{uuid.uuid4().hex}"
    old = i.sql("SELECT 'p' AS product, f AS field, s_suppkey AS cell_id, s_acctbal AS value FROM supplier CROSS JOIN (SELECT 'total' AS f UNION ALL SELECT 'part') x")
    facts = i.sql("SELECT DISTINCT 6E0 AS source_time_offset_hours FROM supplier")
    PR.write_product(old, path, facts, PR.violation_table({"nonfinite": PR.finite_violations(old, ["field"])}))
    PR.write_product(old.filter("field = 'total'").withColumn("value", F.col("value") + 1), path, facts)
    decisions = " ".join(PR.reuse_decision(i.spark, path, offset) for offset in (6.0, -24.0))
    return PR.read_product(i.spark, path).withColumn("decision", F.lit(decisions))


OBS_COLUMNS = [
    "CAST(ts AS TIMESTAMP) AS obs_time", "CAST(event_id % 15 AS INT) AS channel", "concat('inst', CAST(user_id % 3 AS STRING)) AS observer",
    "value AS obs", "value*0.9E0 + 1.5E0 AS hofx", "1.0E0 + CAST(event_id % 7 AS DOUBLE)/10 AS err0", "CAST(event_id % 4 AS INT) AS qc0",
    "CAST(user_id % 11 - 5 AS DOUBLE)/10 AS bias", "1.0E0 AS p0", "CAST(event_id % 101 AS DOUBLE)/50 - 1.0E0 AS p1",
    "value - (value*0.9E0 + 1.5E0) AS ombg", "event_id"]
ARRIVALS = 4


def _arrivals(i, delayed: str):
    """Events as observations with the number of the delivery they come in: a quarter of the period each; rows where ``delayed`` holds come one later."""
    rows = i.table("events").selectExpr("*", "unix_micros(CAST(ts AS TIMESTAMP)) AS us")
    lo, hi = rows.agg(F.min("us"), F.max("us")).first()
    k = F.floor(F.lit(ARRIVALS) * (F.col("us") - lo) / (hi - lo + 1)) + F.when(F.expr(delayed), 1).otherwise(0)
    return rows.select(F.least(k, F.lit(ARRIVALS - 1)).alias("k"), *[F.expr(c) for c in OBS_COLUMNS])


def _stream(i, make):
    """Deliver the events in four parts, resuming from the checkpoint each time, and read what the stream emitted.

    A last row two days later closes the cycles that are open at the end; its own cycle stays open.
    """
    spark = i.spark
    base = f"{work_dir(spark)}/gridspark/stream/{uuid.uuid4().hex}"
    rows = _arrivals(i, "false")
    closing = rows.orderBy(F.col("obs_time").desc()).limit(1).withColumn("obs_time", F.col("obs_time") + F.expr("INTERVAL 2 DAYS")).withColumn("k", F.lit(ARRIVALS))
    rows.where("false").drop("k").write.parquet(f"{base}/in")
    source = spark.readStream.schema(rows.drop("k").schema).option("maxFilesPerTrigger", 1_000_000).parquet(f"{base}/in")
    out = make(source)
    for k in range(ARRIVALS + 1):
        (closing if k == ARRIVALS else rows.where(F.col("k") == k)).drop("k").write.mode("append").parquet(f"{base}/in")
        out.writeStream.format("parquet").outputMode("append").option("checkpointLocation", f"{base}/state").option(
            "path", f"{base}/out").trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(out.schema).parquet(f"{base}/out")


CYCLED = """closed AS (SELECT *, time_bucket(INTERVAL 6 HOUR, obs_time + INTERVAL 3 HOUR, TIMESTAMP '2024-01-01') AS c FROM obs)"""


@query("stream_departures", ["CAST(cycle AS STRING) AS cycle", "observer", "channel", "CAST(n_file AS BIGINT) AS n_file", "CAST(n AS BIGINT) AS n", "ROUND(omb_rms, 7) AS omb_rms"], f"""
WITH {CYCLED} SELECT c AS cycle, observer, channel, count(*) AS n_file, count(*) FILTER (qc0 <= 1) AS n, sqrt(avg(ombg*ombg) FILTER (qc0 <= 1)) AS omb_rms FROM closed GROUP BY 1, 2, 3""", ("obs",))
def stream_departures(i):
    return _stream(i, lambda o: SD.stream_departures(o, CH))


@query("stream_normal_sums", ["CAST(cycle AS STRING) AS cycle", *CH, "ROUND(h_1_1, 9) AS h_1_1", "ROUND(r_1, 9) AS r_1", "CAST(n_obs AS BIGINT) AS n_obs"], f"""
WITH {CYCLED} SELECT c AS cycle, observer, channel, sum(p1*p1/err0) FILTER (qc0 = 0) AS h_1_1, sum(p1*(obs - hofx + bias)/err0) FILTER (qc0 = 0) AS r_1, count(*) FILTER (qc0 = 0) AS n_obs FROM closed GROUP BY 1, 2, 3""", ("obs",))
def stream_normal_sums(i):
    return _stream(i, lambda o: SD.stream_normal_sums(o, PRED, CH))


def _ledger(i, make):
    """A ledger over four deliveries; a row in 23 comes one delivery late, and the second delivery is added twice."""
    base = f"{work_dir(i.spark)}/gridspark/ledger/{uuid.uuid4().hex}"
    rows = _arrivals(i, "event_id % 23 = 5")
    ledger = make(f"{base}/ledger", rows)
    rows.where("false").drop("k").write.parquet(f"{base}/in")
    source = i.spark.readStream.schema(rows.drop("k").schema).option("maxFilesPerTrigger", 1_000_000).parquet(f"{base}/in")
    for k in range(ARRIVALS):
        rows.where(F.col("k") == k).drop("k").write.mode("append").parquet(f"{base}/in")
        ledger.run(source, f"{base}/state")
        if k == 1:
            ledger.add(rows.where("k = 1").drop("k"), 1)  # as after a failure between the sink and the checkpoint
    return ledger


DELIVERED = f"""u AS (SELECT *, epoch_us(obs_time) AS us FROM obs), span_ AS (SELECT min(us) AS lo, max(us) AS hi FROM u),
d AS (SELECT u.*, least({ARRIVALS - 1}, floor({ARRIVALS}*(us - lo)/(hi - lo + 1)) + CASE WHEN loc_id % 23 = 5 THEN 1 ELSE 0 END) AS k,
 time_bucket(INTERVAL 6 HOUR, obs_time + INTERVAL 3 HOUR, TIMESTAMP '2024-01-01') AS c FROM u, span_),
marks AS (SELECT k + 1 AS k, max(max(obs_time)) OVER (ORDER BY k) - INTERVAL 3 HOUR AS mark FROM d GROUP BY k),
judged AS (SELECT d.*, mark IS NOT NULL AND c + INTERVAL 3 HOUR <= mark AS late FROM d LEFT JOIN marks ON marks.k = d.k),
closed AS (SELECT * FROM judged WHERE NOT late AND c + INTERVAL 3 HOUR <= (SELECT max(obs_time) - INTERVAL 3 HOUR FROM d))"""


@query("stream_ledger_departures", ["CAST(cycle AS STRING) AS cycle", "observer", "channel", "CAST(n_file AS BIGINT) AS n_file", "CAST(n AS BIGINT) AS n", "ROUND(omb_rms, 7) AS omb_rms", "ROUND(omb_mean, 7) AS omb_mean", "ROUND(jo_b, 7) AS jo_b"], f"""
WITH {DELIVERED} SELECT c AS cycle, observer, channel, count(*) AS n_file, count(*) FILTER (qc0 <= 1) AS n, sqrt(avg(ombg*ombg) FILTER (qc0 <= 1)) AS omb_rms, avg(ombg) FILTER (qc0 <= 1) AS omb_mean,
 avg(power(ombg/err0, 2)) FILTER (qc0 <= 1) AS jo_b FROM closed GROUP BY 1, 2, 3""", ("obs",))
def stream_ledger_departures(i):
    return SL.departures(_ledger(i, lambda path, rows: SL.Ledger(i.spark, path, CH, SL.departure_sums())).sums(), CH)


@query("stream_late_rows", ["CAST(cycle AS STRING) AS cycle", "CAST(batch AS INT) AS batch", "CAST(event_id AS BIGINT) AS event_id"], f"""
WITH {DELIVERED} SELECT c AS cycle, CAST(k AS INT) AS batch, loc_id AS event_id FROM judged WHERE late""", ("obs",))
def stream_late_rows(i):
    return _ledger(i, lambda path, rows: SL.Ledger(i.spark, path, CH, SL.departure_sums())).late()


@query("stream_coefficients", ["CAST(cycle AS STRING) AS cycle", "observer", "predictor", "ROUND(beta, 6) AS beta", "CAST(n_obs AS BIGINT) AS n_obs"], f"""
WITH {DELIVERED}, s AS ({SUMS_SQL.replace("channel, ", "cycle, ").replace("FROM obs", "FROM (SELECT *, c AS cycle_ FROM closed)").replace("observer, cycle,", "observer, cycle_,")})
SELECT cycle_ AS cycle, * EXCLUDE (cycle_) FROM ({_solve_sql().replace("channel", "cycle_")}) WHERE n_obs >= 5""", ("obs",))
def stream_coefficients(i):
    """Bias coefficients per cycle and observer from sums kept over batches, where there are enough rows for two coefficients."""
    ledger = _ledger(i, lambda path, rows: SL.normal_ledger(i.spark, path, PRED, ["observer"], rows))
    return SL.coefficients(ledger.sums().where("n_obs >= 5"), PRED, ["observer"])
