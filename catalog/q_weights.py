"""Weights, units, scaling, grids and meshes."""
from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from catalog.registry import query
from gridspark.functions import geometry as G
from gridspark.functions.units import convert_units, normalize_unit, point_flux
from gridspark.operators import mesh as M
from gridspark.operators import points as P
from gridspark.operators import scaling as S
from gridspark.operators import weights as W
from gridspark.operators.identity import changed_ranges
from gridspark.session import work_dir
from gridspark.sources import weight_store as WS

NONE_COLS = ["rule", "CAST(n AS BIGINT) AS n"]

APPLY_SQL = """SELECT v.field, w.dst_id, sum(w.s*v.value) AS value
FROM weights w JOIN grid_values v ON w.src_id = v.src_id GROUP BY v.field, w.dst_id"""


@query("weight_apply", ["field", "CAST(dst_id AS BIGINT) AS dst_id", "ROUND(value, 4) AS value"], APPLY_SQL, ("weights", "grid_values"))
def weight_apply(i):
    return W.apply_weights(i("grid_values"), i("weights"), ["field"])


@query("weight_apply_stored", ["field", "CAST(dst_id AS BIGINT) AS dst_id", "ROUND(value, 4) AS value"], APPLY_SQL, ("weights", "grid_values"))
def weight_apply_stored(i):
    """Weights validated and laid out in buckets once, opened again and applied: only the values are shuffled."""
    path = f"{work_dir(i.spark)}/gridspark/weights/{uuid.uuid4().hex}"
    links = i("weights")
    n_dst, n_src = (links.agg(F.max(c) + 1).first()[0] for c in ("dst_id", "src_id"))
    # ids that the given tables leave out hold themselves, so that the table is complete
    gaps = i.spark.range(n_dst).select(F.col("id").alias("dst_id")).join(links.select("dst_id").distinct(), "dst_id", "left_anti")
    links = links.select("dst_id", "src_id", "s").unionByName(gaps.select("dst_id", F.lit(0).cast("bigint").alias("src_id"), F.lit(1.0).alias("s")))
    WS.store_weights(links, path, n_dst, n_src, "grid", "mesh")
    stored = WS.open_weights(i.spark, path)
    done = W.apply_weights(i("grid_values"), stored, ["field"])
    return done.join(gaps, "dst_id", "left_anti")


@query("conservation", ["field", "ROUND(src_total, 2) AS src_total", "ROUND(dst_total, 2) AS dst_total", "ROUND(rel_diff, 6) AS rel_diff", "ok"], f"""
SELECT s.field, src_total, dst_total, abs(dst_total - src_total)/abs(src_total) AS rel_diff,
       abs(dst_total - src_total)/abs(src_total) <= 0.00005 AS ok
FROM (SELECT field, sum(value*area) AS src_total FROM grid_values g JOIN src_area a ON g.src_id = a.src_id GROUP BY field) s
JOIN (SELECT field, sum(value*area) AS dst_total FROM ({APPLY_SQL}) d JOIN dst_area a ON d.dst_id = a.dst_id GROUP BY field) d
ON s.field = d.field""", ("weights", "grid_values", "src_area", "dst_area"))
def conservation(i):
    dst = W.apply_weights(i("grid_values"), i("weights"), ["field"])
    return W.check_conservation(i("grid_values"), dst, i("src_area"), i("dst_area"), ["field"])


@query("weight_validate", NONE_COLS, """
SELECT * FROM (
 SELECT 'row_sum' AS rule, CASE WHEN max(abs(t - 1.0)) > 5e-10 THEN 1 ELSE 0 END AS n FROM (SELECT dst_id, sum(s) AS t FROM bad_weights GROUP BY dst_id)
 UNION ALL SELECT 'missing_destination', (SELECT count(*) FROM supplier) - (SELECT count(DISTINCT dst_id) FROM bad_weights)
 UNION ALL SELECT 'missing_source', (SELECT count(*) FROM part) - (SELECT count(DISTINCT src_id) FROM bad_weights)
) WHERE n > 0""".replace("bad_weights", "(SELECT dst_id, src_id, CASE WHEN src_id % 5 = 0 THEN s*1.01 ELSE s END AS s FROM weights WHERE dst_id % 9 <> 4)"), ("weights",))
def weight_validate(i):
    w = i("weights").filter("dst_id % 9 <> 4").withColumn("s", F.expr("CASE WHEN src_id % 5 = 0 THEN s*1.01D ELSE s END"))
    return W.validate_weights(w, i.table("supplier").count(), i.table("part").count(), True, True)


def _link_sql(side, table):
    return f"""SELECT '{side}' AS side, min(n) AS min, quantile_cont(n, 0.5) AS median, avg(n) AS mean,
quantile_cont(n, 0.95) AS p95, quantile_cont(n, 0.99) AS p99, max(n) AS max
FROM (SELECT t.k, count(w.{side}) AS n FROM {table} t LEFT JOIN weights w ON t.k = w.{side} GROUP BY t.k)"""


@query("weight_link_audit", ["side", "CAST(min AS BIGINT) AS min", "ROUND(median, 6) AS median", "ROUND(mean, 6) AS mean",
                             "ROUND(p95, 6) AS p95", "ROUND(p99, 6) AS p99", "CAST(max AS BIGINT) AS max"],
       _link_sql("dst_id", "(SELECT s_suppkey AS k FROM supplier)") + " UNION ALL " + _link_sql("src_id", "(SELECT p_partkey AS k FROM part)"), ("weights",))
def weight_link_audit(i):
    w = i("weights")
    a = W.link_statistics(w, "dst_id", i.table("supplier").count()).withColumn("side", F.lit("dst_id"))
    return a.unionByName(W.link_statistics(w, "src_id", i.table("part").count()).withColumn("side", F.lit("src_id")))


@query("weight_value_audit", ["CAST(n_links AS BIGINT) AS n_links", "ROUND(min, 9) AS min", "ROUND(mean, 9) AS mean", "ROUND(max, 9) AS max",
                              "CAST(negative AS BIGINT) AS negative", "CAST(zero AS BIGINT) AS zero", "CAST(nonfinite AS BIGINT) AS nonfinite"], """
SELECT count(*) AS n_links, min(s) AS min, avg(s) AS mean, max(s) AS max, sum(CASE WHEN s < 0 THEN 1 ELSE 0 END) AS negative,
sum(CASE WHEN s = 0 THEN 1 ELSE 0 END) AS zero, sum(CASE WHEN isnan(s) OR isinf(s) THEN 1 ELSE 0 END) AS nonfinite FROM weights""", ("weights",))
def weight_value_audit(i):
    return W.weight_statistics(i("weights"))


@query("weight_percentiles", ["prob", "ROUND(value, 9) AS value"], """
SELECT 0.5::DOUBLE AS prob, quantile_cont(s, 0.5) AS value FROM weights UNION ALL SELECT 0.99::DOUBLE, quantile_cont(s, 0.99) FROM weights""", ("weights",))
def weight_percentiles(i):
    return W.weight_percentiles(i("weights"))


@query("weight_order_resets", ["CAST(resets AS BIGINT) AS resets", "CAST(first_reset AS BIGINT) AS first_reset"], """
SELECT count(*) AS resets, min(b.o_orderkey) AS first_reset FROM orders a JOIN orders b ON b.o_orderkey = a.o_orderkey + 1
WHERE b.o_custkey % 50 < a.o_custkey % 50""")
def weight_order_resets(i):
    return W.order_resets(i.sql("SELECT o_orderkey AS link_no, o_custkey % 50 AS row FROM orders"))


@query("weight_five_sided", ["CAST(cell_id AS BIGINT) AS cell_id", "ROUND(lat_deg, 6) AS lat_deg", "ROUND(lon_deg, 6) AS lon_deg",
                             "CAST(n_links AS BIGINT) AS n_links", "ROUND(row_sum, 8) AS row_sum"], """
SELECT m.cell_id, degrees(m.lat) AS lat_deg, CASE WHEN degrees(m.lon) < 0 THEN degrees(m.lon) + 360 ELSE degrees(m.lon) END AS lon_deg,
count(w.s) AS n_links, coalesce(sum(w.s), 0) AS row_sum
FROM mesh m LEFT JOIN weights w ON w.dst_id = m.cell_id WHERE m.n_edges = 5 GROUP BY m.cell_id, m.lat, m.lon""", ("mesh", "weights"))
def weight_five_sided(i):
    return W.five_sided(i("weights"), i("mesh"))


@query("weight_area_conservation", ["ROUND(destination_area, 4) AS destination_area", "ROUND(implied_source_area, 4) AS implied_source_area",
                                    "ROUND(difference, 4) AS difference"], """
SELECT t AS destination_area, m AS implied_source_area, m - t AS difference
FROM (SELECT sum(area) AS t FROM dst_area), (SELECT sum(s*area) AS m FROM weights w JOIN dst_area a ON w.dst_id = a.dst_id)""", ("weights", "dst_area"))
def weight_area_conservation(i):
    return W.area_conservation(i("weights"), i("dst_area"))


UNITS = "list_extract(['kg m-2 s-1','kg/m2/day','KG  m**-2 s**-1','kg s-1 m-2','mol m-2','kg m-2 day-1','molecules cm-2 s-1'], CAST(p_partkey % 7 AS INT) + 1)"
TO_UNITS = "list_extract(['molecules/cm2/s','kg m^-2 s^-1',''], CAST(p_size % 3 AS INT) + 1)"
NORM = "trim(regexp_replace(regexp_replace(replace(lower({}), '**', '^'), '([^^])-([12])\\b', '\\1^-\\2', 'g'), '\\s+', ' ', 'g'))"


def _units(i):
    return i.sql(f"SELECT p_partkey, p_size, p_retailprice, {UNITS} AS su, {TO_UNITS} AS tu FROM part".replace("list_extract([", "element_at(array(").replace("], CAST", "), CAST"))


@query("unit_normalize", ["p_partkey", "unit"], f"SELECT p_partkey, {NORM.format(UNITS)} AS unit FROM part")
def unit_normalize(i):
    return _units(i).withColumn("unit", normalize_unit(F.col("su")))


@query("unit_convert", ["p_partkey", "ROUND(value, 6) AS value"], f"""
SELECT p_partkey, CASE
 WHEN su = tu OR tu = '' THEN p_retailprice*2
 WHEN su IN ('kg m^-2 s^-1','kg s^-1 m^-2') AND tu = 'molecules/cm2/s' AND mw > 0 THEN p_retailprice*2*(0.1*6.02214076e23/mw)/1e18
 WHEN su IN ('kg/m2/day','kg m^-2 day^-1') AND tu = 'molecules/cm2/s' AND mw > 0 THEN p_retailprice*2/86400*(0.1*6.02214076e23/mw)/1e18
 WHEN su IN ('kg m^-2 s^-1','kg s^-1 m^-2') AND tu = 'kg m^-2 s^-1' THEN p_retailprice*2
 WHEN su IN ('kg/m2/day','kg m^-2 day^-1') AND tu = 'kg m^-2 s^-1' THEN p_retailprice*2/86400 END AS value
FROM (SELECT p_partkey, p_retailprice, p_size % 20 AS mw, {NORM.format(UNITS)} AS su, {NORM.format(TO_UNITS)} AS tu FROM part)""")
def unit_convert(i):
    value = convert_units(F.col("p_retailprice"), F.col("su"), F.col("tu"), (F.col("p_size") % 20).cast("double"), F.lit(2.0))
    to_mol = normalize_unit(F.col("tu")) == "molecules/cm2/s"
    return _units(i).withColumn("value", F.when(to_mol, value / 1e18).otherwise(value))


BLOCK = {"default": 0.5, "species": {"NH_3": 0.7, "so2": 1.2}, "fields": {"nh3_sum": 0.8}, "sectors": {"awb": 0.0, "ene": 3.0}}
SPECIES_SQL = "CASE p_partkey % 4 WHEN 0 THEN 'nh-3' WHEN 1 THEN 'SO2' WHEN 2 THEN 'co' ELSE 'ammonia' END"
SECTOR_SQL = "CASE p_size % 3 WHEN 0 THEN 'AWB' WHEN 1 THEN 'ene' ELSE 'tro' END"
FIELD_SQL = "CASE WHEN p_partkey % 8 = 3 THEN 'NH3_sum' ELSE 'other' END"


@query("scaling_factors", ["p_partkey", "ROUND(factor, 6) AS factor", "ROUND(value, 4) AS value"], f"""
SELECT p_partkey, f AS factor, p_retailprice*f AS value FROM (SELECT p_partkey, p_retailprice,
 1.5e0*0.5*CASE p_partkey % 4 WHEN 0 THEN 0.7 WHEN 1 THEN 1.2 WHEN 3 THEN 0.7 ELSE 1.0 END
 *CASE WHEN p_partkey % 8 = 3 THEN 0.8 ELSE 1.0 END*CASE p_size % 3 WHEN 0 THEN 0.0 WHEN 1 THEN 3.0 ELSE 1.0 END AS f FROM part)""")
def scaling_factors(i):
    df = i.sql(f"""SELECT p_partkey, p_retailprice AS value, {SPECIES_SQL} AS sp, {SECTOR_SQL} AS sec, {FIELD_SQL} AS fld,
                   CASE WHEN p_partkey % 4 = 3 THEN 'nh_3' END AS alias FROM part""")
    return S.apply_scaling(df, [BLOCK, 1.5], [F.col("sp"), F.col("alias")], F.col("fld"), F.col("sec"))


SECTORS = """SELECT CAST(extract(month FROM l_shipdate) AS INT) AS month, l_partkey AS src_id,
 CASE l_returnflag WHEN 'A' THEN 'awb' WHEN 'N' THEN 'ene' ELSE 'tro' END AS sector, sum(l_quantity) AS value
FROM lineitem GROUP BY 1, 2, 3"""


@query("sector_sum", ["month", "CAST(src_id AS BIGINT) AS src_id", "sector", "ROUND(value, 6) AS value"], f"""
SELECT month, src_id, sector, CASE sector WHEN 'awb' THEN 0 WHEN 'ene' THEN value*0.5*1.5 ELSE value*0.5 END AS value FROM ({SECTORS})
UNION ALL SELECT month, src_id, 'sum' AS sector, greatest(sum(CASE sector WHEN 'awb' THEN 0 WHEN 'ene' THEN value*1.5 ELSE value END), 0)*0.5 AS value
FROM ({SECTORS}) GROUP BY month, src_id""")
def sector_sum(i):
    parts = i.sql(SECTORS)
    total = parts.groupBy("month", "src_id").agg(F.sum("value").alias("value")).withColumn("sector", F.lit("sum"))
    out, _ = S.adjust_sector_sum(parts.unionByName(total), ["month", "src_id"], ["awb"], {"ene": 1.5}, {"default": 0.5}, [F.lit("co")])
    return out


@query("source_field_terms", ["l_orderkey", "l_linenumber", "l_partkey", "ROUND(value, 4) AS value"], """
SELECT l_orderkey, l_linenumber, l_partkey, 2.0*l_quantity + -0.5*l_extendedprice AS value FROM lineitem""")
def source_field_terms(i):
    return S.source_field(i.table("lineitem"), [("l_quantity", 2.0), ("l_extendedprice", -0.5)])


@query("product_names", ["p_partkey", "name"], """
SELECT p_partkey, CASE p_size % 3 WHEN 0 THEN 'CEDS_x1_2024_bc_monthly' WHEN 1 THEN 'CEDS_x1_2024_nh3_monthly' END AS name FROM part""")
def product_names(i):
    df = i.sql("SELECT p_partkey, CASE p_size % 3 WHEN 0 THEN 'black-carbon' WHEN 1 THEN 'ammonia' ELSE 'unknown' END AS sp FROM part")
    return df.withColumn("name", S.product_name(F.lit("CEDS"), F.lit("x1"), F.lit("2024"), F.col("sp"), F.lit("monthly"),
                                                {"black-carbon": "bc", "ammonia": "nh3"}))


# a grid per 20 suppliers, with 20 latitudes of 9 and 20 longitudes of 18 degrees; the last grid may have fewer
AXES = """SELECT concat('g', CAST(g AS STRING)) AS grid_id, axis, idx, centre FROM (
 SELECT 'lat' AS axis, CAST(floor(s_suppkey/20) AS INT) AS g, CAST(s_suppkey % 20 AS INT) AS idx, -90 + (s_suppkey % 20 + 0.5E0)*9 AS centre FROM supplier
 UNION ALL SELECT 'lon' AS axis, CAST(floor(s_suppkey/20) AS INT) AS g, CAST(s_suppkey % 20 AS INT) AS idx, -180 + (s_suppkey % 20 + 0.5E0)*18 AS centre FROM supplier) x"""


BOUNDS_SQL = """SELECT 'g' || (s_suppkey // 20) AS grid_id, axis, CAST(s_suppkey % 20 AS INT) AS idx, a + w*(s_suppkey % 20) AS lo,
 CASE WHEN axis = 'lat' AND s_suppkey = max(s_suppkey) OVER (PARTITION BY s_suppkey // 20) THEN 90e0 ELSE a + w*(s_suppkey % 20 + 1) END AS hi, a + w*(s_suppkey % 20 + 0.5e0) AS centre
FROM supplier, (VALUES ('lat', -90e0, 9e0), ('lon', -180e0, 18e0)) v(axis, a, w)"""


@query("axis_bounds", ["grid_id", "axis", "idx", "ROUND(lo, 8) AS lo", "ROUND(hi, 8) AS hi"], BOUNDS_SQL)
def axis_bounds(i):
    return M.axis_bounds(i.sql(AXES))


@query("grid_cell_area", ["grid_id", "src_id", "ROUND(lat, 6) AS lat", "ROUND(lon, 6) AS lon", "ROUND(area_sr, 10) AS area_sr"], f"""
WITH b AS ({BOUNDS_SQL}), y AS (SELECT *, count(*) OVER (PARTITION BY grid_id) AS n FROM b WHERE axis = 'lat'), x AS (SELECT * FROM b WHERE axis = 'lon')
SELECT y.grid_id, CAST(y.idx*n + x.idx AS BIGINT) AS src_id, y.centre AS lat, x.centre AS lon, (sin(radians(y.hi)) - sin(radians(y.lo)))*radians(x.hi - x.lo) AS area_sr
FROM y JOIN x ON x.grid_id = y.grid_id""")
def grid_cell_area(i):
    return M.grid_cells(M.axis_bounds(i.sql(AXES)))


# a file per 40 customers: more files with more customers, axes of 40 centres
GRIDS = """SELECT concat('file', CAST(k AS STRING)) AS grid_id, concat('product', CAST(k % 5 AS STRING)) AS product, axis, idx,
 idx*1.25E0 - 30 + (k % 3)*0.000002E0 + CASE WHEN k = 7 THEN 0.05E0 ELSE 0E0 END AS centre
FROM (SELECT CAST(floor(c_custkey/40) AS INT) AS k, CAST(c_custkey % 40 AS INT) AS idx, 'lat' AS axis FROM customer
 UNION ALL SELECT CAST(floor(c_custkey/40) AS INT) AS k, CAST(c_custkey % 40 AS INT) AS idx, 'lon' AS axis FROM customer) x"""

LANES_SQL = " || ':' || ".join(["CAST(count(*) AS VARCHAR)", *[f"CAST(sum(CAST('0x' || substr(h, {8 * k + 1}, 8) AS BIGINT)) AS VARCHAR)" for k in range(8)]])

IDENT_SQL = f"""SELECT grid_id, product, substr(sha256({LANES_SQL}), 1, 16) AS fingerprint FROM (
 SELECT grid_id, product, sha256(axis || ':' || idx || ':' || CAST(round_even(centre/0.0001, 0) AS BIGINT)) AS h FROM ({GRIDS})) GROUP BY grid_id, product"""


@query("grid_identity", ["grid_id", "fingerprint"], IDENT_SQL)
def grid_identity(i):
    return M.grid_identity(i.sql(GRIDS))


@query("grid_identity_conflicts", ["product", "CAST(n_fingerprints AS BIGINT) AS n_fingerprints"],
       f"SELECT product, count(DISTINCT fingerprint) AS n_fingerprints FROM ({IDENT_SQL}) GROUP BY product HAVING count(DISTINCT fingerprint) > 1")
def grid_identity_conflicts(i):
    g = i.sql(GRIDS)
    return M.identity_conflicts(M.grid_identity(g).join(g.select("grid_id", "product").distinct(), "grid_id"), ["product"])


# trees of up to 256 ranges of 256 cells
TREE_SQL = f"""h AS (SELECT cell_id, sha256(concat_ws('|', CAST(cell_id AS VARCHAR), CAST(CAST(round_even(lat*1e9, 0) AS BIGINT) AS VARCHAR),
 CAST(CAST(round_even(lon*1e9, 0) AS BIGINT) AS VARCHAR), CAST(CAST(round_even(area_m2*1e3, 0) AS BIGINT) AS VARCHAR))) AS h FROM {{}}),
leaf AS (SELECT cell_id >> 8 AS range_id, count(*) AS n, sha256({LANES_SQL}) AS d FROM h GROUP BY 1)"""
TOP_SQL = """mid AS (SELECT 0 AS range_id, sha256(string_agg(range_id || '=' || d, ',' ORDER BY range_id)) AS d FROM leaf HAVING count(*) > 1)
SELECT (SELECT sum(n) FROM leaf) AS n_cells, sha256(string_agg(range_id || '=' || d, ',')) AS digest FROM (SELECT range_id, d FROM mid UNION ALL SELECT range_id, d FROM leaf WHERE (SELECT count(*) FROM leaf) = 1)"""


@query("mesh_identity", ["CAST(n_cells AS BIGINT) AS n_cells", "digest"], f"WITH {TREE_SQL.format('mesh')}, {TOP_SQL}", ("mesh",))
def mesh_identity(i):
    return M.mesh_identity(i("mesh"))


MOVED = "SELECT * REPLACE (CASE WHEN cell_id % 512 = 77 THEN lat + 0.01E0 ELSE lat END AS lat) FROM mesh WHERE cell_id % 768 <> 300"


@query("mesh_changed_ranges", ["CAST(range_id AS BIGINT) AS range_id", "CAST(n_before AS BIGINT) AS n_before", "CAST(n_after AS BIGINT) AS n_after"], f"""
WITH {TREE_SQL.format('mesh')}, {TREE_SQL.format(f'({MOVED})').replace('h AS (', 'h2 AS (', 1).replace('leaf AS', 'leaf2 AS').replace('FROM h GROUP', 'FROM h2 GROUP')}
SELECT coalesce(a.range_id, b.range_id) AS range_id, a.n AS n_before, b.n AS n_after FROM leaf a FULL JOIN leaf2 b ON a.range_id = b.range_id WHERE a.d IS DISTINCT FROM b.d""", ("mesh",))
def mesh_changed_ranges(i):
    """The ranges of cells in which a mesh was changed: some cells moved, some left out."""
    moved = i("mesh").where("cell_id % 768 <> 300").withColumn("lat", F.expr("CASE WHEN cell_id % 512 = 77 THEN lat + 0.01D ELSE lat END"))
    return changed_ranges(M.mesh_tree(i("mesh")), M.mesh_tree(moved))


@query("mesh_is_global", ["ROUND(surface_fraction, 9) AS surface_fraction", "is_global"], """
SELECT f AS surface_fraction, abs(f - 1) <= 0.0005 AS is_global FROM (SELECT sum(area_m2)/(4*pi()*6371229.0*6371229.0) AS f FROM mesh)""", ("mesh",))
def mesh_is_global(i):
    return M.is_global(i("mesh"))


@query("local_hour", ["c_custkey", "CAST(off AS INT) AS off"], """
SELECT c_custkey, ((CAST(round_even(lon/15, 0) AS INT) % 24) + 24) % 24 AS off FROM (SELECT c_custkey, CAST(c_custkey*75 % 3600 - 1800 AS DOUBLE)/10 AS lon FROM customer)""")
def local_hour(i):
    df = i.sql("SELECT c_custkey, CAST(c_custkey*75 % 3600 - 1800 AS DOUBLE)/10 AS lon FROM customer")
    return df.withColumn("off", G.local_hour_offset(F.col("lon")))


@query("great_circle", ["cell_id", "nbr_id", "ROUND(km, 6) AS km"], """
SELECT e.cell_id, e.nbr_id, 6371.229*2*asin(least(1.0, sqrt(power(cos(a.lat)*cos(a.lon) - cos(b.lat)*cos(b.lon), 2)
 + power(cos(a.lat)*sin(a.lon) - cos(b.lat)*sin(b.lon), 2) + power(sin(a.lat) - sin(b.lat), 2))/2)) AS km
FROM edges e JOIN mesh a ON a.cell_id = e.cell_id JOIN mesh b ON b.cell_id = e.nbr_id""", ("edges", "mesh"))
def great_circle(i):
    m = i("mesh")
    a = m.select("cell_id", G.unit_xyz(F.col("lat"), F.col("lon")).alias("a"))
    b = m.select(F.col("cell_id").alias("nbr_id"), G.unit_xyz(F.col("lat"), F.col("lon")).alias("b"))
    d = G.chord2(F.col("a.x"), F.col("a.y"), F.col("a.z"), F.col("b.x"), F.col("b.y"), F.col("b.z"))
    return i("edges").join(a, "cell_id").join(b, "nbr_id").withColumn("km", G.chord_to_angle(F.sqrt(d)) * 6371.229)


POLY = "SELECT m.*, (SELECT count(*) FROM part) AS nv FROM mesh m"
VERT = "SELECT p_partkey AS vertex_id, radians(CAST(p_partkey*37 % 1800 - 900 AS DOUBLE)/10) AS lat, radians(CAST(p_partkey*91 % 3600 - 1800 AS DOUBLE)/10) AS lon FROM part"


@query("mesh_polygons", ["cell_id", "ROUND(lon, 8) AS lon", "ROUND(area_sr, 12) AS area_sr", "corners", "ROUND(sum_lat, 8) AS sum_lat", "ROUND(last_lon, 8) AS last_lon"], f"""
SELECT m.cell_id, CASE WHEN m.lon < 0 THEN m.lon + 2*pi() ELSE m.lon END AS lon, m.area_m2/(6371229.0*6371229.0) AS area_sr, 6 AS corners,
 sum(v.lat) + (6 - count(*))*max_by(v.lat, k) AS sum_lat, max_by(v.lon, k) AS last_lon
FROM mesh m CROSS JOIN (SELECT unnest([0,1,2,3,4,5]) AS k) ks CROSS JOIN (SELECT count(*) AS n FROM part) n
JOIN ({VERT}) v ON v.vertex_id = (m.cell_id*13 + k*5) % n.n
WHERE k < m.n_edges AND NOT (k = 2 AND m.cell_id % 10 = 1) GROUP BY m.cell_id, m.lon, m.area_m2""", ("mesh",))
def mesh_polygons(i):
    m = i.sql(f"{POLY}", "mesh").withColumn("vertex_ids", F.transform(F.sequence(F.lit(0), F.lit(5)), lambda k: F.when(
        (k == 2) & (F.col("cell_id") % 10 == 1), F.lit(0)).otherwise((F.col("cell_id") * 13 + k * 5) % F.col("nv") + 1)))
    p = M.mesh_polygons(m, i.sql(VERT))
    total = F.aggregate("corner_lat", F.lit(0.0), lambda a, x: a + x)
    return p.withColumn("corners", F.size("corner_lat")).withColumn("sum_lat", total).withColumn("last_lon", F.element_at("corner_lon", -1))


TRI = """SELECT c.c_custkey, m.lat AS clat, m.lon AS clon, m.lat + (CAST(c.c_custkey % 21 AS DOUBLE) - 10)/100 AS plat,
 m.lon + (CAST(c.c_custkey % 17 AS DOUBLE) - 8)/100 AS plon
FROM customer c JOIN mesh m ON m.cell_id = c.c_custkey % (SELECT count(*) FROM supplier)"""


@query("inside_polygon", ["c_custkey", "inside"], f"""
WITH p AS ({TRI}), v AS (SELECT c_custkey, k, cos(la)*cos(lo) AS x, cos(la)*sin(lo) AS y, sin(la) AS z FROM (
 SELECT c_custkey, 0 AS k, clat - 0.05 AS la, clon - 0.05 AS lo FROM p UNION ALL SELECT c_custkey, 1, clat - 0.05, clon + 0.06 FROM p
 UNION ALL SELECT c_custkey, 2, clat + 0.07, clon FROM p)),
n AS (SELECT a.c_custkey, a.y*b.z - a.z*b.y AS nx, a.z*b.x - a.x*b.z AS ny, a.x*b.y - a.y*b.x AS nz FROM v a JOIN v b ON a.c_custkey = b.c_custkey AND b.k = (a.k + 1) % 3)
SELECT n.c_custkey, bool_and((nx*cos(plat)*cos(plon) + ny*cos(plat)*sin(plon) + nz*sin(plat))
 * CASE WHEN nx*cos(clat)*cos(clon) + ny*cos(clat)*sin(clon) + nz*sin(clat) >= 0 THEN 1 ELSE -1 END >= -1e-12) AS inside
FROM n JOIN p ON p.c_custkey = n.c_custkey GROUP BY n.c_custkey""", ("mesh",))
def inside_polygon(i):
    p = i.sql(TRI, "mesh")
    la = F.array(F.col("clat") - 0.05, F.col("clat") - 0.05, F.col("clat") + 0.07)
    lo = F.array(F.col("clon") - 0.05, F.col("clon") + 0.06, F.col("clon"))
    return p.withColumn("inside", G.inside_polygon(F.col("plat"), F.col("plon"), la, lo, F.col("clat"), F.col("clon")))


@query("neighbor_edges", ["CAST(cell_id AS BIGINT) AS cell_id", "CAST(nbr_id AS BIGINT) AS nbr_id"], """
WITH k AS (SELECT cell_id FROM mesh WHERE bdy_mask = 0),
a AS (SELECT e.* FROM edges e WHERE cell_id IN (FROM k) AND nbr_id IN (FROM k)),
b AS (SELECT cell_id FROM a GROUP BY cell_id HAVING count(*) = 2),
c AS (SELECT * FROM a WHERE cell_id IN (FROM b) AND nbr_id IN (FROM b))
SELECT * FROM c WHERE nbr_id IN (SELECT cell_id FROM c)""", ("edges", "mesh"))
def neighbor_edges(i):
    cells = i("mesh").filter("bdy_mask = 0").withColumn("n_edges", F.lit(2))
    return M.prune_edges(i("edges"), cells, require_full=True)


@query("neighbor_table", ["CAST(cell_id AS BIGINT) AS cell_id", "CAST(n_neighbors AS BIGINT) AS n_neighbors"], """
WITH e AS (SELECT cell_id, (cell_id*7 + 1) % n AS nbr_id FROM mesh, (SELECT count(*) AS n FROM mesh)
 UNION ALL SELECT cell_id, (cell_id*11 + 5) % n FROM mesh, (SELECT count(*) AS n FROM mesh)),
k AS (SELECT cell_id FROM mesh WHERE bdy_mask = 0),
a AS (SELECT e.* FROM e WHERE cell_id IN (FROM k) AND nbr_id IN (FROM k))
SELECT cell_id, count(*) AS n_neighbors FROM a WHERE nbr_id IN (SELECT cell_id FROM a) GROUP BY cell_id""", ("mesh",))
def neighbor_table(i):
    m = i.sql("SELECT m.*, (SELECT count(*) FROM supplier) AS n FROM mesh m", "mesh")
    m = m.withColumn("neighbors", F.expr("array((cell_id*7 + 1) % n + 1, (cell_id*11 + 5) % n + 1, 0)")).withColumn("n_edges", F.lit(3))
    return M.neighbor_counts(M.neighbor_edges(m))


FIELD = """SELECT CAST(floor(s_suppkey/20) AS INT) AS grid_id, CAST(-s_suppkey AS DOUBLE) AS lat, CAST(s_nationkey AS DOUBLE) AS lon, s_acctbal AS value FROM supplier"""


@query("flat_index", ["grid_id", "src_id", "ROUND(value, 4) AS value"], """
WITH s AS (SELECT CAST(s_suppkey // 20 AS INT) AS g, * FROM supplier), n AS (SELECT g, count(DISTINCT s_nationkey) AS n FROM s GROUP BY g)
SELECT s.g AS grid_id, CAST((rank() OVER (PARTITION BY s.g ORDER BY s_suppkey DESC) - 1)*n + dense_rank() OVER (PARTITION BY s.g ORDER BY s_nationkey) - 1 AS BIGINT) AS src_id, s_acctbal AS value
FROM s JOIN n ON n.g = s.g""")
def flat_index(i):
    v = i.sql(FIELD)
    lat, lon = (v.select("grid_id", F.col(c).alias("centre")).distinct() for c in ("lat", "lon"))
    return M.flat_index(v, lat, lon)


@query("point_flux", ["cell_id", "ROUND(gas, 6) AS gas", "ROUND(aerosol, 6) AS aerosol"], """
SELECT cell_id, 500/86400.0*6.022e23/(area_m2*1e4)/1e6 AS gas, 500*1000/12.0/86400.0*6.022e23/(area_m2*1e4)/1e6 AS aerosol FROM mesh""", ("mesh",))
def point_flux_query(i):
    return i("mesh").withColumn("gas", point_flux(F.lit(500.0), F.col("area_m2"), "gas") / 1e6).withColumn(
        "aerosol", point_flux(F.lit(500.0), F.col("area_m2"), "aerosol") / 1e6)


PROFILE = [0.2, 0.1, 0.1, 0.1, 0.1, 0.2, 0.4, 0.8, 1.2, 1.6, 2.0, 2.4, 2.6, 2.6, 2.4, 2.0, 1.6, 1.2, 0.8, 0.6, 0.4, 0.3, 0.2, 0.1]


@query("diurnal_expand", ["cell_id", "CAST(valid_time AS STRING) AS valid_time", "ROUND(value, 6) AS value"], f"""
WITH d AS (SELECT cell_id, day, sum(co) AS value FROM located WHERE cell_id >= 0 GROUP BY cell_id, day),
h AS (SELECT unnest(range(24)) AS h)
SELECT d.cell_id, CAST(day AS TIMESTAMP) + to_hours(CAST(h AS BIGINT)) AS valid_time,
 value*list_extract({PROFILE}, CAST((h + ((CAST(round_even(degrees(lon)/15, 0) AS INT) % 24) + 24) % 24) % 24 AS INT) + 1)/{sum(PROFILE)!r}*24 AS value
FROM d JOIN mesh m ON m.cell_id = d.cell_id CROSS JOIN h""", ("located", "mesh"))
def diurnal_expand(i):
    daily = P.aggregate_points(i("located"), ["cell_id", "day"], {"co": "value"})
    return P.expand_diurnal(daily, i("mesh"), PROFILE, ["value"])


# a grid per 36 customers, 18 centres an axis; every 25th grid repeats a centre
CENTRES = """SELECT concat('g', CAST(CAST(floor(c_custkey/36) AS INT) AS STRING)) AS grid_id, CASE WHEN c_custkey % 2 = 0 THEN 'lat' ELSE 'lon' END AS axis, CAST(floor(c_custkey % 36/2) AS INT) AS idx,
 CASE WHEN floor(c_custkey/36) % 25 = 3 AND floor(c_custkey % 36/2) = 5 THEN 0E0 ELSE CAST(floor(c_custkey % 36/2) AS DOUBLE)*20 END AS centre FROM customer"""


@query("axis_rules", ["grid_id", "axis", "rule"], f"""
WITH c AS ({CENTRES}), d AS (SELECT *, centre - lag(centre) OVER (PARTITION BY grid_id, axis ORDER BY idx) AS step FROM c),
s AS (SELECT grid_id, axis, count(*) AS n, min(step) AS least_step, max(centre) - min(centre) + (arg_min(step, idx) FILTER (step IS NOT NULL) + arg_max(step, idx))/2 AS span FROM d GROUP BY 1, 2)
SELECT grid_id, axis, CASE WHEN n < 2 THEN 'too_short' WHEN least_step <= 0 THEN 'not_increasing' WHEN axis = 'lon' AND abs(span - 360) > 1e-6 THEN 'span_not_360' END AS rule
FROM s WHERE rule IS NOT NULL""".replace("WHERE rule IS NOT NULL", "WHERE n < 2 OR least_step <= 0 OR (axis = 'lon' AND abs(span - 360) > 1e-6)"))
def axis_rules(i):
    return M.axis_violations(i.sql(CENTRES))


@query("identity_verdict", ["grid_id", "verdict"], f"""SELECT grid_id, CASE WHEN CAST(substr(grid_id, 5) AS INT) % 4 = 1 THEN 'warn' WHEN CAST(substr(grid_id, 5) AS INT) % 4 = 2 THEN 'rebuild' ELSE 'use' END AS verdict
FROM ({IDENT_SQL})""")
def identity_verdict(i):
    now = M.grid_identity(i.sql(GRIDS)).withColumn("k", F.expr("CAST(substr(grid_id, 5) AS INT) % 4"))
    kept = now.filter("k <> 1").withColumn("fingerprint", F.expr("CASE WHEN k = 2 THEN 'old' ELSE fingerprint END")).drop("k")
    return M.check_identity(kept, now.drop("k"), ["grid_id"], supplied=False)
