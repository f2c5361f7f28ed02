"""Nearest cells, point aggregation, vegetation, pixels, footprint support."""
from __future__ import annotations

from pyspark.sql import functions as F

from catalog.registry import query
from gridspark.operators import points as P
from gridspark.operators import vegetation as V
from gridspark.operators.nearest import cell_index, nearest_cell

_indexes: dict[tuple, object] = {}


def boxes(i, interior: bool = False):
    """Box table of the mesh of this folder, written once per application and reused."""
    key = (i.spark.sparkContext.applicationId, i.folder, interior)
    if key not in _indexes:
        mesh = i("mesh").filter("bdy_mask = 0") if interior else i("mesh")
        _indexes[key] = cell_index(mesh)
    return _indexes[key]


XYZ = """p AS (SELECT fire_id, cos(radians(lat))*cos(radians(lon)) AS x, cos(radians(lat))*sin(radians(lon)) AS y, sin(radians(lat)) AS z FROM fires),
m AS (SELECT cell_id, area_m2, cos(lat)*cos(lon) AS x, cos(lat)*sin(lon) AS y, sin(lat) AS z FROM mesh{})"""
NEAREST = """WITH {}, d AS (SELECT fire_id, m.cell_id, area_m2, power(p.x - m.x, 2) + power(p.y - m.y, 2) + power(p.z - m.z, 2) AS d FROM p CROSS JOIN m)
SELECT fire_id, arg_min(cell_id, d) AS cell_id, 6371.229*2*asin(sqrt(min(d))/2) AS distance_km, arg_min(area_m2, d) AS area_m2 FROM d GROUP BY fire_id"""
NEAR_COLS = ["fire_id", "CAST(cell_id AS BIGINT) AS cell_id", "ROUND(distance_km, 5) AS distance_km"]


@query("nearest_cell", NEAR_COLS, NEAREST.format(XYZ.format("")), ("fires", "mesh"))
def nearest_all(i):
    return nearest_cell(i("fires"), i("mesh"), index=boxes(i))


@query("nearest_interior_cell", NEAR_COLS, NEAREST.format(XYZ.format(" WHERE bdy_mask = 0")), ("fires", "mesh"))
def nearest_interior(i):
    return nearest_cell(i("fires"), i("mesh"), interior_only=True, index=boxes(i, True))


@query("nearest_cell_reject", NEAR_COLS, f"""SELECT fire_id, CASE WHEN distance_km*1000 <= 50*sqrt(area_m2/pi()) THEN cell_id ELSE -1 END AS cell_id, distance_km
FROM ({NEAREST.format(XYZ.format(''))})""", ("fires", "mesh"))
def nearest_reject(i):
    return nearest_cell(i("fires"), i("mesh"), reject_outside=True, factor=50.0, index=boxes(i))


@query("point_sums", ["CAST(day AS STRING) AS day", "cell_id", "ROUND(co, 4) AS co", "ROUND(bc, 4) AS bc", "ROUND(frp, 6) AS frp"], """
SELECT day, cell_id, sum(co) AS co, sum(bc) AS bc, avg(frp) AS frp FROM located WHERE cell_id >= 0 GROUP BY day, cell_id""", ("located",))
def point_sums(i):
    return P.aggregate_points(i("located"), ["day", "cell_id"], {"co": "co", "bc": "bc", "frp": "frp", "absent": "x"}, {"frp": "mean"})


@query("species_flux", ["CAST(day AS STRING) AS day", "cell_id", "ROUND(co, 4) AS co", "ROUND(bc, 4) AS bc", "ROUND(frp, 6) AS frp"], """
SELECT day, l.cell_id, sum(co)/86400*6.022e23/(area_m2*1e4)*0.7/1e3 AS co, sum(bc)*1000/12.0/86400*6.022e23/(area_m2*1e4)/1e6 AS bc, avg(frp) AS frp
FROM located l JOIN mesh m ON m.cell_id = l.cell_id GROUP BY day, l.cell_id, area_m2""", ("located", "mesh"))
def species_flux(i):
    sums = P.aggregate_points(i("located"), ["day", "cell_id"], {"co": "co", "bc": "bc", "frp": "frp"}, {"frp": "mean"})
    out = P.points_to_flux(sums, i("mesh"), {"co": "gas", "bc": "aerosol", "frp": "scalar"}, {"co": 0.7, "frp": 9.0})
    return out.withColumn("co", F.col("co") / 1e3).withColumn("bc", F.col("bc") / 1e6)


@query("fire_moments", ["CAST(day AS STRING) AS day", "cell_id", "ROUND(fire_size_avg, 3) AS fire_size_avg", "ROUND(fire_size_std, 3) AS fire_size_std",
                        "ROUND(frp_avg, 5) AS frp_avg", "ROUND(frp_std, 5) AS frp_std"], """
SELECT day, cell_id, coalesce(avg(CASE WHEN a >= 0 THEN a END), 0) AS fire_size_avg, coalesce(stddev_pop(CASE WHEN a >= 0 THEN a END), 0) AS fire_size_std, avg(frp) AS frp_avg, stddev_pop(frp) AS frp_std
FROM (SELECT *, CASE WHEN fire_id % 19 = 5 THEN -area ELSE area END AS a FROM located) WHERE cell_id >= 0 GROUP BY day, cell_id""", ("located",))
def fire_moments(i):
    f = i("located").withColumn("area", F.expr("CASE WHEN fire_id % 19 = 5 THEN -area ELSE area END"))
    return P.fire_moments(f, ["day", "cell_id"])


@query("silent_zero", ["genveg", "CAST(n_read AS BIGINT) AS n_read"], """
SELECT genveg, count(*) AS n_read FROM located GROUP BY genveg HAVING sum(CASE WHEN cell_id >= 0 AND genveg <> 3 THEN 1 ELSE 0 END) = 0""", ("located",))
def silent_zero(i):
    f = i("located").withColumn("cell_id", F.expr("CASE WHEN genveg = 3 THEN -1 ELSE cell_id END"))
    return P.silent_zero(f, ["genveg"])


CAT = "CASE genveg WHEN 1 THEN 4 WHEN 2 THEN 3 WHEN 3 THEN 1 WHEN 4 THEN 2 ELSE 0 END"
VEG_COLS = ["CAST(day AS STRING) AS day", "cell_id", "CAST(category AS INT) AS category", "ROUND(share, 8) AS share", "ROUND(known_frac, 8) AS known_frac",
            "CAST(n_records AS BIGINT) AS n_records", "ROUND(mean_area, 4) AS mean_area"]


def _veg_sql(table, keys="day, cell_id"):
    return f"""WITH k AS (SELECT {keys}, {CAT} AS c, sum(area) AS w, count(*) AS n FROM {table} GROUP BY {keys}, c)
SELECT {keys}, CASE WHEN sum(CASE WHEN c > 0 THEN w ELSE 0 END) > 0 THEN arg_max(c, CASE WHEN c > 0 THEN w*100 - c*1e-9 ELSE -1 END) ELSE 0 END AS category,
 CASE WHEN sum(CASE WHEN c > 0 THEN w ELSE 0 END) > 0 THEN max(CASE WHEN c > 0 THEN w ELSE 0 END)/sum(CASE WHEN c > 0 THEN w ELSE 0 END) ELSE 0 END AS share,
 CASE WHEN sum(w) > 0 THEN sum(CASE WHEN c > 0 THEN w ELSE 0 END)/sum(w) ELSE 0 END AS known_frac, sum(n) AS n_records, sum(w)/sum(n) AS mean_area FROM k GROUP BY {keys}"""


@query("dominant_category", VEG_COLS, _veg_sql("(SELECT * FROM located WHERE cell_id >= 0)"), ("located",))
def dominant_category(i):
    return V.dominant_category(P.accepted(i("located")), ["day", "cell_id"])


@query("category_crosswalk", ["genveg", "CAST(category AS INT) AS category", "CAST(n AS BIGINT) AS n"], f"SELECT genveg, {CAT} AS category, count(*) AS n FROM fires GROUP BY genveg", ("fires",))
def category_crosswalk(i):
    return i("fires").withColumn("category", V.crosswalk(F.col("genveg"))).groupBy("genveg", "category").agg(F.count(F.lit(1)).alias("n"))


BROKEN = """SELECT file_date, lat, CASE WHEN fire_id % 41 = 1 THEN lon + 1000 ELSE lon END AS lon, CASE WHEN fire_id % 43 = 1 THEN 7 ELSE genveg END AS genveg,
 CASE WHEN fire_id % 47 = 1 THEN -area WHEN fire_id % 53 = 1 THEN CAST('NaN' AS DOUBLE) ELSE area END AS area,
 CASE WHEN fire_id % 59 = 1 THEN 400 ELSE extract(doy FROM file_date) END AS day_number FROM fires"""


@query("fire_validation", ["CAST(file_date AS STRING) AS file_date", "reason", "CAST(n AS BIGINT) AS n", "fatal"], f"""
SELECT file_date, reason, count(*) AS n, reason <> 'negative_area' AS fatal FROM (SELECT file_date, CASE WHEN isnan(area) THEN 'nonfinite' WHEN day_number = 400 THEN 'day_mismatch'
 WHEN lon > 360 THEN 'coordinates' WHEN area < 0 THEN 'negative_area' WHEN genveg = 7 THEN 'unknown_code' END AS reason FROM ({BROKEN})) WHERE reason IS NOT NULL GROUP BY 1, 2""", ("fires",))
def fire_validation(i):
    return V.validate_fires(i.sql(BROKEN, "fires"), F.col("file_date"))[1]


@query("fire_validation_kept", ["CAST(file_date AS STRING) AS file_date", "CAST(n AS BIGINT) AS n", "ROUND(area, 2) AS area"], f"""
SELECT file_date, count(*) AS n, sum(area) AS area FROM ({BROKEN}) WHERE NOT isnan(area) AND day_number < 400 AND lon <= 360 AND area >= 0 AND genveg <> 7 GROUP BY 1""", ("fires",))
def fire_validation_kept(i):
    kept, _ = V.validate_fires(i.sql(BROKEN, "fires"), F.col("file_date"))
    return kept.groupBy("file_date").agg(F.count(F.lit(1)).alias("n"), F.sum("area").alias("area"))


AXIS = """SELECT CAST(s_suppkey AS INT) AS idx, {a} + CAST(s_suppkey*{w} AS DOUBLE)/(SELECT count(*) FROM supplier) AS lo,
 {a} + CAST((s_suppkey + 1)*{w} AS DOUBLE)/(SELECT count(*) FROM supplier) AS hi FROM supplier"""
LAT_AXIS, LON_AXIS = AXIS.format(a=-90, w=180), AXIS.format(a=-180, w=360)
TURNED = "SELECT f.*, CASE WHEN fire_id % 2 = 0 THEN lon ELSE lon + 360 END AS turned FROM fires f"
PIXEL_SQL = f"""SELECT f.*, y.idx AS iy, x.idx AS ix FROM (SELECT *, (turned + 180) % 360 - 180 AS x FROM ({TURNED})) f
JOIN ({LAT_AXIS}) y ON y.lo <= f.lat AND f.lat < y.hi JOIN ({LON_AXIS}) x ON x.lo <= f.x AND f.x < x.hi"""


@query("pixel_assign", ["fire_id", "iy", "ix"], PIXEL_SQL, ("fires",))
def pixel_assign(i):
    return V.assign_pixel(i.sql(TURNED, "fires"), i.sql(LAT_AXIS), i.sql(LON_AXIS), lon="turned")


@query("emitting_records", ["fire_id", "iy", "ix"], f"""SELECT fire_id, iy, ix FROM ({PIXEL_SQL}) WHERE area > 0 AND (iy*7 + ix) % 5 > 1""", ("fires",))
def emitting_records(i):
    placed = V.assign_pixel(i.sql(TURNED, "fires"), i.sql(LAT_AXIS), i.sql(LON_AXIS), lon="turned")
    lit = placed.select("day", "iy", "ix").distinct().withColumn("flux", F.expr(
        "CASE (iy*7 + ix) % 5 WHEN 0 THEN 0D WHEN 1 THEN double('NaN') ELSE 1D + ix END"))
    return V.emitting_records(placed, lit)


@query("duplicate_records", ["CAST(file_date AS STRING) AS file_date", "genveg", "CAST(n AS BIGINT) AS n"], """
SELECT file_date, genveg, count(*) AS n FROM (SELECT file_date, genveg, round(area/1000) AS area FROM fires) GROUP BY file_date, genveg, area HAVING count(*) > 1""", ("fires",))
def duplicate_records(i):
    return V.duplicate_records(i.sql("SELECT file_date, 0E0 AS lat, 0E0 AS lon, genveg, round(area/1000) AS area FROM fires", "fires"))


FIRE_SIZE = "SELECT DISTINCT day, cell_id, CASE WHEN cell_id % 3 = 0 THEN 0E0 ELSE 50E0 + cell_id END AS value FROM located WHERE cell_id >= 0"
TARGET = "SELECT day, cell_id, co AS value FROM located WHERE cell_id >= 0 AND fire_id % 4 = 1"


@query("eligible_cells", ["CAST(day AS STRING) AS day", "cell_id"], f"""SELECT s.day, s.cell_id FROM ({FIRE_SIZE}) s
WHERE value = 0 AND EXISTS (SELECT 1 FROM ({TARGET}) t WHERE t.day = s.day AND t.cell_id = s.cell_id AND t.value > 0)""", ("located",))
def eligible_cells(i):
    return V.eligible_cells(i.sql(FIRE_SIZE, "located"), i.sql(TARGET, "located"))


# overlap geometry replaced by an arithmetic match, so that the assignment itself has a SQL form
# pixels multiply with the cells: a cell meets five pixels of its own and a fire one cell
MATCHES = " UNION ALL ".join(f"SELECT cell_id, CAST(cell_id AS INT) AS iy, {k} AS ix FROM mesh" for k in range(5))
RECORDS = "SELECT day, fire_id AS record_id, CAST(fire_id % (SELECT count(*) FROM supplier) AS INT) AS iy, CAST(fire_id % 7 AS INT) AS ix, genveg, area FROM fires"
VEG = "SELECT day, cell_id, 0 AS category, 0E0 AS share, 0E0 AS known_frac, CAST(0 AS BIGINT) AS n_records FROM ({})".format(FIRE_SIZE) + " v"
SUPPORT = f"""h AS (SELECT DISTINCT r.day, e.cell_id, r.record_id, r.genveg, r.area FROM ({RECORDS}) r JOIN ({MATCHES}) m ON m.iy = r.iy AND m.ix = r.ix
 JOIN (SELECT day, cell_id FROM ({FIRE_SIZE}) WHERE value = 0) e ON e.cell_id = m.cell_id AND e.day = r.day),
n AS (SELECT * FROM ({_veg_sql('h')}) WHERE category > 0)"""


@query("footprint_support", ["CAST(day AS STRING) AS day", "cell_id", "ROUND(value, 3) AS value", "CAST(category AS INT) AS category", "ROUND(share, 8) AS share",
                             "CAST(n_records AS BIGINT) AS n_records"], f"""WITH {SUPPORT}
SELECT s.day, s.cell_id, coalesce(mean_area, value) AS value, coalesce(category, 0) AS category, coalesce(share, 0) AS share, coalesce(n_records, 0) AS n_records
FROM ({FIRE_SIZE}) s LEFT JOIN n ON n.day = s.day AND n.cell_id = s.cell_id""", ("located", "mesh"))
def footprint_support(i):
    size, veg = i.sql(FIRE_SIZE, "located"), i.sql(VEG, "located")
    eligible = size.filter("value = 0").select("day", "cell_id")
    new_size, new_veg = V.footprint_support(eligible, i.sql(MATCHES, "mesh"), i.sql(RECORDS, "fires"), size, veg)
    return new_size.join(new_veg, ["day", "cell_id"])


@query("mean_consistency", ["CAST(day AS STRING) AS day", "cell_id", "ROUND(a, 4) AS a", "ROUND(b, 4) AS b"], """
WITH a AS (SELECT day, cell_id, avg(area) AS v FROM located WHERE cell_id >= 0 GROUP BY 1, 2)
SELECT day, cell_id, v AS a, CASE WHEN cell_id % 6 = 0 THEN v*1.001 ELSE v END AS b FROM a WHERE NOT abs(v - CASE WHEN cell_id % 6 = 0 THEN v*1.001 ELSE v END) <= 0.5 + 2e-5*abs(CASE WHEN cell_id % 6 = 0 THEN v*1.001 ELSE v END)""", ("located",))
def mean_consistency(i):
    a = V.dominant_category(P.accepted(i("located")), ["day", "cell_id"]).withColumnRenamed("mean_area", "v")
    b = a.withColumn("v", F.expr("CASE WHEN cell_id % 6 = 0 THEN v*1.001D ELSE v END"))
    return V.check_consistency(a, b, ["day", "cell_id"], "v")


@query("manifest_days", ["CAST(day AS STRING) AS day", "rule"], """
WITH d AS (SELECT CAST(ts AS DATE) AS day, count(*) AS n FROM events WHERE day(ts) NOT IN (7, 15) GROUP BY 1),
f AS (SELECT * FROM d WHERE n > 0)
SELECT day, 'gap' AS rule FROM f WHERE day + INTERVAL 1 DAY NOT IN (SELECT day FROM f) AND day <> (SELECT max(day) FROM f)""")
def manifest_days(i):
    m = i.sql("SELECT DISTINCT CAST(ts AS DATE) AS day FROM events WHERE day(ts) NOT IN (7, 15)")
    return V.reference_days(m, m)


def _clip_sql(k):
    """One step of clipping: the ring r against edge k of the cell c, from CTE c{k} to c{k + 1}."""
    nxt = (k + 1) % 4 + 1
    at = f"c[{k + 1}]"
    return f"""h{k} AS (SELECT *, list_transform(r, lambda p: ((c[{nxt}].x - {at}.x)*(p.y - {at}.y) - (c[{nxt}].y - {at}.y)*(p.x - {at}.x))*turn) AS h FROM c{k}),
c{k + 1} AS (SELECT * EXCLUDE (r, h), flatten(list_transform(range(1, len(r) + 1), lambda i: list_concat(
 CASE WHEN h[i] >= 0 THEN [r[i]] ELSE [] END,
 CASE WHEN (h[i] >= 0) <> (h[i % len(r) + 1] >= 0) THEN [{{'x': r[i].x + (r[i % len(r) + 1].x - r[i].x)*(h[i]/(h[i] - h[i % len(r) + 1])),
  'y': r[i].y + (r[i % len(r) + 1].y - r[i].y)*(h[i]/(h[i] - h[i % len(r) + 1]))}}] ELSE [] END))) AS r FROM h{k})"""


def _plane_sql(lat, lon):
    """A point (radians) on the plane that touches the sphere at clat, clon."""
    depth = f"(sin(clat)*sin({lat}) + cos(clat)*cos({lat})*cos({lon} - clon))"
    return f"""{{'x': cos({lat})*sin({lon} - clon)*(6371220e0/{depth}), 'y': (cos(clat)*sin({lat}) - sin(clat)*cos({lat})*cos({lon} - clon))*(6371220e0/{depth})}}"""


def _shoelace_sql(ring):
    return f"list_sum(list_transform(range(1, len({ring}) + 1), lambda i: {ring}[i].x*{ring}[i % len({ring}) + 1].y - {ring}[i % len({ring}) + 1].x*{ring}[i].y))/2"


def overlap_sql(h, cells="mesh"):
    """CTEs that end in met_areas(cell_id, iy, ix, coarse, fine): every close pair of a square cell of half width ``h`` and a pixel with
    fires, clipped edge by edge."""
    angle = "2*asin(least(sqrt(power(cos({0})*cos({1}) - cos({2})*cos({3}), 2) + power(cos({0})*sin({1}) - cos({2})*sin({3}), 2) + power(sin({0}) - sin({2}), 2))/2, 1))"
    corners = [(-1, -1), (-1, 1), (1, 1), (1, -1)]
    reach = ", ".join(angle.format(f"lat + h*{a}", f"lon + h*{b}", "lat", "lon") for a, b in corners)
    share = "(CASE WHEN k <= pieces THEN k ELSE 2*pieces + 1 - k END)::DOUBLE/pieces"
    ring = _plane_sql("CASE WHEN k <= pieces THEN radians(lat_lo) ELSE radians(lat_hi) END", f"(radians(lon_lo) + (radians(lon_hi) - radians(lon_lo))*({share}))")
    return f"""ax_lat AS ({LAT_AXIS}), ax_lon AS ({LON_AXIS}),
lit AS (SELECT DISTINCT y.idx AS iy, x.idx AS ix, y.lo AS lat_lo, y.hi AS lat_hi, x.lo AS lon_lo, x.hi AS lon_hi FROM fires f
 JOIN ax_lat y ON y.lo <= f.lat AND f.lat < y.hi JOIN ax_lon x ON x.lo <= f.lon AND f.lon < x.hi),
cc AS (SELECT cell_id, lat, lon, {h} AS h FROM {cells}),
cr AS (SELECT *, greatest({reach}) + 1e-8 AS reach FROM cc),
near_ AS (SELECT cell_id, iy, ix, lat AS clat, lon AS clon, h, lat_lo, lat_hi, lon_lo, lon_hi FROM cr, lit
 WHERE {angle.format("radians((lat_lo + lat_hi)/2)", "radians((lon_lo + lon_hi)/2)", "lat", "lon")} <= reach + radians((lon_hi - lon_lo + lat_hi - lat_lo)/2)),
steps_ AS (SELECT *, CAST(greatest(1, ceil((lon_hi - lon_lo)/step)) AS BIGINT) AS pieces FROM near_, (SELECT unnest([0.02e0, 0.01e0]) AS step)),
rings AS (SELECT cell_id, iy, ix, step, list_transform(range(0, 2*pieces + 2), lambda k: {ring}) AS r,
 [{", ".join(_plane_sql(f"(clat + h*{a})", f"(clon + h*{b})") for a, b in corners)}] AS c FROM steps_),
c0 AS (SELECT *, sign({_shoelace_sql("c")}) AS turn FROM rings),
{", ".join(_clip_sql(k) for k in range(4))},
areas AS (SELECT cell_id, iy, ix, step, CASE WHEN len(r) = 0 THEN 0e0 ELSE abs({_shoelace_sql("r")}) END AS area FROM c4),
met_areas AS (SELECT cell_id, iy, ix, max(area) FILTER (step > 0.015) AS coarse, max(area) FILTER (step < 0.015) AS fine FROM areas GROUP BY 1, 2, 3)"""


@query("overlap_pairs", ["CAST(cell_id AS BIGINT) AS cell_id", "CAST(iy AS INT) AS iy", "CAST(ix AS INT) AS ix", "ROUND(area_fine/1e6, 2) AS area_km2", "decided"], f"""
WITH {overlap_sql("0.2e0/sqrt((SELECT count(*) FROM supplier))")}
SELECT cell_id, iy, ix, fine AS area_fine, (coarse > 1) = (fine > 1) AS decided FROM met_areas WHERE fine > 1 OR coarse > 1""", ("fires", "mesh"))
def overlap_pairs(i):
    h = 0.2 / i.table("supplier").count() ** 0.5  # half width of a cell in radians; cells shrink as they multiply
    cells = i("mesh").select("cell_id", "lat", "lon", F.array(*[F.col("lat") + h * s for s in (-1, -1, 1, 1)]).alias("corner_lat"),
                             F.array(*[F.col("lon") + h * s for s in (-1, 1, 1, -1)]).alias("corner_lon"))
    lat, lon = i.sql(LAT_AXIS), i.sql(LON_AXIS)
    placed = V.assign_pixel(i("fires"), lat, lon, wrap=False).select("iy", "ix").distinct()
    pixels = placed.join(lat.select(F.col("idx").alias("iy"), F.col("lo").alias("lat_lo"), F.col("hi").alias("lat_hi")), "iy").join(
        lon.select(F.col("idx").alias("ix"), F.col("lo").alias("lon_lo"), F.col("hi").alias("lon_hi")), "ix")
    pairs, unsure = V.overlap_pairs(cells, pixels)
    return pairs.withColumn("decided", F.lit(True)).unionByName(unsure.select("cell_id", "iy", "ix", "area_fine").withColumn("decided", F.lit(False)))


PARTIAL = "SELECT genveg, fire_id, area, CASE WHEN genveg % 2 = 0 THEN frp END AS frp FROM fires"


@query("optional_defaults", ["genveg", "ROUND(frp, 3) AS frp", "spread", "CAST(n AS BIGINT) AS n"], f"""
SELECT genveg, sum(coalesce(frp, 0)) AS frp, 0e0 AS spread, count(*) AS n FROM ({PARTIAL}) GROUP BY genveg""", ("fires",))
def optional_defaults(i):
    out, _ = P.default_optional(i.sql(PARTIAL, "fires"), ["frp", "spread"], ["genveg"])
    return out.groupBy("genveg").agg(F.sum("frp").alias("frp"), F.sum("spread").alias("spread"), F.count(F.lit(1)).alias("n"))


@query("optional_warnings", ["genveg", "field"], """
SELECT DISTINCT genveg, 'spread' AS field FROM fires UNION ALL SELECT DISTINCT genveg, 'frp' FROM fires WHERE genveg % 2 = 1""", ("fires",))
def optional_warnings(i):
    return P.default_optional(i.sql(PARTIAL, "fires"), ["frp", "spread"], ["genveg"])[1]
