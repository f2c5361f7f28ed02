"""Text, gridded and feedback sources; product checks."""
from __future__ import annotations

from pyspark.sql import functions as F

from catalog.registry import query
from gridspark.functions import dates as DT
from gridspark.functions import geometry as G
from gridspark.functions.numbers import FEEDBACK_FILL, is_unparsed, missing_policy, parse_double
from gridspark.sources import feedback as FB
from gridspark.sources import fire_text as FT
from gridspark.sources import gridded as GR
from gridspark.sources import products as PR

# Daily files as lines: odd days in Fortran notation with a trailing comma, even days separated by blanks,
# a comment and a blank line in each, columns in another order.
LINES = """
SELECT concat('/data/GLOB_X_2024', lpad(CAST(extract(doy FROM ts) AS STRING), 3, '0'), '.txt') AS file, 10 + event_id AS pos,
 CASE WHEN day(ts) % 2 = 1 THEN concat(CAST(extract(doy FROM ts) AS STRING), ',', CAST(event_id AS STRING), ', ', replace(CAST(CAST(event_id % 800 AS DOUBLE)/10 AS STRING), 'e', 'E'), 'D+00,', '0.', CAST(100 + event_id % 900 AS STRING), 'D+03,', CASE event_id % 11 WHEN 0 THEN 'nan' WHEN 1 THEN 'x1' ELSE '7.5' END, ',')
 ELSE concat(CAST(event_id % 800 AS STRING), 'E-1   ', CAST(event_id AS STRING), '  ', CAST(100 + event_id % 900 AS STRING), ' ', CASE event_id % 11 WHEN 0 THEN 'nan' WHEN 1 THEN '*' ELSE '7.5' END) END AS line
FROM events
UNION ALL SELECT DISTINCT concat('/data/GLOB_X_2024', lpad(CAST(extract(doy FROM ts) AS STRING), 3, '0'), '.txt'), 0, '# made up' FROM events
UNION ALL SELECT DISTINCT concat('/data/GLOB_X_2024', lpad(CAST(extract(doy FROM ts) AS STRING), 3, '0'), '.txt'), 1, '  ' FROM events
UNION ALL SELECT DISTINCT concat('/data/GLOB_X_2024', lpad(CAST(extract(doy FROM ts) AS STRING), 3, '0'), '.txt'), 2,
 CASE WHEN day(ts) % 2 = 1 THEN 'DAY,FIRE, LATI,AREA,CO' ELSE 'LAT FIRE FIRE_AREA CO' END FROM events"""
LINE_COLUMNS = {"fire": ["FIRE"], "lat": FT.LAT_NAMES, "area": FT.AREA_NAMES, "co": ["CO"]}


def _records(i):
    return FT.parse_lines(i.sql(LINES), LINE_COLUMNS).withColumn("file_date", DT.date_from_name(F.col("file")))


@query("fire_text_parse", ["CAST(file_date AS STRING) AS file_date", "CAST(fire AS BIGINT) AS fire", "ROUND(lat, 4) AS lat", "ROUND(area, 4) AS area", "co", "bad_co"], """
SELECT CAST(ts AS DATE) AS file_date, event_id AS fire, (event_id % 800)/10.0 AS lat, CAST(100 + event_id % 900 AS DOUBLE) AS area,
 CASE WHEN event_id % 11 > 1 THEN 7.5e0 END AS co, event_id % 11 = 1 AND day(ts) % 2 = 1 AS bad_co FROM events""")
def fire_text_parse(i):
    return _records(i)


# a file per customer: quoted names, names that begin like records, records that begin with letters
LAYOUT_LINES = """SELECT concat('f', CAST(c_custkey AS STRING)) AS file, k AS pos, CASE k WHEN 0 THEN '# note' WHEN 1 THEN
 CASE c_custkey % 4 WHEN 0 THEN '"DAY","LATI","AREA"' WHEN 1 THEN 'CO,LATI,AREA' WHEN 2 THEN 'CO LATI AREA' ELSE 'CO, LATI, AREA' END
 WHEN 2 THEN CASE c_custkey % 4 WHEN 0 THEN concat(CAST(c_custkey AS STRING), ',2.0,3.0') WHEN 1 THEN 'nan 2.0 3.0' WHEN 2 THEN 'x 2.0 3.0' ELSE 'nan,2.0,3.0,' END
 ELSE '7,8,9' END AS line FROM customer CROSS JOIN (SELECT 0 AS k UNION ALL SELECT 1 UNION ALL SELECT 2 UNION ALL SELECT 3) x"""


@query("fire_text_layouts", ["file", "comma", "names"], """
SELECT 'f' || c_custkey AS file, c_custkey % 4 IN (0, 3) AS comma, CASE WHEN c_custkey % 4 = 0 THEN 'day lati area' ELSE 'co lati area' END AS names FROM customer""")
def fire_text_layouts(i):
    return FT.file_layouts(FT.content_lines(i.sql(LAYOUT_LINES))).withColumn("names", F.array_join("names", " "))


@query("fire_text_guard", ["file", "field", "rule"], """
SELECT '/data/GLOB_X_2024' || lpad(CAST(dayofyear(ts) AS VARCHAR), 3, '0') || '.txt' AS file, 'co' AS field, 'too_many_unparsed' AS rule FROM events
WHERE day(ts) % 2 = 1 GROUP BY 1 HAVING count(*) FILTER (event_id % 11 = 1) > 0.02*count(*)""")
def fire_text_guard(i):
    return FT.parse_guard(_records(i), ["lat", "area", "co"])


@query("fire_text_missing_column", ["file", "missing"], """
SELECT DISTINCT '/data/GLOB_X_2024' || lpad(CAST(dayofyear(ts) AS VARCHAR), 3, '0') || '.txt' AS file, 'day' AS missing FROM events WHERE day(ts) % 2 = 0""")
def fire_text_missing_column(i):
    return FT.missing_columns(i.sql(LINES), {**LINE_COLUMNS, "day": FT.DAY_NAMES}, ["lat", "area", "day"])


TOKENS = "SELECT event_id, CASE event_id % 9 WHEN 0 THEN concat('  ', CAST(event_id AS STRING), '.5D+01') WHEN 1 THEN concat('-0.', CAST(1 + event_id % 7 AS STRING), 'd-2') WHEN 2 THEN '' WHEN 3 THEN 'N/A' WHEN 4 THEN '12DEF' WHEN 5 THEN '1.5f' WHEN 6 THEN '+3' WHEN 7 THEN concat(CAST(event_id AS STRING), 'e1') ELSE '.25' END AS t FROM events"


@query("fortran_numbers", ["event_id", "ROUND(v, 6) AS v", "bad"], """
SELECT event_id, CASE event_id % 9 WHEN 0 THEN (event_id + 0.5e0)*10 WHEN 1 THEN -(1 + event_id % 7)/1000.0 WHEN 6 THEN 3 WHEN 7 THEN event_id*10e0 WHEN 8 THEN 0.25 END AS v, event_id % 9 IN (4, 5) AS bad FROM events""")
def fortran_numbers(i):
    return i.sql(TOKENS).select("event_id", parse_double(F.col("t")).alias("v"), is_unparsed(F.col("t")).alias("bad"))


@query("date_from_name", ["o_orderkey", "CAST(d AS STRING) AS d"], """
SELECT o_orderkey, CASE WHEN year(o_orderdate) >= 2000 AND o_orderkey % 3 < 2 THEN CAST(o_orderdate AS DATE) END AS d FROM orders""")
def date_from_name(i):
    name = """SELECT o_orderkey, CASE o_orderkey % 3 WHEN 0 THEN concat('/a/2b/F_', date_format(o_orderdate, 'yyyyMMdd'), '.txt.gz?v=20010101') WHEN 1 THEN concat('GLOB_M_', date_format(o_orderdate, 'yyyyDDD'), '.txt')
              ELSE concat('F_', date_format(o_orderdate, 'yyyyMM'), '.txt') END AS name FROM orders"""
    return i.sql(name).withColumn("d", DT.date_from_name(F.col("name")))


CONTAINERS = """SELECT o_orderkey, CASE o_custkey % 4 WHEN 0 THEN 'F_1997_c20220714.txt' WHEN 1 THEN 'F_199703_c20230101.txt' WHEN 2 THEN 'F_199702.txt' ELSE 'dated.txt' END AS file,
 CASE o_custkey % 4 WHEN 0 THEN CAST(1 + o_orderkey % 365 AS STRING) WHEN 1 THEN CAST(1 + o_orderkey % 31 AS STRING) WHEN 2 THEN CAST(32 + o_orderkey % 28 AS STRING)
 ELSE CASE o_orderkey % 4 WHEN 0 THEN date_format(o_orderdate, 'yyyyMMdd') WHEN 1 THEN date_format(o_orderdate, 'yyyy-MM-dd') WHEN 2 THEN date_format(o_orderdate, 'yyyy/MM/dd') ELSE date_format(o_orderdate, 'yyyyDDD') END END AS day FROM orders"""
CONTAINER_SQL = """SELECT o_orderkey, CASE o_custkey % 4 WHEN 0 THEN 'F_1997_c20220714.txt' WHEN 1 THEN 'F_199703_c20230101.txt' WHEN 2 THEN 'F_199702.txt' ELSE 'dated.txt' END AS file,
 CASE o_custkey % 4 WHEN 0 THEN DATE '1997-01-01' + CAST(o_orderkey % 365 AS INT) WHEN 1 THEN DATE '1997-03-01' + CAST(o_orderkey % 31 AS INT) WHEN 2 THEN DATE '1997-02-01' + CAST(o_orderkey % 28 AS INT) ELSE CAST(o_orderdate AS DATE) END AS file_date FROM orders"""


@query("container_dates", ["o_orderkey", "CAST(file_date AS STRING) AS file_date"], CONTAINER_SQL)
def container_dates(i):
    return FT.container_dates(i.sql(CONTAINERS))


@query("stage_days", ["CAST(file_date AS STRING) AS file_date", "CAST(n AS BIGINT) AS n", "repeated"], f"""
SELECT file_date, count(*) AS n, count(DISTINCT file) > 1 AS repeated FROM ({CONTAINER_SQL}) WHERE file_date BETWEEN DATE '1997-02-10' AND DATE '1997-04-10' GROUP BY file_date""")
def stage_days(i):
    kept, repeated = FT.stage_days(FT.container_dates(i.sql(CONTAINERS)), "1997-02-10", "1997-04-10")
    n = kept.groupBy("file_date").agg(F.count(F.lit(1)).alias("n"))
    return n.join(repeated, "file_date", "left").withColumn("repeated", F.col("n_files").isNotNull())


CANDIDATES = """SELECT CAST(o_orderdate AS DATE) AS day, concat('s', CAST(o_custkey % 3 AS STRING)) AS source, CAST(o_custkey % 3 AS INT) AS priority, o_orderkey % 2 = 0 AS is_local,
 concat('p', CAST(o_custkey % 7 AS STRING)) AS path, CASE o_custkey % 3 WHEN 0 THEN 1996 END AS start_year, CASE o_custkey % 3 WHEN 1 THEN 1999 END AS end_year FROM orders"""


@query("source_priority", ["CAST(day AS STRING) AS day", "source", "path"], f"""
SELECT day, source, path FROM ({CANDIDATES}) WHERE year(day) >= coalesce(start_year, 0) AND year(day) <= coalesce(end_year, 9999)
QUALIFY row_number() OVER (PARTITION BY day ORDER BY priority, is_local DESC, path) = 1""")
def source_priority(i):
    return FT.prefer_sources(i.sql(CANDIDATES))[0]


@query("source_conflicts", ["CAST(day AS STRING) AS day", "source", "CAST(n_paths AS BIGINT) AS n_paths"], f"""
SELECT day, source, count(DISTINCT path) AS n_paths FROM ({CANDIDATES}) WHERE is_local AND year(day) >= coalesce(start_year, 0) AND year(day) <= coalesce(end_year, 9999) GROUP BY 1, 2 HAVING count(DISTINCT path) > 1""")
def source_conflicts(i):
    return FT.prefer_sources(i.sql(CANDIDATES))[1]


@query("alias_columns", ["p_partkey", "size", "ROUND(price, 2) AS price"], "SELECT p_partkey, p_size AS size, p_retailprice AS price FROM part")
def alias_columns(i):
    return GR.select_aliases(i.table("part"), {"size": ["SIZE", "P_SIZE"], "price": ["cost", "p_retailprice"]}, ["p_partkey"], True)


GAPPY = "SELECT p_partkey, p_brand, CASE WHEN p_partkey % 10 = 1 THEN double('NaN') WHEN p_partkey % 10 = 2 THEN NULL WHEN p_partkey % 10 = 3 THEN double('Infinity') ELSE p_retailprice END AS value FROM part"


@query("missing_policy_zero", ["p_partkey", "ROUND(value, 2) AS value"], "SELECT p_partkey, CASE WHEN p_partkey % 10 IN (1, 2, 3) THEN 0 ELSE p_retailprice END AS value FROM part")
def missing_policy_zero(i):
    return i.sql(GAPPY).withColumn("value", missing_policy(F.col("value"), "zero"))


@query("missing_policy_error", ["p_brand", "CAST(n_missing AS BIGINT) AS n_missing"], "SELECT p_brand, count(*) AS n_missing FROM part WHERE p_partkey % 10 IN (1, 2, 3) GROUP BY p_brand")
def missing_policy_error(i):
    return GR.missing_values(GR.clean_values(i.sql(GAPPY)), ["p_brand"])


@query("source_records", ["series_id", "record_id", "CAST(valid_time AS STRING) AS valid_time"], "SELECT DISTINCT series_id, record_id, valid_time - INTERVAL 30 HOUR AS valid_time FROM records", ("records",))
def source_records(i):
    r = i("records")
    return GR.source_records(r.unionByName(r), -30.0)


@query("coordinate_quantum", ["event_id", "q", "ROUND(snapped, 6) AS snapped"], """
SELECT event_id, CAST(round_even(lat/0.0001, 0) AS BIGINT) AS q, round_even(lat/0.0001, 0)*0.0001 AS snapped FROM (SELECT fire_id AS event_id, lat + 0.000003 AS lat FROM fires)""", ("fires",))
def coordinate_quantum(i):
    f = i.sql("SELECT fire_id AS event_id, lat + 0.000003E0 AS lat FROM fires", "fires")
    return f.withColumn("q", G.quantum_index(F.col("lat"))).withColumn("snapped", G.quantize(F.col("lat")))


@query("feedback_parts", ["loc_id", "ROUND(obs, 4) AS obs", "ROUND(hofx, 4) AS hofx"], """
SELECT loc_id, CASE WHEN loc_id % 6 <> 0 THEN obs END AS obs, CASE WHEN loc_id % 8 <> 0 THEN hofx END AS hofx FROM obs""", ("obs",))
def feedback_parts(i):
    o = i("obs").select("loc_id", F.when(F.col("loc_id") % 6 == 0, F.lit(FEEDBACK_FILL)).otherwise(F.col("obs")).alias("obs"),
                        F.when(F.col("loc_id") % 8 == 0, F.lit(FEEDBACK_FILL).cast("float").cast("double")).otherwise(F.col("hofx")).alias("hofx"))
    return FB.concat_parts([o.filter(F.col("loc_id") % 3 == k) for k in range(3)])


@query("int_repair", ["loc_id", "position"], "SELECT loc_id, CASE WHEN loc_id % 9 <> 0 THEN CAST(trunc(obs) AS INT) END AS position FROM obs", ("obs",))
def int_repair(i):
    o = i("obs").select("loc_id", F.when(F.col("loc_id") % 9 == 0, F.lit(FEEDBACK_FILL)).otherwise(F.col("obs")).cast("float").alias("position"))
    return FB.repair_int_columns(o, ["position"])


@query("missing_channel", ["observer", "missing_channel"], "SELECT observer, observer = 'inst1' AS missing_channel FROM obs GROUP BY observer", ("obs",))
def missing_channel(i):
    o = i("obs").withColumn("channel", F.expr("CASE WHEN observer = 'inst1' AND channel = 4 THEN -999 ELSE channel END"))
    return FB.has_missing_channel(o, ["observer"])


@query("schema_migration", ["loc_id", "observationTime", "channelNumber", "ROUND(latitude, 3) AS latitude"], """
SELECT loc_id, CAST(floor(epoch(obs_time)) AS BIGINT) AS "observationTime", channel AS "channelNumber", CAST(lat AS FLOAT) AS latitude FROM obs""", ("obs",))
def schema_migration(i):
    o = i("obs").select("loc_id", F.unix_timestamp("obs_time").alias("datetime"), F.col("channel").alias("sensor_channel"), F.col("lat").alias("latitude"), F.lit(1).alias("old"))
    out, _ = FB.migrate_schema(o, [
        {"name": "observationTime", "type": "bigint", "deprecated": ["datetime"]}, {"name": "channelNumber", "type": "int", "deprecated": ["sensor_channel"]},
        {"name": "latitude"}, {"name": "old", "remove": True}, {"name": "loc_id", "type": "bigint"}])
    return out


@query("product_checks", ["rule", "CAST(n AS BIGINT) AS n"], """
SELECT 'nonfinite' AS rule, count(DISTINCT p_brand) AS n FROM part WHERE p_partkey % 10 IN (1, 2, 3) UNION ALL SELECT 'incomplete', count(*) FROM (SELECT DISTINCT p_brand, p_size FROM part) x
 CROSS JOIN (SELECT unnest(['f0','f1','f2']) AS f) y WHERE NOT EXISTS (SELECT 1 FROM part p WHERE p.p_brand = x.p_brand AND p.p_size = x.p_size AND 'f' || (p.p_partkey % 3) = y.f)""")
def product_checks(i):
    bad = PR.finite_violations(i.sql(GAPPY), ["p_brand"])
    inc = PR.incomplete_steps(i.sql("SELECT p_brand, p_size, concat('f', CAST(p_partkey % 3 AS STRING)) AS field FROM part"), ["f0", "f1", "f2"], ["p_brand", "p_size"])
    return PR.violation_counts({"nonfinite": bad, "incomplete": inc})


@query("product_wide", ["src_id", "ROUND(f0, 3) AS f0", "ROUND(f3, 3) AS f3"], """
SELECT src_id, max(CASE WHEN field = 'f0' THEN value END) AS f0, max(CASE WHEN field = 'f3' THEN value END) AS f3 FROM grid_values GROUP BY src_id""", ("grid_values",))
def product_wide(i):
    return PR.widen_fields(i("grid_values"), ["f0", "f1", "f2", "f3", "f4"], ["src_id"])


@query("first_pattern", ["name", "CAST(n AS BIGINT) AS n"], """
SELECT 'labels.parquet' AS name, count(*) AS n FROM labels UNION ALL SELECT 'lineitem.parquet', count(*) FROM lineitem""")
def first_pattern(i):
    """The files of the first pattern that matches any, with their rows; patterns before it name no file or an unset variable."""
    patterns = ["{folder}/none-*.parquet", "$GRIDSPARK_UNSET_FOLDER/*.parquet", "{folder}/l*.parquet", "{folder}/*.parquet"]
    out = None
    for path in GR.first_available(i.spark, patterns, folder=i.folder):
        part = i.spark.read.parquet(path).agg(F.count(F.lit(1)).alias("n")).withColumn("name", F.lit(path.rstrip("/").rsplit("/", 1)[1]))
        out = part if out is None else out.unionByName(part)
    return out
