"""Inputs derived from the given tables."""
from __future__ import annotations

from catalog.registry import define

define("mesh", """
SELECT CAST(s_suppkey AS BIGINT) AS cell_id,
       CAST((s_suppkey*7919) % 1700 - 850 AS DOUBLE)/10 AS lat_deg,
       CAST((s_suppkey*104729) % 3600 - 1800 AS DOUBLE)/10 AS lon_deg,
       radians(CAST((s_suppkey*7919) % 1700 - 850 AS DOUBLE)/10) AS lat,
       radians(CAST((s_suppkey*104729) % 3600 - 1800 AS DOUBLE)/10) AS lon,
       CAST(1000000000 AS DOUBLE) + 100000*abs(s_acctbal) AS area_m2,
       CASE WHEN s_nationkey % 5 = 0 THEN 1 ELSE 0 END AS bdy_mask,
       CASE WHEN s_suppkey % 12 = 0 THEN 5 ELSE 6 END AS n_edges
FROM supplier""")

define("fires", """
SELECT event_id AS fire_id, CAST(ts AS DATE) AS file_date, CAST(ts AS DATE) AS day,
       CAST((event_id*15485863) % 179999 - 89999 AS DOUBLE)/1000 AS lat,
       CAST((event_id*32452843) % 359999 - 180000 AS DOUBLE)/1000 AS lon,
       value*1000 AS area, value*10 AS frp, value AS co, value/2 AS bc,
       CASE event_type WHEN 'signup' THEN 1 WHEN 'click' THEN 2 WHEN 'view' THEN 3 WHEN 'purchase' THEN 4 ELSE 0 END AS genveg
FROM events""")

# a located form that does not depend on the nearest-cell search
define("located", """
SELECT f.*, CASE WHEN f.fire_id % 17 = 3 THEN CAST(-1 AS BIGINT) ELSE CAST(f.fire_id % (SELECT count(*) FROM supplier) AS BIGINT) END AS cell_id
FROM fires f""", ("fires",))

define("links", """
SELECT l_suppkey AS dst_id, l_partkey AS src_id, sum(l_quantity) AS q
FROM lineitem GROUP BY l_suppkey, l_partkey""")

define("weights", """
SELECT l.dst_id, l.src_id, l.q / t.total AS s
FROM links l JOIN (SELECT dst_id, sum(q) AS total FROM links GROUP BY dst_id) t ON l.dst_id = t.dst_id""", ("links",))

define("grid_values", " UNION ALL ".join(
    f"SELECT p_partkey AS src_id, 'f{k}' AS field, p_retailprice * {k + 1} AS value FROM part" for k in range(5)))

define("src_area", "SELECT p_partkey AS src_id, CAST(1 + p_size AS DOUBLE) AS area FROM part")
define("dst_area", "SELECT s_suppkey AS dst_id, 1.0E0 + abs(s_acctbal)/1000 AS area FROM supplier")

define("obs", """
SELECT event_id AS loc_id, CAST(ts AS TIMESTAMP) AS obs_time,
       CAST(event_id % 15 AS INT) AS channel, concat('inst', CAST(user_id % 3 AS STRING)) AS observer,
       to_cycle AS cycle, value AS obs, value*0.9E0 + 1.5E0 AS hofx,
       1.0E0 + CAST(event_id % 7 AS DOUBLE)/10 AS err0, CAST(event_id % 4 AS INT) AS qc0, CAST(event_id % 3 AS INT) AS qc1,
       CAST(user_id % 11 - 5 AS DOUBLE)/10 AS bias, 1.0E0 AS p0,
       CAST(event_id % 101 AS DOUBLE)/50 - 1.0E0 AS p1,
       value - (value*0.9E0 + 1.5E0) AS ombg,
       CASE WHEN user_id % 3 = 2 THEN value - (value*0.9E0 + 1.5E0) ELSE (value - (value*0.9E0 + 1.5E0))*0.6E0 END AS oman,
       CAST((event_id*15485863) % 179999 - 89999 AS DOUBLE)/1000 AS lat,
       CAST((event_id*32452843) % 359999 - 180000 AS DOUBLE)/1000 AS lon,
       CAST(event_id % 3 AS INT) AS prequality, CAST(user_id % 900 AS DOUBLE) AS station_height,
       CAST(user_id % 900 AS DOUBLE) + CAST(event_id % 300 AS DOUBLE) AS model_height
FROM (SELECT *, CAST(date_trunc('day', ts) AS TIMESTAMP) AS to_cycle FROM events) e""")

define("records", """
SELECT concat('s', CAST(user_id % 4 AS STRING)) AS series_id, CAST(CAST(ts AS DATE) AS STRING) AS record_id,
       CAST(CAST(ts AS DATE) AS TIMESTAMP) AS valid_time, CAST(sum(CAST(round(value*100) AS BIGINT)) AS DOUBLE) AS value
FROM events
WHERE (CAST(extract(day FROM ts) AS INT) + user_id % 4) % 7 <> 3
GROUP BY user_id % 4, CAST(ts AS DATE)""")

define("targets", """
SELECT DISTINCT concat('s', CAST(user_id % 4 AS STRING)) AS series_id, CAST(date_trunc('hour', ts) AS TIMESTAMP) AS target
FROM events""")

define("state", """
SELECT 1 + l_linenumber % 4 AS member, CASE l_partkey % 3 WHEN 0 THEN 'theta' WHEN 1 THEN 'qv' ELSE 'u' END AS variable,
       l_partkey AS cell_id, sum(l_quantity) AS value
FROM lineitem GROUP BY 1 + l_linenumber % 4, l_partkey""")

define("prior_state", "SELECT member, variable, cell_id, value + member*3.0E0 + CAST(cell_id % 7 AS DOUBLE) AS value FROM state", ("state",))

define("edges", """
SELECT DISTINCT cell_id, nbr_id FROM (
  SELECT s_suppkey AS cell_id, (s_suppkey*7 + 1) % (SELECT count(*) FROM supplier) AS nbr_id FROM supplier
  UNION ALL
  SELECT s_suppkey AS cell_id, (s_suppkey*11 + 5) % (SELECT count(*) FROM supplier) AS nbr_id FROM supplier
) e WHERE cell_id <> nbr_id""")
