"""Ensembles, model state, chemistry columns, audits, routing."""
from __future__ import annotations

from pyspark.sql import functions as F

from catalog.registry import query
from gridspark.operators import audit as A
from gridspark.operators import chem as C
from gridspark.operators import ensemble as E
from gridspark.operators import scaling as S
from gridspark.operators import state as ST

KEYS = ["variable", "cell_id"]
MV = ["member", "variable", "cell_id", "ROUND(value, 5) AS value"]


@query("ensemble_moments", ["variable", "cell_id", "ROUND(mean, 6) AS mean", "ROUND(variance, 7) AS variance", "CAST(n_members AS BIGINT) AS n_members"], """
SELECT variable, cell_id, avg(value) AS mean, coalesce(var_samp(value), 0) AS variance, count(*) AS n_members FROM state GROUP BY 1, 2""", ("state",))
def ensemble_moments(i):
    return E.ensemble_moments(i("state"), KEYS)


@query("ensemble_variance_pop", ["variable", "cell_id", "ROUND(variance, 7) AS variance"], "SELECT variable, cell_id, var_pop(value) AS variance FROM state GROUP BY 1, 2", ("state",))
def ensemble_variance_pop(i):
    return E.ensemble_moments(i("state"), KEYS, ddof=0)


@query("increment", MV, """SELECT a.member, a.variable, a.cell_id, a.value - b.value AS value FROM prior_state a JOIN state b ON a.member = b.member AND a.cell_id = b.cell_id
WHERE a.variable IN ('theta', 'qv')""", ("state", "prior_state"))
def increment(i):
    return E.increment(i("prior_state"), i("state"), ["member", *KEYS], ["theta", "qv"])


@query("increment_summary", ["variable"] + [f"ROUND({c}_{s}, 4) AS {c}_{s}" for c in "abd" for s in ("min", "max", "mean")], """
SELECT variable, min(a) AS a_min, max(a) AS a_max, avg(a) AS a_mean, min(b) AS b_min, max(b) AS b_max, avg(b) AS b_mean, min(a - b) AS d_min, max(a - b) AS d_max, avg(a - b) AS d_mean
FROM (SELECT a.variable, a.value AS a, b.value AS b FROM prior_state a JOIN state b ON a.member = b.member AND a.cell_id = b.cell_id) GROUP BY variable""", ("state", "prior_state"))
def increment_summary(i):
    return E.increment_summary(i("prior_state"), i("state"), ["member", *KEYS])


BOTH = """b AS (SELECT p.member, p.variable, p.cell_id, p.value AS pv, s.value AS av FROM prior_state p JOIN state s ON p.member = s.member AND p.cell_id = s.cell_id),
m AS (SELECT cell_id, avg(pv) AS pm, avg(av) AS am, stddev_samp(pv) AS ps, stddev_samp(av) AS sa FROM b GROUP BY cell_id)"""


@query("rtpp", MV, f"WITH {BOTH} SELECT member, variable, b.cell_id, am + 0.3*(av - am) + 0.7*(pv - pm) AS value FROM b JOIN m ON m.cell_id = b.cell_id", ("state", "prior_state"))
def rtpp(i):
    return E.rtpp(i("prior_state"), i("state"), KEYS, 0.7)


@query("rtps", MV, f"""WITH {BOTH} SELECT member, variable, b.cell_id, am + (av - am)*CASE WHEN sa > 0 THEN 1 + 0.5*(ps - sa)/sa ELSE 1 END AS value FROM b JOIN m ON m.cell_id = b.cell_id""", ("state", "prior_state"))
def rtps(i):
    return E.rtps(i("prior_state"), i("state"), KEYS, 0.5)


@query("inflate", MV, f"WITH {BOTH} SELECT member, variable, b.cell_id, am + (av - am)*1.2 AS value FROM b JOIN m ON m.cell_id = b.cell_id", ("state", "prior_state"))
def inflate(i):
    return E.inflate(i("state"), KEYS, 1.2)


CENTRE = """SELECT variable, cell_id, max(value) AS value FROM prior_state GROUP BY variable, cell_id
 UNION ALL SELECT 'smois' AS variable, cell_id, max(value)/2 AS value FROM prior_state WHERE variable = 'qv' GROUP BY cell_id"""


@query("recenter", MV, f"""WITH c AS ({CENTRE}), m AS (SELECT variable, cell_id, avg(value) AS mean FROM state GROUP BY 1, 2)
SELECT member, s.variable, s.cell_id, s.value - mean + c.value AS value FROM state s JOIN m ON m.cell_id = s.cell_id AND m.variable = s.variable JOIN c ON c.cell_id = s.cell_id AND c.variable = s.variable WHERE s.variable IN ('theta', 'u')
UNION ALL SELECT member, variable, cell_id, value FROM c, (SELECT DISTINCT member FROM state) WHERE variable NOT IN ('theta', 'u')""", ("state", "prior_state"))
def recenter(i):
    return E.recenter(i("state"), i.sql(CENTRE, "prior_state"), ["theta", "u"], KEYS)[0]


SCALARS = """SELECT l_orderkey, l_linenumber, l_partkey, CASE l_returnflag WHEN 'A' THEN 'qv' WHEN 'N' THEN 'qc' ELSE 'theta' END AS variable, l_discount - 0.03E0 AS value FROM lineitem"""


@query("lower_bounds", ["variable", "CAST(n AS BIGINT) AS n", "ROUND(total, 6) AS total", "min"], f"""
SELECT variable, count(*) AS n, sum(v) AS total, min(v) AS min FROM (SELECT variable, CASE variable WHEN 'qv' THEN greatest(value, 1e-12) WHEN 'qc' THEN greatest(value, 0) ELSE value END AS v FROM ({SCALARS})) GROUP BY 1""")
def lower_bounds(i):
    out, _ = ST.floor_values(i.sql(SCALARS))
    return out.groupBy("variable").agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total"), F.min("value").alias("min"))


@query("lower_bounds_report", ["variable", "CAST(n_raised AS BIGINT) AS n_raised", "ROUND(min_before, 9) AS min_before", "bound"], f"""
SELECT variable, count(*) AS n_raised, min(value) AS min_before, CASE variable WHEN 'qv' THEN 1e-12 ELSE 0e0 END AS bound FROM ({SCALARS}) WHERE variable <> 'theta' AND value < CASE variable WHEN 'qv' THEN 1e-12 ELSE 0e0 END GROUP BY 1""")
def lower_bounds_report(i):
    return ST.floor_values(i.sql(SCALARS))[1]


NAMES = "CASE p_partkey % 6 {} END"
COLD = "SELECT CASE p_partkey % 5 WHEN 0 THEN 'qdust1' WHEN 1 THEN 'qso2' WHEN 2 THEN 'persistent_hno3' WHEN 3 THEN 'background_hno3' ELSE 'smois' END AS variable, p_partkey AS cell_id, p_retailprice AS value FROM part"
WARM = "SELECT CASE p_partkey % 5 WHEN 0 THEN 'qdust1' WHEN 1 THEN 'qso2' WHEN 2 THEN 'persistent_hno3' WHEN 3 THEN 'qc' ELSE 'smois' END AS variable, p_partkey AS cell_id, p_retailprice*2 AS value FROM part"


@query("state_carry", ["variable", "cell_id", "ROUND(value, 4) AS value"], f"""
WITH c AS ({COLD}), w AS ({WARM})
SELECT c.variable, c.cell_id, CASE WHEN c.variable IN ('qdust1', 'qso2', 'smois') THEN coalesce(w.value, c.value) ELSE c.value END AS value FROM c LEFT JOIN w ON w.variable = c.variable AND w.cell_id = c.cell_id
UNION ALL SELECT variable, cell_id, value FROM w WHERE variable = 'qc'""")
def state_carry(i):
    return ST.carry_state(i.sql(COLD), i.sql(WARM), KEYS, carry_persistent=False, include_land=True, include_hydrometeors=True)[0]


@query("state_carry_report", ["variable", "status", "fatal"], """
SELECT v AS variable, CASE WHEN v IN ('qdust1', 'qso2', 'persistent_hno3') THEN 'copied' ELSE 'missing_in_destination' END AS status, v NOT IN ('qdust1', 'qso2', 'persistent_hno3') AS fatal
FROM (SELECT unnest(['qbcphobic','qbcphilic','qbrphobic','qbrphilic','qocphobic','qocphilic','qdust1','qdust2','qdust3','qdust4','qdust5','qni1','qni2','qni3','qso4','qseas1','qseas2','qseas3','qseas4','qseas5',
 'qso2','qso2v','qso4v','qdms','qmsa','qnh3','qnh4a','qsoapa','qsoapbb','qsoapbg','persistent_hno3']) AS v)
WHERE (SELECT count(*) FROM part) > 0""")
def state_carry_report(i):
    return ST.carry_state(i.sql(COLD), i.sql(WARM), KEYS)[1]


LAYERS = "SELECT l_orderkey AS src_id, CAST(l_linenumber AS INT) AS lev, sum(l_quantity) AS dp FROM lineitem GROUP BY 1, 2"


@query("pressure_column", ["src_id", "lev", "ROUND(pressure, 6) AS pressure"], f"""
SELECT src_id, lev, 1.0 + coalesce(sum(dp) OVER (PARTITION BY src_id ORDER BY lev ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) + 0.5*dp AS pressure FROM ({LAYERS})""")
def pressure_column(i):
    return C.column_pressure(i.sql(LAYERS), ["src_id"])


CHEM = " UNION ALL ".join(f"""SELECT CAST(l_shipdate AS DATE) AS file_date, CAST(l_suppkey % 4 AS INT) AS time_idx, '{v}' AS variable, CAST(l_linenumber - 1 AS INT) AS lev,
 l_partkey AS src_id, sum(l_quantity)*{f}E0 AS value FROM lineitem GROUP BY 1, 2, 4, 5""" for v, f in (("DELP", 1), ("SO2", 2), ("NH3", 3)))
VALID = "SELECT DISTINCT CAST(l_shipdate AS TIMESTAMP) + INTERVAL '6' HOUR AS valid_time FROM lineitem"
SPECIES_MAP = [{"source": "DELP", "target": "DPRES", "weight": 1.0}, {"source": "SO2", "target": "qso2", "weight": 0.5}, {"source": "NH3", "target": "qnh3"}]


@query("chem_columns", ["CAST(valid_time AS STRING) AS valid_time", "variable", "out_lev", "CAST(src_id AS BIGINT) AS src_id", "ROUND(value, 6) AS value"], f"""
WITH c AS ({CHEM}), n AS (SELECT file_date, max(time_idx) + 1 AS nt FROM c GROUP BY 1),
t AS (SELECT v.valid_time, n.file_date, CASE WHEN nt > 1 THEN hour(v.valid_time)//6 ELSE 0 END AS ti FROM ({VALID}) v JOIN n ON n.file_date = CAST(v.valid_time AS DATE)),
p AS (SELECT valid_time, variable, lev, src_id, value FROM c JOIN t ON t.file_date = c.file_date AND t.ti = c.time_idx),
m AS (SELECT valid_time, CASE variable WHEN 'DELP' THEN 'DPRES' WHEN 'SO2' THEN 'qso2' ELSE 'qnh3' END AS variable, lev, src_id, value*CASE variable WHEN 'SO2' THEN 0.5*1.5 ELSE 1 END AS value FROM p),
a AS (SELECT * FROM m UNION ALL SELECT valid_time, 'PRES', lev, src_id, 1 + coalesce(sum(value) OVER (PARTITION BY valid_time, src_id ORDER BY lev ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) + 0.5*value FROM m WHERE variable = 'DPRES')
SELECT valid_time, variable, CAST(max(lev) OVER (PARTITION BY valid_time, variable) + 1 - lev AS INT) AS out_lev, src_id, value FROM a""")
def chem_columns(i):
    return C.chem_columns(i.sql(CHEM), i.sql(VALID), SPECIES_MAP, 6, scaling={"so2": 1.5})


@query("chem_missing_fields", ["CAST(file_date AS STRING) AS file_date", "missing"], f"SELECT DISTINCT file_date, 'CO' AS missing FROM ({CHEM})")
def chem_missing_fields(i):
    return C.missing_fields(i.sql(CHEM), [*SPECIES_MAP, {"source": "CO", "target": "qco"}], ["file_date"])


ORDERS_B = "SELECT o_orderkey, CASE WHEN o_orderkey % 97 = 0 THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice, o_custkey FROM orders WHERE o_orderkey % 89 <> 0"


@query("table_diff", ["variable", "CAST(only_a AS BIGINT) AS only_a", "CAST(only_b AS BIGINT) AS only_b", "CAST(n_diff AS BIGINT) AS n_diff", "ROUND(max_abs, 6) AS max_abs", "ROUND(rms, 8) AS rms"], f"""
WITH j AS (SELECT a.o_orderkey AS ka, b.o_orderkey AS kb, a.o_totalprice AS pa, b.o_totalprice AS pb, a.o_custkey AS ca, b.o_custkey AS cb FROM orders a FULL JOIN ({ORDERS_B}) b ON a.o_orderkey = b.o_orderkey)
SELECT 'o_totalprice' AS variable, count(*) FILTER (kb IS NULL) AS only_a, count(*) FILTER (ka IS NULL) AS only_b, count(*) FILTER (pa <> pb) AS n_diff, max(abs(pa - pb)) AS max_abs, sqrt(avg(power(pa - pb, 2))) AS rms FROM j
UNION ALL SELECT 'o_custkey', count(*) FILTER (kb IS NULL), count(*) FILTER (ka IS NULL), count(*) FILTER (ca <> cb), max(abs(ca - cb)), sqrt(avg(power(ca - cb, 2))) FROM j""")
def table_diff(i):
    return A.diff_tables(i.table("orders"), i.sql(ORDERS_B), ["o_orderkey"], ["o_totalprice", "o_custkey"])


@query("table_diff_ranges", ["variable", "CAST(only_a AS BIGINT) AS only_a", "CAST(only_b AS BIGINT) AS only_b", "CAST(n_diff AS BIGINT) AS n_diff", "ROUND(max_abs, 6) AS max_abs", "ROUND(rms, 8) AS rms"], f"""
WITH j AS (SELECT a.o_orderkey AS ka, b.o_orderkey AS kb, a.o_totalprice AS pa, b.o_totalprice AS pb, a.o_custkey AS ca, b.o_custkey AS cb FROM orders a FULL JOIN ({ORDERS_B}) b ON a.o_orderkey = b.o_orderkey)
SELECT 'o_totalprice' AS variable, count(*) FILTER (kb IS NULL) AS only_a, count(*) FILTER (ka IS NULL) AS only_b, count(*) FILTER (pa <> pb) AS n_diff, max(abs(pa - pb)) AS max_abs, sqrt(avg(power(pa - pb, 2))) AS rms FROM j
UNION ALL SELECT 'o_custkey', count(*) FILTER (kb IS NULL), count(*) FILTER (ka IS NULL), count(*) FILTER (ca <> cb), max(abs(ca - cb)), sqrt(avg(power(ca - cb, 2))) FROM j""")
def table_diff_ranges(i):
    return A.diff_large(i.table("orders"), i.sql(ORDERS_B), ["o_orderkey"], ["o_totalprice", "o_custkey"])


CONFIG_A = "SELECT concat('set:', CAST(c_custkey AS STRING)) AS key, c_mktsegment AS value FROM customer WHERE c_custkey % 17 <> 3"
CONFIG_B = "SELECT concat('set:', CAST(c_custkey AS STRING)) AS key, CASE WHEN c_custkey % 23 = 1 THEN 'changed' ELSE c_mktsegment END AS value FROM customer WHERE c_custkey % 19 <> 5"


@query("config_drift", ["key", "status", "reference", "candidate"], f"""
SELECT coalesce(a.key, b.key) AS key, CASE WHEN b.key IS NULL THEN 'MISSING' WHEN a.key IS NULL THEN 'EXTRA' ELSE 'DIFFERS' END AS status, a.value AS reference, b.value AS candidate
FROM ({CONFIG_A}) a FULL JOIN ({CONFIG_B}) b ON a.key = b.key WHERE (a.value IS NULL OR b.value IS NULL OR a.value <> b.value) AND NOT regexp_matches(coalesce(a.key, b.key), '9$')""")
def config_drift(i):
    return A.diff_config(i.sql(CONFIG_A), i.sql(CONFIG_B), "9$")


REQUIRED = "SELECT concat('stream', CAST(n_regionkey AS STRING)) AS stream, concat('p', CAST(n_nationkey AS STRING)) AS product, concat('f', CAST(n_nationkey % 4 AS STRING)) AS field FROM nation"
PRODUCTS = "SELECT concat('p', CAST(s_nationkey AS STRING)) AS product, concat('f', CAST(s_suppkey % 3 AS STRING)) AS field, CASE WHEN s_nationkey % 5 = 1 THEN 0E0 ELSE s_acctbal END AS value FROM supplier WHERE s_nationkey <> 11"


@query("completeness_audit", ["stream", "product", "field", "status"], f"""
WITH v AS (SELECT product, field, bool_or(value <> 0) AS alive FROM ({PRODUCTS}) GROUP BY 1, 2)
SELECT stream, r.product, r.field, CASE WHEN r.product NOT IN (SELECT product FROM v) THEN 'missing_product' WHEN v.alive IS NULL THEN 'missing_field'
 WHEN r.field IN ('f1', 'f9') AND NOT v.alive THEN 'all_zero' ELSE 'ok' END AS status FROM ({REQUIRED}) r LEFT JOIN v ON v.product = r.product AND v.field = r.field
UNION ALL SELECT '-', '-', 'f9', 'no_provider'""")
def completeness_audit(i):
    return A.audit_products(i.sql(REQUIRED), i.sql(PRODUCTS), ["f1", "f9"])


VEG_TIMES = "SELECT DISTINCT CAST(CAST(ts AS DATE) AS TIMESTAMP) AS valid_time, user_id % 20 AS cell_id, CASE WHEN user_id % 20 = 7 AND day(ts) = 5 THEN 8 ELSE CAST(user_id % 5 AS INT) END AS category FROM events WHERE day(ts) <> 9"
SIZE_TIMES = "SELECT DISTINCT CAST(CAST(ts AS DATE) AS TIMESTAMP) AS valid_time FROM events WHERE day(ts) <> 20"


@query("category_sanity", ["rule", "CAST(valid_time AS STRING) AS valid_time", "CAST(n AS BIGINT) AS n"], f"""
WITH v AS ({VEG_TIMES}), t AS (SELECT DISTINCT valid_time FROM v), s AS ({SIZE_TIMES})
SELECT 'category' AS rule, valid_time, count(*) AS n FROM v WHERE category > 4 GROUP BY 2
UNION ALL SELECT 'not_in_fire_size', valid_time, 1 FROM t WHERE valid_time NOT IN (FROM s)
UNION ALL SELECT 'not_in_category', valid_time, 1 FROM s WHERE valid_time NOT IN (FROM t)
UNION ALL SELECT 'gap', d, 1 FROM (SELECT unnest(range((SELECT min(valid_time) FROM t), (SELECT max(valid_time) FROM t), INTERVAL 1 DAY)) AS d) WHERE d NOT IN (FROM t)
UNION ALL SELECT 'not_covered', min(valid_time), 1 FROM t HAVING max(valid_time) < TIMESTAMP '2024-03-01'""")
def category_sanity(i):
    return A.check_categories(i.sql(VEG_TIMES), i.sql(SIZE_TIMES), "2024-01-02 00:00:00", "2024-03-01 00:00:00")


REQUESTS = """SELECT c_custkey AS request_id, CASE c_custkey % 10 WHEN 0 THEN '' WHEN 9 THEN 'cntl' ELSE concat('pert0', CAST(c_custkey % 10 AS STRING)) END AS variant,
 CASE c_nationkey % 6 WHEN 1 THEN 'ceds' WHEN 2 THEN 'bogus' ELSE '' END AS anth, CASE c_nationkey % 5 WHEN 1 THEN 'qfed' WHEN 2 THEN 'gbbepx' ELSE '' END AS biob, '' AS biog,
 CASE c_nationkey % 4 WHEN 1 THEN 'ceds' WHEN 2 THEN 'follow-anth' ELSE '' END AS nh3 FROM customer"""
# fixed values, written out apart from the code under test: variant, anthropogenic and fire inventory
_VARIANT_ROWS = """('cntl', 'cams', 'gfas'),
 ('pert01', 'cams', 'finn'),
 ('pert02', 'cams', 'qfed'),
 ('pert03', 'ceds', 'finn'),
 ('pert04', 'ceds', 'gfas'),
 ('pert05', 'ceds', 'qfed'),
 ('pert06', 'cams-mix', 'finn'),
 ('pert07', 'cams-mix', 'gfas'),
 ('pert08', 'cams-mix', 'qfed')"""


@query("inventory_routing", ["request_id", "dimension", "species", "inventory", "known"], f"""
WITH r AS (SELECT q.*, v.a, v.b FROM (SELECT *, CASE WHEN variant = '' THEN 'cntl' ELSE variant END AS vn FROM ({REQUESTS})) q LEFT JOIN (VALUES {_VARIANT_ROWS}) v(k, a, b) ON v.k = q.vn),
c AS (SELECT request_id, CASE WHEN anth <> '' THEN anth ELSE a END AS a, CASE WHEN biob <> '' THEN biob ELSE b END AS b, nh3 FROM r),
n AS (SELECT *, CASE nh3 WHEN '' THEN 'cams' WHEN 'follow-anth' THEN CASE a WHEN 'cams-mix' THEN 'cams' ELSE a END ELSE nh3 END AS h FROM c)
SELECT request_id, 'anth' AS dimension, s AS species, CASE s WHEN 'nh3' THEN h WHEN 'iso' THEN 'cams' WHEN 'mnt' THEN 'cams' ELSE a END AS inventory,
 CASE s WHEN 'nh3' THEN h IN ('cams', 'ceds') ELSE a IN ('cams', 'ceds', 'cams-mix') END AS known FROM n, (SELECT unnest(['bc','oc','so2','co','nh3','iso','mnt']) AS s)
UNION ALL SELECT request_id, 'biob', s, CASE WHEN s IN ('iso', 'mnt') AND b IN ('qfed', 'gbbepx') THEN 'finn' ELSE b END, true FROM n, (SELECT unnest(['bc','oc','nh3','so2','co','iso','mnt']) AS s)
UNION ALL SELECT request_id, 'biog', s, 'cams', true FROM n, (SELECT unnest(['co','iso','mnt','apin','bpin']) AS s)""")
def inventory_routing(i):
    return S.route_inventories(i.sql(REQUESTS))


@query("missing_products", ["product", "field"], f"SELECT DISTINCT product, field FROM ({REQUIRED}) EXCEPT SELECT product, field FROM ({PRODUCTS})")
def missing_products(i):
    return S.missing_products(i.sql(REQUIRED), i.sql(PRODUCTS), ["product", "field"])


MEMBERS = """SELECT CAST(s_suppkey + CASE WHEN s_suppkey % 40 = 7 THEN 1 ELSE 0 END AS INT) AS member, CASE s_nationkey % 4 WHEN 0 THEN 'cams' WHEN 1 THEN 'ceds' WHEN 2 THEN 'cams-mix' ELSE 'other' END AS anth,
 'gfas' AS biob, 'cams' AS biog, CASE WHEN s_suppkey % 25 = 3 THEN CAST('NaN' AS DOUBLE) WHEN s_suppkey % 25 = 4 THEN -1E0 ELSE 1E0 + CAST(s_suppkey AS DOUBLE)/100 END AS dust_relative, 1E0 AS seasalt_relative FROM supplier"""


@query("member_violations", ["member", "rule"], f"""WITH m AS ({MEMBERS}), n AS (SELECT count(*) - 1 AS n FROM supplier)
SELECT member, 'factor:dust' AS rule FROM m WHERE isnan(dust_relative) OR dust_relative < 0 UNION ALL SELECT member, 'inventory:anth' FROM m WHERE anth = 'other'
UNION ALL SELECT member, 'member:range' FROM m, n WHERE member < 1 OR member > n UNION ALL SELECT member, 'member:repeated' FROM m GROUP BY member HAVING count(*) > 1
UNION ALL SELECT CAST(k AS INT), 'member:missing' FROM (SELECT unnest(range(1, n + 1)) AS k FROM n) WHERE k NOT IN (SELECT member FROM m)""")
def member_violations(i):
    return S.member_factors(i.sql(MEMBERS), {"dust": 0.5, "seasalt": 2.0}, i.table("supplier").count() - 1)[1]


@query("member_factors", ["member", "ROUND(dust_factor, 8) AS dust_factor", "ROUND(seasalt_factor, 8) AS seasalt_factor"], f"""
SELECT member, 0.5*dust_relative AS dust_factor, 2e0*seasalt_relative AS seasalt_factor FROM ({MEMBERS}) WHERE NOT isnan(dust_relative)""")
def member_factors(i):
    out, _ = S.member_factors(i.sql(MEMBERS), {"dust": 0.5, "seasalt": 2.0}, i.table("supplier").count() - 1)
    return out.filter(~F.isnan("dust_relative"))


@query("level_flip", ["src_id", "lev", "out_lev"], f"SELECT src_id, lev, CAST(max(lev) OVER (PARTITION BY src_id) + 1 - lev AS INT) AS out_lev FROM ({LAYERS})")
def level_flip(i):
    return C.flip_levels(i.sql(LAYERS), ["src_id"])
