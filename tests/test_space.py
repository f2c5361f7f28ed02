import math

import numpy as np
import pandas as pd
import pytest
from conftest import rows
from pyspark.sql import functions as F

from gridspark.functions import geometry as G
from gridspark.operators import mesh as M
from gridspark.operators import qc as Q
from gridspark.operators import vegetation as V
from gridspark.operators.nearest import box_indices, cell_index, morton, nearest_cell

R = G.SPHERE_RADIUS_M


def xyz(lat, lon):
    return np.c_[np.cos(lat) * np.cos(lon), np.cos(lat) * np.sin(lon), np.sin(lat)]


@pytest.fixture(scope="module")
def scattered(spark):
    """A third of the cells and points crowd one spot; poles and date line are included."""
    rng = np.random.default_rng(5)
    lat, lon = np.arcsin(rng.uniform(-1, 1, 600)), rng.uniform(-math.pi, math.pi, 600)
    lat[:200], lon[:200] = rng.normal(0.4, 1e-3, 200), rng.normal(1.0, 1e-3, 200)
    lat[200], lat[201] = math.pi / 2, -math.pi / 2
    lat[300], lon[300] = lat[5], lon[5]  # coincident centres
    pla, plo = np.degrees(np.arcsin(rng.uniform(-1, 1, 900))), rng.uniform(-180, 360, 900)
    pla[:300], plo[:300] = np.degrees(rng.normal(0.4, 1e-3, 300)), np.degrees(rng.normal(1.0, 1e-3, 300))
    pla[300:304], plo[300:304] = [90, -90, 0, 0], [12, 7, 180, -180]
    mesh = spark.createDataFrame(pd.DataFrame(dict(cell_id=np.arange(600), lat=lat, lon=lon, area_m2=1e11, bdy_mask=np.arange(600) % 2)))
    points = spark.createDataFrame(pd.DataFrame(dict(pid=np.arange(900), lat=pla, lon=plo)))
    d = ((xyz(np.radians(pla), np.radians(plo))[:, None, :] - xyz(lat, lon)[None]) ** 2).sum(2)
    return mesh, points, d


@pytest.mark.parametrize(("limit", "threshold"), [(16, "10m"), (2, "-1")])
def test_nearest_equals_brute_force(spark, scattered, limit, threshold):
    mesh, points, d = scattered
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        out = nearest_cell(points, mesh, index=cell_index(mesh, limit)).toPandas().sort_values("pid")
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert len(out) == 900
    assert (out.cell_id.to_numpy() == d.argmin(1)).all()
    assert np.allclose(out.distance_km, 2 * np.arcsin(np.sqrt(d.min(1)) / 2) * R / 1000)


def test_morton_numbers_are_runs_of_boxes(spark):
    rng = np.random.default_rng(3)
    xs = rng.integers(0, 2**20, (200, 3))
    df = spark.createDataFrame([tuple(map(int, r)) for r in xs], "x int, y int, z int")
    code = morton(F.col("x"), F.col("y"), F.col("z"))
    back = df.withColumn("code", code).select("x", "y", "z", "code", *[c.alias(n) for n, c in box_indices(F.col("code")).items()])
    for r in back.collect():
        assert (r.x, r.y, r.z) == (r.bx, r.by, r.bz)
        assert r.code == sum((v >> k & 1) << 3 * k + 2 - i for i, v in enumerate((r.x, r.y, r.z)) for k in range(20))
    up = df.select(F.shiftright(code, 6).alias("a"), morton(*[F.shiftright(c, 2) for c in "xyz"]).alias("b"))
    assert up.where("a <> b").count() == 0


def test_ring_around_a_pole_is_rows(spark):
    ring = [(i, math.radians(80), 2 * math.pi * i / 150) for i in range(150)] + [(150 + i, 0.0, 0.7 * i) for i in range(9)]
    mesh = spark.createDataFrame(ring, "cell_id bigint, lat double, lon double")
    index = cell_index(mesh, 16)
    assert index.agg(F.max(F.size("cands"))).first()[0] <= 16 and index.agg(F.max("chunk")).first()[0] >= 9
    pts = [(0, 90.0, 0.0), (1, 90.0, 33.0), (2, 89.9999999, 10.0), (3, 80.0, 2.4), (4, -5.0, 0.0), (5, None, 1.0), (0, 90.0, 0.0)]
    out = sorted(map(tuple, nearest_cell(spark.createDataFrame(pts, "pid int, lat double, lon double"), mesh, index=index).select("pid", "cell_id").collect()))
    assert [o[0] for o in out] == [0, 0, 1, 2, 3, 4, 5]
    at = xyz(np.array([r[1] for r in ring]), np.array([r[2] for r in ring]))
    for pid, cell in out[:-1]:
        _, la, lo = next(p for p in pts if p[0] == pid)
        d = ((xyz(np.radians([la]), np.radians([lo])) - at) ** 2).sum(1)
        assert d[cell] <= d.min() + 1e-15
    assert out[-1] == (5, -1)


def test_index_of_a_regional_mesh_and_of_one_cell(spark):
    rng = np.random.default_rng(8)
    lat, lon = rng.uniform(0.5, 0.52, 400), rng.uniform(1.0, 1.02, 400)
    mesh = spark.createDataFrame(pd.DataFrame(dict(cell_id=np.arange(400), lat=lat, lon=lon)))
    pla, plo = np.degrees(np.arcsin(rng.uniform(-1, 1, 500))), rng.uniform(-180, 180, 500)
    pla[:200], plo[:200] = np.degrees(rng.uniform(0.49, 0.53, 200)), np.degrees(rng.uniform(0.99, 1.03, 200))
    points = spark.createDataFrame(pd.DataFrame(dict(pid=np.arange(500), lat=pla, lon=plo)))
    d = ((xyz(np.radians(pla), np.radians(plo))[:, None, :] - xyz(lat, lon)[None]) ** 2).sum(2)
    out = nearest_cell(points, mesh).toPandas().sort_values("pid")
    assert (out.cell_id.to_numpy() == d.argmin(1)).all()
    one = nearest_cell(points, mesh.where("cell_id = 7")).select("cell_id").distinct().collect()
    assert [r[0] for r in one] == [7]


def test_points_are_not_repeated_by_level(spark, scattered):
    """A point is shuffled about once, however many levels the boxes have."""
    mesh, points, _ = scattered
    index = cell_index(mesh, 16)
    levels = index.select("level").distinct().count()
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        out = nearest_cell(points, mesh, index=index).select("pid", "cell_id")
        assert len(out.collect()) == 900
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    stack, repeated = [out._jdf.queryExecution().executedPlan()], []
    while stack:
        node = stack.pop()
        if node.nodeName() == "Generate":
            repeated.append(node.metrics().apply("numOutputRows").value())
        stack += [node.children().apply(k) for k in range(node.children().size())]
    assert levels >= 5 and repeated and max(repeated) <= 900 * (levels - 2)


def test_nearest_interior_only(scattered):
    mesh, points, d = scattered
    out = nearest_cell(points, mesh, interior_only=True).toPandas().sort_values("pid")
    inside = np.where(np.arange(600) % 2 == 0, 0.0, 9.0)
    assert (out.cell_id.to_numpy() == (d + inside).argmin(1)).all()


def test_nearest_rejects(spark, scattered):
    mesh, points, d = scattered
    extra = points.union(spark.createDataFrame([(900, float("nan"), 0.0), (901, 91.0, 0.0), (902, None, 0.0)], points.schema))
    out = nearest_cell(extra, mesh, reject_outside=True, factor=1.0).toPandas().sort_values("pid")
    far = 2 * np.arcsin(np.sqrt(d.min(1)) / 2) * R > math.sqrt(1e11 / math.pi)
    assert (out.cell_id.to_numpy()[:900] == np.where(far, -1, d.argmin(1))).all()
    assert list(out.cell_id[900:]) == [-1, -1, -1] and not out.accepted[900:].any()


def test_polygon_of_two_cell_mesh(spark):
    cells = spark.createDataFrame([(0, math.radians(45), [0.3, 0.3, 1.3, 1.3], [-1., 1., 1., -1.]), (1, math.radians(-45), [-0.3, -0.3, -1.3, -1.3], [1., -1., -1., 1.]),
                                   (2, 0.0, [0.1, 0.2], [0.1, 0.1])], "c int, lat double, la array<double>, lo array<double>")
    inside = G.inside_polygon(F.col("lat"), F.lit(0.0), F.col("la"), F.col("lo"), F.col("lat"), F.lit(0.0))
    outside = G.inside_polygon(-F.col("lat"), F.lit(0.0), F.col("la"), F.col("lo"), F.col("lat"), F.lit(0.0))
    assert rows(cells.select("c", inside, outside)) == [(0, True, False), (1, True, False), (2, False, False)]


def test_identity_ignores_float32_noise(spark):
    axis = (np.arange(1800) + 0.5) * 0.1 - 90
    variants = {"a": axis, "b": axis.astype(np.float32).astype(float), "c": axis + 0.05, "d": axis + 1e-3, "e": axis[:900]}
    df = spark.createDataFrame([(k, "lat", i, float(c)) for k, v in variants.items() for i, c in enumerate(v)], "grid_id string, axis string, idx int, centre double")
    fp = {r["grid_id"]: r["fingerprint"] for r in M.grid_identity(df).collect()}
    assert fp["a"] == fp["b"] and len(set(fp.values())) == 4


def test_axis_bounds_and_rules(spark):
    df = spark.createDataFrame([("g", "lat", 0, -45.0), ("g", "lat", 1, 45.0), ("g", "lon", 0, -90.0), ("g", "lon", 1, 90.0),
                                ("h", "lon", 0, 0.0), ("h", "lon", 1, 100.0), ("h", "lat", 0, 5.0), ("k", "lat", 0, 5.0), ("k", "lat", 1, 4.0)], "grid_id string, axis string, idx int, centre double")
    b = M.axis_bounds(df.filter("grid_id = 'g'"))
    assert rows(b.select("axis", "idx", "lo", "hi")) == [("lat", 0, -90., 0.), ("lat", 1, 0., 90.), ("lon", 0, -180., 0.), ("lon", 1, 0., 180.)]
    assert M.grid_cells(b).agg(F.sum("area_sr")).first()[0] == pytest.approx(4 * math.pi)
    assert rows(M.axis_violations(df)) == [("h", "lat", "too_short"), ("h", "lon", "span_not_360"), ("k", "lat", "not_increasing")]


def test_check_identity(spark):
    e = spark.createDataFrame([("a", "1"), ("b", "1"), ("c", "1")], "k string, fingerprint string")
    r = spark.createDataFrame([("a", "1"), ("b", "2")], "k string, fingerprint string")
    assert rows(M.check_identity(r, e, ["k"], False).select("k", "verdict")) == [("a", "use"), ("b", "rebuild"), ("c", "warn")]
    assert rows(M.check_identity(r, e, ["k"], True).select("k", "verdict"))[1] == ("b", "error")


def test_neighbors_drop_isolated(spark):
    # a ring of 4, a pair that only sees the boundary, and padding
    mesh = spark.createDataFrame([(0, 0, 2, [2, 4, 0]), (1, 0, 2, [1, 3, 0]), (2, 0, 2, [2, 4, 0]), (3, 0, 2, [3, 1, 0]), (4, 0, 1, [6, 0, 0]), (5, 1, 1, [5, 0, 0])],
                                 "cell_id bigint, bdy_mask int, n_edges int, neighbors array<bigint>")
    assert rows(M.neighbor_counts(M.neighbor_edges(mesh))) == [(0, 2), (1, 2), (2, 2), (3, 2)]
    full = M.neighbor_edges(mesh.withColumn("n_edges", F.when(F.col("cell_id") == 0, 3).otherwise(F.col("n_edges"))), require_full=True)
    assert rows(full) == [(1, 2), (2, 1), (2, 3), (3, 2)]


def pixels(spark, data):
    return spark.createDataFrame([(0, i, *b) for i, b in enumerate(data)], "iy int, ix int, lon_lo double, lon_hi double, lat_lo double, lat_hi double")


def cell(spark, lat, lon, h):
    la, lo, d = math.radians(lat), math.radians(lon), math.radians(h)
    return spark.createDataFrame([(0, la, lo, [la - d, la - d, la + d, la + d], [lo - d, lo + d, lo + d, lo - d])],
                                 "cell_id bigint, lat double, lon double, corner_lat array<double>, corner_lon array<double>")


def test_overlap_across_the_date_line(spark):
    p = pixels(spark, [(-180., -179.9, -.1, .1), (-179., -178.9, -.1, .1), (180.2, 180.3, -.1, .1)])
    hits, unsure = V.overlap_pairs(cell(spark, 0, 180, .2), p)
    assert [r["ix"] for r in hits.collect()] == [0] and unsure.count() == 0


def test_overlap_area_at_the_equator(spark):
    hits, _ = V.overlap_pairs(cell(spark, 0, 10, .5), pixels(spark, [(9.5, 10.0, -.25, .25), (20., 21., 0., 1.)]))
    side = math.radians(0.5) * V.OVERLAP_RADIUS_M
    assert [r["ix"] for r in hits.collect()] == [0]
    assert hits.first()["area_fine"] == pytest.approx(side * side, rel=1e-3)


def test_overlap_finds_every_pair(spark):
    """All pairs that share area are found, with cells up to the poles, coarser and finer than the pixels."""
    lat = [-89.0, -60.3, 0.1, 45.2, 88.7, 20.0, -33.3, 60.1]
    cells = None
    for k, la in enumerate(lat):
        c = cell(spark, la, 35.0 * k - 80, [.6, .6, .6, .6, .6, 7.0, .01, 2.5][k]).withColumn("cell_id", F.lit(k).cast("bigint"))
        cells = c if cells is None else cells.union(c)
    grid = spark.range(180).select(F.explode(F.sequence(F.lit(0), F.lit(359))).alias("ix"), F.col("id").cast("int").alias("iy")).select(
        "iy", "ix", (F.col("ix") - 180.0).alias("lon_lo"), (F.col("ix") - 179.0).alias("lon_hi"), (F.col("iy") - 90.0).alias("lat_lo"), (F.col("iy") - 89.0).alias("lat_hi"))
    # the area test itself on all pairs near the cell latitude is the reference
    import pandas as pd
    pdc, pdp = cells.toPandas(), grid.toPandas()
    want = set()
    for c in pdc.itertuples():
        reach = 1.2 + math.degrees(max(c.corner_lat) - c.lat)
        near = pdp[(pdp.lat_hi > math.degrees(c.lat) - reach) & (pdp.lat_lo < math.degrees(c.lat) + reach)]
        if abs(math.degrees(c.lat)) < 60:
            near = near[abs((near.lon_lo - math.degrees(c.lon) + 180) % 360 - 180) < 3 * reach]
        for q in near.itertuples():
            row = pd.Series(dict(lat=c.lat, lon=c.lon, corner_lat=c.corner_lat, corner_lon=c.corner_lon, lat_lo=q.lat_lo, lat_hi=q.lat_hi, lon_lo=q.lon_lo, lon_hi=q.lon_hi))
            if V._areas(pd.DataFrame([row]), 0.01)[0] > 1.0:
                want.add((c.cell_id, q.iy, q.ix))
    hits, unsure = V.overlap_pairs(cells, grid)
    got = [(r["cell_id"], r["iy"], r["ix"]) for r in hits.collect()]
    assert sorted(got) == sorted(want) and len(want) >= 150  # each pair once


def test_a_coarse_cell_adds_a_few_boxes(spark):
    fine = spark.range(2000).select(F.col("id").alias("cell_id"), (F.rand(4) * 1.2).alias("lat"), (F.rand(5) * 1.5).alias("lon"), F.lit(0.004).alias("reach"))
    pixels = spark.range(3000).select(F.col("id").cast("int").alias("ix"), (F.rand(6) * 1.2).alias("lat"), (F.rand(7) * 1.5).alias("lon"), F.lit(0.003).alias("half"))
    at = lambda df: df.withColumn("at", G.unit_xyz(F.col("lat"), F.col("lon")))
    coarse = spark.createDataFrame([(9999, 0.5, 0.5, 0.4)], fine.schema)

    def loads(cells):
        (covers, inside), (above, below) = V.overlap_boxes(at(cells), at(pixels))
        assert above.count() == 0 == below.count()
        count = lambda df: {r["box"]: r["count"] for r in df.groupBy("box").count().collect()}
        return count(covers), count(inside)

    few, many = loads(fine), loads(fine.unionByName(coarse))
    level = {b.level for b in few[0]}
    assert {b: n for b, n in many[0].items() if b.level in level} == few[0]
    assert {b: n for b, n in many[1].items() if b.level in level} == few[1]
    assert sum(many[0].values()) - sum(few[0].values()) <= 125


def test_pixels_half_open(spark):
    pts = spark.createDataFrame([(0, 0., 180.), (1, 0., -180.), (2, 90., 0.)], "k int, lat double, lon double")
    lat = spark.createDataFrame([(0, -90., 0.), (1, 0., 90.)], "idx int, lo double, hi double")
    lon = spark.createDataFrame([(0, -180., 0.), (1, 0., 180.)], "idx int, lo double, hi double")
    assert rows(V.assign_pixel(pts, lat, lon).select("k", "iy", "ix")) == [(0, 1, 0), (1, 1, 0), (2, 1, 1)]


def test_points_on_an_edge_are_not_moved_by_a_turn(spark):
    # 6000 columns of 0.06 degrees: these longitudes are a rounding below an edge, and turned by 360 degrees on it or above
    edge = [-180 + k * 360.0 / 6000 for k in range(6001)]
    near = {k: round(edge[k] * 1000) / 1000 for k in range(1, 6000)}
    at = [k for k, x in near.items() if x < edge[k] <= ((x + 180.0) % 360.0) - 180.0][:20]
    assert at
    lat = spark.createDataFrame([(0, -90., 0.), (1, 0., 90.)], "idx int, lo double, hi double")
    lon = spark.createDataFrame([(k, edge[k], edge[k + 1]) for k in range(6000)], "idx int, lo double, hi double")
    pts = spark.createDataFrame([(k, 1., near[k]) for k in at] + [(-1, 1., 540.0)], "k int, lat double, lon double")
    assert rows(V.assign_pixel(pts, lat, lon, wrap=False).select("k", "ix")) == [(-1, 0)] + [(k, k - 1) for k in at]


def test_superob_bins_on_an_edge(spark):
    # row 5 of 13 has 25 columns, so edges lie at 14.4 degrees; these longitudes are in one column as given and in another turned by 360
    col = lambda x: math.floor(x / 360.0 * 25)
    near = [v / 1000 + s * 360 for v in range(0, 360000, 14400) for s in (0, 1, 2)] + [math.nextafter(v / 1000, 0) for v in range(14400, 360000, 14400)]
    lons = [x for x in near if col(math.fmod(x, 360.0)) != col((math.fmod(x, 360.0) + 360.0) % 360.0)]
    assert lons
    obs = spark.createDataFrame([(k, -13.0, x, 1.0) for k, x in enumerate(lons)], "k int, lat double, lon double, obs double")
    want = sorted((k, 5, col((math.fmod(x, 360.0) + 360.0) % 360.0), 1.0, 1) for k, x in enumerate(lons))
    assert rows(Q.superob(obs, 1500.0, ["k"], ["obs"])) == want
