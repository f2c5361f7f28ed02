"""Meshes and regular grids: axes, areas, polygons, neighbours, identity."""
from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridspark.functions import geometry as G
from gridspark.operators.identity import digest_tree, range_digests, root
from gridspark.operators.skew import lookup_join


def axis_bounds(axis: DataFrame) -> DataFrame:
    """Bounds from centres: axis(grid_id, axis, idx, centre) gains lo and hi.

    Interior bounds are midpoints, the outer ones a half step away; latitude ends are
    set to the poles. The window covers one axis, whose length is the grid's.
    """
    w = Window.partitionBy("grid_id", "axis").orderBy("idx")
    before, after = F.lag("centre").over(w), F.lead("centre").over(w)
    lo = F.when(before.isNotNull(), (before + F.col("centre")) / 2.0).otherwise(
        F.col("centre") - (after - F.col("centre")) / 2.0)
    hi = F.when(after.isNotNull(), (F.col("centre") + after) / 2.0).otherwise(
        F.col("centre") + (F.col("centre") - before) / 2.0)
    lat = F.col("axis") == "lat"
    return axis.withColumn("lo", F.when(lat & before.isNull(), -90.0).otherwise(lo)).withColumn(
        "hi", F.when(lat & after.isNull(), 90.0).otherwise(hi))


def axis_violations(axis: DataFrame, periodic: tuple[str, ...] = ("lon",), tol: float = 1e-6) -> DataFrame:
    """Rule breaks of an axis: too short, not strictly increasing, periodic span not 360 degrees."""
    w = Window.partitionBy("grid_id", "axis").orderBy("idx")
    step = axis.withColumn("step", F.col("centre") - F.lag("centre").over(w))
    bounds = axis_bounds(axis).groupBy("grid_id", "axis").agg((F.max("hi") - F.min("lo")).alias("span"))
    per = step.groupBy("grid_id", "axis").agg(F.count(F.lit(1)).alias("n"), F.min("step").alias("least"))
    per = per.join(bounds, ["grid_id", "axis"])
    rule = (
        F.when(F.col("n") < 2, "too_short")
        .when(F.col("least") <= 0, "not_increasing")
        .when(F.col("axis").isin(list(periodic)) & (F.abs(F.col("span") - 360.0) > tol), "span_not_360")
    )
    return per.withColumn("rule", rule).filter(F.col("rule").isNotNull()).select("grid_id", "axis", "rule")


def grid_cells(bounds: DataFrame) -> DataFrame:
    """Cells of regular grids: src_id (longitude fastest), centres, bounds and area in steradian."""
    lat = bounds.filter(F.col("axis") == "lat").select(
        "grid_id", F.dense_rank().over(Window.partitionBy("grid_id").orderBy("centre")).alias("i"),
        F.col("centre").alias("lat"), F.col("lo").alias("lat_lo"), F.col("hi").alias("lat_hi"))
    # the longitudes of a grid travel as one array, so a latitude row explodes into its own cells
    entry = F.struct(F.col("centre").alias("lon"), F.col("lo").alias("lon_lo"), F.col("hi").alias("lon_hi"))
    lon = bounds.filter(F.col("axis") == "lon").groupBy("grid_id").agg(F.array_sort(F.collect_list(entry)).alias("lons"))
    cells = lookup_join(lat, lon, ["grid_id"], "inner").withColumn("nlon", F.size("lons"))
    cells = cells.select("*", F.posexplode("lons").alias("j", "x"))
    src = (F.col("i") - 1) * F.col("nlon") + F.col("j")
    area = G.band_area_sr(F.col("lat_lo"), F.col("lat_hi"), F.col("x.lon_hi") - F.col("x.lon_lo"))
    return cells.select("grid_id", src.cast("bigint").alias("src_id"), "lat", "x.lon", "lat_lo", "lat_hi",
                        "x.lon_lo", "x.lon_hi", area.alias("area_sr"))


def flat_index(values: DataFrame, lat_axis: DataFrame, lon_axis: DataFrame) -> DataFrame:
    """src_id for long values keyed by (lat, lon): rank of latitude x nlon + rank of longitude.

    Ranking the axes makes a descending latitude ascend, so rows never need a flip.
    """
    wl = Window.partitionBy("grid_id").orderBy("centre")
    lat = lat_axis.select("grid_id", F.col("centre").alias("lat"), (F.dense_rank().over(wl) - 1).alias("i"))
    lon = lon_axis.select("grid_id", F.col("centre").alias("lon"), (F.dense_rank().over(wl) - 1).alias("j"),
                          F.count(F.lit(1)).over(Window.partitionBy("grid_id")).alias("nlon"))
    out = lookup_join(lookup_join(values, lat, ["grid_id", "lat"], "inner"), lon, ["grid_id", "lon"], "inner")
    return out.withColumn("src_id", (F.col("i") * F.col("nlon") + F.col("j")).cast("bigint")).drop("i", "j", "nlon")


def grid_identity(axis: DataFrame) -> DataFrame:
    """Fingerprint per grid from quantised axes; encoding noise below the quantum does not matter.

    Places and values of an axis are added up as digests, so no array holds an axis.
    """
    q = axis.select("grid_id", "axis", "idx", G.quantum_index(F.col("centre")).alias("q"))
    text = F.concat_ws(":", F.col("axis"), F.col("idx").cast("string"), F.col("q").cast("string"))
    return range_digests(q, ["grid_id"], text).select("grid_id", F.substring("digest", 1, 16).alias("fingerprint"))


def identity_conflicts(fingerprints: DataFrame, group: list[str]) -> DataFrame:
    """Groups whose members (files, products) do not all share one fingerprint."""
    return fingerprints.groupBy(*group).agg(F.countDistinct("fingerprint").alias("n_fingerprints")).filter(
        F.col("n_fingerprints") > 1)


def check_identity(recorded: DataFrame, expected: DataFrame, keys: list[str], supplied: bool) -> DataFrame:
    """Decision per item: ``use``, ``warn`` (no record), and on mismatch ``rebuild`` or, if supplied, ``error``."""
    r, e = F.col("recorded"), F.col("expected")
    verdict = F.when(r.isNull(), "warn").when(r == e, "use").otherwise("error" if supplied else "rebuild")
    return expected.withColumnRenamed("fingerprint", "expected").join(
        recorded.withColumnRenamed("fingerprint", "recorded"), keys, "left").withColumn("verdict", verdict)


def mesh_text() -> Column:
    """Text of a cell's geometry: coordinates at 1e-9 rad, areas at 1e-3 m2."""
    return F.concat_ws(
        "|", F.col("cell_id").cast("string"),
        F.rint(F.col("lat") * 1e9).cast("bigint").cast("string"),
        F.rint(F.col("lon") * 1e9).cast("bigint").cast("string"),
        F.rint(F.col("area_m2") * 1e3).cast("bigint").cast("string"))


def mesh_tree(mesh: DataFrame) -> DataFrame:
    """Digest tree of a mesh over ranges of cells; two trees tell which ranges differ."""
    return digest_tree(mesh, "cell_id", mesh_text())


def mesh_identity(mesh: DataFrame) -> DataFrame:
    """Order-free fingerprint of a mesh: number of cells and the digest at the top of its tree."""
    return root(mesh_tree(mesh)).select(F.col("n_rows").alias("n_cells"), "digest")


def is_global(mesh: DataFrame, radius_m: float = G.SPHERE_RADIUS_M) -> DataFrame:
    """Surface fraction of the cells, and whether it is the whole sphere."""
    frac = F.sum("area_m2") / F.lit(4.0 * math.pi * radius_m**2)
    return mesh.agg(frac.alias("surface_fraction")).withColumn(
        "is_global", F.abs(F.col("surface_fraction") - 1.0) <= G.GLOBAL_AREA_TOLERANCE)


def mesh_polygons(mesh: DataFrame, vertices: DataFrame, radius_m: float = G.SPHERE_RADIUS_M,
                  mask_boundary: bool = False) -> DataFrame:
    """Polygon table: corners padded to the widest active order, centre longitude wrapped, area in steradian.

    mesh(cell_id, lat, lon, area_m2, n_edges, vertex_ids 1-based, bdy_mask); vertices(vertex_id 0-based,
    lat, lon). Corners are fetched by an equi-join; a cell gathers only its own few corners.
    """
    n_vertices = vertices.agg(F.max("vertex_id").alias("m")).first()["m"] + 1
    width = mesh.agg(F.max("n_edges").alias("m")).first()["m"]
    ids = G.valid_vertices(F.col("vertex_ids"), F.col("n_edges"), F.lit(n_vertices))
    corners = mesh.select("cell_id", F.posexplode(ids).alias("pos", "vertex_id"))
    found = corners.join(vertices.select("vertex_id", F.col("lat").alias("vlat"), F.col("lon").alias("vlon")), "vertex_id")
    rings = found.groupBy("cell_id").agg(F.array_sort(F.collect_list(F.struct("pos", "vlat", "vlon"))).alias("ring"))
    mask = F.when(F.col("bdy_mask") != 0, 0).otherwise(1) if mask_boundary else F.lit(1)
    out = mesh.join(rings, "cell_id", "left")

    def corner(name):
        return G.pad_with_last(F.transform("ring", lambda r: r[name]), F.lit(width))

    return out.select(
        "cell_id", "lat", G.wrap_2pi(F.col("lon")).alias("lon"), (F.col("area_m2") / radius_m**2).alias("area_sr"),
        corner("vlat").alias("corner_lat"), corner("vlon").alias("corner_lon"), mask.alias("mask"),
        (F.coalesce(F.size("ring"), F.lit(0)) < 3).alias("invalid"))


def neighbor_edges(mesh: DataFrame, interior_only: bool = True, require_full: bool = False) -> DataFrame:
    """Edge list (cell_id, nbr_id) over kept cells; mesh has 1-based ``neighbors`` and ``n_edges``.

    Cells outside the mask, optionally cells without their full number of neighbours, and
    then cells left without any neighbour are dropped together with references to them.
    """
    base = mesh.filter(F.col("bdy_mask") == 0) if interior_only else mesh
    raw = base.select("cell_id", "n_edges", F.explode(F.slice("neighbors", F.lit(1), F.col("n_edges"))).alias("nbr1"))
    links = raw.select("cell_id", "n_edges", (F.col("nbr1") - 1).cast("bigint").alias("nbr_id")).filter("nbr_id >= 0")
    return prune_edges(links, base.select("cell_id", "n_edges"), require_full)


def prune_edges(links: DataFrame, cells: DataFrame, require_full: bool = False) -> DataFrame:
    """Keep links between kept cells: links(cell_id, nbr_id), cells(cell_id[, n_edges])."""
    keep = cells.select("cell_id").distinct()

    def between(edges, kept):
        return edges.join(kept, "cell_id", "left_semi").join(
            kept.select(F.col("cell_id").alias("nbr_id")), "nbr_id", "left_semi")

    inside = between(links.select("cell_id", "nbr_id"), keep)
    if require_full:
        have = inside.groupBy("cell_id").agg(F.count(F.lit(1)).alias("have"))
        keep = cells.join(have, "cell_id").filter(F.col("have") == F.col("n_edges")).select("cell_id")
        inside = between(inside, keep)
    # one pass, like the two-pass mask: cells left without links vanish with the links that name them
    with_links = inside.select("cell_id").distinct()
    return between(inside, with_links).select("cell_id", "nbr_id")


def neighbor_counts(edges: DataFrame) -> DataFrame:
    """Number of kept neighbours per cell."""
    return edges.groupBy("cell_id").agg(F.count(F.lit(1)).alias("n_neighbors"))
