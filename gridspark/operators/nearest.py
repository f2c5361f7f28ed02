"""Nearest cell centre on the sphere.

The mesh is turned once into a table of boxes of the unit cube, each with the few cells that
can be nearest to some point inside it. A point then needs one equi-join on its box, so the
points, the side that grows, are never repeated and are not shuffled while the table is small.
"""
from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridspark.functions import geometry as G
from gridspark.operators.skew import lookup_join
from gridspark.session import settle

MAX_CANDIDATES = 32
#: an octree node with more cells is split
NODE_CELLS = 8
STEP = 2
DEEPEST = 20
#: the table that tells a point which levels have boxes around it holds about so many nodes, few enough to be broadcast
MAP_NODES = 1 << 17
_MARGIN = 1e-12
_SPREAD = ((32, 0x1F00000000FFFF), (16, 0x1F0000FF0000FF), (8, 0x100F00F00F00F00F), (4, 0x10C30C30C30C30C3), (2, 0x1249249249249249))


def _box_of(axis: Column, level: Column) -> Column:
    """Index of the box holding a coordinate of [-1, 1] when that span is cut 2**level times."""
    n = F.pow(F.lit(2.0), level)
    return F.least(F.floor((axis + 1.0) / 2.0 * n), n - 1).cast("int")


def morton(x: Column, y: Column, z: Column) -> Column:
    """One number whose bits are those of three box indices in turn (21 bits each); the boxes of a larger box are a run of numbers."""
    def spread(v):
        v = v.cast("bigint")
        for shift, mask in _SPREAD:
            v = v.bitwiseOR(F.shiftleft(v, shift)).bitwiseAND(F.lit(mask))
        return v

    return F.shiftleft(spread(x), 2).bitwiseOR(F.shiftleft(spread(y), 1)).bitwiseOR(spread(z))


def box_indices(code: Column) -> dict[str, Column]:
    """The three indices of a Morton number."""
    def gather(v):
        v = v.bitwiseAND(F.lit(_SPREAD[-1][1]))
        for (shift, _), mask in zip(_SPREAD[::-1], [m for _, m in _SPREAD[-2::-1]] + [0x1FFFFF]):
            v = v.bitwiseOR(F.shiftright(v, shift)).bitwiseAND(F.lit(mask))
        return v.cast("int")

    return {"bx": gather(F.shiftright(code, 2)), "by": gather(F.shiftright(code, 1)), "bz": gather(code)}


def _box_key(code: Column, level: Column) -> Column:
    """A box as one number: its Morton number after a leading 1, whose place tells the level."""
    return F.call_function("shiftleft", F.lit(1).cast("bigint"), level * 3).bitwiseOR(code)


def _geometry(level: Column) -> tuple[dict[str, Column], Column]:
    """Centre by axis and half width of the boxes (bx, by, bz) of a level."""
    half = F.lit(1.0) / F.pow(F.lit(2.0), level)
    return {a: (F.col(f"b{a}") * 2.0 + 1.0) * half - 1.0 for a in "xyz"}, half


def _on_sphere(centre: dict[str, Column], half: Column) -> Column:
    near = sum((F.pow(F.greatest(F.abs(centre[a]) - half, F.lit(0.0)), 2) for a in "xyz"), F.lit(0.0))
    far = sum((F.pow(F.abs(centre[a]) + half, 2) for a in "xyz"), F.lit(0.0))
    return (near <= 1.0 + 1e-9) & (far >= 1.0 - 1e-9)


BOX = ["level", "bx", "by", "bz"]


def _winners(pairs: DataFrame) -> DataFrame:
    """Pairs of box and cell without the cells that win nowhere in the box.

    Cell c can beat cell w at a point p of the sphere only if p.(c - w) >= 0; the largest value
    over a box is the value at its centre plus half its width times |c - w| summed by axis.
    """
    centre, half = _geometry(F.col("level"))
    d2 = G.chord2(centre["x"], centre["y"], centre["z"], F.col("x"), F.col("y"), F.col("z"))
    best = pairs.groupBy(*BOX).agg(F.min_by(F.struct("x", "y", "z"), F.struct(d2.alias("d"), F.col("cell_id"))).alias("w"))
    both = pairs.join(best, BOX)
    diff = {a: F.col(a) - F.col(f"w.{a}") for a in "xyz"}
    at_centre = sum((centre[a] * diff[a] for a in "xyz"), F.lit(0.0))
    reach = sum((F.abs(diff[a]) for a in "xyz"), F.lit(0.0)) * half
    return both.filter(at_centre + reach >= -_MARGIN).select(*BOX, "cell_id", "x", "y", "z")


def _split(boxes: DataFrame) -> DataFrame:
    """Children (``STEP`` levels down) of every box with the candidates that may win somewhere inside."""
    side = range(2**STEP)
    kids_of = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(j).alias("j"), F.lit(k).alias("k"))
                        for i in side for j in side for k in side])
    kids = boxes.withColumn("o", F.explode(kids_of)).select(
        (F.col("level") + STEP).alias("level"), *[(F.col(f"b{a}") * 2**STEP + F.col(f"o.{o}")).alias(f"b{a}") for a, o in zip("xyz", "ijk")], "cell_id", "x", "y", "z")
    return _winners(kids.filter(_on_sphere(*_geometry(F.col("level")))))


def _leaves(cells: DataFrame) -> DataFrame:
    """Leaves (level, node, x, y, z) of an octree over the cells: surface boxes with at most ``NODE_CELLS`` cells, each with the
    position of one cell in it, or else in the node above.

    Cells are sorted by Morton number, so the nodes of every level are runs of numbers, counted where they lie.
    """
    levels = F.explode(F.array(*[F.lit(k) for k in range(0, DEEPEST + 1, STEP)])).alias("level")
    at = cells.select("code", "cell_id", "x", "y", "z", levels)
    node = F.expr(f"shiftright(code, 3 * ({DEEPEST} - level))")
    nodes = settle(at.groupBy("level", node.alias("node")).agg(F.count(F.lit(1)).alias("n"), F.min_by(F.struct("x", "y", "z"), "cell_id").alias("at")))
    inner = nodes.filter((F.col("n") > NODE_CELLS) & (F.col("level") < DEEPEST) | (F.col("level") == 0))
    kids = inner.select((F.col("level") + STEP).alias("level"), F.explode(F.sequence(F.lit(0), F.lit(8**STEP - 1))).alias("k"), "node", F.col("at").alias("above"))
    kids = kids.select("level", (F.shiftleft("node", 3 * STEP) + F.col("k")).alias("node"), "above")
    kids = kids.select("level", "node", "above", *[c.alias(n) for n, c in box_indices(F.col("node")).items()])
    kids = kids.filter(_on_sphere(*_geometry(F.col("level"))))
    kids = kids.join(inner.select("level", "node"), ["level", "node"], "left_anti").join(nodes.select("level", "node", "at"), ["level", "node"], "left")
    return kids.select(*BOX, F.coalesce("at", "above").alias("at"))


def _seeds(cells: DataFrame) -> DataFrame:
    """Candidate pairs (level, bx, by, bz, cell_id, x, y, z) of every leaf.

    No point of a box is farther from its nearest cell than from the known one, so candidates lie within the distance of that cell from the
    centre and the diagonal. They are looked up in the at most 27 boxes, no narrower than this, around the centre.
    """
    leaves = _leaves(cells)
    centre, half = _geometry(F.col("level"))
    leaves = leaves.select(*BOX, F.struct(*[centre[a].alias(a) for a in "xyz"]).alias("c"), half.alias("half"), "at")
    away = F.sqrt(G.chord2(F.col("c.x"), F.col("c.y"), F.col("c.z"), F.col("at.x"), F.col("at.y"), F.col("at.z")))
    radius = away + F.col("half") * (2 * 3**0.5) + 1e-9
    leaves = leaves.withColumn("radius", radius)
    fit = F.floor(F.log2(F.lit(2.0) / F.col("radius")) / STEP) * STEP
    leaves = settle(leaves.withColumn("g", F.least(F.greatest(fit, F.lit(0)), F.lit(DEEPEST)).cast("int")))
    used = sorted(r["g"] for r in leaves.select("g").distinct().collect())  # at most one per level
    n = F.pow(F.lit(2.0), F.col("g"))

    def span(a):
        lo, hi = (F.floor((F.col(f"c.{a}") + s * F.col("radius") + 1.0) / 2.0 * n) for s in (-1, 1))
        return F.sequence(F.greatest(lo, F.lit(0)).cast("int"), F.least(hi, n - 1).cast("int"))

    around = leaves
    for a in "xyz":
        around = around.withColumn(f"g{a}", F.explode(span(a)))
    around = around.withColumn("node", morton(F.col("gx"), F.col("gy"), F.col("gz"))).drop("gx", "gy", "gz")
    keyed = cells.withColumn("g", F.explode(F.array(*[F.lit(k) for k in used]))).withColumn("node", F.expr(f"shiftright(code, 3 * ({DEEPEST} - g))"))
    met = around.join(keyed.drop("code"), ["g", "node"])
    close = G.chord2(F.col("c.x"), F.col("c.y"), F.col("c.z"), F.col("x"), F.col("y"), F.col("z")) <= F.pow("radius", 2)
    return met.filter(close).select(*BOX, "cell_id", "x", "y", "z")


def cell_index(mesh: DataFrame, max_candidates: int = MAX_CANDIDATES) -> DataFrame:
    """Box table (level, bx, by, bz, chunk, cands) of a mesh(cell_id, lat, lon in radians).

    The boxes begin as leaves of an octree that is as fine as the mesh is, so their number follows the number of cells from the first
    round on; boxes with more than ``max_candidates`` candidates are split until none is left. Where many cells are equally near
    to one point (the ring around a pole), the box with that point keeps them all at the deepest level, in as many rows of
    at most ``max_candidates`` as it takes (``chunk`` numbers them). Centres that coincide are represented by the lowest id. Each round is
    one distributed pass, written before the next. Write the result beside the mesh and reuse it.
    """
    at = mesh.select("cell_id", G.unit_xyz(F.col("lat"), F.col("lon")).alias("p")).select("cell_id", "p.*")
    code = morton(*[_box_of(F.col(a), F.lit(DEEPEST)) for a in "xyz"])
    cells = settle(at.groupBy("x", "y", "z").agg(F.min("cell_id").alias("cell_id")).withColumn("code", code).repartitionByRange("code").sortWithinPartitions("code"))
    tried, done = settle(_winners(settle(_seeds(cells)))), []
    while True:
        counts = tried.groupBy(*BOX).agg(F.count(F.lit(1)).alias("n"))
        over = settle(counts.filter((F.col("n") > max_candidates) & (F.col("level") + STEP <= DEEPEST)).drop("n"))
        last = over.isEmpty()
        done.append(tried if last else tried.join(over, BOX, "left_anti"))
        if last:
            break
        tried = settle(_split(tried.join(over, BOX, "left_semi")))
    # candidates in chunks: a hash deals them, so no row holds more than a few more than the limit
    pairs = functools.reduce(DataFrame.unionByName, done)
    nth = F.row_number().over(Window.partitionBy(*BOX).orderBy("cell_id")) - 1
    pairs = pairs.withColumn("chunk", F.floor(nth / max_candidates).cast("int"))
    return settle(pairs.groupBy(*BOX, "chunk").agg(F.collect_list(F.struct("cell_id", "x", "y", "z")).alias("cands")))


def nearest_cell(points: DataFrame, mesh: DataFrame, interior_only: bool = False, reject_outside: bool = False,
                 factor: float = 2.5, radius_m: float = G.SPHERE_RADIUS_M, lat: str = "lat", lon: str = "lon",
                 index: DataFrame | None = None) -> DataFrame:
    """points(lat, lon in degrees, ...) gain cell_id, distance_km and accepted.

    Ties go to the lowest cell_id. Points that are not finite or beyond the poles get -1. With
    ``reject_outside`` a point farther than ``factor * sqrt(area / pi)`` from its cell, or outside
    its polygon when the mesh has ``corner_lat``/``corner_lon``, gets -1 as well.
    ``index`` is a table written by :func:`cell_index` for the same cells; by its bytes Spark decides whether it is broadcast.
    """
    if reject_outside and factor <= 0:
        raise ValueError("factor must be positive")
    used = mesh.filter(F.col("bdy_mask") == 0) if interior_only else mesh
    boxes = cell_index(used) if index is None else index
    chunk = F.col("chunk") if "chunk" in boxes.columns else F.lit(0)
    boxes = boxes.select("level", morton(F.col("bx"), F.col("by"), F.col("bz")).alias("at"), chunk.alias("chunk"), "cands")
    above = F.explode(F.sequence(F.lit(0), F.col("level"), F.lit(STEP))).alias("g")
    nodes = boxes.select("level", "at", "chunk", above).groupBy("g").agg(
        F.approx_count_distinct(F.expr("shiftright(at, 3 * (level - g))")).alias("n"), F.max(F.when(F.col("level") == F.col("g"), F.col("chunk"))).alias("chunk"))
    facts = sorted(nodes.collect())  # at most one row per level
    if not facts:
        raise ValueError("the mesh has no cells")
    levels, chunks = [f["g"] for f in facts if f["chunk"] is not None], max(f["chunk"] or 0 for f in facts)
    inf = float("inf")
    fine = (F.abs(F.col(lat)) <= 90.0) & ~F.isnan(lon) & (F.abs(F.col(lon)) < inf)
    # a point without a usable position is looked up at (1, 0, 0) and given -1 afterwards
    nowhere = F.struct(F.lit(1.0).alias("x"), F.lit(0.0).alias("y"), F.lit(0.0).alias("z"))
    p = points.withColumn("_ok", F.coalesce(fine, F.lit(False))).withColumn(
        "_p", F.when(F.col("_ok"), G.unit_xyz(F.radians(lat), F.radians(lon))).otherwise(nowhere))
    p = p.select(*points.columns, "_ok", *[F.col(f"_p.{a}").alias(f"_{a}") for a in "xyz"])
    p = p.withColumn("_code", morton(*[_box_of(F.col(f"_{a}"), F.lit(DEEPEST)) for a in "xyz"]))
    # a node with boxes of its own level or deeper holds no part of a larger one, so few levels are left to look at
    g = max((f["n"], f["g"]) for f in facts if f["n"] <= MAP_NODES)[1]
    below = boxes.filter(F.col("level") >= g).groupBy(F.expr(f"shiftright(at, 3 * (level - {g}))").alias("_node")).agg(F.collect_set("level").alias("_levels"))
    keyed = lookup_join(p.withColumn("_node", F.expr(f"shiftright(_code, {3 * (DEEPEST - g)})")), below, ["_node"])
    larger = F.array(*[F.lit(v) for v in levels if v < g]).cast("array<int>")
    keyed = keyed.withColumn("_level", F.explode(F.coalesce("_levels", larger)))
    keyed = keyed.withColumn("_box", _box_key(F.expr(f"shiftright(_code, 3 * ({DEEPEST} - _level))"), F.col("_level"))).drop("_code", "_node", "_levels", "_level")
    # every position lies in exactly one box over all levels, so the inner join restores one row per point
    boxes = boxes.select(_box_key(F.col("at"), F.col("level")).alias("_box"), "chunk", "cands")
    px, py, pz = (F.col(f"_{a}") for a in "xyz")
    scored = F.transform("cands", lambda c: F.struct(
        G.chord2(px, py, pz, c["x"], c["y"], c["z"]).alias("d"), c["cell_id"].alias("cell_id")))
    best = F.array_min(scored)
    if not chunks:
        hit = keyed.join(boxes.drop("chunk"), "_box").withColumn("_n", best).drop("cands", "_box")
    else:
        # a box of many equally near cells has several rows: its few points keep the best of them
        crowded = settle(boxes.filter("chunk > 0").select("_box").distinct())
        plain = keyed.join(crowded, "_box", "left_anti").join(boxes.drop("chunk"), "_box").withColumn("_n", best)
        several = keyed.withColumn("_row", F.monotonically_increasing_id()).join(crowded, "_box", "left_semi")
        several = several.join(boxes.drop("chunk"), "_box").withColumn("_n", best)
        point = [c for c in keyed.columns if c != "_box"]
        several = several.groupBy("_row").agg(*[F.first(c).alias(c) for c in point], F.min("_n").alias("_n"))
        hit = plain.select(*point, "_n").unionByName(several.select(*point, "_n"))
    angle = G.chord_to_angle(F.sqrt("_n.d"))
    hit = hit.withColumn("cell_id", F.when(F.col("_ok"), F.col("_n.cell_id")).otherwise(F.lit(-1)).cast("bigint"))
    hit = hit.withColumn("distance_km", F.when(F.col("_ok"), angle * (radius_m / 1000.0)))
    if reject_outside:
        shape = [c for c in ("corner_lat", "corner_lon") if c in mesh.columns]
        centre = [F.col("lat").alias("_clat"), F.col("lon").alias("_clon"), *shape] if len(shape) == 2 else []
        hit = lookup_join(hit, mesh.select("cell_id", F.col("area_m2").alias("_area"), *centre), ["cell_id"])
        near = F.col("distance_km") * 1000.0 <= factor * F.sqrt(F.col("_area") / F.lit(3.141592653589793))
        if len(shape) == 2:
            near = near & G.inside_polygon(F.radians(lat), F.radians(lon), F.col("corner_lat"), F.col("corner_lon"),
                                           F.col("_clat"), F.col("_clon"))
        hit = hit.withColumn("_ok", F.col("_ok") & F.coalesce(near, F.lit(False)))
        hit = hit.withColumn("cell_id", F.when(F.col("_ok"), F.col("cell_id")).otherwise(F.lit(-1).cast("bigint")))
        hit = hit.drop("_area", "_clat", "_clon", *shape)
    return hit.withColumnRenamed("_ok", "accepted").drop("_x", "_y", "_z", "_n")
