"""Dominant vegetation category of fires and footprint fire support."""
from __future__ import annotations

from itertools import chain

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridspark.functions.geometry import chord2, unit_xyz, wrap_from
from gridspark.functions.numbers import is_finite
from gridspark.operators.skew import lookup_join, salted_join
from gridspark.session import settle

# Vegetation code of a fire record to category. 0 unknown, 1 tropical forest,
# 2 extratropical forest, 3 woody savanna or shrub, 4 grass or crop.
CROSSWALK = {0: 0, 1: 4, 2: 3, 3: 1, 4: 2, 5: 2, 6: 2, 9: 4}
# Tolerances of the staged-mean check and the two densifications of the overlap test.
MEAN_RTOL, MEAN_ATOL = 2e-5, 0.5
DENSIFY_STEPS = (0.02, 0.01)
OVERLAP_RADIUS_M = 6371220.0
#: finest level of the boxes in which shapes meet: about 24 m wide
FINEST_BOX = 18


def crosswalk(code: Column, table: dict[int, int] | None = None) -> Column:
    """Category of a code, NULL for a code the table does not know."""
    pairs = [F.lit(x) for x in chain.from_iterable((table or CROSSWALK).items())]
    return F.create_map(*pairs)[code]


def validate_fires(fires: DataFrame, day: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """(kept records, rejected counts by reason and whether fatal).

    Negative areas are skipped and counted. Non-finite values, a DAY other than the manifest's day of
    year, coordinates out of range and unknown or fractional codes are fatal.
    """
    numbers = [F.col(c) for c in ("lat", "lon", "genveg", "area")]
    finite = is_finite(numbers[0])
    for c in numbers[1:]:
        finite = finite & is_finite(c.cast("double"))
    place = F.col("lat").between(-90, 90) & F.col("lon").between(-180, 360)
    code = F.col("genveg").cast("double")
    whole = code == F.floor(code)
    reason = F.when(~finite, "nonfinite")
    if day is not None:
        reason = reason.when(F.col("day_number") != F.dayofyear(day), "day_mismatch")
    reason = (reason.when(~place, "coordinates").when(F.col("area") < 0, "negative_area")
              .when(~whole | crosswalk(code.cast("int")).isNull(), "unknown_code"))
    marked = fires.withColumn("reason", reason)
    counts = marked.filter(F.col("reason").isNotNull()).groupBy("file_date", "reason").agg(
        F.count(F.lit(1)).alias("n")).withColumn("fatal", F.col("reason") != "negative_area")
    return marked.filter(F.col("reason").isNull()).drop("reason"), counts


def dominant_category(fires: DataFrame, keys: list[str], code: str = "genveg", area: str = "area") -> DataFrame:
    """Category with the largest summed area per ``keys``; ties take the lowest, 0 if no known area.

    One aggregation: four conditional sums and a count per key, then a projection.
    """
    cat = crosswalk(F.col(code))
    sums = [F.sum(F.when(cat == k, F.col(area)).otherwise(0.0)).alias(f"w{k}") for k in range(5)]
    per = fires.groupBy(*keys).agg(*sums, F.count(F.lit(1)).alias("n_records"), F.sum(area).alias("total"))
    known = F.col("w1") + F.col("w2") + F.col("w3") + F.col("w4")
    top = F.greatest("w1", "w2", "w3", "w4")
    best = F.when(known == 0, 0)
    for k in range(1, 5):
        best = best.when(F.col(f"w{k}") == top, k)
    return per.select(
        *keys, best.alias("category"), F.when(known > 0, top / known).otherwise(0.0).alias("share"),
        F.when(F.col("total") > 0, known / F.col("total")).otherwise(0.0).alias("known_frac"),
        "n_records", F.when(F.col("n_records") > 0, F.col("total") / F.col("n_records")).otherwise(0.0).alias("mean_area"))


def check_consistency(a: DataFrame, b: DataFrame, keys: list[str], value: str, rtol: float = MEAN_RTOL,
                      atol: float = MEAN_ATOL) -> DataFrame:
    """Keys where ``a`` does not reproduce ``b`` within ``atol + rtol * abs(b)``; an absent side counts as 0."""
    both = a.select(*keys, F.col(value).alias("a")).join(b.select(*keys, F.col(value).alias("b")), keys, "full_outer")
    both = both.withColumn("a", F.coalesce("a", F.lit(0.0))).withColumn("b", F.coalesce("b", F.lit(0.0)))
    return both.filter(~(F.abs(F.col("a") - F.col("b")) <= atol + rtol * F.abs(F.col("b"))))


def reference_days(manifest: DataFrame, reference: DataFrame, day: str = "day") -> DataFrame:
    """Manifest problems: repeated days, gaps, and days without exactly one reference record."""
    d = manifest.groupBy(day).agg(F.count(F.lit(1)).alias("n"))
    nxt = d.select(F.date_sub(day, 1).alias(day), F.lit(True).alias("has_next"))
    last = d.agg(F.max(day).alias("last")).first()["last"]
    refs = reference.groupBy(day).agg(F.count(F.lit(1)).alias("n_ref"))
    out = d.join(nxt, day, "left").join(refs, day, "left")
    rule = (F.when(F.col("n") > 1, "repeated_day").when(F.col("has_next").isNull() & (F.col(day) != F.lit(last)), "gap")
            .when(F.coalesce("n_ref", F.lit(0)) != 1, "reference_records"))
    return out.withColumn("rule", rule).filter(F.col("rule").isNotNull()).select(day, "rule")


def assign_pixel(points: DataFrame, lat_axis: DataFrame, lon_axis: DataFrame, lat: str = "lat", lon: str = "lon",
                 wrap: bool = True) -> DataFrame:
    """Row and column of the regular pixel that holds each point: ``lo <= x < hi``.

    axis(idx, lo, hi). Longitude is wrapped into the raster's own 360 degrees and the north pole
    belongs to the last row. The turn rounds in the last digits, which moves points on an edge to the neighbour; without ``wrap``
    longitudes that lie within the raster's 360 degrees are compared as they are given, and only others are turned. Pixel bounds meet points by an equi-join on a bucket of the axis, about one
    candidate per point; an axis is a few thousand rows and its size is checked before it is broadcast.
    """
    west = lon_axis.agg(F.min("lo").alias("w")).first()["w"]
    north = lat_axis.agg(F.max("hi").alias("n")).first()["n"]
    x, turned = F.col(lon), wrap_from(F.col(lon), F.lit(west))
    p = points.withColumn("_x", turned if wrap else F.when((x >= west) & (x < west + 360.0), x).otherwise(turned))
    for axis, value, name in ((lat_axis, F.col(lat), "iy"), (lon_axis, F.col("_x"), "ix")):
        width = axis.agg(((F.max("hi") - F.min("lo")) / F.count(F.lit(1))).alias("w")).first()["w"]
        top = F.lit(north) if name == "iy" else F.lit(float("inf"))
        table = axis.select(F.col("idx").cast("int").alias(name), "lo", "hi").withColumn(
            "_b", F.explode(F.sequence(F.floor(F.col("lo") / width), F.floor(F.col("hi") / width))))
        p = p.withColumn("_v", value).withColumn("_b", F.floor(F.col("_v") / width))
        p = lookup_join(p, table, ["_b"], "inner")
        p = p.filter((F.col("lo") <= F.col("_v")) & ((F.col("_v") < F.col("hi")) | (
            (F.col("_v") == F.col("hi")) & (F.col("hi") == top)))).drop("_b", "_v", "lo", "hi")
    return p.drop("_x")


def duplicate_records(fires: DataFrame) -> DataFrame:
    """Exact repeats of (day, lat, lon, code, area), which have no identity of their own."""
    return fires.groupBy("file_date", "lat", "lon", "genveg", "area").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")


def _on_plane(lat, lon, centre_lat, centre_lon):
    """Points (pairs x n, radians) on the plane that touches the sphere at each pair's centre; great circles are
    straight there. Points on the far half of the sphere become NaN."""
    turn = lon - centre_lon[:, None]
    up, out = np.sin(centre_lat)[:, None], np.cos(centre_lat)[:, None]
    depth = up * np.sin(lat) + out * np.cos(lat) * np.cos(turn)
    scale = OVERLAP_RADIUS_M / np.where(depth > 0, depth, np.nan)
    return np.stack([np.cos(lat) * np.sin(turn) * scale, (out * np.sin(lat) - up * np.cos(lat) * np.cos(turn)) * scale], axis=2)


def _shoelace(ring, size):
    """Signed areas of padded rings (pairs x places x 2) of ``size`` points each."""
    at = np.arange(ring.shape[1])[None, :]
    after = np.take_along_axis(ring, np.where(at + 1 < size[:, None], at + 1, 0)[:, :, None], axis=1)
    cross = ring[:, :, 0] * after[:, :, 1] - after[:, :, 0] * ring[:, :, 1]
    return np.where(at < size[:, None], cross, 0.0).sum(axis=1) / 2.0


def clipped_areas(rings, cells):
    """Areas of rings (pairs x n x 2) inside convex cells (pairs x k x 2), all pairs of a batch at once.

    The half plane of one cell edge after the other cuts every ring. A ring is a padded row with its own
    number of points; a cut keeps the points inside and adds one where an edge crosses, and rows are closed up.
    Cells with fewer corners repeat one: an edge without length cuts nothing.
    """
    size = np.full(len(rings), rings.shape[1])
    turn = np.sign(_shoelace(cells, np.full(len(cells), cells.shape[1])))
    for k in range(cells.shape[1]):
        start, along = cells[:, k], cells[:, (k + 1) % cells.shape[1]] - cells[:, k]
        at = np.arange(rings.shape[1])[None, :]
        real = at < size[:, None]
        follow = np.where(at + 1 < size[:, None], at + 1, 0)
        height = (along[:, None, 0] * (rings[:, :, 1] - start[:, None, 1]) - along[:, None, 1] * (rings[:, :, 0] - start[:, None, 0])) * turn[:, None]
        height_after = np.take_along_axis(height, follow, axis=1)
        inside = real & (height >= 0)
        crossing = real & ((height >= 0) != (height_after >= 0))
        part = height / np.where(crossing, height - height_after, 1.0)
        cut = rings + (np.take_along_axis(rings, follow[:, :, None], axis=1) - rings) * part[:, :, None]
        points = np.stack([rings, cut], axis=2).reshape(len(rings), -1, 2)
        used = np.stack([inside, crossing], axis=2).reshape(len(rings), -1)
        size = used.sum(axis=1)
        order = np.argsort(~used, axis=1, kind="stable")[:, : max(1, int(size.max(initial=1)))]
        rings = np.take_along_axis(points, order[:, :, None], axis=1)
    area = np.abs(_shoelace(rings, size))
    return np.where(np.isnan(turn), np.nan, area)


def _areas(pdf, step):
    """Overlap of each pair with the pixel's parallels drawn in pieces of at most ``step`` degrees."""
    corners = pdf.corner_lat.map(len).to_numpy()
    pad = lambda lists: np.array([np.r_[x, np.repeat(x[-1], corners.max() - len(x))] for x in lists])
    lat, lon = pdf.lat.to_numpy(), pdf.lon.to_numpy()
    cells = _on_plane(pad(pdf.corner_lat), pad(pdf.corner_lon), lat, lon)
    pieces = np.maximum(1, np.ceil((pdf.lon_hi - pdf.lon_lo).to_numpy() / step)).astype(int)
    area = np.full(len(pdf), np.nan)
    for n in np.unique(pieces):
        mine = np.flatnonzero(pieces == n)
        share = np.arange(n + 1)[None, :] / n
        box = pdf.iloc[mine]
        west, east, south, north = (np.radians(box[c].to_numpy())[:, None] for c in ("lon_lo", "lon_hi", "lat_lo", "lat_hi"))
        eastward = west + (east - west) * share
        ring = _on_plane(np.hstack([south + 0 * share, north + 0 * share]), np.hstack([eastward, eastward[:, ::-1]]), lat[mine], lon[mine])
        seen = np.isfinite(ring).all(axis=(1, 2)) & np.isfinite(cells[mine]).all(axis=(1, 2))
        if seen.any():
            area[mine[seen]] = clipped_areas(ring[seen], cells[mine[seen]])
    return area


def _overlap_batches(batches):
    for pdf in batches:
        if len(pdf):
            coarse, fine = (_areas(pdf, s) for s in DENSIFY_STEPS)
            yield pd.DataFrame({"cell_id": pdf.cell_id, "iy": pdf.iy, "ix": pdf.ix, "area_coarse": coarse, "area_fine": fine})


def _box_level(radius: Column) -> Column:
    """The finest level whose boxes, 2 / 2**level wide, are no narrower than ``radius`` (of the unit sphere)."""
    return F.greatest(F.least(F.floor(F.log2(F.lit(2.0) / F.greatest(radius, F.lit(1e-9)))), F.lit(FINEST_BOX)), F.lit(0)).cast("int")


def _width(level: Column) -> Column:
    return F.lit(2.0) / F.pow(F.lit(2.0), level)


def _box(at: Column, level: Column) -> Column:
    return F.struct(level.alias("level"), *[F.floor(at[a] / _width(level)).alias(a) for a in "xyz"])


def _boxes_within(at: Column, radius: Column, level: Column) -> Column:
    """All boxes of a level that come within ``radius`` of a point."""
    w = _width(level)
    span = {a: F.sequence(F.floor((at[a] - radius) / w), F.floor((at[a] + radius) / w)) for a in "xyz"}

    def apart(i, a):
        return F.greatest(i * w - at[a], at[a] - (i + 1) * w, F.lit(0.0))

    every = F.flatten(F.transform(span["x"], lambda i: F.flatten(F.transform(span["y"], lambda j: F.transform(
        span["z"], lambda k: F.struct(level.alias("level"), i.alias("x"), j.alias("y"), k.alias("z")))))))
    gap = lambda b: sum((F.pow(apart(b[a], a), 2) for a in "xyz"), F.lit(0.0))
    return F.filter(every, lambda b: gap(b) <= F.pow(radius + 1e-12, 2))


def _widest(df: DataFrame, radius: str) -> dict[int, float]:
    """Largest radius per level; at most ``FINEST_BOX`` + 1 rows."""
    return {r["level"]: r["r"] for r in df.groupBy("level").agg(F.max(radius).alias("r")).collect()}


def _met(big: DataFrame, small: DataFrame, radius: str, widths: dict[int, float], levels: dict[int, float], equal: bool) -> tuple[DataFrame, DataFrame]:
    """(boxes that each of ``big`` covers at its own level, boxes in which each of ``small`` lies at every coarser level of ``big``).

    ``widths`` are the largest radii of ``small`` by level, ``levels`` those of ``big``; with ``equal`` a level meets itself.
    """
    other = {k: max((r for m, r in widths.items() if m > k or equal and m == k), default=None) for k in levels}
    reach = F.create_map(*[F.lit(x) for k, r in other.items() if r is not None for x in (k, float(r))]) if any(r is not None for r in other.values()) else None
    if reach is None:
        covers = big.where("false").withColumn("box", _box(F.col("at"), F.col("level")))
    else:
        covers = big.withColumn("_r", F.col(radius) + reach[F.col("level")]).where("_r IS NOT NULL")
        covers = covers.withColumn("box", F.explode(_boxes_within(F.col("at"), F.col("_r"), F.col("level")))).drop("_r")
    above = F.filter(F.array(*[F.lit(k) for k in sorted(levels)]).cast("array<int>"), lambda k: (k <= F.col("level")) if equal else (k < F.col("level")))
    inside = small.withColumn("box", F.explode(F.transform(above, lambda k: _box(F.col("at"), k))))
    return covers, inside


def _keyed(boxed: DataFrame) -> DataFrame:
    return boxed.select("*", *[F.col(f"box.{k}").alias(f"b_{k}") for k in ("level", "x", "y", "z")]).drop("box", "at", "level")


def overlap_boxes(cells: DataFrame, pixels: DataFrame) -> list[tuple[DataFrame, DataFrame]]:
    """Two pairs of tables that meet by ``box``: cells that are as coarse as the pixels or coarser, covering boxes, with the pixels
    in them; and pixels that are coarser, covering, with the cells in them.

    A box belongs to a hierarchy of cubes around the sphere. Each shape has the level of its own radius, covers the few boxes of that level
    it can meet a finer shape in, and lies in one box of every coarser level in use. So a pair meets once, and one
    coarse cell adds a few boxes of its own level and leaves the loads of all others as they are.
    """
    cells, pixels = (df.withColumn("level", _box_level(F.col(r))) for df, r in ((cells, "reach"), (pixels, "half")))
    of_cells, of_pixels = _widest(cells, "reach"), _widest(pixels, "half")
    return [_met(cells, pixels, "reach", of_pixels, of_cells, True), _met(pixels, cells, "half", of_cells, of_pixels, False)]


def overlap_pairs(cells: DataFrame, pixels: DataFrame, min_area: float = 1.0) -> tuple[DataFrame, DataFrame]:
    """(pairs of cell and pixel whose overlap exceeds ``min_area`` m2, pairs that need inspection).

    cells(cell_id, lat, lon, corner_lat, corner_lon; radians), pixels(iy, ix, lat_lo, lat_hi, lon_lo,
    lon_hi; degrees). A cell reaches as far as its own furthest corner, a pixel half its widths; candidates meet in
    :func:`overlap_boxes`. They are settled by the clipped area in a projection about the cell where great circles are straight; the
    threshold must give one answer at both densifications, else the pair goes to the second output.
    """
    reach = F.array_max(F.zip_with("corner_lat", "corner_lon", lambda a, b: _angle_to(a, b, F.col("lat"), F.col("lon"))))
    c = cells.withColumn("reach", reach + 1e-8).withColumn("at", unit_xyz(F.col("lat"), F.col("lon")))
    half = F.radians((F.col("lon_hi") - F.col("lon_lo") + F.col("lat_hi") - F.col("lat_lo")) / 2.0)
    p = pixels.withColumn("plat", F.radians((F.col("lat_lo") + F.col("lat_hi")) / 2.0)).withColumn(
        "plon", F.radians((F.col("lon_lo") + F.col("lon_hi")) / 2.0)).withColumn("half", half)
    p = p.withColumn("at", unit_xyz(F.col("plat"), F.col("plon")))
    close = _angle_to(F.col("plat"), F.col("plon"), F.col("lat"), F.col("lon")) <= F.col("reach") + F.col("half")
    cand = None
    for covers, inside in overlap_boxes(settle(c), settle(p)):
        met = salted_join(settle(_keyed(inside)), _keyed(covers), ["b_level", "b_x", "b_y", "b_z"])
        met = met.filter(close).select("cell_id", "iy", "ix", "lat", "lon", "corner_lat", "corner_lon", "lat_lo", "lat_hi", "lon_lo", "lon_hi")
        cand = met if cand is None else cand.unionByName(met)
    area = cand.mapInPandas(_overlap_batches, "cell_id bigint, iy int, ix int, area_coarse double, area_fine double")
    above = [F.coalesce(F.col(n) > min_area, F.lit(False)) for n in ("area_coarse", "area_fine")]
    unsure = (above[0] != above[1]) | F.isnan("area_fine")
    area = settle(area)  # read by both outputs
    return area.filter(~unsure & above[1]).select("cell_id", "iy", "ix", "area_fine"), area.filter(unsure)


def _angle_to(lat_a, lon_a, lat_b, lon_b) -> Column:
    a, b = unit_xyz(lat_a, lon_a), unit_xyz(lat_b, lon_b)
    d = chord2(a["x"], a["y"], a["z"], b["x"], b["y"], b["z"])
    return F.asin(F.least(F.sqrt(d) / 2.0, F.lit(1.0))) * 2.0


def eligible_cells(fire_size: DataFrame, target: DataFrame, scope: list[int] | None = None) -> DataFrame:
    """(day, cell_id) with fire size exactly 0 and any positive target emission that day."""
    positive = target.groupBy("day", "cell_id").agg(F.max("value").alias("top")).filter("top > 0")
    zero = fire_size.filter(F.col("value") == 0).select("day", "cell_id")
    out = zero.join(positive.select("day", "cell_id"), ["day", "cell_id"], "left_semi")
    return out if scope is None else out.filter(F.col("cell_id").isin(scope))


def emitting_records(fires: DataFrame, flux: DataFrame) -> DataFrame:
    """Fires (day, iy, ix, area, ...) with area > 0 in pixels whose flux is finite and positive."""
    lit = flux.filter(is_finite(F.col("flux")) & (F.col("flux") > 0)).select("day", "iy", "ix")
    return salted_join(fires.filter("area > 0"), lit, ["day", "iy", "ix"], "left_semi")


def footprint_support(eligible: DataFrame, matches: DataFrame, records: DataFrame, fire_size: DataFrame,
                      veg: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(fire size, vegetation) with support written into eligible cells that overlap emitting pixels.

    matches(cell_id, iy, ix), records(day, record_id, iy, ix, genveg, area). Each record counts once per
    receiving cell; cells whose category stays 0 and all other cells keep their values.
    """
    receiving = matches.select("cell_id", "iy", "ix").join(eligible, "cell_id")
    hits = salted_join(records, receiving, ["day", "iy", "ix"]).select(
        "day", "cell_id", "record_id", "genveg", "area").dropDuplicates(["day", "cell_id", "record_id"])
    found = dominant_category(hits, ["day", "cell_id"]).filter("category > 0")
    size = fire_size.join(found.select("day", "cell_id", "mean_area"), ["day", "cell_id"], "left").select(
        "day", "cell_id", F.coalesce("mean_area", "value").alias("value"))
    new = found.select("day", "cell_id", *[F.col(c).alias(f"_{c}") for c in ("category", "share", "known_frac", "n_records")])
    out = veg.join(new, ["day", "cell_id"], "left").select(
        "day", "cell_id", *[F.coalesce(f"_{c}", c).alias(c) for c in ("category", "share", "known_frac", "n_records")])
    return size, out
