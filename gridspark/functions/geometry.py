"""Spherical geometry as Column expressions. Angles are radians unless a name says degrees."""
from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# Default sphere radius (m) and the coordinate quantum (degrees).
SPHERE_RADIUS_M = 6371229.0
COORD_QUANTUM_DEG = 1.0e-4
GLOBAL_AREA_TOLERANCE = 5.0e-4
POLYGON_TOLERANCE = 1.0e-12


def unit_xyz(lat: Column, lon: Column) -> Column:
    """Struct (x, y, z) on the unit sphere."""
    return F.struct(
        (F.cos(lat) * F.cos(lon)).alias("x"),
        (F.cos(lat) * F.sin(lon)).alias("y"),
        F.sin(lat).alias("z"),
    )


def chord2(ax, ay, az, bx, by, bz) -> Column:
    """Squared straight-line distance between two points of the unit sphere."""
    dx, dy, dz = ax - bx, ay - by, az - bz
    return dx * dx + dy * dy + dz * dz


def chord_to_angle(chord: Column) -> Column:
    """Great-circle angle of a chord."""
    half = F.greatest(F.lit(0.0), F.least(F.lit(1.0), chord / 2.0))
    return F.asin(half) * 2.0


def local_hour_offset(lon_deg: Column) -> Column:
    """Local solar hour offset 0..23; half-even rounding of longitude / 15."""
    return F.pmod(F.rint(lon_deg / 15.0).cast("int"), F.lit(24))


def band_area_sr(lat_lo_deg: Column, lat_hi_deg: Column, dlon_deg: Column) -> Column:
    """Area in steradian of a latitude/longitude cell."""
    return (F.sin(F.radians(lat_hi_deg)) - F.sin(F.radians(lat_lo_deg))) * F.radians(dlon_deg)


def quantum_index(coord_deg: Column, quantum: float = COORD_QUANTUM_DEG) -> Column:
    """Integer number of quanta, half-even, so encoding noise below a quantum vanishes."""
    return F.rint(coord_deg / F.lit(quantum)).cast("bigint")


def quantize(coord_deg: Column, quantum: float = COORD_QUANTUM_DEG) -> Column:
    """Coordinate snapped to the quantum."""
    return F.rint(coord_deg / F.lit(quantum)) * F.lit(quantum)


def wrap_2pi(lon: Column) -> Column:
    """Longitude in [0, 2 pi)."""
    return F.pmod(lon, F.lit(2.0 * math.pi))


def wrap_from(lon_deg: Column, west_deg: Column) -> Column:
    """Longitude in [west, west + 360)."""
    return F.pmod(lon_deg - west_deg, F.lit(360.0)) + west_deg


def valid_vertices(ids: Column, n_edges: Column, n_vertices: Column) -> Column:
    """Zero-based vertex ids of the first ``n_edges`` entries, invalid ones removed."""
    used = F.slice(ids, F.lit(1), n_edges)
    return F.transform(F.filter(used, lambda v: (v > 0) & (v <= n_vertices)), lambda v: v - 1)


def pad_with_last(values: Column, width: Column) -> Column:
    """Repeat the last element until the array has ``width`` elements."""
    missing = F.greatest(width - F.size(values), F.lit(0)).cast("int")
    return F.concat(values, F.array_repeat(F.element_at(values, -1), missing))


def inside_polygon(lat: Column, lon: Column, corner_lat: Column, corner_lon: Column,
                   centre_lat: Column, centre_lon: Column, tolerance: float = POLYGON_TOLERANCE) -> Column:
    """Point in convex spherical polygon, whichever way its corners run; False below three corners."""
    verts = F.zip_with(corner_lat, corner_lon, lambda a, b: unit_xyz(a, b))
    nxt = F.concat(F.slice(verts, F.lit(2), F.greatest(F.size(verts) - 1, F.lit(0))), F.slice(verts, 1, 1))
    p, c = unit_xyz(lat, lon), unit_xyz(centre_lat, centre_lon)

    def on_inner_side(a, b):
        nx = a.y * b.z - a.z * b.y
        ny = a.z * b.x - a.x * b.z
        nz = a.x * b.y - a.y * b.x
        to_centre = nx * c.x + ny * c.y + nz * c.z
        to_point = nx * p.x + ny * p.y + nz * p.z
        return F.when(to_centre >= 0, to_point).otherwise(-to_point) >= F.lit(-tolerance)

    ok = F.forall(F.zip_with(verts, nxt, on_inner_side), lambda b: b)
    return F.coalesce((F.size(verts) >= 3) & ok, F.lit(False))
