"""Observation error models, bands and channel lists."""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Named latitude bands (name, min, max) in degrees.
BANDS_7 = [("SPol", -90.0, -60.0), ("SMid", -60.0, -30.0), ("STro", -30.0, -5.0), ("ITCZ", -5.0, 5.0),
           ("NTro", 5.0, 30.0), ("NMid", 30.0, 60.0), ("NPol", 60.0, 90.0)]
BANDS_3 = [("SXTro", -90.0, -30.0), ("Tro", -30.0, 30.0), ("NXTro", 30.0, 90.0)]


def parse_channels(text: str) -> list[int]:
    """Channel ids of an expression such as ``1-6, 15``."""
    out: list[int] = []
    for part in text.replace(" ", "").split(","):
        if part:
            lo, _, hi = part.partition("-")
            out.extend(range(int(lo), int(hi or lo) + 1))
    return out


def error_ramp(x: Column, x0, x1, err0, err1) -> Column:
    """``err0`` up to ``x0``, linear to ``err1`` at ``x1``, ``err1`` above."""
    x0, x1, err0, err1 = (F.lit(v) if not isinstance(v, Column) else v for v in (x0, x1, err0, err1))
    share = F.least(F.greatest((x - x0) / (x1 - x0), F.lit(0.0)), F.lit(1.0))
    return F.when(x.isNotNull(), err0 + share * (err1 - err0))


def error_stepwise(x: Column, xvals: list[float], errors: list[float], scale: Column | None = None) -> Column:
    """Piecewise linear over (xvals, errors), flat outside, either order of xvals; optional multiplier."""
    if len(xvals) != len(errors) or len(xvals) < 2:
        raise ValueError("xvals and errors need the same length of at least two")
    pairs = sorted(zip(xvals, errors))
    out = F.when(x <= pairs[0][0], F.lit(float(pairs[0][1])))
    for (xa, ea), (xb, eb) in zip(pairs, pairs[1:]):
        out = out.when(x <= xb, F.lit(float(ea)) + (x - F.lit(float(xa))) * F.lit((eb - ea) / (xb - xa)))
    out = out.when(x.isNotNull(), F.lit(float(pairs[-1][1])))
    return out if scale is None else out * scale


def latitude_band(lat_deg: Column, bands=BANDS_7) -> Column:
    """Band name with ``min <= lat < max``; the top band includes its upper edge."""
    top = max(hi for _, _, hi in bands)
    expr = None
    for name, lo, hi in bands:
        inside = (lat_deg >= lo) & ((lat_deg <= hi) if hi == top else (lat_deg < hi))
        expr = F.when(inside, name) if expr is None else expr.when(inside, name)
    return expr
