"""Clipped areas of a whole batch against areas found by counting points."""
import numpy as np
import pytest

from gridspark.operators.vegetation import clipped_areas


def counted(ring, cell, n=400):
    """Area of the part of a box ring inside a convex cell, by a fine lattice of points."""
    lo, hi = ring.min(axis=0), ring.max(axis=0)
    x, y = np.meshgrid(*[np.linspace(a, b, n, endpoint=False) + (b - a) / n / 2 for a, b in zip(lo, hi, strict=True)])
    inside = np.ones_like(x, bool)
    sign = np.sign(sum(a[0] * b[1] - b[0] * a[1] for a, b in zip(cell, np.roll(cell, -1, axis=0), strict=True)))
    for a, b in zip(cell, np.roll(cell, -1, axis=0), strict=True):
        inside &= ((b[0] - a[0]) * (y - a[1]) - (b[1] - a[1]) * (x - a[0])) * sign >= 0
    return inside.mean() * (hi - lo).prod()


@pytest.mark.parametrize("turn", [1, -1])
def test_batch_of_pairs(turn):
    rng = np.random.default_rng(3)
    rings, cells = [], []
    for _ in range(40):
        a, b = rng.uniform(-2, 1, 2), rng.uniform(0.3, 3, 2)
        box = [(a[0] + b[0] * t, a[1]) for t in np.linspace(0, 1, 5)] + [(a[0] + b[0] * t, a[1] + b[1]) for t in np.linspace(1, 0, 5)]
        corners = np.sort(rng.uniform(0, 2 * np.pi, 5))[::turn]
        cell = [(1.5 * np.cos(t), 1.5 * np.sin(t)) for t in corners]
        rings.append(box)
        cells.append([*cell, cell[-1]])  # padded
    got = clipped_areas(np.array(rings), np.array(cells))
    want = [counted(np.array(r), np.array(c)[:-1]) for r, c in zip(rings, cells, strict=True)]
    assert np.allclose(got, want, atol=0.02)
    assert (got == 0).any() or min(want) > 0
