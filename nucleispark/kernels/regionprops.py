"""Properties of one binary mask."""

from __future__ import annotations

from math import atan2, pi, sqrt

import numpy as np

from nucleispark.kernels.components import fill_holes

NAMES = ("area", "convex_area", "eccentricity", "extent", "filled_area", "major_axis_length", "minor_axis_length", "orientation", "perimeter", "solidity", "pa_ratio")


def _axes(mask: np.ndarray) -> tuple[float, float, float, float]:
    """Major and minor axis, eccentricity and orientation of the ellipse with the same second moments, pixels being unit squares."""
    y, x = np.nonzero(mask)
    y, x = y - y.mean(), x - x.mean()
    a, b, c = (y * y).mean() + 1 / 12, (x * x).mean() + 1 / 12, (x * y).mean()
    half = sqrt(((a - b) / 2) ** 2 + c * c)
    big, small = (a + b) / 2 + half, max((a + b) / 2 - half, 0.0)
    if abs(a - b) < 1e-12:
        angle = 0.0 if abs(c) < 1e-12 else (pi / 4 if c > 0 else -pi / 4)
    else:
        angle = 0.5 * atan2(2 * c, a - b)
    return 4 * sqrt(big), 4 * sqrt(small), sqrt(1 - small / big) if big else 0.0, angle


def perimeter(mask: np.ndarray) -> float:
    """Length along border pixels: straight steps 1, diagonal ones the square root of 2, corners half of both."""
    m = np.pad(np.asarray(mask, bool), 1)
    inner = m[1:-1, 1:-1] & m[:-2, 1:-1] & m[2:, 1:-1] & m[1:-1, :-2] & m[1:-1, 2:]
    edge = np.pad(m[1:-1, 1:-1] & ~inner, 1).astype(int)
    near = edge[:-2, 1:-1] + edge[2:, 1:-1] + edge[1:-1, :-2] + edge[1:-1, 2:]
    across = edge[:-2, :-2] + edge[:-2, 2:] + edge[2:, :-2] + edge[2:, 2:]
    at = edge[1:-1, 1:-1] > 0
    code = 1 + 2 * near[at] + 10 * across[at]
    # Fixed weights by that code.
    weight = {5: 1.0, 7: 1.0, 15: 1.0, 17: 1.0, 25: 1.0, 27: 1.0, 21: sqrt(2), 33: sqrt(2), 13: (1 + sqrt(2)) / 2, 23: (1 + sqrt(2)) / 2}
    return float(sum(weight.get(int(k), 0.0) * n for k, n in zip(*np.unique(code, return_counts=True), strict=True)))


def convex_area(mask: np.ndarray) -> int:
    """Pixels whose centres lie in the hull of the middles of the set pixels' sides."""
    y, x = np.nonzero(mask)
    pts = np.unique(np.concatenate([np.stack([2 * y + a, 2 * x + b], 1) for a, b in ((1, 0), (-1, 0), (0, 1), (0, -1))]), axis=0)

    def half(points: np.ndarray) -> list[np.ndarray]:
        chain: list[np.ndarray] = []
        for p in points:
            while len(chain) > 1 and (chain[-1][0] - chain[-2][0]) * (p[1] - chain[-2][1]) - (chain[-1][1] - chain[-2][1]) * (p[0] - chain[-2][0]) <= 0:
                chain.pop()
            chain.append(p)
        return chain[:-1]

    hull = np.array(half(pts) + half(pts[::-1]))
    gy, gx = np.mgrid[0 : mask.shape[0], 0 : mask.shape[1]] * 2
    inside = np.ones(mask.shape, bool)
    for a, b in zip(hull, np.roll(hull, -1, axis=0), strict=True):
        inside &= (b[0] - a[0]) * (gx - a[1]) - (b[1] - a[1]) * (gy - a[0]) >= 0
    return int(inside.sum())


def region_properties(mask: np.ndarray) -> dict[str, float | None]:
    """All of NAMES; each None for an empty mask."""
    mask = np.asarray(mask, bool)
    area = int(mask.sum())
    if not area:
        return dict.fromkeys(NAMES)
    major, minor, eccentricity, orientation = _axes(mask)
    hull, filled, length = convex_area(mask), int(fill_holes(mask).sum()), perimeter(mask)
    return {
        "area": float(area), "convex_area": float(hull), "eccentricity": eccentricity, "extent": area / mask.size, "filled_area": float(filled), "major_axis_length": major,
        "minor_axis_length": minor, "orientation": orientation, "perimeter": length, "solidity": area / hull, "pa_ratio": length**2 / filled,
    }
