"""Contours of masks at level 0.5, polygon filling and mask resizing."""

from __future__ import annotations

import numpy as np

# Marching squares: for each code of a 2x2 quad (1 upper left, 2 upper right, 4 lower right, 8 lower left) the sides that its
# contour pieces join, set pixels to the left. Diagonal set pixels are apart.
_PIECES = {
    1: ["LT"], 2: ["TR"], 3: ["LR"], 4: ["RB"], 5: ["LT", "RB"], 6: ["TB"], 7: ["LB"], 8: ["BL"], 9: ["BT"], 10: ["TR", "BL"], 11: ["BR"], 12: ["RL"], 13: ["RT"], 14: ["TL"],
}
_SIDES = {"T": (0.0, 0.5), "R": (0.5, 1.0), "B": (1.0, 0.5), "L": (0.5, 0.0)}


def contours(mask: np.ndarray) -> list[np.ndarray]:
    """Closed polygons (row, col) around set pixels, cut to the pixel grid's centres [0, h-1] x [0, w-1]."""
    h, w = mask.shape
    m = np.pad(np.asarray(mask, np.int64), 1)
    code = m[:-1, :-1] + 2 * m[:-1, 1:] + 4 * m[1:, 1:] + 8 * m[1:, :-1]
    after: dict[tuple[float, float], tuple[float, float]] = {}
    for r, c in zip(*np.nonzero((code > 0) & (code < 15)), strict=True):
        for a, b in _PIECES[int(code[r, c])]:
            after[(r + _SIDES[a][0], c + _SIDES[a][1])] = (r + _SIDES[b][0], c + _SIDES[b][1])
    out = []
    while after:
        start = at = min(after)
        ring = [at]
        while (at := after.pop(at)) != start:
            ring.append(at)
        ring = np.array([*ring, start]) - 1
        out.append(np.stack([np.clip(ring[:, 0], 0, h - 1), np.clip(ring[:, 1], 0, w - 1)], 1))
    return out


def area(polygon: np.ndarray) -> float:
    y, x = polygon[:, 0], polygon[:, 1]
    return abs(float((x * np.roll(y, -1) - np.roll(x, -1) * y).sum())) / 2


def fill_polygon(polygon: np.ndarray, h: int, w: int) -> np.ndarray:
    """Pixels whose centres are inside by the even-odd rule or on the border; polygon rows are (x, y)."""
    x, y = np.asarray(polygon, float).T
    x2, y2 = np.roll(x, -1), np.roll(y, -1)
    gy, gx = np.mgrid[0:h, 0:w].astype(float)
    inside, border = np.zeros((h, w), bool), np.zeros((h, w), bool)
    for a, b, c, d in zip(x, y, x2, y2, strict=True):
        if b != d:
            crossing = (b > gy) != (d > gy)
            inside ^= crossing & (gx < (c - a) * (gy - b) / (d - b) + a)
        on = np.abs((c - a) * (gy - b) - (d - b) * (gx - a)) < 1e-9
        border |= on & (gx >= min(a, c)) & (gx <= max(a, c)) & (gy >= min(b, d)) & (gy <= max(b, d))
    return inside | border


def resize(soft: np.ndarray, h: int, w: int) -> np.ndarray:
    """Bilinear resize with half-pixel centres and repeated borders."""

    def at(n: int, m: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        s = np.clip((np.arange(n) + 0.5) * m / n - 0.5, 0, m - 1)
        lo = np.floor(s).astype(int)
        return lo, np.minimum(lo + 1, m - 1), s - lo

    r0, r1, fr = at(h, soft.shape[0])
    c0, c1, fc = at(w, soft.shape[1])
    top = soft[r0][:, c0] * (1 - fc) + soft[r0][:, c1] * fc
    low = soft[r1][:, c0] * (1 - fc) + soft[r1][:, c1] * fc
    return top * (1 - fr[:, None]) + low * fr[:, None]
