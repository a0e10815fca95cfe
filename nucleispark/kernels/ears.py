"""Triangles of a simple polygon."""

from __future__ import annotations

import numpy as np


def _turn(a: np.ndarray, b: np.ndarray, c: np.ndarray) -> np.ndarray:
    return (b[..., 0] - a[..., 0]) * (c[..., 1] - a[..., 1]) - (b[..., 1] - a[..., 1]) * (c[..., 0] - a[..., 0])


def triangles(polygon: np.ndarray) -> np.ndarray:
    """(n, 3, 2): ears cut off one by one, the ear at the first vertex that has one; corners on a straight line go without a triangle.

    A repeated last corner is dropped. Polygons that cross themselves have no such triangles: ValueError.
    """
    p = np.asarray(polygon, float).reshape(-1, 2)
    p = p[np.append((p[1:] != p[:-1]).any(axis=1), True)] if len(p) else p
    if len(p) > 1 and (p[0] == p[-1]).all():
        p = p[:-1]
    if len(p) < 3:
        return np.zeros((0, 3, 2))
    if _turn(p[:1], p, np.roll(p, -1, axis=0)).sum() < 0:
        p = p[::-1]
    left, out, i, since = list(range(len(p))), [], 0, 0
    while len(left) > 2:
        if since > len(left):
            raise ValueError("the polygon crosses itself")
        i %= len(left)
        a, b, c = p[left[i - 1]], p[left[i]], p[left[(i + 1) % len(left)]]
        turn = _turn(a, b, c)
        ear = turn > 0
        if ear and len(left) > 3:
            q = p[[x for x in left if x not in (left[i - 1], left[i], left[(i + 1) % len(left)])]]
            q = q[~((q == a).all(1) | (q == b).all(1) | (q == c).all(1))]
            ear = not ((_turn(a, b, q) >= 0) & (_turn(b, c, q) >= 0) & (_turn(c, a, q) >= 0)).any()
        if ear or turn == 0:
            if ear:
                out.append((a, b, c))
            del left[i]
            since = 0
        else:
            i, since = i + 1, since + 1
    return np.array(out).reshape(-1, 3, 2)
