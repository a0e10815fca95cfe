"""Delaunay triangulations of many sets of integer points at once, by incremental insertion with exact tests."""

from __future__ import annotations

import numpy as np


def _turn(a: np.ndarray, b: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Positive where a, b, c turn left."""
    return (b[..., 0] - a[..., 0]) * (c[..., 1] - a[..., 1]) - (b[..., 1] - a[..., 1]) * (c[..., 0] - a[..., 0])


def in_circle(a: np.ndarray, b: np.ndarray, c: np.ndarray, p: np.ndarray) -> np.ndarray:
    """Positive where p is inside the circle of the left-turning a, b, c; 0 on it. Exact for coordinates below about 10^4."""
    a, b, c = a - p, b - p, c - p
    sa, sb, sc = ((x * x).sum(-1) for x in (a, b, c))
    return a[..., 0] * (b[..., 1] * sc - c[..., 1] * sb) - a[..., 1] * (b[..., 0] * sc - c[..., 0] * sb) + sa * (b[..., 0] * c[..., 1] - c[..., 0] * b[..., 1])


def inside(p: np.ndarray, a: np.ndarray, b: np.ndarray, c: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Whether points q are inside the circles of left-turning a, b, c, given by index. On the circle it counts how the points would
    be lifted by ever smaller steps in their order: the first of the four decides."""
    side = in_circle(p[a], p[b], p[c], p[q])
    found, on = side > 0, np.flatnonzero(side == 0)
    if len(on):
        a, b, c, q = a[on], b[on], c[on], q[on]
        first = np.minimum(np.minimum(a, b), np.minimum(c, q))
        tie = np.where(first == a, _turn(p[q], p[b], p[c]), np.where(first == b, _turn(p[q], p[c], p[a]), np.where(first == c, _turn(p[q], p[a], p[b]), -1)))
        found[on] = tie > 0
    return found


def triangulate(points: np.ndarray, starts: np.ndarray | None = None) -> np.ndarray:
    """Triangles (m, 3) of indices into integer points; one set for each order of the points (see `inside`).

    starts: where each set of points begins, and the end of the last (None: one set). Points of a set are distinct. Fewer than
    three points, or all on a line, have no triangles. All sets get their next point in one step, so that a step's work is one
    for all of them. Outside the hull each edge has a triangle with the point at infinity, index -1.
    """
    p = np.asarray(points, np.int64).reshape(-1, 2)
    starts = np.array([0, len(p)]) if starts is None else np.asarray(starts, np.int64)
    turns, order = _insertion_order(p, starts)
    sizes = np.diff(starts)
    live = np.flatnonzero(turns != 0)
    a, b, c = (order[starts[live] + x] for x in range(3))
    a, b = np.where(turns[live] > 0, a, b), np.where(turns[live] > 0, b, a)
    out = np.full(len(live), -1)
    tri = np.stack([a, b, c, b, a, out, c, b, out, a, c, out], 1).reshape(-1, 3)
    own, step, done = np.repeat(live, 4), 3, []
    while len(tri):
        full = sizes[own] <= step
        if full.any():
            done.append(tri[full])
            tri, own = tri[~full], own[~full]
        tri, own = _insert(p, tri, own, order[np.minimum(starts[:-1] + step, len(p) - 1)])
        step += 1
    tri = np.concatenate(done) if done else np.zeros((0, 3), np.int64)
    return tri[tri[:, 2] >= 0]


def _insertion_order(p: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each set how its first two points and the first that is not on their line turn (0: there is none), and all indices with
    that point moved to the third place."""
    turns, order = np.zeros(len(starts) - 1, np.int64), np.arange(len(p))
    for s in np.flatnonzero(np.diff(starts) >= 3):
        lo, hi = starts[s], starts[s + 1]
        turn = _turn(p[lo], p[lo + 1], p[lo + 2 : hi])
        third = int((turn != 0).argmax())
        turns[s] = turn[third]
        order[lo + 2 : lo + 3 + third] = np.roll(order[lo + 2 : lo + 3 + third], 1)
    return turns, order


def _insert(p: np.ndarray, tri: np.ndarray, own: np.ndarray, new: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Triangles and their sets after point new[s] came into each set s that has triangles here."""
    k, ghost = new[own], tri[:, 2] < 0
    bad = np.zeros(len(tri), bool)
    real = tri[~ghost]
    bad[~ghost] = inside(p, real[:, 0], real[:, 1], real[:, 2], k[~ghost])
    u, v, q = p[tri[ghost, 0]], p[tri[ghost, 1]], p[k[ghost]]
    side = _turn(u, v, q)
    between = ((q - u) * (q - v)).sum(1) < 0
    bad[ghost] = (side > 0) | (side == 0) & between
    gone, sets = tri[bad], np.tile(own[bad], 3)
    edges = np.concatenate([gone[:, [0, 1]], gone[:, [1, 2]], gone[:, [2, 0]]])
    n = len(p) + 1
    code, back = (edges[:, 0] + 1) * n + edges[:, 1] + 1, (edges[:, 1] + 1) * n + edges[:, 0] + 1
    rim = ~np.isin(code, back)
    edges, sets = edges[rim], sets[rim]
    more = np.column_stack([edges, new[sets]])
    at0, at1 = edges[:, 0] < 0, edges[:, 1] < 0
    more[at0] = more[at0][:, [1, 2, 0]]
    more[at1] = more[at1][:, [2, 0, 1]]
    return np.concatenate([tri[~bad], more]), np.concatenate([own[~bad], sets])
