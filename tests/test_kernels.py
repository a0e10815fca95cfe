"""Geometry helpers against brute force and known values."""

from __future__ import annotations

from collections import Counter
from itertools import combinations
from math import pi, sqrt

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from nucleispark.kernels import components, contour, conv, delaunay, regionprops

masks = st.integers(0, 2**32).map(lambda s: np.random.default_rng(s).random((9, 11)) < np.random.default_rng(s + 1).uniform(0.2, 0.8))


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 300), st.integers(0, 300)), unique=True, min_size=0, max_size=40))
def test_delaunay_circles_are_empty(points):
    p = np.array(sorted(points), np.int64).reshape(-1, 2)
    tri = delaunay.triangulate(p)
    for t in tri:
        a, b, c = p[t]
        assert delaunay._turn(a, b, c) > 0
        rest = np.delete(p, t, axis=0)
        assert not (delaunay.in_circle(a, b, c, rest) > 0).any()
    edges = Counter(frozenset(e) for t in tri.tolist() for e in ((t[0], t[1]), (t[1], t[2]), (t[2], t[0])))
    assert all(n <= 2 for n in edges.values())
    if len(tri):
        hull = sum(n == 1 for n in edges.values())
        assert len(tri) == 2 * len(p) - 2 - hull


def test_delaunay_special_cases():
    square = np.array([[0, 0], [0, 10], [10, 0], [10, 10]])
    assert len(delaunay.triangulate(square)) == 2
    line = np.stack([np.arange(5), 2 * np.arange(5)], 1)
    assert len(delaunay.triangulate(line)) == 0
    assert len(delaunay.triangulate(np.zeros((0, 2)))) == 0


def all_triples(p: np.ndarray) -> set[frozenset[int]]:
    """The triangles whose circles hold no point, by trying all."""
    found = set()
    for a, b, c in combinations(range(len(p)), 3):
        turn = delaunay._turn(p[a], p[b], p[c])
        if turn:
            b, c = (b, c) if turn > 0 else (c, b)
            rest = np.array([k for k in range(len(p)) if k not in (a, b, c)], np.int64)
            if not len(rest) or not delaunay.inside(p, *(np.full(len(rest), x) for x in (a, b, c)), rest).any():
                found.add(frozenset((a, b, c)))
    return found


@settings(max_examples=100, deadline=None)
@given(st.lists(st.lists(st.tuples(st.integers(0, 4), st.integers(0, 4)), unique=True, max_size=14), max_size=4))
def test_insertion_into_many_sets_agrees_with_all_triples_on_points_of_one_circle(sets):
    sets = [np.array(sorted(s), np.int64).reshape(-1, 2) for s in sets]
    starts = np.cumsum([0] + [len(s) for s in sets])
    tri = delaunay.triangulate(np.concatenate([np.zeros((0, 2), np.int64), *sets]), starts)
    assert sum(len(all_triples(s)) for s in sets) == len(tri)
    for s, lo, hi in zip(sets, starts[:-1], starts[1:], strict=True):
        assert {frozenset(t) for t in (tri[(tri[:, 0] >= lo) & (tri[:, 0] < hi)] - lo).tolist()} == all_triples(s)


@settings(max_examples=60, deadline=None)
@given(masks)
def test_contours_enclose_what_quads_say(mask):
    m = components.fill_holes(mask)
    q = m[:-1, :-1].astype(int) + m[1:, :-1] + m[:-1, 1:] + m[1:, 1:]
    across = (m[:-1, :-1] == m[1:, 1:]) & (q == 2)
    wanted = (q == 1).sum() / 8 + ((q == 2) & ~across).sum() / 2 + across.sum() / 4 + (q == 3).sum() * 7 / 8 + (q == 4).sum()
    assert sum(contour.area(r) for r in contour.contours(m)) == pytest.approx(wanted)


def flood(mask: np.ndarray, diagonal: bool) -> int:
    todo, n = {tuple(x) for x in np.argwhere(mask)}, 0
    near = [(a, b) for a in (-1, 0, 1) for b in (-1, 0, 1) if diagonal or abs(a) + abs(b) == 1]
    while todo:
        n, front = n + 1, [todo.pop()]
        while front:
            r, c = front.pop()
            for a, b in near:
                if (r + a, c + b) in todo:
                    todo.remove((r + a, c + b))
                    front.append((r + a, c + b))
    return n


@settings(max_examples=60, deadline=None)
@given(masks, st.booleans())
def test_components_are_those_of_flooding(mask, diagonal):
    numbers, n = components.label(mask, diagonal)
    assert n == flood(mask, diagonal) and ((numbers > 0) == mask).all()


def test_holes_and_small_parts():
    ring = np.pad(np.ones((3, 3), bool), 1)
    ring[2, 2] = False
    assert components.fill_holes(ring).sum() == 9
    two = np.zeros((5, 5), bool)
    two[0, 0] = two[2, 2] = two[2, 3] = True
    assert components.remove_small(two, 2).sum() == 2


def test_correlation_and_blur_against_plain_loops():
    rng = np.random.default_rng(3)
    image, kernel = rng.random((9, 12)) * (rng.random((9, 12)) < 0.4), rng.random((5, 5))
    want = np.zeros_like(image)
    for i in range(9):
        for j in range(12):
            want[i, j] = sum(kernel[a + 2, b + 2] * image[i + a, j + b] for a in range(-2, 3) for b in range(-2, 3) if 0 <= i + a < 9 and 0 <= j + b < 12)
    assert np.allclose(conv.correlate(image, kernel), want)
    x, sigma = rng.random(11), 1.7
    taps = [np.exp(-0.5 * (k / sigma) ** 2) for k in range(-7, 8)]
    wide = np.concatenate([x[::-1], x, x[::-1]])
    assert np.allclose(conv.gaussian_weights(11, sigma) @ x, [sum(t * wide[11 + i + k] for t, k in zip(taps, range(-7, 8), strict=True)) / sum(taps) for i in range(11)])


def test_correlation_is_linear_and_keeps_mass_inside():
    kernel = conv.density_kernel(16, 1 / 32)
    image = np.zeros((80, 80))
    image[40, 40] = 2
    out = conv.correlate(image, kernel)
    assert out.sum() == pytest.approx(2 * kernel.sum())
    assert np.allclose(conv.correlate(3 * image, kernel), 3 * out)
    assert conv.density_kernel(None, 1 / 32) is None and conv.density_kernel(1.0, 1 / 32) is None
    assert kernel.shape == (17, 17)


def test_region_properties_of_a_rectangle_and_a_disk():
    box = regionprops.region_properties(np.ones((4, 6), bool))
    assert box["area"] == 24 and box["extent"] == 1 and box["convex_area"] == 24 and box["solidity"] == 1 and box["perimeter"] == 16
    assert box["major_axis_length"] == pytest.approx(4 * sqrt(36 / 12)) and box["minor_axis_length"] == pytest.approx(4 * sqrt(16 / 12))
    disk = regionprops.region_properties(conv.disk(20) > 0)
    assert disk["eccentricity"] == pytest.approx(0, abs=1e-6) and disk["perimeter"] == pytest.approx(2 * pi * 20, rel=0.06)
    assert set(regionprops.region_properties(np.zeros((3, 3), bool)).values()) == {None}


def test_polygon_fill_and_resize():
    assert contour.fill_polygon(np.array([[1, 1], [4, 1], [4, 3], [1, 3]]), 6, 6).sum() == 12
    up = contour.resize(np.array([[0.0, 1.0]]), 1, 4)
    assert up[0].tolist() == [0, 0.25, 0.75, 1]
