"""Connected components, hole filling and small-object removal on masks."""

from __future__ import annotations

import numpy as np


def label(mask: np.ndarray, diagonal: bool = False) -> tuple[np.ndarray, int]:
    """Component numbers 1.. in row-major order of their first pixel, 0 outside, and how many; union of row runs."""
    mask = np.asarray(mask, bool)
    h, w = mask.shape
    edge = np.diff(np.pad(mask, ((0, 0), (1, 1))).astype(np.int8), axis=1)
    rows, begin = np.nonzero(edge == 1)
    end = np.nonzero(edge == -1)[1]
    parent = list(range(len(rows)))
    begins, ends = begin.tolist(), end.tolist()  # numbers of lists are read faster one by one

    def find(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    first = np.searchsorted(rows, np.arange(h + 1)).tolist()
    reach = int(diagonal)
    for r in range(1, h):
        i, j = first[r - 1], first[r]
        while i < first[r] and j < first[r + 1]:
            if begins[i] < ends[j] + reach and begins[j] < ends[i] + reach:
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
            if ends[i] < ends[j]:
                i += 1
            else:
                j += 1
    roots = np.array([find(i) for i in range(len(rows))], np.int64)
    names, number = np.unique(roots, return_inverse=True)
    out = np.zeros((h, w), np.int64)
    out[mask] = np.repeat(number + 1, end - begin)
    return out, len(names)


def fill_holes(mask: np.ndarray) -> np.ndarray:
    """The mask with every background component that doesn't touch the border set."""
    outside, n = label(~np.pad(np.asarray(mask, bool), 1))
    return ~(outside == outside[0, 0])[1:-1, 1:-1] if n else np.asarray(mask, bool)


def remove_small(mask: np.ndarray, least: float) -> np.ndarray:
    numbers, n = label(mask)
    big = np.bincount(numbers.ravel(), minlength=n + 1) >= least
    big[0] = False
    return big[numbers]
