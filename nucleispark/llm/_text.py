"""Array helpers that the text operators share: words and their hashes of many texts at once.

A text is handled as UTF-8 bytes inside one flat array. A word is a maximal run of digits, letters a-z (A-Z are
lower-cased first) and bytes from 0x80 on, which is `[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+` on the lower-cased text.
Null and empty texts have no words. Memory is bounded by CHUNK_BYTES or by the longest single text.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Texts are cut into runs of about so many bytes; a longer text makes a run of its own.
CHUNK_BYTES = 1 << 20
#: Words of a shingle, for near-duplicate operators.
SHINGLE = 5

_BYTES = np.arange(256)
LOWER = np.where((_BYTES >= 65) & (_BYTES <= 90), _BYTES + 32, _BYTES).astype(np.uint8)
IS_WORD = ((_BYTES >= 48) & (_BYTES <= 57)) | ((_BYTES >= 97) & (_BYTES <= 122)) | (_BYTES >= 128)
_BASE = 0x9E3779B97F4A7C15
_MASK = (1 << 64) - 1
_VALUE = ((_BYTES.astype(np.uint64) + np.uint64(1)) * np.uint64(0xD6E8FEB86659FD93)).astype(np.uint64)
_powers: dict[str, np.ndarray] = {}


class Words(NamedTuple):
    """Words of many texts: their hashes in order, and where each text's words begin (one more entry than texts)."""

    hashes: np.ndarray
    first: np.ndarray
    starts: np.ndarray
    ends: np.ndarray


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of an odd number modulo 2 ** 64, and of its inverse."""
    if len(_powers.get("up", ())) < n:
        size = max(n, CHUNK_BYTES + 1)
        for key, base in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
            p = np.full(size, base, dtype=np.uint64)
            p[0] = 1
            _powers[key] = np.cumprod(p)
    return _powers["up"][:n], _powers["down"][:n]


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts and their offsets; null counts as empty."""
    column = pc.fill_null(column, "").cast(pa.large_string())
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[at[0] : at[-1]], at - at[0]


def chunks(column: pa.Array, size: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) of runs of rows of about `size` bytes."""
    data, at = utf8(column)
    lo = 0
    while lo < len(column):
        hi = max(lo + 1, int(np.searchsorted(at, at[lo] + size, side="right")) - 1)
        yield lo, hi, data[at[lo] : at[hi]], at[lo : hi + 1] - at[lo]
        lo = hi


def words(data: np.ndarray, offsets: np.ndarray) -> Words:
    n = len(data)
    if not n:
        none = np.zeros(0, np.int64)
        return Words(np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64), none, none)
    low = LOWER[data]
    inside = np.zeros(n + 1, bool)
    inside[:n] = IS_WORD[low]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    edges = offsets[(offsets > 0) & (offsets < n)]
    begins[edges] |= inside[edges]
    ends = inside[:n] & (~inside[1:] | begins[1:])
    starts, ends = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    up, down = powers(n)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(_VALUE[low] * up, out=total[1:])
    hashes = (total[ends] - total[starts]) * down[starts]
    return Words(mix(hashes + (ends - starts).astype(np.uint64)), np.searchsorted(starts, offsets), starts, ends)


def grams(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hashes of k consecutive words at each position, over the borders of texts too."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = hashes[:n].copy()
    for j in range(1, k):
        out *= np.uint64(0x9E6C63D0876A9A47)
        out += hashes[j : j + n]
    return mix(out)


def inside(first: np.ndarray, k: int) -> np.ndarray:
    """Whether the k words from each position on belong to one text; as long as grams(., k)."""
    n = int(first[-1]) - k + 1
    if n <= 0:
        return np.zeros(0, bool)
    last = np.repeat(first[1:], np.diff(first))[:n]
    return np.arange(n) + k <= last


def shingle_sets(data: np.ndarray, offsets: np.ndarray, k: int = SHINGLE) -> list[np.ndarray]:
    """For each text the sorted distinct hashes of its shingles; a text of fewer words, but not none, has one."""
    w = words(data, offsets)
    g = grams(w.hashes, k)
    out = []
    for lo, hi in zip(w.first[:-1].tolist(), w.first[1:].tolist(), strict=True):
        if hi - lo >= k:
            out.append(np.unique(g[lo : hi - k + 1]))
        elif hi > lo:
            out.append(grams(w.hashes[lo:hi], hi - lo))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def modulus_of_id(column: str, n: int) -> Column:
    """crc32 of the id as text, modulo n; for null ids the empty text's, 0."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")) % n
