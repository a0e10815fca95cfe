"""BPE encoding and decoding with a public vocabulary file, by batched numpy merge rounds.

A text is cut at special tokens, brought to NFC, lower-cased and split into pieces (contractions, letter runs, single
numerals, runs of other signs). The symbols of all new pieces of a batch stand in one flat array. A round looks up the
rank of each neighbouring pair by binary search over sorted pair keys, takes the least rank of each piece and merges
all its places from left to right; rounds end when no piece has a pair left.
"""

from __future__ import annotations

import hashlib
import json
import os
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Pieces whose ids a worker remembers.
REMEMBERED = 200_000
#: Characters of text that are encoded at once; a longer text is a batch of its own.
BATCH_CHARS = 1 << 20
# Fixed by the vocabulary's pre-tokenizer.
_PIECES = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\p{White_Space}\p{L}\p{N}]+")
_END = "</w>"


def byte_signs() -> list[str]:
    """The sign that stands for each byte in byte-level vocabularies: printable ones themselves, others from U+0100 on."""
    plain = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    signs, more = {b: chr(b) for b in plain}, 0
    for b in range(256):
        if b not in signs:
            signs[b] = chr(256 + more)
            more += 1
    return [signs[b] for b in range(256)]


class Vocabulary:
    """Tables of a word-end BPE vocabulary file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        ids = spec["model"]["vocab"]
        self.special = {x["content"]: x["id"] for x in spec["added_tokens"]}
        self.sign = os.path.commonprefix(list(self.special))  # texts without it hold no special token
        self.cut = regex.compile("|".join(map(regex.escape, sorted(self.special, key=len, reverse=True)))) if self.special else None
        signs = byte_signs()
        self.byte, self.last = (np.array([ids[s + end] for s in signs], np.int64) for end in ("", _END))
        left, right, made = (np.array(x, np.int64) for x in zip(*((ids[a], ids[b], ids[a + b]) for a, b in spec["model"]["merges"]), strict=True))
        keys = left << 32 | right
        order = np.argsort(keys, kind="stable")
        self.keys, self.rank, self.made = keys[order], order, made[order]
        first = np.append(True, self.keys[1:] != self.keys[:-1])
        self.keys, self.rank, self.made = self.keys[first], self.rank[first], self.made[first]
        tokens = {**{v: k for k, v in ids.items()}, **{v: k for k, v in self.special.items()}}
        raw = [tokens.get(i, "").encode() for i in range(max(tokens) + 1)]
        self.sizes = np.array([len(x) for x in raw], np.int64)
        self.at, self.bytes = np.cumsum(self.sizes) - self.sizes, np.frombuffer(b"".join(raw), np.uint8)
        self.known: dict[str | int, int] = {x: i for i, x in enumerate(self.special.values())}
        self.known_ids: list[np.ndarray] = [np.array([x], np.int64) for x in self.known]

    def pieces(self, text: str) -> list[str | int]:
        """Pieces of a text; ids of special tokens stand for themselves."""
        if self.cut is None or self.sign not in text:
            return _split(text)
        out, at = [], 0
        for m in self.cut.finditer(text):
            out += [*_split(text[at : m.start()]), self.special[m[0]]]
            at = m.end()
        return out + _split(text[at:])

    def merge(self, pieces: list[str]) -> list[np.ndarray]:
        """Ids of each piece (none is empty)."""
        raw = [p.encode() for p in pieces]
        sizes = np.array([len(x) for x in raw], np.int64)
        data = np.frombuffer(b"".join(raw), np.uint8)
        symbols, owner = self.byte[data], np.repeat(np.arange(len(raw)), sizes)
        ends = np.cumsum(sizes) - 1
        symbols[ends] = self.last[data[ends]]
        done: list[tuple[np.ndarray, np.ndarray]] = []
        none = len(self.rank) + 1
        rank, made = self._look_up(symbols[:-1], symbols[1:], owner[:-1] == owner[1:])
        rank, made = np.append(rank, none), np.append(made, 0)  # of the pair that begins at each symbol
        while len(symbols):
            heads = np.flatnonzero(np.append(True, owner[1:] != owner[:-1]))
            per = np.diff(np.append(heads, len(symbols)))
            least = np.repeat(np.minimum.reduceat(rank, heads), per)
            live = least < none
            if not live.all():  # finished pieces leave
                done.append((owner[~live], symbols[~live]))
                symbols, owner, rank, made, least = symbols[live], owner[live], rank[live], made[live], least[live]
                if not len(symbols):
                    break
            hit = rank == least
            place = np.arange(len(hit))
            hit &= (place - np.maximum.accumulate(np.where(hit, -1, place))) % 2 == 1  # of places that overlap, every other one
            symbols[hit] = made[hit]
            keep = np.append(True, ~hit[:-1])
            symbols, owner, rank, made, hit = symbols[keep], owner[keep], rank[keep], made[keep], hit[keep]
            new = np.flatnonzero(hit | np.append(hit[1:], False))
            new = new[new < len(symbols) - 1]
            rank[-1] = none
            rank[new], made[new] = self._look_up(symbols[new], symbols[new + 1], owner[new] == owner[new + 1])
        owner, symbols = (np.concatenate(x) for x in zip(*done, strict=True)) if done else (np.zeros(0, np.int64),) * 2
        order = np.argsort(owner, kind="stable")
        return np.split(symbols[order], np.cumsum(np.bincount(owner, minlength=len(raw)))[:-1]) if len(raw) else []

    def _look_up(self, left: np.ndarray, right: np.ndarray, same: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and merged symbol of pairs; a rank beyond all if there is none or the two are of different pieces."""
        keys = left << 32 | right
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where((self.keys[at] == keys) & same, self.rank[at], len(self.rank) + 1), self.made[at]

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in one array, and each text's end in it."""
        known, fresh = self.known, {}
        index: list[int] = []
        counts = []
        for text in texts:
            pieces = self.pieces(text)
            counts.append(len(pieces))
            for p in pieces:
                i = known.get(p)
                if i is None and (i := fresh.get(p)) is None:
                    i = fresh[p] = len(known) + len(fresh)
                index.append(i)
        made = self.merge(list(fresh))
        table = self.known_ids + made
        for p, ids in zip(fresh, made, strict=True):
            if len(self.known_ids) >= REMEMBERED:
                break
            known[p] = len(self.known_ids)
            self.known_ids.append(ids)
        if not index:
            return np.zeros(0, np.int64), np.zeros(len(texts), np.int64)
        sizes = np.fromiter(map(len, table), np.int64, len(table))
        index = np.array(index, np.int64)
        flat, starts, n = np.concatenate(table), np.cumsum(sizes) - sizes, sizes[index]
        ends = np.cumsum(n)
        ids = flat[np.repeat(starts[index] - (ends - n), n) + np.arange(ends[-1])]
        return ids, np.append(0, ends)[np.cumsum(counts)]

    def decode(self, ids: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """UTF-8 of all texts in one array, and each text's end in it: tokens joined by a space, as without a decoder."""
        if not len(ids):
            return np.zeros(0, np.uint8), np.zeros(len(ends), np.int64)
        last = np.zeros(len(ids), bool)
        last[ends[np.diff(ends, prepend=0) > 0] - 1] = True
        sizes = self.sizes[ids]
        room = sizes + ~last
        stop = np.cumsum(room)
        out = np.full(stop[-1], 32, np.uint8)
        to = np.repeat(stop - room, sizes) + (np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes))
        out[to] = self.bytes[np.repeat(self.at[ids] - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())]
        return out, np.append(0, stop)[ends]


def _split(text: str) -> list[str]:
    return _PIECES.findall(unicodedata.normalize("NFC", text).replace("Σ", "σ").lower())


@lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


def _batches(texts: list[str | None]) -> Iterator[tuple[int, list[str]]]:
    lo, own, size = 0, [], 0
    for i, t in enumerate(texts):
        if own and size + len(t or "") > BATCH_CHARS:
            yield lo, own
            lo, own, size = i, [], 0
        own.append(t or "")
        size += len(t or "")
    if own:
        yield lo, own


def encode(docs: DataFrame, path: str, *, id: str = "doc_id", text: str = "text", arrays: bool = True, keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per row: id, kept columns, n_tokens, ids_sha256 (of little-endian unsigned 32-bit ids), decoded_sha256, and
    if arrays, token_ids and decoded. Null and empty texts have no tokens and an empty decoded text.

    path: the vocabulary file, at the same place on all executors (or shipped with --files). Repeated rows stay.
    """
    rows = docs.select(F.col(text).alias("t"), F.col(id).alias("k"), *(F.col(c).alias(f"k{i}") for i, c in enumerate(keep)))
    kept = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields[1:])
    new = "n_tokens long, ids_sha256 string, decoded_sha256 string" + ", token_ids array<int>, decoded string" * arrays

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = vocabulary(path)
        for batch in batches:
            n, ids_sha, decoded_sha, token_ids, decoded = [], [], [], [], []
            for _, texts in _batches(batch.column(0).to_pylist()):
                ids, ends = v.encode(texts)
                back, stops = v.decode(ids, ends)
                raw, back = memoryview(ids.astype("<u4").tobytes()), memoryview(back.tobytes())
                a = c = 0
                for b, d in zip(ends.tolist(), stops.tolist(), strict=True):
                    n.append(b - a)
                    ids_sha.append(hashlib.sha256(raw[4 * a : 4 * b]).hexdigest())
                    decoded_sha.append(hashlib.sha256(back[c:d]).hexdigest())
                    if arrays:
                        token_ids.append(ids[a:b].astype(np.int32))
                        decoded.append(str(back[c:d], "utf-8"))
                    a, c = b, d
            out = [*batch.columns[1:], pa.array(n, pa.int64()), pa.array(ids_sha, pa.string()), pa.array(decoded_sha, pa.string())]
            if arrays:
                out += [pa.array(token_ids, pa.list_(pa.int32())), pa.array(decoded, pa.string())]
            yield pa.RecordBatch.from_arrays(out, names=[x.split()[0] for x in f"{kept}, {new}".split(", ")])

    out = rows.mapInArrow(run, f"{kept}, {new}")
    for i, c in enumerate(keep):
        out = out.withColumnRenamed(f"k{i}", c)
    return out.withColumnRenamed("k", id)
