"""Benchmark decontamination by winnowing.

A fingerprint of a text is the least hash of k consecutive words in each window of `span - k + 1` such hashes (all that
equal the least are kept). Texts that share `span` consecutive words share the fingerprint of that span, at the same
place in it, so joining the fingerprints of documents and benchmark items and extending each hit to both sides, word by
word, finds every shared span of `span` words. Items of fewer words are one span each: their window is a single hash.

The benchmark is the query set and is compared with all documents in blocks. A block has at most `block_words` words,
or one longer item; its fingerprints are sent to all tasks (some 40 bytes a word, so at most about 80 MB at the default).
Documents pass the blocks one after the other without any shuffle; after each but the last they are checkpointed and the
block is dropped, so that driver and tasks hold one block at a time, however large the benchmark is.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nucleispark.llm._text import chunks, grams, inside, words
from nucleispark.session import checkpointed

SPAN = 10
K_GRAM = 5
BLOCK_WORDS = 2_000_000
_BITS = 22


class Block(NamedTuple):
    """Fingerprints of some items. words: all hashes with a 0 before, between and after items."""

    ids: list[str]
    words: np.ndarray
    item_at: np.ndarray
    grams: list[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]


def _slide(x: np.ndarray, w: int, least: bool) -> np.ndarray:
    """Minimum or maximum of w neighbours from each position on."""
    f, have = (np.minimum if least else np.maximum), 1
    while have < w:
        step = min(have, w - have)
        x = f(x[:-step], x[step:]) if len(x) > step else x[:0]
        have += step
    return x


def winnow(g: np.ndarray, valid: np.ndarray, w: int) -> np.ndarray:
    """Positions of g that hold the least hash of any window of w; valid: whether the window from there on is one."""
    if w == 1:
        return np.flatnonzero(valid)
    low = _slide(g, w, True)
    if not len(low):
        return np.zeros(0, np.int64)
    high = np.zeros(len(low) + 2 * (w - 1), np.uint64)  # a gram's windows begin at most w-1 before it
    high[w - 1 : w - 1 + len(low)] = np.where(valid[: len(low)], low, np.uint64(0))
    covered = np.zeros(len(low) + 2 * (w - 1), bool)
    covered[w - 1 : w - 1 + len(low)] = valid[: len(low)]
    return np.flatnonzero((g == _slide(high, w, False)[: len(g)]) & _slide(covered, w, False)[: len(g)])


def _spans(lengths: np.ndarray, span: int, k: int) -> list[tuple[int, int]]:
    """(span, gram size) for each length that items' windows have."""
    return [(n, n if n < span else min(k, span)) for n in sorted({min(int(x), span) for x in lengths} - {0})]


def build_block(ids: list[str], texts: list[str], span: int, k: int) -> Block:
    flat, item_at, starts, lengths = [np.zeros(1, np.uint64)], [np.full(1, -1)], [], []
    at = 1
    for i, (_, _, data, offsets) in enumerate(c for t in texts for c in chunks(pa.array([t], pa.string()))):
        w = words(data, offsets).hashes
        flat += [w, np.zeros(1, np.uint64)]
        item_at += [np.full(len(w), i), np.full(1, -1)]
        starts.append(at)
        lengths.append(len(w))
        at += len(w) + 1
    all_words, item_at, starts, lengths = np.concatenate(flat), np.concatenate(item_at).astype(np.int64), np.array(starts, np.int64), np.array(lengths, np.int64)
    out = []
    for n, size in _spans(lengths, span, k):
        mine = (lengths >= n) if n == span else (lengths == n)
        g = grams(all_words, size)
        own = np.where(item_at >= 0, mine[item_at], False)
        ok = own[: len(all_words) - n + 1] & (item_at[: len(all_words) - n + 1] == item_at[n - 1 :]) if len(all_words) >= n else np.zeros(0, bool)
        at = winnow(g, np.pad(ok, (0, max(0, len(g) - len(ok)))), n - size + 1)
        at = at[np.argsort(g[at], kind="stable")]
        seen = np.zeros(1 << _BITS, bool)
        seen[(g[at] >> np.uint64(64 - _BITS)).astype(np.int64)] = True
        out.append((n, size, g[at], at, seen))
    return Block(ids, all_words, item_at, out)


def match_block(hashes: np.ndarray, first: np.ndarray, block: Block) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends) of the hit words, and the distinct pairs (text, item) of the texts that `hashes` and `first` hold."""
    lo, hi, texts, items = [], [], [], []
    text_of = np.repeat(np.arange(len(first) - 1), np.diff(first))
    for n, size, keys, where, seen in block.grams:
        g = grams(hashes, size)
        ok = inside(first, n)
        at = winnow(g, np.pad(ok, (0, len(g) - len(ok))), n - size + 1)
        at = at[seen[(g[at] >> np.uint64(64 - _BITS)).astype(np.int64)]]
        a, b = np.searchsorted(keys, g[at], "left"), np.searchsorted(keys, g[at], "right")
        p = np.repeat(at, b - a)
        q = where[np.repeat(a, b - a) + np.arange(len(p)) - np.repeat(np.cumsum(b - a) - (b - a), b - a)] if len(p) else p
        same = np.ones(len(p), bool)
        for j in range(size):
            same &= hashes[p + j] == block.words[q + j]
        p, q = p[same], q[same]
        left, right = np.zeros(len(p), np.int64), np.zeros(len(p), np.int64)
        begin, end = first[text_of[p]], first[text_of[p] + 1]
        for j in range(1, n - size + 1):
            x = (left == j - 1) & (p - j >= begin)
            left += x & (hashes[np.maximum(p - j, 0)] == block.words[q - np.minimum(j, left + 1)])
            x = (right == j - 1) & (p + size - 1 + j < end)
            right += x & (hashes[np.minimum(p + size - 1 + j, len(hashes) - 1)] == block.words[q + size - 1 + np.minimum(j, right + 1)])
        found = left + size + right >= n
        p, q, left, right = p[found], q[found], left[found], right[found]
        lo.append(p - left)
        hi.append(p + size + right)
        texts.append(text_of[p])
        items.append(block.item_at[q])
    cat = lambda x: np.concatenate(x) if x else np.zeros(0, np.int64)
    lo, hi, texts, items = cat(lo), cat(hi), cat(texts), cat(items)
    pairs = np.unique(texts * max(1, len(block.ids)) + items)
    return lo, hi, pairs // max(1, len(block.ids)), pairs % max(1, len(block.ids))


def _blocks(benchmark: DataFrame, item_id: str, item_text: str, block_words: int, span: int, k: int) -> Iterator[Block]:
    """Items in blocks of bounded size, fetched one partition at a time, each built when it is asked for."""
    n_words = F.regexp_count(F.col(item_text), F.lit("[0-9A-Za-z\\x{80}-\\x{10FFFF}]+"))
    ids, texts, size = [], [], 0
    for row in benchmark.select(F.col(item_id).cast("string").alias("i"), F.col(item_text).alias("t"), n_words.alias("n")).filter("i is not null and t is not null").toLocalIterator():
        if ids and size + row.n > block_words:
            yield build_block(ids, texts, span, k)
            ids, texts, size = [], [], 0
        ids.append(row.i)
        texts.append(row.t)
        size += row.n
    if ids:
        yield build_block(ids, texts, span, k)


def decontaminate(
    docs: DataFrame, benchmark: DataFrame, *, id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text",
    span: int = SPAN, k: int = K_GRAM, block_words: int = BLOCK_WORDS, keep: Sequence[str] = (),
) -> DataFrame:
    """One row per document row: id, the columns named in `keep`, n_words, hit_spans (disjoint ranges of word positions,
    sorted) and item_ids (sorted strings).

    Null and empty texts have no words and no hits. Repeated rows are judged each on its own. Null item ids or texts are
    no items; repeated items count once. No benchmark rows: no hits. Other columns of the inputs are not looked at; a
    kept column called like one of the results is an error.
    """
    if {"n_words", "hit_spans", "item_ids", id} & set(keep):
        raise ValueError("keep: names of results can't be kept")
    sc = docs.sparkSession.sparkContext
    kept = [F.col(id).alias("k"), *(F.col(c).alias(f"k{i}") for i, c in enumerate(keep))]
    out = docs.select(F.col(text).alias("t"), F.lit(None).cast("array<long>").alias("edges"), F.lit(None).cast("array<string>").alias("items"), F.lit(None).cast("long").alias("n"), *kept)
    last = out.drop("t").schema
    blocks = _blocks(benchmark, item_id, item_text, block_words, span, k)
    block = next(blocks, None) or build_block([], [], span, k)
    while block is not None:
        shared, following = sc.broadcast(block), next(blocks, None)
        out = out.mapInArrow(_judge(shared, following is not None), out.schema if following is not None else last)
        if following is not None:
            out = checkpointed(out)
            shared.unpersist()
        block = following
    at = F.sequence(F.lit(0), F.size("edges") - 2, F.lit(2))
    spans = F.transform(at, lambda i: F.struct(F.get("edges", i).alias("start"), F.get("edges", i + 1).alias("end")))
    return out.select(
        F.col("k").alias(id), *(F.col(f"k{i}").alias(c) for i, c in enumerate(keep)), F.col("n").alias("n_words"),
        F.when(F.size("edges") > 0, spans).otherwise(F.array().cast("array<struct<start:long,end:long>>")).alias("hit_spans"), F.col("items").alias("item_ids"),
    )


def _judge(shared, more_to_come: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = shared.value
        for batch in batches:
            texts, old_edges, old_items = batch.column(0), batch.column(1), batch.column(2)
            edges, items, counts = [], [], []
            for lo, hi, data, offsets in chunks(texts):
                w = words(data, offsets)
                starts, ends, in_text, of_item = match_block(w.hashes, w.first, block)
                per_text = np.split(of_item, np.searchsorted(in_text, np.arange(1, hi - lo)))
                order = np.argsort(starts, kind="stable")
                starts, ends = starts[order], ends[order]
                cut = np.searchsorted(starts, w.first)
                for r in range(hi - lo):
                    a, b, zero = cut[r], cut[r + 1], w.first[r]
                    more = np.stack([starts[a:b] - zero, ends[a:b] - zero], 1) if b > a else np.zeros((0, 2), np.int64)
                    had = old_edges[lo + r].as_py()
                    if had:
                        more = np.concatenate([np.array(had, np.int64).reshape(-1, 2), more])
                    edges.append(_union(more))
                    items.append(sorted({block.ids[i] for i in per_text[r]} | set(old_items[lo + r].as_py() or ())))
                counts.append(np.diff(w.first))
            n = np.concatenate(counts) if counts else np.zeros(0, np.int64)
            new = [pa.array(edges, pa.list_(pa.int64())), pa.array(items, pa.list_(pa.string())), pa.array(n, pa.int64()), *batch.columns[4:]]
            yield pa.RecordBatch.from_arrays([texts] * more_to_come + new, names=batch.schema.names[1 - more_to_come :])

    return run


def _union(spans: np.ndarray) -> list[int]:
    """Sorted disjoint spans, flat."""
    out: list[int] = []
    for a, b in sorted(map(tuple, spans.tolist())):
        if out and a <= out[-1]:
            out[-1] = max(out[-1], b)
        else:
            out += [a, b]
    return out


def digest(judged: DataFrame, id: str = "doc_id") -> DataFrame:
    """The columns of the decontamination contract from decontaminate()'s rows."""
    n_hit = F.coalesce(F.aggregate("hit_spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"]), F.lit(0).cast("long"))
    return judged.select(
        F.col(id), "n_words", n_hit.alias("n_hit"), F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "item_ids"), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"),
    )

