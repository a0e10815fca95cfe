"""Substring dedup by compact windows.

The tokens of a text are its five-word shingles. Under one hash function, all token ranges whose least hash is the one at
place c form a compact window (l, c, r): they begin in [l, c] and end in [c, r]. Windows at least as wide as the shortest
passage are the nodes of the Cartesian tree over the places that are the least of some range of that width; there are
about 2 / (width + 1) of them a token. Two passages share a MinHash value exactly if they lie in windows of one value.

1. Windows of HASHES functions, keyed by hash value; each is linked to the key's first window, by document and place.
2. Links of two documents are joined as intervals: NEED functions must have room for one passage on both sides.
3. The ranges found are compared shingle by shingle: a passage is the longest range of at least `min_words` words whose
   shingles and the counterpart's have similarity >= threshold, then the longest to its left and to its right, and so on.
4. Where a key has three windows or more it is crowded: its first document may hold only a part of a passage that others
   share. So ranges of the shortest passage's length get keys of their own. Where so many functions are crowded that fewer
   than NEED have a complete link: the range's hash, unless step 3 found it word for word in an earlier document. Where any
   is crowded: its value and another linked function's together, and, where NEED functions are linked, the range's two ends,
   unless the range lies in a passage found. The first holder of such a key has the whole range, or both values in one range,
   or both ends as far apart. Those links go through step 3 too.

So a passage that an earlier document has word for word is always found (but for collisions of 64-bit hashes): the first
holder of a range never finds it in an earlier document, so it always gives the range's key. A passage of similarity s is
found if NEED of HASHES functions agree, with probability 0.973 at s = 0.8 and 0.996 at 0.9. Earlier documents with a part of
the passage hold the values, but not the ends of ranges in it, as far apart up to EDITS shingles. Of SPARE ranges in a row one
gives its ends, chosen by its first shingle, so a passage with as many whose ends both have too is found. Where a passage is
shorter than SPARE - 1 words more than the shortest, or its sides differ by more words, the search by two values may end with
a holder of a part, the key's first.

Whole texts are never collected: heads' texts are cut to tiles of powers of two, so the pieces that a document gives are
bounded by its length, whatever the number of its copies.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from nucleispark.llm._carry import map_column
from nucleispark.llm._text import SHINGLE, chunks, grams, inside, mix, powers, words
from nucleispark.llm.decontaminate import winnow
from nucleispark.session import checkpointed as cut

MIN_WORDS = 50
THRESHOLD = 0.8
HASHES, NEED = 4, 2
#: By how many words at most a passage of the shortest length may be longer in its counterpart for their ends to be one key.
EDITS = 2
#: Of so many ranges that begin one after the other, one gives its ends as a key.
SPARE = 6
#: Keys of at least one in SHARE windows of a sample (one in SAMPLE documents), so at most SHARE keys, are dealt into PARTS.
#: This spreads work only: results are the same with any of these numbers.
SAMPLE, SHARE, PARTS = 64, 20_000, 64
#: Bits of a place's number: centre, and how far the window reaches to its left and right (farther counts as so far); and the
#: bit of crowded ones.
_C, _REACH, _CROWDED = 35, 12, 1 << 62
#: Bits of the filter of wanted documents; its table has 1 / 64 as many rows.
FILTER_BITS = 1 << 23
#: The smallest tile has 2 ** TILE shingles.
TILE = 6
_SEEDS = mix(np.arange(1, HASHES + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_ODD = np.uint64(0x9E6C63D0876A9A47)


def compact_windows(values: np.ndarray, valid: np.ndarray, first: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(c, l, r) of the windows at least `width` wide. values: token hashes of many texts; valid: whether a range of that
    width begins at each; first: where each text's tokens begin, by place in `values`, and the end of its tokens.

    Of equal least hashes in a range the leftmost has the window.
    """
    c = winnow(values, valid, width)
    if not len(c):
        return c, c, c
    v = values[c]
    text = np.searchsorted(first[:, 0], c, side="right") - 1
    n = len(c)
    left, right = np.arange(n) - 1, np.arange(n) + 1
    same = lambda i, j: (j >= 0) & (j < n) & (text[np.clip(j, 0, n - 1)] == text[i])
    for far, after in ((left, False), (right, True)):
        todo = np.arange(n)
        while len(todo):
            at = far[todo]
            on = same(todo, at)
            todo, at = todo[on], at[on]
            on = (v[at] >= v[todo]) if after else (v[at] > v[todo])
            todo, at = todo[on], at[on]
            far[todo] = far[at]
    has_left, has_right = same(np.arange(n), left), same(np.arange(n), right)
    low = np.where(has_left, c[np.clip(left, 0, n - 1)] + 1, first[text, 0])
    high = np.where(has_right, c[np.clip(right, 0, n - 1)] - 1, first[text, 1] - 1)
    wide = high - low >= width - 1  # of equal values one may be the leftmost in too narrow ranges only
    return c[wide], low[wide], high[wide]


def _token_ranges(first: np.ndarray, k: int) -> np.ndarray:
    """[begin, end) of each text's shingles among grams of all words."""
    return np.stack([first[:-1], np.maximum(first[1:] - k + 1, first[:-1])], 1)


def pack(fn: int, c: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """One number a window, that sorts by centre under a function. A text has fewer than 2 ** 31 bytes, so each centre fits."""
    far = (1 << _REACH) - 1
    return ((fn << _C | c) << _REACH | np.minimum(c - left, far)) << _REACH | np.minimum(right - c, far)


def unpack(place: np.ndarray) -> np.ndarray:
    """Rows (fn, c, l, r)."""
    far = (1 << _REACH) - 1
    c = place >> (2 * _REACH) & ((1 << _C) - 1)
    return np.stack([place >> (2 * _REACH + _C), c, c - (place >> _REACH & far), c + (place & far)])


def windows(rows: DataFrame, k: int, width: int, hot: np.ndarray) -> DataFrame:
    """(doc, key, place, hot) of rows (doc, text): place in shingles from the text's beginning. A key in `hot` (sorted) becomes
    one of PARTS keys, by a hash of doc, and the column `hot` holds its place there."""
    rows = rows.select("doc", "text", F.pmod(F.xxhash64("doc"), F.lit(PARTS)).alias("deal"))
    schema = T.StructType([rows.schema["doc"], *T._parse_datatype_string("key long, place long, hot int").fields])
    shared = rows.sparkSession.sparkContext.broadcast(hot)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequent = shared.value
        for batch in batches:
            deal = batch.column(2).to_numpy()
            for lo, _, data, offsets in chunks(batch.column(1)):
                w = words(data, offsets)
                g, valid, ranges = grams(w.hashes, k), inside(w.first, width + k - 1), _token_ranges(w.first, k)
                valid = np.pad(valid, (0, len(g) - len(valid)))
                found = []
                for fn, seed in enumerate(_SEEDS):
                    values = mix(g ^ seed)
                    c, left, right = compact_windows(values, valid, ranges, width)
                    begin = w.first[np.searchsorted(w.first, c, side="right") - 1]
                    found.append((values[c].view(np.int64), pack(fn, c - begin, left - begin, right - begin), c))
                key, place, c = map(np.concatenate, zip(*found, strict=True))
                text_of = np.searchsorted(w.first, c, side="right") - 1 + lo
                at = np.searchsorted(frequent, key)
                often = frequent[np.minimum(at, len(frequent) - 1)] == key if len(frequent) else np.zeros(len(key), bool)
                dealt = np.where(often, mix(key.view(np.uint64) + np.uint64(1) + deal[text_of].astype(np.uint64)).view(np.int64), key)
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(text_of)), pa.array(dealt), pa.array(place), pa.array(at.astype(np.int32), mask=~often)], names=schema.names)

    return rows.mapInArrow(run, schema)


def frequent_keys(rows: DataFrame, k: int, width: int) -> np.ndarray:
    """At most SHARE keys, sorted: those that one in SHARE windows of a sample have, three of them at least."""
    sample = windows(rows.filter(F.pmod(F.xxhash64("doc", F.lit("hot")), F.lit(SAMPLE)) == 0), k, width, np.zeros(0, np.int64))
    counts = cut(sample.groupBy("key").agg(F.count("*").alias("n")).filter("n > 2"))
    level = sample.count() / SHARE
    return np.array(sorted(r["key"] for r in counts.filter(F.col("n") >= level).collect()), np.int64)


def linked_windows(found: DataFrame) -> DataFrame:
    """(doc, links) of the documents with windows whose key another one has too: for each the place, the key's first window
    (other, other_place) and whether the key is crowded."""
    over, at = Window.partitionBy("key"), F.struct("doc", "place")
    near = found.select("doc", "place", "hot", F.min(at).over(over).alias("head"), F.max("doc").over(over).alias("last"), F.count("*").over(over).alias("n"))
    near = cut(near.filter("hot is not null or head.doc < last").select("doc", "place", "hot", "head", (F.col("n") > 2).alias("many")))  # few of all windows
    firsts = near.filter("hot is not null").groupBy("hot").agg(F.min("head").alias("first"))  # at most SHARE rows
    near = near.join(F.broadcast(firsts), "hot", "left").withColumn("head", F.coalesce("first", "head"))
    link = F.struct("place", F.col("head.doc").alias("other"), F.col("head.place").alias("other_place"), (F.col("many") | F.col("hot").isNotNull()).alias("crowded"), F.xxhash64("head.doc").alias("code"), (F.col("head.doc") < F.col("doc")).alias("earlier"))
    return near.groupBy("doc").agg(F.collect_list(link).alias("links"))


def fitting(group: np.ndarray, mine: np.ndarray, other: np.ndarray, width: int) -> np.ndarray:
    """Whether each link has room for one passage, on both sides, with a link of its group by another function (for NEED = 2).
    mine, other: rows (fn, c, l, r)."""
    order = np.lexsort((mine[1], group))
    group, mine, other = group[order], mine[:, order], other[:, order]
    good, todo = np.zeros(len(order), bool), np.arange(len(order))
    step = 0
    while len(todo):
        step += 1
        left = np.zeros(len(todo), bool)
        for x in (step, -step):
            at = np.flatnonzero((todo + x >= 0) & (todo + x < len(order)))
            a, b = todo[at], todo[at] + x
            near = (group[a] == group[b]) & (np.abs(mine[1, b] - mine[1, a]) <= 4 * width)
            at, a, b = at[near], a[near], b[near]
            left[at] = True
            fits = mine[0, a] != mine[0, b]
            for side in (mine, other):
                begin, end = np.maximum(side[2, a], side[2, b]), np.minimum(side[3, a], side[3, b])
                fits &= (end - begin + 1 >= width) & (np.minimum(side[1, a], side[1, b]) >= begin) & (np.maximum(side[1, a], side[1, b]) <= end)
            good[a[fits]] = good[b[fits]] = True
        todo = todo[left & ~good[todo]]
    out = np.zeros(len(order), bool)
    out[order] = good
    return out


def runs(group: np.ndarray, low: np.ndarray, high: np.ndarray, other_low: np.ndarray, other_high: np.ndarray, width: int) -> tuple[np.ndarray, ...]:
    """Ranges (member, begin, end, other begin, other end, shift): those of a group that go on with about the same shift, with
    `width` more on each side. member: one of the entries of a run."""
    shift = other_low - low
    bucket = shift // width
    order = np.lexsort((low, bucket, group))
    if not len(order):
        return (order,) * 6
    g, b, lo = group[order], bucket[order], low[order]
    at = np.flatnonzero(np.append(True, (g[1:] != g[:-1]) | (b[1:] != b[:-1]) | (np.diff(lo) > 4 * width)))
    least, most = (lambda x, f=f: f.reduceat(x[order], at) for f in (np.minimum, np.maximum))
    size = np.diff(np.append(at, len(order)))
    return (order[at], np.maximum(least(low) - width, 0), most(high) + width, np.maximum(least(other_low) - width, 0), most(other_high) + width, np.add.reduceat(shift[order], at) // size)


def _listed(doc_at: np.ndarray, n: int, columns: dict[str, pa.Array], kind: pa.DataType) -> pa.Array:
    """A list for each of n rows; doc_at: the row of each entry, in rising order."""
    offsets = np.searchsorted(doc_at, np.arange(n + 1)).astype(np.int32)
    values = pa.StructArray.from_arrays([columns[f.name].cast(f.type) for f in kind], fields=list(kind))
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), values)


def _range_type(doc: pa.DataType) -> pa.StructType:
    return pa.struct([("s", pa.int32()), ("e", pa.int32()), ("other", doc), ("os", pa.int32()), ("oe", pa.int32()), ("shift", pa.int32())])


def _to_lists(member_row: np.ndarray, others: pa.Array, found: tuple[np.ndarray, ...], n: int) -> pa.Array:
    member, *numbers = found
    row = member_row[member]
    order = np.argsort(row, kind="stable")
    columns = {"other": others.take(pa.array(member[order]))} | {name: pa.array(x[order]) for name, x in zip(("s", "e", "os", "oe", "shift"), numbers, strict=True)}
    return _listed(row[order], n, columns, _range_type(others.type))


def _ranges_ddl(kind: T.DataType) -> str:
    return f"ranges array<struct<s:int,e:int,other:{kind.simpleString()},os:int,oe:int,shift:int>>"


def _rows_of(lists: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """The row of each entry, and the entries."""
    return np.repeat(np.arange(len(lists)), np.diff(lists.offsets.to_numpy())), lists.flatten()


def _groups(row: np.ndarray, code: np.ndarray) -> np.ndarray:
    """A number for each different (row, code)."""
    order = np.lexsort((code, row))
    out = np.zeros(len(row), np.int64)
    out[order[1:]] = np.cumsum((np.diff(row[order]) != 0) | (np.diff(code[order]) != 0))
    return out


def join_intervals(linked: DataFrame, width: int) -> DataFrame:
    """(doc, ranges, places) of linked_windows(): ranges that earlier documents may have, and, if any is crowded, the windows' places."""

    def run(lists: pa.Array) -> list[pa.Array]:
        row, x = _rows_of(lists)
        place, code = (x.field(i).to_numpy().astype(np.int64) for i in (0, 4))
        crowded, earlier = (x.field(i).to_numpy(zero_copy_only=False).astype(bool) for i in (3, 5))
        at = np.flatnonzero(earlier)
        mine, other = unpack(place[at]), unpack(x.field(2).to_numpy().astype(np.int64)[at])
        group = _groups(row[at], code[at])
        good = fitting(group, mine, other, width)
        at, group, mine, other = at[good], group[good], mine[:, good], other[:, good]
        found = runs(group, mine[1], mine[1] + 1, other[1], other[1] + 1, width)
        many = np.flatnonzero((np.bincount(row[crowded], minlength=len(lists)) > 0)[row])
        places = pa.ListArray.from_arrays(pa.array(np.searchsorted(row[many], np.arange(len(lists) + 1)).astype(np.int32)), pa.array(place[many] | np.where(crowded[many], _CROWDED, 0)))
        return [_to_lists(row[at], x.field(1).take(pa.array(at)), found, len(lists)), places]

    return map_column(linked, "links", ["doc"], f"{_ranges_ddl(linked.schema['doc'].dataType)}, places array<bigint>", run)


def key_links(keys: DataFrame, width: int) -> DataFrame:
    """(doc, ranges, places: none) of rows (doc, key, s, e, ask): those that ask, with the key's first row if it is an earlier
    document's. Minima are combined before they are shuffled, no group is gathered, and rows whose key no other document has
    mostly stay where they are."""
    firsts = cut(keys.groupBy("key").agg(F.min(F.struct("doc", "s", "e")).alias("head"), F.max("doc").alias("last")).filter("head.doc < last").drop("last"))
    links = _only(keys.filter("ask"), firsts, "key").join(firsts, "key").filter("head.doc < doc")
    links = links.groupBy("doc").agg(F.collect_set(F.struct("s", "e", F.col("head.doc").alias("other"), F.col("head.s").alias("os"), F.col("head.e").alias("oe"), F.xxhash64("head.doc").alias("code"))).alias("links"))

    def run(lists: pa.Array) -> list[pa.Array]:
        row, x = _rows_of(lists)
        s, e, low, high, code = (x.field(i).to_numpy().astype(np.int64) for i in (0, 1, 3, 4, 5))
        return [_to_lists(row, x.field(2), runs(_groups(row, code), s, e + width, low, high + width, width), len(lists)), pa.ListArray.from_arrays(pa.array(np.zeros(len(lists) + 1, np.int32)), pa.array([], pa.int64()))]

    return map_column(links, "links", ["doc"], f"{_ranges_ddl(links.schema['doc'].dataType)}, places array<bigint>", run)


def _only(rows: DataFrame, ids: DataFrame, id: str = "doc") -> DataFrame:
    """The rows that may have an `id` of `ids`: a filter of FILTER_BITS bits, at most FILTER_BITS / 64 rows of two numbers, spares
    the others a shuffle. With very many ids it lets all pass; the join that follows decides."""
    bit = F.pmod(F.xxhash64(id), F.lit(FILTER_BITS))
    filled = ids.select(bit.alias("b")).groupBy(F.expr("b div 64").alias("w")).agg(F.bit_or(F.expr("shiftleft(1L, cast(b % 64 as int))")).alias("bits"))
    kept = rows.withColumn("b", bit).withColumn("w", F.expr("b div 64")).join(F.broadcast(filled), "w")
    return kept.filter("shiftright(bits, cast(b % 64 as int)) & 1 = 1").drop("b", "w", "bits")


def _slice(w, text: int, begin: int, end: int, data: np.ndarray) -> bytes:
    """The bytes of words [begin, end) of a text."""
    a, b = int(w.first[text]) + begin, min(int(w.first[text]) + end, int(w.first[text + 1]))
    return data[w.starts[a] : w.ends[b - 1]].tobytes() if b > a else b""


def _tiles(rows: DataFrame, k: int) -> DataFrame:
    """(doc, level, tile, slice) of rows (doc, text, tiles): the words of shingles [tile << level, (tile + 2) << level)."""
    schema = T.StructType([rows.schema["doc"], *T._parse_datatype_string("level int, tile int, slice string").fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(2).to_pylist()
            for lo, hi, data, offsets in chunks(batch.column(1)):
                w = words(data, offsets)
                out = [(r, t["level"], t["tile"], _slice(w, r - lo, t["tile"] << t["level"], (t["tile"] + 2 << t["level"]) + k - 1, data)) for r in range(lo, hi) for t in lists[r]]
                which, level, tile, text = zip(*out, strict=True) if out else ((), (), (), ())
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(which, pa.int64())), pa.array(level, pa.int32()), pa.array(tile, pa.int32()), pa.array(text, pa.binary()).cast(pa.string())], names=schema.names)

    return rows.select("doc", "text", "tiles").mapInArrow(run, schema)


def _counterparts(rows: DataFrame, ranges: DataFrame, k: int) -> DataFrame:
    """(doc, against) of rows (doc, text) and (doc, ranges): the ranges with their counterparts' words."""
    pairs = ranges.select("doc", F.inline("ranges")).withColumn("level", F.greatest(F.lit(TILE), F.length(F.bin(F.col("oe") - F.col("os") - 1))))
    pairs = pairs.withColumn("tile", F.expr("shiftright(os, level)"))
    wanted = pairs.select(F.col("other").alias("doc"), "level", "tile").distinct().groupBy("doc").agg(F.collect_list(F.struct("level", "tile")).alias("tiles"))
    wanted = cut(wanted)
    tiles = _tiles(_only(rows, wanted).join(wanted, "doc"), k).withColumnRenamed("doc", "other")
    both = pairs.join(tiles, ["other", "level", "tile"]).withColumn("x", F.struct("slice", (F.col("os") - F.expr("shiftleft(tile, level)")).alias("from"), (F.col("oe") - F.col("os") + k - 1).alias("n")))

    def trim(x: pa.Array) -> list[pa.Array]:
        begin, n = x.field("from").to_pylist(), x.field("n").to_pylist()
        out = []
        for lo, hi, data, offsets in chunks(x.field("slice")):
            w = words(data, offsets)
            out += [_slice(w, r - lo, begin[r], begin[r] + n[r], data) for r in range(lo, hi)]
        return [pa.array(out, pa.binary()).cast(pa.string())]

    trimmed = map_column(both, "x", ["doc", "s", "e", "other", "os", "shift"], "words string", trim)
    return trimmed.groupBy("doc").agg(F.collect_list(F.struct("s", "e", "other", "os", "shift", "words")).alias("against"))


def places(a: np.ndarray, b: np.ndarray, shift: int) -> np.ndarray:
    """For each of a the place in b that has the same value and is nearest to its own place + shift; -1 if there is none."""
    if not len(a) or not len(b):
        return np.full(len(a), -1)
    order = np.argsort(b, kind="stable")
    v = b[order]
    lo, hi = np.searchsorted(v, a, "left"), np.searchsorted(v, a, "right")
    # Among equal values `order` rises, so one search over (rank of the value, place) finds the neighbours of the aim.
    rank = np.cumsum(np.append(False, v[1:] != v[:-1]))
    span = len(b) + 1
    aim = np.clip(np.arange(len(a)) + shift, 0, len(b) - 1)
    at = np.searchsorted(rank * span + order, rank[np.minimum(lo, len(b) - 1)] * span + aim)
    after, before = order[np.clip(at, lo, np.maximum(hi - 1, lo)).clip(0, len(b) - 1)], order[np.clip(at - 1, lo, np.maximum(hi - 1, lo)).clip(0, len(b) - 1)]
    return np.where(hi > lo, np.where(np.abs(after - aim) < np.abs(before - aim), after, before), -1)


def verify(a: np.ndarray, b: np.ndarray, where: np.ndarray, width: int, threshold: float) -> list[tuple[int, int, int, int, float]]:
    """Passages (begin, end, other's begin, other's end, similarity) of shingles a that b has too, at `where`, longest first in each part."""
    match = where >= 0
    cost = 2 * threshold / (1 - threshold)  # equally long sides have similarity >= t if hits outnumber misses by 2t / (1-t)
    out, todo = [], [(0, len(a))]
    while todo:
        lo, hi = todo.pop()
        if hi - lo < width or np.count_nonzero(match[lo:hi]) < width * threshold / 2:
            continue
        sums = np.concatenate([[0.0], np.cumsum(np.where(match[lo:hi], 1.0, -cost))])
        least = np.minimum.accumulate(sums)
        begin = len(sums) - np.searchsorted(least[::-1], sums + 1e-9, side="right")  # the first place with a sum not above
        i = int(np.argmax(np.arange(len(sums)) - begin))
        s, e = lo + int(begin[i]), lo + i
        while e > s and not match[e - 1]:
            e -= 1
        while s < e and not match[s]:
            s += 1
        if e - s < width:
            continue
        todo += [(lo, s), (e, hi)]
        hit = np.flatnonzero(match[s:e]) + s
        shift = where[hit] - hit
        mine = where[hit][np.abs(shift - np.median(shift)) <= width // 2]
        if len(mine):
            x, y = np.unique(a[s:e]), np.unique(b[mine.min() : mine.max() + 1])
            both = len(np.intersect1d(x, y, assume_unique=True))
            alike = both / (len(x) + len(y) - both)
            if alike >= threshold - 1e-9:
                out.append((s, e, int(mine.min()), int(mine.max()) + 1, alike))
                continue
        jump, gap = np.abs(np.diff(shift)), np.diff(hit)  # its hits lie apart in the counterpart: cut where they part most
        if len(jump):
            at = int(np.argmax(jump)) if jump.any() else int(np.argmax(gap))
            todo += [(s, int(hit[at]) + 1), (int(hit[at + 1]), e)]
    return out


def range_hashes(g: np.ndarray, width: int) -> np.ndarray:
    """Hashes of `width` shingles from each place on."""
    if len(g) < width:
        return np.zeros(0, np.uint64)
    up, down = powers(len(g))
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(g * up)])
    return mix((total[width:] - total[:-width]) * down[: len(g) - width + 1])


def verbatim(a: np.ndarray, b: np.ndarray, width: int) -> tuple[np.ndarray, list[tuple[int, int, int, int, float]]]:
    """Places from which a has `width` shingles that stand in a row in b too, and the runs of those as passages."""
    x, y = range_hashes(a, width), range_hashes(b, width)
    if not len(x) or not len(y):
        return np.zeros(0, np.int64), []
    order = np.argsort(y, kind="stable")
    where = order[np.minimum(np.searchsorted(y[order], x), len(y) - 1)]
    at = np.flatnonzero(y[where] == x)
    if not len(at):
        return at, []
    new = np.flatnonzero(np.append(True, (np.diff(at) != 1) | (np.diff(where[at]) != 1)))
    last = np.append(new[1:], len(at)) - 1
    return at, [(int(at[i]), int(at[j]) + width, int(where[at[i]]), int(where[at[j]]) + width, 1.0) for i, j in zip(new, last, strict=True)]


def _centres(place: np.ndarray, begin: np.ndarray, n: int, width: int) -> tuple[np.ndarray, np.ndarray]:
    """For each function and place the centre of the window that the range of `width` from there on has, or -1, and whether it is
    crowded; windows at `place`, of texts that begin at `begin`."""
    out, many = np.full((HASHES, n), -1), np.zeros((HASHES, n), bool)
    fn, c, low, high = unpack(place & (_CROWDED - 1))
    first, last = np.maximum(low, c - width + 1), np.minimum(c, high - width + 1)
    size = np.maximum(last - first + 1, 0)
    which = np.repeat(np.arange(len(c)), size)
    at = np.arange(len(which)) - np.repeat(np.cumsum(size) - size, size) + (first + begin)[which]
    out[fn[which], at] = (c + begin)[which]
    many[fn[which], at] = (place >= _CROWDED)[which]
    return out, many


def _open_keys(g: np.ndarray, valid: np.ndarray, centres: np.ndarray, crowded: np.ndarray, same: np.ndarray, known: np.ndarray, width: int) -> list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(key, begin, end, ask) of ranges that links may have missed, by their first and last place of beginning. valid: where ranges
    begin in one text; crowded: whether a centre's window is; same: where one was found word for word; known: where one lies in
    a passage."""
    many = crowded & (centres >= 0)
    out = []
    at = np.flatnonzero(valid & (many.sum(0) > HASHES - NEED) & ~same)
    if len(at):
        out.append((range_hashes(g, width)[at], at, at, ~known[at]))
    at = np.flatnonzero(valid & many.any(0) & ~known)
    chosen = winnow(np.where(valid, mix(g), ~np.uint64(0)), np.arange(len(g)) + SPARE <= len(g), SPARE)
    linked = np.intersect1d(at, chosen, assume_unique=True)
    linked = linked[(centres[:, linked] >= 0).sum(0) >= NEED]
    for more in range(EDITS + 1):
        x = linked[linked + more < len(valid)]
        x = x[valid[x + more]]
        if len(x):
            out.append((mix(mix(g[x]) * _ODD + g[x + width - 1 + more]), x, x, np.ones(len(x), bool)))
    for a in range(HASHES):
        for b in range(a + 1, HASHES):
            x = at[(centres[a, at] >= 0) & (centres[b, at] >= 0) & (many[a, at] | many[b, at])]
            if not len(x):
                continue
            new = np.append(True, (np.diff(x) > 1) | (np.diff(centres[a, x]) != 0) | (np.diff(centres[b, x]) != 0))
            begin = x[new]
            key = mix(g[centres[a, begin]] ^ _SEEDS[a]) * _ODD + mix(g[centres[b, begin]] ^ _SEEDS[b]) + np.uint64(1 + a * HASHES + b)
            out.append((mix(key), begin, x[np.append(new[1:], True)], np.ones(len(begin), bool)))
    return out


def _told_schema(doc: T.DataType) -> T.StructType:
    parts = T._parse_datatype_string("text_key long, s int, e int, os int, oe int, alike double, key long, ask boolean").fields
    return T.StructType([T.StructField("doc", doc), T.StructField("other", doc), *parts])


def confirm(rows: DataFrame, ranges: DataFrame, k: int, width: int, threshold: float) -> DataFrame:
    """Passages and the keys of ranges (`key` is not null) of rows (doc, text) and (doc, ranges, places), as `_told_schema` says.

    A document with its counterparts' words is one row: both are bounded by its length.
    """
    schema = _told_schema(rows.schema["doc"].dataType)
    against = _counterparts(rows, ranges, k)
    crowded = ranges.filter(F.size("places") >= NEED).select("doc", "places")
    asked = cut(crowded.select("doc").union(ranges.filter(F.size("ranges") > 0).select("doc")))
    x = _only(rows, asked).join(crowded, "doc", "left").join(against, "doc", "left").filter("places is not null or against is not null").select("doc", F.xxhash64("text").alias("text_key"), "text", "against", "places")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, text_key, texts, pieces, crowds = batch.columns
            piece_at = np.concatenate([[0], np.cumsum(np.diff(pieces.offsets.to_numpy()) * pieces.is_valid().to_numpy(zero_copy_only=False))])
            flat = pieces.flatten()
            s, e, os, shift = (flat.field(i).to_numpy().astype(np.int64) for i in (0, 1, 3, 4))
            crowd_at = np.concatenate([[0], np.cumsum(np.diff(crowds.offsets.to_numpy()) * crowds.is_valid().to_numpy(zero_copy_only=False))])
            crowd = crowds.flatten().to_numpy().astype(np.int64)
            for lo, hi, data, offsets in chunks(texts):
                w = words(data, offsets)
                g, valid = grams(w.hashes, k), inside(w.first, width + k - 1)
                valid = np.pad(valid, (0, len(g) - len(valid)))
                ends = _token_ranges(w.first, k)
                same, known = np.zeros(len(g) + 1, bool), np.zeros(len(g) + 1, bool)
                passages = []
                first, last = int(piece_at[lo]), int(piece_at[hi])
                owner = np.searchsorted(piece_at, np.arange(first, last), side="right") - 1 - lo
                for plo, phi, pdata, poffsets in chunks(flat.field(5).slice(first, last - first)):
                    pw = words(pdata, poffsets)
                    pg = grams(pw.hashes, k)
                    for p in range(plo, phi):
                        begin, end = ends[owner[p]]
                        x, q = begin + s[first + p], first + p
                        a = g[x : min(begin + e[q], end)]
                        b = pg[pw.first[p - plo] : max(pw.first[p - plo], pw.first[p - plo + 1] - k + 1)]
                        equal, more = verbatim(a, b, width)
                        same[x + equal] = True
                        found = more
                        if not more or more[0][:2] != (0, len(a)):
                            found = verify(a, b, places(a, b, int(s[q] + shift[q] - os[q])), width, threshold)
                            found += [m for m in more if not any(f[0] <= m[0] and m[1] <= f[1] for f in found)]
                        for a0, a1, b0, b1, alike in found:
                            known[x + a0 : max(x + a0, x + a1 - width + 1)] = True
                            passages.append((lo + owner[p], q, s[q] + a0, s[q] + a1, os[q] + b0, os[q] + b1, alike))
                if passages:
                    r, q, *numbers, alike = map(np.array, zip(*passages, strict=True))
                    none = [pa.nulls(len(r), pa.int64()), pa.nulls(len(r), pa.bool_())]
                    yield pa.RecordBatch.from_arrays([ids.take(pa.array(r)), flat.field(2).take(pa.array(q)), text_key.take(pa.array(r)), *(pa.array(n.astype(np.int32)) for n in numbers), pa.array(alike), *none], names=schema.names)
                place = crowd[crowd_at[lo] : crowd_at[hi]]
                begin, end = (np.repeat(x, np.diff(crowd_at[lo : hi + 1])) for x in (w.first[:-1], ends[:, 1]))
                fits = unpack(place & (_CROWDED - 1))[1] + begin < end  # rows that share an id may have shorter texts
                if fits.any():
                    centres, many = _centres(place[fits], begin[fits], len(g) + width, width)
                    for key, b, to, ask in _open_keys(g, valid, centres[:, : len(g)], many[:, : len(g)], same[:-1], known[:-1], width):
                        r = np.searchsorted(w.first, b, side="right") - 1
                        numbers = [pa.array((v - w.first[r]).astype(np.int32)) for v in (b, to)]
                        empty = [pa.nulls(len(r), pa.int32()), pa.nulls(len(r), pa.int32()), pa.nulls(len(r), pa.float64())]
                        yield pa.RecordBatch.from_arrays([ids.take(pa.array(r + lo)), pa.nulls(len(r), ids.type), pa.nulls(len(r), pa.int64()), *numbers, *empty, pa.array(key.view(np.int64)), pa.array(ask)], names=schema.names)

    return x.mapInArrow(run, schema)


def repeated_passages(docs: DataFrame, *, id: str = "doc_id", text: str = "text", min_words: int = MIN_WORDS, threshold: float = THRESHOLD, k: int = SHINGLE) -> DataFrame:
    """One row per repeated passage and an earlier document that has it: id, start_word, end_word (exclusive), n_words, kept_id,
    kept_start, kept_end, similarity, text_key (xxhash64 of the text it is in). Documents without such a passage have no row.

    A document is earlier if its id is less; one earlier document is named for each passage, not all of them. Null, empty
    and short texts have no passages; rows with a null id are left alone. Rows that share an id are one document: they are
    not compared with each other, and `text_key` says which of them has the passage. Repeats inside one text aren't looked
    for. Words are as in `_text`. Other columns are not looked at.
    """
    width = min_words - k + 1
    if not 0 < width <= 1 << (_REACH - 3):
        raise ValueError(f"min_words must be from {k} to {(1 << (_REACH - 3)) + k - 1}")
    rows = docs.select(F.col(id).alias("doc"), F.col(text).alias("text")).filter("doc is not null and text is not null")
    linked = linked_windows(windows(rows, k, width, frequent_keys(rows, k, width)))
    told = cut(confirm(rows, cut(join_intervals(linked, width)), k, width, threshold))
    again = cut(key_links(told.filter("key is not null"), width))
    p = told.filter("key is null").unionByName(confirm(rows, again, k, width, threshold))
    order = Window.partitionBy("doc", "text_key", "other").orderBy("s", F.desc("e"), "os", "oe").rowsBetween(Window.unboundedPreceding, -1)
    p = p.withColumn("before", F.max("e").over(order)).filter("before is null or before < e")  # not inside another one of the two documents
    return p.select(
        F.col("doc").alias(id), F.col("s").cast("long").alias("start_word"), (F.col("e") + k - 1).cast("long").alias("end_word"), (F.col("e") - F.col("s") + k - 1).cast("long").alias("n_words"),
        F.col("other").alias("kept_id"), F.col("os").cast("long").alias("kept_start"), (F.col("oe") + k - 1).cast("long").alias("kept_end"), F.round("alike", 6).alias("similarity"), "text_key",
    )


def without_spans(texts: pa.Array, spans: list[list[tuple[int, int]]]) -> list[str]:
    """The texts without those ranges of words, cut from the first word's first byte to the last word's last."""
    out = []
    for lo, _, data, offsets in chunks(texts):
        w = words(data, offsets)
        for i, (a, b, begin, end) in enumerate(zip(w.first[:-1].tolist(), w.first[1:].tolist(), offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)):
            parts, at = [], begin
            for s, e in sorted(spans[lo + i]):
                s, e = a + s, min(a + e, b)
                if e > s and w.ends[e - 1] > at:
                    parts.append(data[at : max(at, w.starts[s])].tobytes())
                    at = int(w.ends[e - 1])
            out.append(b"".join([*parts, data[at:end].tobytes()]).decode())
    return out
