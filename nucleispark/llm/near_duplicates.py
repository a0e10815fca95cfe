"""N-gram Jaccard join with Bayesian candidate pruning.

Documents with equal sets of five-word shingles are one class from the start; only one text of each class goes on.
1. MinHash: ROWS * BANDS values per class; classes that agree in all rows of a band share a bucket. A pair of similarity
   0.8 misses all buckets with probability (1 - 0.8 ** 6) ** 40, about 5 in a million.
2. Each bucket links its members to its least one, which bounds rows by members; connected components of those links hold
   every candidate pair, and are as small as near-copy groups are.
3. Within a component, in blocks of BLOCK texts against one another, MinHash values are compared STEP by STEP. A pair is
   dropped as soon as the posterior probability of similarity >= threshold, from a flat prior and the agreements so far,
   is below TOLERANCE; the pairs left are verified on their whole shingle sets.
A block comparison returns one row per text, the number of its links and a root, never pairs, so that a group of n
near copies costs comparisons in proportion to n squared, but rows in proportion to n * n / BLOCK.
"""

from __future__ import annotations

from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nucleispark.llm._carry import map_column
from nucleispark.llm._shared import connected_components
from nucleispark.llm._text import SHINGLE, chunks, mix, shingle_sets
from nucleispark.session import checkpointed as cut

THRESHOLD = 0.8
ROWS, BANDS = 6, 40
HASHES = ROWS * BANDS
STEP = 32
TOLERANCE = 1e-6
BLOCK = 512
HOT_KEYS = 1000
_MULTIPLIERS = np.random.default_rng(3).integers(0, 1 << 63, HASHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """A row of HASHES minima for each set; none is empty."""
    flat = np.concatenate(sets)
    starts = np.cumsum([0] + [len(s) for s in sets[:-1]])
    out = np.empty((len(sets), HASHES), np.uint64)
    for i, a in enumerate(_MULTIPLIERS):
        out[:, i] = np.minimum.reduceat(flat * a, starts)
    return out >> np.uint64(24)


def _bands(s: np.ndarray) -> np.ndarray:
    s = s.reshape(len(s), BANDS, ROWS)
    h = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64), s.shape[:2]).copy()
    for r in range(ROWS):
        h = mix(h * np.uint64(0x9E3779B97F4A7C15) + s[:, :, r])
    return h.view(np.int64)


def _set_key(s: np.ndarray) -> bytes:
    return int(s.sum(dtype=np.uint64)).to_bytes(8, "big") + int(mix(s ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64)).to_bytes(8, "big")


def _describe(k: int):
    def run(texts: pa.Array) -> list[pa.Array]:
        keys, bands = [], []
        for _, _, data, offsets in chunks(texts):
            sets = shingle_sets(data, offsets, k)
            some = [s for s in sets if len(s)]
            rows = iter(_bands(signatures(some))) if some else iter(())
            keys += [_set_key(s) if len(s) else None for s in sets]
            bands += [next(rows) if len(s) else None for s in sets]
        return [pa.array(keys, pa.binary()), pa.array(bands, pa.list_(pa.int64()))]

    return run


def least_agreements(threshold: float, tolerance: float = TOLERANCE) -> np.ndarray:
    """For 0 to HASHES compared values, the fewest agreements with which a pair stays.

    With m of h agreeing and a flat prior the similarity is Beta(m + 1, h - m + 1), whose tail beyond t is the
    probability of at most m successes in h + 1 trials of chance t.
    """
    out = []
    for h in range(HASHES + 1):
        tail, m = 0.0, 0
        while m <= h:
            tail += comb(h + 1, m) * threshold**m * (1 - threshold) ** (h + 1 - m)
            if tail >= tolerance:
                break
            m += 1
        out.append(m)
    return np.array(out)


def similar_pairs(a: list[np.ndarray], b: list[np.ndarray] | None, threshold: float) -> np.ndarray:
    """Whether each of `a` and each of `b` (None: of `a` itself, i < j) has similarity >= threshold, as a matrix."""
    sa = signatures(a).astype(np.uint32)
    sb, other = (sa, a) if b is None else (signatures(b).astype(np.uint32), b)
    least = least_agreements(threshold)
    na, nb = np.array([len(s) for s in a]), np.array([len(s) for s in other])
    may = np.minimum(na[:, None], nb[None]) >= threshold * np.maximum(na[:, None], nb[None]) - 1e-9
    if b is None:
        may = np.triu(may, 1)
    i, j = np.nonzero(may)
    agree = np.zeros(len(i), np.int64)
    for h in range(0, HASHES, STEP):
        for x in range(h, min(h + STEP, HASHES)):
            agree += sa[i, x] == sb[j, x]
        stay = agree >= least[min(h + STEP, HASHES)]
        i, j, agree = i[stay], j[stay], agree[stay]
        if not len(i):
            break
    out = np.zeros((len(a), len(other)), bool)
    if len(i):
        inter = _intersections(a, other, i, j)
        good = inter * (1 + threshold) >= threshold * (na[i] + nb[j]) - 1e-9
        out[i[good], j[good]] = True
    return out


def _intersections(a: list[np.ndarray], b: list[np.ndarray], i: np.ndarray, j: np.ndarray) -> np.ndarray:
    if len(i) <= 4 * (len(a) + len(b)):
        return np.array([_common(a[x], b[y]) for x, y in zip(i.tolist(), j.tolist(), strict=True)])
    ia, ib = np.unique(i), np.unique(j)
    left, right = [a[x] for x in ia], [b[x] for x in ib]
    shared = np.intersect1d(np.concatenate(left), np.concatenate(right))
    total = np.zeros((len(ia), len(ib)), np.float32)
    for lo in range(0, len(shared), 8192):  # one run of columns after the other, so that memory is bounded
        part = shared[lo : lo + 8192]
        total += _incidence(left, part) @ _incidence(right, part).T
    return total[np.searchsorted(ia, i), np.searchsorted(ib, j)].round().astype(np.int64)


def _common(x: np.ndarray, y: np.ndarray) -> int:
    if len(x) > len(y):
        x, y = y, x
    at = np.searchsorted(y, x)
    return int((y[np.minimum(at, len(y) - 1)] == x).sum())


def _incidence(sets: list[np.ndarray], part: np.ndarray) -> np.ndarray:
    out = np.zeros((len(sets), len(part)), np.float32)
    for r, s in enumerate(sets):
        at = np.searchsorted(part, s)
        at[at == len(part)] = 0
        out[r, at[part[at] == s]] = 1
    return out


def _compare(k: int, threshold: float):
    def run(group: pa.Table) -> pa.Table:
        group = group.combine_chunks()
        first, second = group["i"][0].as_py(), group["j"][0].as_py()
        texts = group["text"].combine_chunks()
        texts = texts.chunk(0) if isinstance(texts, pa.ChunkedArray) else texts
        sets = [s for _, _, data, offsets in chunks(texts) for s in shingle_sets(data, offsets, k)]
        own: dict[bytes, tuple[np.ndarray, int, int]] = {}
        for s, key, n, block in zip(sets, group["key"].to_pylist(), group["n"].to_pylist(), group["block"].to_pylist(), strict=True):
            if len(s) and _set_key(s) == key:  # a repeated id may have brought another text
                own[key] = (s, n, block)
        keys = sorted(own)
        blocks, n = np.array([own[x][2] for x in keys]), np.array([own[x][1] for x in keys], np.int64)
        ia, ib = np.flatnonzero(blocks == first), np.flatnonzero(blocks == second)
        near = np.zeros((len(keys), len(keys)), bool)
        if len(ia) and len(ib):
            found = similar_pairs([own[keys[x]][0] for x in ia], None if first == second else [own[keys[x]][0] for x in ib], threshold)
            near[np.ix_(ia, ib)] = found
            near |= near.T
        root, todo = np.full(len(keys), -1), list(range(len(keys)))
        for x in todo:
            front = np.array([x]) if root[x] < 0 and near[x].any() else np.zeros(0, np.int64)
            while len(front):
                root[front] = x
                front = np.flatnonzero(near[front].any(0) & (root < 0))
        at = np.flatnonzero(root >= 0)
        return pa.table({"key": pa.array([keys[x] for x in at], pa.binary()), "links": pa.array(near[at] @ n, pa.int64()), "root": pa.array([keys[root[x]] for x in at], pa.binary())})

    return run


def near_duplicates(docs: DataFrame, *, id: str = "doc_id", text: str = "text", k: int = SHINGLE, threshold: float = THRESHOLD) -> DataFrame:
    """One row per row: id, class_id, n_links.

    n_links: other documents whose shingle sets have similarity >= threshold with its own. class_id: the least id of all
    documents that chains of links lead to, itself included. Texts of fewer than k words, but not none, are one shingle.
    Null and empty texts and texts without words have no links and their own id as class. Rows with a null id get null in
    both columns and link nothing. Repeated rows are documents of their own. Other columns are not looked at.
    """
    rows = docs.select(F.col(id).alias("id"), F.col(text).alias("text"))
    all_docs = cut(map_column(rows, "text", ["id"], "key binary, bands array<long>", _describe(k)))
    described = all_docs.filter("key is not null and id is not null")
    classes = cut(described.groupBy("key").agg(F.count("*").alias("n"), F.min("id").alias("least"), F.first("bands").alias("bands")))

    listed = classes.select("key", F.explode("bands").alias("bucket"))
    full = listed.groupBy("bucket").agg(F.min("key").alias("head"), F.count("*").alias("members")).filter("members > 1").select("bucket", "head")
    groups = connected_components(listed.join(full, "bucket").filter("key <> head").select(F.col("key").alias("a"), F.col("head").alias("b")))
    sizes = groups.groupBy("root").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    members = groups.select(F.col("node").alias("key"), "root").join(sizes, "root").join(classes.select("key", "n", "least"), "key")
    members = members.withColumn("block", F.pmod(F.xxhash64("key"), F.col("blocks")).cast("int"))
    pairs = members.join(rows.withColumnRenamed("id", "least"), "least").withColumn("x", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    pairs = pairs.select("root", F.least("block", "x").alias("i"), F.greatest("block", "x").alias("j"), "key", "n", "block", "text")
    # Few bytes, but much work a group: Spark would put too many of them into one task.
    spark = docs.sparkSession
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 4 * spark.sparkContext.defaultParallelism)
    pairs = pairs.repartition(tasks, "root", "i", "j")
    compared = cut(pairs.groupBy("root", "i", "j").applyInArrow(_compare(k, threshold), "key binary, links long, root binary"))

    roots = connected_components(compared.select(F.col("key").alias("a"), F.col("root").alias("b"))).withColumnRenamed("node", "key")
    links = compared.groupBy("key").agg(F.sum("links").alias("links"))
    linked = roots.join(links, "key").join(classes.select("key", "least"), "key")
    heads = linked.groupBy("root").agg(F.min("least").alias("class_id"))
    linked = linked.join(heads, "root").select("key", "links", "class_id")
    known = classes.select("key", "n", "least").join(linked, "key", "left").select("key", "n", F.coalesce("class_id", "least").alias("class_id"), (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("links"))
    return _name_classes(all_docs, cut(known)).withColumnRenamed("id", id)


def _name_classes(docs: DataFrame, known: DataFrame) -> DataFrame:
    """(id, class_id, n_links) of all (id, key), from (key, class_id, links, n).

    Keys of a thousandth of all documents or more are at most a thousand; their rows are sent to all tasks, so that copies of one
    text don't meet in one task.
    """
    bound = max(2, known.agg(F.sum("n")).first()[0] or 0) / HOT_KEYS
    hot, cold = known.filter(F.col("n") >= bound).drop("n"), known.filter(F.col("n") < bound).drop("n")
    keyed = docs.filter("id is not null and key is not null").select("id", "key")
    alone = docs.filter("id is null or key is null").select("id", F.col("id").alias("class_id"), F.when(F.col("id").isNotNull(), F.lit(0)).cast("long").alias("n_links"))
    # At most HOT_KEYS rows of 32 bytes.
    first = keyed.join(F.broadcast(hot), "key").select("id", "class_id", F.col("links").alias("n_links"))
    rest = keyed.join(F.broadcast(hot.select("key")), "key", "left_anti").join(cold, "key").select("id", "class_id", F.col("links").alias("n_links"))
    return first.unionByName(rest).unionByName(alone)
