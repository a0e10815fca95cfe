"""Quality classifier: Bradley-Terry pairwise ranking.

A document's strength is a weighted sum of features of its whole text. The weights are learned from pairs of a better and
a worse labelled document by logistic loss on the difference of their features. The score is a logistic function of the
strength that passes `LEVEL` at the strength quantile that equals the share of worse documents among the labelled ones,
so that thresholding scores at `LEVEL` cuts at that quantile.

Training reads at most `max_rows` labels, chosen by a hash of their ids, and at most 2 * max_rows rows of documents with
those ids; of these only the features go to the driver. The choice does not depend on how rows are dealt out.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nucleispark.llm._carry import map_column
from nucleispark.llm._text import chunks, grams, modulus_of_id, words

LEVEL = 0.3
MAX_ROWS = 20_000
PAIRS, STEPS, BATCH, RATE, DECAY = 200_000, 3000, 512, 0.5, 1e-4
#: Cuts of each feature's range, at quantiles of the labelled rows; each piece has a slope of its own.
PIECES = 6
_B = np.arange(256)
_CLASSES = {
    "upper": (_B >= 65) & (_B <= 90), "lower": (_B >= 97) & (_B <= 122), "digit": (_B >= 48) & (_B <= 57), "wide": _B >= 128, "space": (_B == 32) | (_B == 9), "line": _B == 10,
    "stop": (_B == 46) | (_B == 63), "comma": (_B == 44) | (_B == 59) | (_B == 58), "shout": _B == 33, "sign": np.isin(_B, np.frombuffer(b'"#$%&()*+-/<=>@[\\]^_`{|}~', np.uint8)),
}
_TABLE = np.stack([m.astype(np.float32) for m in _CLASSES.values()], 1)
FEATURES = (*_CLASSES, "bytes", "words", "word_length", "distinct_words", "top_word", "distinct_triples", "distinct_lines", "mean_line", "stop_words", "short_words")


def features(texts: pa.Array) -> np.ndarray:
    """A row of FEATURES for each text, null counting as empty."""
    out = []
    for lo, hi, data, offsets in chunks(texts):
        w = words(data, offsets)
        triples = grams(w.hashes, 3)
        x = np.zeros((hi - lo, len(FEATURES)))
        n = np.maximum(np.diff(offsets), 1)
        some = np.flatnonzero(np.diff(offsets))
        if len(some):
            x[some, : len(_CLASSES)] = np.add.reduceat(_TABLE[data], offsets[some], axis=0, dtype=np.float64) / n[some, None]
        length = w.ends - w.starts
        for r, (a, b, i, j) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist(), w.first[:-1].tolist(), w.first[1:].tolist(), strict=True)):
            k = max(1, j - i)
            count = np.unique(w.hashes[i:j], return_counts=True)[1] if j > i else np.zeros(1)
            lines = data[a:b].tobytes().split(b"\n")
            x[r, len(_CLASSES) :] = (
                np.log1p(b - a), np.log1p(j - i), length[i:j].sum() / k, len(count) / k, count.max() / k,
                len(np.unique(triples[i : j - 2])) / max(1, j - i - 2) if j - i > 2 else 1.0, len(set(lines)) / len(lines),
                np.log1p((b - a) / len(lines)), np.sort(count)[-10:].sum() / k, (length[i:j] <= 2).sum() / k,
            )
        out.append(x)
    return np.concatenate(out) if out else np.zeros((0, len(FEATURES)))


class Model(NamedTuple):
    """knots: the cuts of each feature; the strength at which the score is LEVEL, and the score's slope there."""

    knots: np.ndarray
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    centre: float
    slope: float

    def strength(self, x: np.ndarray) -> np.ndarray:
        return (_pieces(x, self.knots) - self.mean) / self.scale @ self.weights

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * (self.strength(x) - self.centre) + np.log(LEVEL / (1 - LEVEL)), -60, 60)))


def _pieces(x: np.ndarray, knots: np.ndarray) -> np.ndarray:
    """Features, and what of each lies beyond each cut."""
    return np.concatenate([x, *(np.maximum(x - k, 0) for k in knots)], 1)


def fit(x: np.ndarray, good: np.ndarray, seed: int = 11) -> Model:
    """The model of feature rows and whether each is a better document. Without both kinds all scores are equal: LEVEL or
    above if there are better ones."""
    rng = np.random.default_rng(seed)
    knots = np.quantile(x, np.linspace(0, 1, PIECES + 1)[1:-1], axis=0) if len(x) else np.zeros((PIECES - 1, len(FEATURES)))
    z = _pieces(x, knots)
    if good.all() or not good.any():
        flat = Model(knots, np.zeros(z.shape[1]), np.ones(z.shape[1]), np.zeros(z.shape[1]), 0.0, 1.0)
        return flat._replace(centre=-1.0 if good.any() or not len(x) else 1.0)
    mean, scale = z.mean(0), np.maximum(z.std(0), 1e-6)
    z = (z - mean) / scale
    high, low = rng.choice(np.flatnonzero(good), PAIRS), rng.choice(np.flatnonzero(~good), PAIRS)
    w, step_sizes = np.zeros(z.shape[1]), np.full(z.shape[1], 1e-8)
    for step in range(STEPS):
        at = rng.integers(0, PAIRS, BATCH)
        d = z[high[at]] - z[low[at]]
        g = -(d / (1 + np.exp(np.clip(d @ w, -60, 60)))[:, None]).mean(0) + DECAY * w
        step_sizes += g * g
        w -= RATE * (1 - step / STEPS) * g / np.sqrt(step_sizes)
    s = z @ w
    centre = float(np.quantile(s, 1 - good.mean()))
    target = good.astype(float)
    bias = np.log(LEVEL / (1 - LEVEL))
    loss = lambda a: np.logaddexp(0, np.where(target > 0, -1, 1) * (a * (s - centre) + bias)).mean()
    return Model(knots, mean, scale, w, centre, float(min(np.geomspace(0.05, 20, 60), key=loss)))


def train(docs: DataFrame, labels: DataFrame, *, id: str = "doc_id", text: str = "text", label: str = "quality", max_rows: int = MAX_ROWS) -> Model:
    """A model of the documents that `labels` marks 1 (better) or 0; null ids, labels and texts without a row are left out."""
    marks = labels.select(F.col(id).alias("id"), F.col(label).cast("int").alias("mark")).filter("id is not null and mark in (0, 1)")
    share = min(1.0, max_rows / max(1, marks.count()))
    chance = F.pmod(F.xxhash64("id", F.lit("quality")), F.lit(1 << 30)) / (1 << 30)
    some = F.broadcast(marks.withColumn("chance", chance).filter(F.col("chance") < share).orderBy("chance", "id", "mark").limit(max_rows))  # rows of 20 bytes
    rows = docs.select(F.col(id).alias("id"), F.col(text).alias("text")).join(some, "id")
    found = map_column(rows, "text", ["mark", "chance"], "x binary", lambda t: [pa.array([r.tobytes() for r in features(t)], pa.binary())])
    found = [(r["mark"], r["x"]) for r in found.orderBy("chance", "mark", "x").limit(2 * max_rows).collect()]
    found.sort(key=lambda r: (r[0], bytes(r[1])))
    x = np.stack([np.frombuffer(r[1]) for r in found]) if found else np.zeros((0, len(FEATURES)))
    return fit(x, np.array([r[0] == 1 for r in found], bool))


def score(docs: DataFrame, model: Model, *, text: str = "text", keep: tuple[str, ...] = ("doc_id",), name: str = "score") -> DataFrame:
    """One row per row: kept columns and the score, 0 to 1; higher: better likelier. Null texts score as empty ones; equal texts alike."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    return map_column(docs, text, keep, f"`{name}` double", lambda t: [pa.array(shared.value.score(features(t)), pa.float64())])


def learnable(labels: DataFrame, id: str = "doc_id") -> DataFrame:
    """The labels that the quality contract lets one learn from."""
    return labels.filter(modulus_of_id(id, 5) != 0)
