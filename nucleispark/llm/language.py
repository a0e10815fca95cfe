"""Language identification: averaged hashed subword embeddings under a linear softmax, trained by stochastic gradient descent.

Subwords are runs of 2 to 4 bytes of the text, with A-Z lower-cased and all but letters, digits and bytes from 0x80 on
read as spaces, hashed into BUCKETS. A text's mean embedding goes through a linear layer. A fifth of the training rows
fixes a temperature that makes the scores probabilities; texts whose score is below a level are rejected.

Training reads about `per_language` documents of each language, or fewer of each where that would be more than `max_rows` in all,
chosen by a hash of their ids; twice as many at most, and of each only the counts of its buckets (98 kB at most), so that what
reaches the driver is bounded whatever the corpus, the number of languages or the length of texts. The choice does not depend on how
rows are dealt out.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nucleispark.llm._carry import map_column
from nucleispark.llm._text import IS_WORD, LOWER, chunks, modulus_of_id
from nucleispark.session import checkpointed as cut

ORDERS = (2, 3, 4)
BUCKETS = 1 << 14
DIMENSIONS = 16
PER_LANGUAGE = 600
#: Documents to learn from, of all languages together.
MAX_ROWS = 20_000
EPOCHS, BATCH, RATE = 6, 16, 20.0
REJECT_BELOW = 0.4
UNDETERMINED = "und"
_PLAIN = np.where(IS_WORD[LOWER], LOWER, 32).astype(np.uint32)
_LETTER = ((np.arange(256) >= 65) & (np.arange(256) <= 90)) | ((np.arange(256) >= 97) & (np.arange(256) <= 122))


class Model(NamedTuple):
    """logits: what each bucket adds to each language's logit (a row of zeros last), already divided by the temperature."""

    languages: list[str]
    logits: np.ndarray
    bias: np.ndarray


def buckets(data: np.ndarray, offsets: np.ndarray, n: int) -> np.ndarray:
    """The bucket of the n bytes from each place on; BUCKETS where they reach beyond their text."""
    x = _PLAIN[data]
    out = np.full(len(x), BUCKETS, np.int32)
    if len(x) >= n:
        h = x[: len(x) - n + 1] + np.uint32(n << 8)
        for j in range(1, n):
            h = h * np.uint32(0x01000193) + x[j : len(x) - n + 1 + j]
        out[: len(h)] = ((h * np.uint32(0x9E3779B1)) >> np.uint32(18)).astype(np.int32)
        for j in range(1, n):
            last = offsets[1:] - j
            out[last[last >= offsets[:-1]]] = BUCKETS
    return out


def _per_text(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sums of each text's rows."""
    out = np.zeros((len(offsets) - 1, *values.shape[1:]), np.float64)
    some = np.flatnonzero(np.diff(offsets))
    if len(some):
        out[some] = np.add.reduceat(values, offsets[some], axis=0)
    return out


def _histograms(texts: pa.Array) -> list[pa.Array]:
    """Buckets that occur, as bytes of 16-bit numbers, and their counts, as bytes of 32-bit numbers."""
    which, counts = [], []
    for _, _, data, offsets in chunks(texts):
        each = [buckets(data, offsets, n) for n in ORDERS]
        for a, b in zip(offsets[:-1], offsets[1:], strict=True):
            found = np.bincount(np.concatenate([e[a:b] for e in each]), minlength=BUCKETS + 1)[:BUCKETS]
            at = np.flatnonzero(found)
            which.append(at.astype("<u2").tobytes())
            counts.append(found[at].astype("<u4").tobytes())
    return [pa.array(which, pa.binary()), pa.array(counts, pa.binary())]


def fit(rows: list[tuple[str, bytes, bytes]], seed: int = 7) -> Model:
    """The model of (language, buckets, counts) rows."""
    languages = sorted({r[0] for r in rows})
    if not languages:
        return Model([], np.zeros((BUCKETS + 1, 0), np.float32), np.zeros(0))
    rng = np.random.default_rng(seed)
    rows = sorted(rows)
    y = np.array([languages.index(r[0]) for r in rows])
    at, weight = [np.frombuffer(r[1], "<u2") for r in rows], []
    for r in rows:
        c = np.frombuffer(r[2], "<u4").astype(np.float32)
        weight.append(c / max(1.0, float(c.sum())))
    order = rng.permutation(len(rows))
    check, train = order[: len(rows) // 5], order[len(rows) // 5 :]
    share = np.bincount(y[train], minlength=len(languages)) / max(1, len(train))
    emb = rng.normal(0, 1 / DIMENSIONS, (BUCKETS, DIMENSIONS)).astype(np.float32)
    out, bias = np.zeros((DIMENSIONS, len(languages)), np.float32), np.log(share + 1e-3).astype(np.float32)
    out += rng.normal(0, 0.1, out.shape)

    def dense(ids: np.ndarray) -> np.ndarray:
        x = np.zeros((len(ids), BUCKETS), np.float32)
        for i, r in enumerate(ids):
            x[i, at[r]] = weight[r]
        return x

    steps = EPOCHS * -(-len(train) // BATCH)
    step = 0
    for _ in range(EPOCHS):
        rng.shuffle(train)
        for lo in range(0, len(train), BATCH):
            ids = train[lo : lo + BATCH]
            rate = RATE * (1 - step / steps)
            step += 1
            x = dense(ids)
            hidden = x @ emb
            p = _softmax(hidden @ out + bias)
            p[np.arange(len(ids)), y[ids]] -= 1
            p /= len(ids)
            back = p @ out.T
            out -= (rate / 10) * (hidden.T @ p)
            bias -= (rate / 100) * p.sum(0)
            emb -= rate * (x.T @ back)
    table = emb @ out
    heat = 1.0
    if len(check):
        raw = np.concatenate([dense(check[i : i + 256]) @ table for i in range(0, len(check), 256)]) + bias
        loss = lambda t: -np.log(np.maximum(_softmax(raw / t)[np.arange(len(check)), y[check]], 1e-12)).mean()
        heat = min(np.geomspace(0.1, 10, 81), key=loss)
    return Model(languages, np.concatenate([table / heat, np.zeros((1, len(languages)), np.float32)]).astype(np.float32), bias / heat)


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


def train(docs: DataFrame, *, id: str = "doc_id", text: str = "text", lang: str = "lang", per_language: int = PER_LANGUAGE, max_rows: int = MAX_ROWS) -> Model:
    """A model of the rows with text and language. No such rows: a model without languages. More languages than `max_rows`: of some
    of them only, which the hash picks."""
    rows = docs.select(F.col(id).alias("id"), F.col(text).alias("text"), F.col(lang).cast("string").alias("lang")).filter("text is not null and lang is not null")
    sizes = cut(rows.groupBy("lang").agg(F.count("*").alias("n")))
    known = sizes.count()
    if not known:
        return fit([])
    quota = min(per_language, max_rows / known)
    chance = F.pmod(F.xxhash64("id", F.lit("language")), F.lit(1 << 30)) / (1 << 30)
    sample = rows.withColumn("chance", chance).join(F.broadcast(sizes) if known <= max_rows else sizes, "lang").filter(F.col("chance") < F.lit(float(quota)) / F.col("n"))
    found = map_column(sample, "text", ["lang", "chance"], "which binary, counts binary", _histograms)
    found = found.orderBy("chance", "lang", "which", "counts").limit(int(2 * quota * known)).collect()
    return fit([(r["lang"], bytes(r["which"]), bytes(r["counts"])) for r in found])


def judge(model: Model, texts: pa.Array) -> list[pa.Array]:
    names, scores = [], []
    for _, _, data, offsets in chunks(texts):
        total, used = np.zeros((len(offsets) - 1, len(model.languages))), np.zeros(len(offsets) - 1)
        for n in ORDERS:
            at = buckets(data, offsets, n)
            total += _per_text(model.logits[at], offsets)
            used += _per_text((at < BUCKETS).astype(np.float64), offsets)
        spoken = _per_text(_LETTER[data].astype(np.float64), offsets) > 0
        for i in np.flatnonzero(~spoken):
            spoken[i] = any(map(str.isalpha, str(data[offsets[i] : offsets[i + 1]].tobytes(), "utf-8")))
        if model.languages:
            p = _softmax(total / np.maximum(used, 1)[:, None] + model.bias)
            best = p.argmax(1)
            names += [model.languages[b] if s else UNDETERMINED for b, s in zip(best, spoken, strict=True)]
            scores.append(np.where(spoken, p.max(1), 0.0))
        else:
            names += [UNDETERMINED] * len(spoken)
            scores.append(np.zeros(len(spoken)))
    return [pa.array(names, pa.string()), pa.array(np.concatenate(scores) if scores else np.zeros(0), pa.float64())]


def identify(docs: DataFrame, model: Model, *, text: str = "text", keep: tuple[str, ...] = ("doc_id",), names: tuple[str, str, str] = ("lang_pred", "score", "rejected"), reject_below: float = REJECT_BELOW) -> DataFrame:
    """One row per row: kept columns, the language, its probability and whether it is rejected.

    `und` with score 0, and rejected: null texts, texts without a letter, and all texts under a model without languages.
    Else the likeliest language, of equal ones the first by name; rejected if its probability is below `reject_below`.
    Repeated rows are judged alike.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    out = map_column(docs, text, keep, f"`{names[0]}` string, `{names[1]}` double", lambda x: judge(shared.value, x))
    return out.withColumn(names[2], (F.col(names[0]) == UNDETERMINED) | (F.col(names[1]) < reject_below))


def learnable(docs: DataFrame, id: str = "doc_id") -> DataFrame:
    """The rows that the language contract lets one learn from."""
    return docs.filter(modulus_of_id(id, 3) != 1)
