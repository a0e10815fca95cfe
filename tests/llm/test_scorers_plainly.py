"""Quality scores and languages of whole tables against loops over bytes and words, and one step of training by hand."""

from __future__ import annotations

import math
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from test_llm_operators import FOLDER, split

from nucleispark.llm import language, quality, queries

ODD = ["", "!!!", "a", "A b\n\nA b\n", "ünïcode ÄÖ x", "one two three one two three", "x" * 500, "word " * 300, "1 2 3", "\n", "tab\tand  space?"]


def plain_features(text: str) -> list[float]:
    raw = text.encode()
    sets = {
        "upper": range(65, 91), "lower": range(97, 123), "digit": range(48, 58), "wide": range(128, 256), "space": (32, 9), "line": (10,), "stop": b".?", "comma": b",;:", "shout": b"!",
        "sign": b'"#$%&()*+-/<=>@[\\]^_`{|}~',
    }
    shares = [sum(b in members for b in raw) / max(1, len(raw)) for members in sets.values()]
    own = split(text)
    k, count = max(1, len(own)), Counter(own)
    triples = {tuple(own[i : i + 3]) for i in range(len(own) - 2)}
    lines = raw.split(b"\n")
    return [
        *shares, math.log1p(len(raw)), math.log1p(len(own)), sum(len(w.encode()) for w in own) / k, (len(count) if own else 1) / k, max(count.values(), default=0) / k,
        len(triples) / (len(own) - 2) if len(own) > 2 else 1.0, len(set(lines)) / len(lines), math.log1p(len(raw) / len(lines)), sum(sorted(count.values())[-10:]) / k, sum(len(w.encode()) <= 2 for w in own) / k,
    ]


def plain_quality(model: quality.Model, text: str) -> float:
    x = plain_features(text)
    z = x + [max(v - k, 0.0) for cuts in model.knots.tolist() for v, k in zip(x, cuts, strict=True)]
    strength = sum((v - m) / s * w for v, m, s, w in zip(z, model.mean.tolist(), model.scale.tolist(), model.weights.tolist(), strict=True))
    logit = model.slope * (strength - model.centre) + math.log(0.3 / 0.7)
    return 1 / (1 + math.exp(-max(-60.0, min(60.0, logit))))


def test_quality_scores_by_loops(spark):
    docs, labels = (spark.read.parquet(f"{FOLDER}/{n}.parquet") for n in ("documents", "labels"))
    model = quality.train(docs, quality.learnable(labels))
    texts = {r["doc_id"]: r["text"] or "" for r in docs.collect()}
    got = {r["doc_id"]: r for r in queries.op7_quality(spark, FOLDER).collect()}
    assert set(got) == set(texts)
    for i, t in texts.items():
        assert got[i]["score"] == pytest.approx(plain_quality(model, t), abs=1e-9), i
        assert got[i]["predicted"] == int(got[i]["score"] >= 0.3)
    odd = model.score(quality.features(pa.array(ODD)))
    assert odd.tolist() == pytest.approx([plain_quality(model, t) for t in ODD], abs=1e-9)


def test_one_step_of_ranking_by_hand(monkeypatch):
    monkeypatch.setattr(quality, "PAIRS", 40)
    monkeypatch.setattr(quality, "BATCH", 6)
    monkeypatch.setattr(quality, "STEPS", 1)
    draw = np.random.default_rng(3)
    x, good = draw.random((15, len(quality.FEATURES))), draw.random(15) < 0.6
    model = quality.fit(x, good, seed=5)
    rng = np.random.default_rng(5)
    high, low = rng.choice(np.flatnonzero(good), 40), rng.choice(np.flatnonzero(~good), 40)
    at = rng.integers(0, 40, 6)
    z = [[(v - m) / s for v, m, s in zip([*r, *(max(v - k, 0) for cuts in model.knots for v, k in zip(r, cuts, strict=True))], model.mean, model.scale, strict=True)] for r in x.tolist()]
    for f in range(len(model.weights)):
        # At zero weights each pair's chance of being the wrong way round is a half.
        g = -sum((z[high[i]][f] - z[low[i]][f]) * 0.5 for i in at) / 6
        assert model.weights[f] == pytest.approx(-quality.RATE * g / math.sqrt(1e-8 + g * g), abs=1e-9)


def plain_language(model: language.Model, text: str) -> tuple[str, float]:
    if not any(map(str.isalpha, text)):
        return "und", 0.0
    plain = [b + 32 if 65 <= b <= 90 else b for b in text.encode()]
    plain = [b if b >= 128 or 97 <= b <= 122 or 48 <= b <= 57 else 32 for b in plain]
    total, used = [0.0] * len(model.languages), 0
    table = model.logits.tolist()
    for n in language.ORDERS:
        for i in range(len(plain) - n + 1):
            h = plain[i] + (n << 8)
            for b in plain[i + 1 : i + n]:
                h = (h * 0x01000193 + b) % 2**32
            row = table[(h * 0x9E3779B1 % 2**32) >> 18]
            total = [t + v for t, v in zip(total, row, strict=True)]
            used += 1
    raw = [t / max(1, used) + float(b) for t, b in zip(total, model.bias, strict=True)]
    e = [math.exp(r - max(raw)) for r in raw]
    best = max(range(len(e)), key=lambda i: (e[i], -i))
    return model.languages[best], e[best] / sum(e)


def test_languages_by_loops(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    model = language.train(language.learnable(docs))
    got = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in queries.op9_language_id(spark, FOLDER).collect()}
    short = {r["doc_id"]: r["text"] or "" for r in docs.collect() if len(r["text"] or "") < 4000}
    assert len(short) > 100
    for i, t in short.items():
        name, score = plain_language(model, t)
        assert got[i][0] == name and got[i][1] == pytest.approx(score, abs=1e-5), i
    names, scores = language.judge(model, pa.array(ODD))
    for t, n, s in zip(ODD, names.to_pylist(), scores.to_pylist(), strict=True):
        name, score = plain_language(model, t)
        assert n == name and s == pytest.approx(score, abs=1e-5)


def test_one_step_of_the_embeddings_by_hand(monkeypatch):
    monkeypatch.setattr(language, "EPOCHS", 1)
    rng = random.Random(2)
    rows = []
    for name in ("a", "b", "a", "b"):
        at = sorted(rng.sample(range(language.BUCKETS), 5))
        rows.append((name, np.array(at, "<u2").tobytes(), np.array([rng.randint(1, 9) for _ in at], "<u4").tobytes()))
    model = language.fit(rows, seed=9)
    draw = np.random.default_rng(9)
    draw.permutation(4)
    emb = draw.normal(0, 1 / language.DIMENSIONS, (language.BUCKETS, language.DIMENSIONS)).astype(np.float32).astype(float)
    out = draw.normal(0, 0.1, (language.DIMENSIONS, 2)).astype(np.float32).astype(float)
    bias = np.log(np.array([0.5, 0.5]) + 1e-3)
    old_out, new_out, new_bias, new_emb = out.copy(), out.copy(), bias.copy(), emb.copy()
    for name, which, counts in rows:
        at, c = np.frombuffer(which, "<u2"), np.frombuffer(counts, "<u4").astype(float)
        weight = c / c.sum()
        hidden = sum(w * emb[b] for b, w in zip(at, weight, strict=True))
        raw = [sum(hidden[d] * old_out[d, k] for d in range(len(hidden))) + bias[k] for k in range(2)]
        p = [math.exp(r) / sum(map(math.exp, raw)) for r in raw]
        miss = [(p[k] - (name == "ab"[k])) / 4 for k in range(2)]
        for k in range(2):
            new_out[:, k] -= language.RATE / 10 * hidden * miss[k]
            new_bias[k] -= language.RATE / 100 * miss[k]
            for b, w in zip(at, weight, strict=True):
                new_emb[b] -= language.RATE * w * miss[k] * old_out[:, k]
    assert np.allclose(model.logits[:-1], new_emb @ new_out, atol=1e-4) and np.allclose(model.bias, new_bias, atol=1e-5) and not model.logits[-1].any()


def test_every_language_is_learned_from_rows_bounded_in_all(spark, monkeypatch):
    """520 languages of one document each are all in the model; four of 100 each share 40 rows, the rare fifth gives all it has."""
    many = spark.createDataFrame([(i, f"zort{i} blah{i}", f"l{i}") for i in range(520)], "doc_id long, text string, lang string")
    assert len(language.train(many).languages) == 520
    seen = []
    monkeypatch.setattr(language, "fit", seen.append)
    rows = [(i, f"word{i}", f"l{i % 4}") for i in range(400)] + [(1000, "rare", "l4"), (1001, None, "l5"), (1002, "x", None)]
    language.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"), max_rows=40)
    counts = [sum(lang == f"l{k}" for lang, _, _ in seen[0]) for k in range(6)]
    assert min(counts[:4]) > 0 and 16 < sum(counts[:4]) < 64 and counts[4:] == [1, 0]
    language.train(many, max_rows=100)
    assert 50 < len(seen[1]) <= 200
