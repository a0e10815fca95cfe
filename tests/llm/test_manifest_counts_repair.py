"""Manifests, token counts and repaired conversations against plain versions, and on odd rows."""

from __future__ import annotations

import hashlib
import random
import zlib
from functools import lru_cache

import pytest
from pyspark.sql import functions as F

from nucleispark.llm import conversation_repair, merkle, queries, token_counts

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


# 11


def leaf_of(row: dict) -> str:
    return sha("".join("-" if row[c] is None else f"{len(str(row[c]).encode())}:{row[c]}" for c in COLUMNS))


def tree_of(leaves: list[str]) -> tuple[str, list[list[tuple[list[str], list[str]]]]]:
    """The top node, and each leaf's siblings, level by level."""
    own, level, at = [[] for _ in leaves], leaves, list(range(len(leaves)))
    while len(level) > 1:
        for i, p in enumerate(at):
            lo = p - p % 3
            own[i].append((level[lo:p], level[p + 1 : lo + 3]))
        level = [sha("".join(level[i : i + 3])) for i in range(0, len(level), 3)]
        at = [p // 3 for p in at]
    return level[0], own


def plain_manifest(rows: list[dict]) -> list[tuple]:
    sources = sorted({r["source"] for r in rows}, key=lambda s: (s is not None, (s or "").encode()))
    parts = []
    for s in sources:
        mine = sorted((r for r in rows if r["source"] == s), key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf_of(r)))
        parts.append((mine, *tree_of([leaf_of(r) for r in mine])))
    root, far = tree_of([top for _, top, _ in parts])
    out = []
    for (mine, top, own), beyond in zip(parts, far, strict=True):
        for r, near in zip(mine, own, strict=True):
            h = leaf_of(r)
            even = r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 2 == 0
            folded = leaf_of(r | {"text": r["text"].replace("\n", "")}) if even and r["text"] is not None else h
            for before, after in near + beyond:
                folded = sha("".join([*before, folded, *after]))
            out.append((r["doc_id"], h, top, root, sha("".join(x for b, a in near + beyond for x in b + a)), folded, folded == root))
    return sorted(out, key=str)


def manifest_of(docs, **more):
    tampered = [F.replace("text", F.lit("\n"), F.lit("")) if c == "text" else F.col(c) for c in COLUMNS]
    rows = merkle.manifest(docs, COLUMNS, id="doc_id", tree="source", tampered=tampered, when=F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0, **more)
    return sorted((tuple(r[c] for c in ("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")) for r in rows.collect()), key=str)


@pytest.mark.parametrize("depth", [1, 2, 7])
def test_manifest_against_a_plain_tree(spark, depth):
    rng = random.Random(depth)
    rows = [(i * 3, "line\n" * rng.randint(0, 3) + "é", rng.choice(["en", None]), rng.choice(["a", "b", "ü", "", None]), 7) for i in range(60)]
    rows += [(None, None, None, None, None), (None, "x\ny", None, "a", None), (5, "same\n", "en", "a", 5), (5, "same\n", "en", "a", 5), (5, "other", "en", "a", 5), (7, None, "en", "lone", 0), (8, "", "en", "two", 0), (9, "long " * 50_000, "en", "two", 0)]
    docs = spark.createDataFrame(rows, DOCS)
    clash = docs.withColumns({"pos": F.lit("x"), "h": F.lit(1), "tree": F.lit(2), "n": F.lit(3), "_at": F.lit(4), "id": F.lit("y")}).repartition(7)
    expected = plain_manifest([dict(zip(("doc_id", "text", "lang", "source", "n_chars"), r, strict=True)) for r in rows])
    assert manifest_of(clash, depth=depth) == expected
    assert {x[-1] for x in expected} == {True, False}


def test_manifest_of_one_row_and_of_none(spark):
    one = spark.createDataFrame([(1, "t", "en", "s", 1)], DOCS)
    (row,) = manifest_of(one)
    assert row[1] == row[2] == row[3] and row[4] == sha("") and row[6]
    assert manifest_of(one.filter("doc_id > 1")) == []


def test_manifest_over_several_superblocks(spark):
    """A hot source of more places than a superblock has."""
    docs = spark.range(5000).select(F.col("id").alias("doc_id"), F.concat(F.lit("a\nb"), F.col("id")).alias("text"), F.lit("en").alias("lang"), F.when(F.col("id") % 10 < 9, "hot").otherwise(F.col("id").cast("string")).alias("source"), F.lit(1).cast("long").alias("n_chars"))
    assert manifest_of(docs.repartition(5)) == plain_manifest([r.asDict() for r in docs.collect()])


# 12


def test_token_counts_are_the_librarys(spark):
    import sentencepiece

    path = queries.tokenizer_path("piece_bpe_32k.model")
    library = sentencepiece.SentencePieceProcessor(model_file=path)
    rng = random.Random(12)
    signs = " \n\t▁aabbccddeeoottthhe.,!0123é漢字😀\x00<s>/-_=(){}ABC  "
    texts = ["", " ", "\n", "   ", "▁", "a\n\n b", "<s>x</s><unk><0x0A>", "trailing  ", "x" * 3000, "ab" * 500 + " " * 40, "word " * 5000, "漢字" * 300, "unspaced" * 200 + "\n" * 9, "　a b"]
    texts += ["".join(rng.choice(signs) for _ in range(rng.choice([3, 20, 200]))) for _ in range(1500)]
    texts += [r[0] for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("text").collect()]
    rows = [(i, t) for i, t in enumerate(texts)] + [(7, None), (None, "repeated row"), (None, "repeated row")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"k": F.lit("x"), "t": F.lit(1), "n_tokens": F.lit("clash")})
    got = sorted((tuple(r) for r in token_counts.count_tokens(docs, path, limit=100).collect()), key=str)
    n = [len(x) for x in library.encode([t or "" for _, t in rows])]
    assert got == sorted(((i, len((t or "").encode()), c, c > 100) for (i, t), c in zip(rows, n, strict=True)), key=str)
    assert token_counts.count_tokens(docs.filter("doc_id < 0"), path).count() == 0


def test_whole_tokens_are_proven():
    """Each string of the shortcut is one token by itself, and a text of it alone too, for those that begin with the space sign."""
    import sentencepiece

    path = queries.tokenizer_path("piece_bpe_32k.model")
    library = sentencepiece.SentencePieceProcessor(model_file=path)
    whole = token_counts.whole_tokens(path)
    own = [p[1:] for p in whole if p[0] == "▁" and "▁" not in p[1:] and len(p) > 1]
    assert len(own) > 10_000 and all(len(x) == 1 for x in library.encode(own))


def test_counts_without_the_shortcut_are_the_same():
    path = queries.tokenizer_path("piece_bpe_32k.model")
    vocabulary = token_counts.pieces(path)
    texts = ["the quick brown fox\njumps  over", "aaaa bbbb " * 9, "Straße и мир 42"]
    assert token_counts.PreTokens(vocabulary, frozenset()).of_texts(texts) == token_counts.PreTokens(vocabulary, token_counts.whole_tokens(path)).of_texts(texts)


# 13


def plain_repair(rows: list[tuple]) -> tuple:
    """rows (turn, role, text) after damage; the cheapest edits by trying all, the least of equal ones."""
    rows = sorted(((t, " " if r is None else r, " " if x is None else x) for t, r, x in rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
    seen, faults = set(), []
    for _, role, text in rows:
        body = text.strip(" \t\n\x0b\x0c\r")
        faults.append("blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else "")
        seen.add((role, text))
    roles = {"n": "u", "s": "u", "u": "a", "a": "u"}
    names = {"u": "user", "a": "assistant"}

    @lru_cache(maxsize=None)
    def best(i: int, place: str, inserted: int) -> tuple[int, str, tuple[str, ...]] | None:
        found = []
        if i == len(rows) and place in "na":
            found.append((0, "", ()))
        if inserted < 2 and (rest := best(i, roles[place], inserted + 1)):
            found.append((rest[0] + 2, "I" + rest[1], (names[roles[place]] + ":", *rest[2])))
        if i < len(rows):
            _, role, text = rows[i]
            if rest := best(i + 1, place, 0):
                found.append((rest[0] + 3, "D" + rest[1], rest[2]))
            if faults[i] not in ("blank", "duplicate"):
                cut = faults[i] == "truncated"
                if (role[:1] == "s" and place == "n" or role[:1] == roles[place]) and (rest := best(i + 1, role[0], 0)):
                    found.append((rest[0] + cut, "K" + rest[1], (f"{role}:{text}", *rest[2])))
                if rest := best(i + 1, roles[place], 0):
                    found.append((rest[0] + 2 + cut, "R" + rest[1], (f"{names[roles[place]]}:{text}", *rest[2])))
        return min(found, default=None)

    cost, audit, lines = best(0, "n", 0)
    turns = [t for t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:], strict=False))
    return gaps, *(faults.count(f) for f in ("blank", "duplicate", "truncated")), illegal, cost, audit, sha("\n".join(lines)), lines


def test_repairs_against_all_edits(spark):
    rng = random.Random(13)
    rows = []
    for conv in [*range(150), None]:
        for turn in range(rng.randint(0, 7)):
            role = rng.choice(["system", "user", "user", "assistant", "assistant", "tool", "", None])
            rows.append((conv, rng.choice([turn, turn, turn, None, turn * 5]), role, rng.choice(["Hi.", "So", " \n", "", "A? ", None, f"t{turn}!", "Hi."])))
    conv = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumns({"k": F.lit("x"), "pos": F.lit(1), "phase": F.lit(2), "gone": F.lit("clash"), "kind": F.lit(3)})
    got = {r["conv_id"]: tuple(r)[1:] for r in conversation_repair.repair_report(conv).collect()}
    expected = {c: plain_repair([r[1:] for r in rows if r[0] == c]) for c in {r[0] for r in rows}}
    assert got == {c: x[:-1] for c, x in expected.items()}
    turns: dict = {}
    for r in sorted(conversation_repair.repaired_turns(conv).collect(), key=lambda r: r["place"]):
        turns.setdefault(r["conv_id"], []).append(f"{r['role']}:{r['text']}")
    assert turns == {c: list(x[-1]) for c, x in expected.items() if x[-1]}
    assert conversation_repair.repair_report(conv.filter("conv_id > 999")).count() == 0


def test_damage_by_hand(spark):
    rows = [(c, t, r, x) for c in range(40) for t, (r, x) in enumerate([("system", "Be. Good!"), ("user", "Why?"), (None, None), ("assistant", "So. It is")])] + [(None, None, "user", "Hm.")]
    made = conversation_repair.damaged(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    expected = []
    for c, t, role, text in rows:
        role, text = role or " ", text or " "
        m = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        text = "" if m == 1 else "".join(x for x in text if x not in ".!?") if m == 2 else text
        expected += [(c, t, "user" if m == 4 else role, text, m == 0)] * (2 if m == 3 else 1)
    assert sorted(map(tuple, made.collect()), key=str) == sorted(expected, key=str)
    report = {r["conv_id"]: r for r in conversation_repair.repair_report(made, gone="gone").collect()}
    assert set(report) == {*range(40), None}


def test_a_conversation_that_is_gone(spark):
    rows = spark.createDataFrame([(1, 0, "user", "Hi.", True), (2, 0, "user", "Hi.", None)], "conv_id long, turn long, role string, text string, gone boolean")
    got = {r["conv_id"]: tuple(r)[1:] for r in conversation_repair.repair_report(rows, gone="gone").collect()}
    assert got[1] == (0, 0, 0, 0, 0, 0, "", sha("")) and got[2][5:7] == (2, "KI")


def test_a_giant_conversation_is_streamed(spark, monkeypatch):
    """Far more turns than a batch has; and backpointers that wait in a file come back in reverse."""
    n = 20_001
    rows = spark.range(n).select(F.lit(1).alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") % 2 == 0, "user").otherwise("assistant").alias("role"), F.concat(F.lit("t"), "id", F.lit(".")).alias("text"))
    (got,) = conversation_repair.repair_report(rows.repartition(6)).collect()
    lines = [f"{'assistant' if i % 2 else 'user'}:t{i}." for i in range(n)] + ["assistant:"]
    assert got["cost"] == 2 and got["audit"] == "K" * n + "I" and got["repaired_sha256"] == sha("\n".join(lines))
    monkeypatch.setattr(conversation_repair, "HELD", 10)
    kept = conversation_repair._Bytes()
    for i in range(57):
        kept.add(i)
    assert list(reversed(kept)) == list(range(56, -1, -1)) and kept.blocks == 5
