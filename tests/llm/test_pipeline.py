"""The stages on a small corpus with planted cases."""

from __future__ import annotations

import random

from pyspark.sql import functions as F

import corpus_pipeline
from nucleispark.llm import queries
from test_llm_operators import DOCS, planted, prose, split


def test_stages_do_what_they_decide(spark, tmp_path):
    rng = random.Random(12)
    base = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").filter("length(text) > 300").limit(60).collect()
    rows = [(r["doc_id"], r["text"], r["lang"], r["source"], r["n_chars"]) for r in base]
    clean = {r[0] for r in rows}
    passage, item = prose(rng, 60), prose(rng, 25)
    near = prose(rng, 200).split()
    rows += [(10_000, " ".join(near), "en", "s", 1), (10_001, " ".join([*near[:100], "other", *near[101:]]), "en", "s", 1), (10_002, " ".join(near), "en", "s", 1)]
    before, after = prose(rng, 90), prose(rng, 5)
    rows += [(10_010, f"{prose(rng, 80)} {passage}", "en", "s", 1), (10_011, f"{before} {passage} {after}", "en", "s", 1), (10_012, passage, "en", "s", 1)]
    rows += [(10_020, f"{prose(rng, 50)} {item} {prose(rng, 50)}", "en", "s", 1), (10_030, None, None, None, None), (10_031, "", "en", "s", 0), (10_032, "12 34", "en", "s", 5)]
    folder = str(tmp_path)
    docs = spark.createDataFrame(rows, DOCS).withColumns({"score": F.lit("clash"), "__lang": F.lit(1)})
    docs.write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(1, item), (2, None)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    now, ids, texts = spark.read.parquet(f"{folder}/documents.parquet"), [], {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, now, folder)
        assert out.columns == docs.columns, name
        out.write.parquet(f"{folder}/{name}")
        now = spark.read.parquet(f"{folder}/{name}")
        found = now.collect()
        ids.append({r["doc_id"] for r in found})
        texts = {r["doc_id"]: r for r in found}
    assert not ids[0] & {10_030, 10_031, 10_032} and {10_000, 10_001, 10_002, 10_010, 10_020} <= ids[0]
    assert 10_000 in ids[1] and not ids[1] & {10_001, 10_002}
    assert 10_010 in ids[2] and 10_012 not in ids[2] and split(texts[10_011]["text"]) == split(before) + split(after)
    assert texts[10_011]["n_chars"] == len(texts[10_011]["text"])
    assert 10_020 not in ids[3] and ids[2] - ids[3] == {10_020}
    assert len(ids[3] & clean) > 0.7 * len(clean)
    last = corpus_pipeline.run(spark, folder).collect()
    assert {r["doc_id"] for r in last} == ids[3] and all(r["n_tokens"] == len(r["token_ids"]) for r in last)
    assert corpus_pipeline.ORACLE_SQL is None and "pipeline" in queries.QUERIES
    assert planted(random.Random(1))[1]


def test_stages_tell_rows_of_one_id_apart(spark):
    rng = random.Random(13)
    passage, near, alone = prose(rng, 80), prose(rng, 120), prose(rng, 150)
    a, b = f"{passage} {prose(rng, 60)}", prose(rng, 200)
    rows = [(1, f"{prose(rng, 40)} {passage}"), (2, a), (2, b), (2, b), (3, near), (3, near), (3, near + " more"), (4, near), (5, alone), (5, alone), (None, near), (None, None), (6, ""), (6, "")]
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], DOCS)
    kept = corpus_pipeline.near_duplicate_join(spark, docs, "").collect()
    assert sorted((r["doc_id"] or 0, r["text"] or "") for r in kept if r["doc_id"] not in (3,)) == sorted([(0, near), (0, ""), (1, rows[0][1]), (2, a), (2, b), (5, alone), (6, ""), (6, "")])
    assert sum(r["doc_id"] == 3 for r in kept) == 1
    left = corpus_pipeline.substring_deduplication(spark, docs, "").collect()
    assert [split(r["text"]) for r in left if r["doc_id"] == 2 and split(r["text"])[0] != split(b)[0]] == [split(a)[80:]]
    assert sum(r["text"] == b for r in left) == 2 and sum(r["text"] == "" for r in left) == 2 and sum(r["text"] is None for r in left) == 1


def test_stages_of_empty_tables(spark, tmp_path):
    folder = str(tmp_path)
    docs = spark.createDataFrame([], DOCS)
    docs.write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, folder).count() == 0
    assert corpus_pipeline.run(spark, folder).count() == 0
