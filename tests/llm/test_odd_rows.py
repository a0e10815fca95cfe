"""Repeated rows and very long values in the operators' tables."""

from __future__ import annotations

from pyspark.sql import functions as F
from test_llm_operators import DOCS

from nucleispark.llm import bpe, chat, decontaminate, html_text, queries, url_filter

LONG = "word " * 60_000


def test_chats_with_repeated_turns_and_a_very_long_one(spark):
    rows = [(1, 0, "user", LONG), (1, 1, "assistant", "b"), (2, 0, "user", LONG), (3, 0, "user", "x"), (3, 0, "user", "x"), (4, 0, "user", "x")]
    got = {r["conv_id"]: r for r in chat.format_chats(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()}
    assert set(got) == {1, 3} and len(got[1]["chat"]) > len(LONG) and got[3]["n_turns"] == 2  # a repeated row is a turn of its own


def test_urls_that_repeat_or_are_very_long(spark):
    long = "https://a.example.com/en/" + "x" * 200_000 + "?q=" + "y" * 100_000
    rows = [(1, long), (2, long), (2, long), (3, None), (3, None), (4, "no scheme"), (5, "ftp://EXAMPLE.com/en/z#t"), (6, "http://")]
    got = sorted(((r["page_id"], r["host"], len(r["path"]), r["rule"], r["verdict"]) for r in url_filter.filter_urls(spark.createDataFrame(rows, "page_id long, url string"), queries.RULES).collect()), key=str)
    own, none = ("a.example.com", 200_004, "example.com/en/", "block"), ("", 0, None, "allow")
    assert got == [(1, *own), (2, *own), (2, *own), (3, *none), (3, *none), (4, *none), (5, "example.com", 5, "example.com/en/", "block"), (6, *none)]


def test_repeated_documents_are_decontaminated_alike(spark):
    item = "one two three four five six seven eight nine ten eleven"
    docs = spark.createDataFrame([(1, f"{LONG} {item} end", "en", "s", 1)] * 2 + [(2, item, "en", "s", 1), (None, item, None, None, None)], DOCS)
    benchmark = spark.createDataFrame([(7, item), (7, item), (8, None)], "item_id long, text string")
    got = sorted(((r["doc_id"] or 0, r["n_hit"], r["n_items"]) for r in decontaminate.digest(decontaminate.decontaminate(docs, benchmark)).collect()))
    assert got == [(0, 11, 1), (1, 11, 1), (1, 11, 1), (2, 11, 1)]


def test_repeated_documents_are_encoded_alike(spark):
    docs = spark.createDataFrame([(1, "A cat, again."), (1, "A cat, again."), (2, LONG), (2, None)], "doc_id long, text string")
    got = sorted(((r["doc_id"], r["n_tokens"], r["ids_sha256"]) for r in bpe.encode(docs, queries.tokenizer_path(), arrays=False).collect()))
    assert got[0] == got[1] and [g[1] for g in got[2:]] == sorted([0, 60_000])


def test_repeated_and_very_long_pages(spark):
    page = f"<body><nav>Menu</nav><article><h1>Head</h1><p>{LONG}</p></article></body>"
    rows = [(1, "http://h/1", page), (1, "http://h/1", page), (2, None, page), (3, "http://h/2", None)]
    got = sorted((r["page_id"], r["n_chars"]) for r in html_text.extract(spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", F.lit("clash"))).collect())
    n = len("Head\n\n") + len(LONG.strip())
    assert got == [(1, n), (1, n), (2, n), (3, 0)]
