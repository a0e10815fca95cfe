"""The queries of this subpackage and, where SQL can express them, their DuckDB counterparts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from nucleispark.llm import bpe, chat, conversation_repair, decontaminate, html_text, language, merkle, near_duplicates, oracles, quality, substring_dedup, token_counts, transport, url_filter
from nucleispark.llm._text import modulus_of_id
from nucleispark.session import on_workers, read

RULES = (("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"), ("block", "net", "/es/"), ("block", "net", "/fr/"))


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.format_chats(read(spark, sf_dir, "conversations"))


def op2_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.filter_urls(read(spark, sf_dir, "pages"), RULES).withColumn("mined_tokens", F.concat_ws(" ", "mined_tokens")).withColumn("confidence", F.round("confidence", 9))


def op3_media_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    media = transport.to_media(read(on_workers(spark), sf_dir, "documents"))
    return transport.read_media(media).select("doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature", "lost", "random_access")


def op4_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates.near_duplicates(read(on_workers(spark), sf_dir, "documents"))


def op5_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(read(on_workers(spark), sf_dir, "pages"))


def op6_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, benchmark = read(on_workers(spark), sf_dir, "documents", "benchmark")
    return decontaminate.digest(decontaminate.decontaminate(docs, benchmark))


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = read(on_workers(spark), sf_dir, "documents", "labels")
    scored = quality.score(docs, quality.train(docs, quality.learnable(labels)))
    return scored.select("doc_id", (modulus_of_id("doc_id", 5) == 0).alias("held_out"), "score", (F.col("score") >= quality.LEVEL).cast("int").alias("predicted"))


def op8_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode(read(on_workers(spark), sf_dir, "documents"), tokenizer_path(), arrays=False)


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(on_workers(spark), sf_dir, "documents")
    found = language.identify(docs, language.train(language.learnable(docs)))
    return found.select("doc_id", (modulus_of_id("doc_id", 3) == 1).alias("held_out"), "lang_pred", "score", "rejected")


def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.repeated_passages(read(on_workers(spark), sf_dir, "documents"))


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = ("doc_id", "source", "lang", "n_chars", "text")
    tampered = [F.replace("text", F.lit("\n"), F.lit("")) if c == "text" else F.col(c) for c in columns]
    even = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    return merkle.manifest(read(on_workers(spark), sf_dir, "documents"), columns, id="doc_id", tree="source", tampered=tampered, when=even)


def op12_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(read(on_workers(spark), sf_dir, "documents"), tokenizer_path("piece_bpe_32k.model"))


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_repair.repair_report(conversation_repair.damaged(read(on_workers(spark), sf_dir, "conversations")), gone="gone")


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    from corpus_pipeline import run

    return run(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_chat_formatting, op2_url_filters, op3_media_columns, op4_ngram_jaccard_join, op5_html_extraction, op6_benchmark_decontamination, op7_quality, op8_bpe, op9_language_id, op10_substring_dedup, op11_merkle_manifest, op12_token_counts,
        op13_conversation_repair, pipeline,
    )
}
ORACLES = oracles.ORACLES
