"""A training corpus from raw documents: five stages, each an operator of `nucleispark.llm`.

Every stage takes (spark, docs, sf_dir) and judges all documents that the one before it kept; an empty table stays empty. All but
the last return the columns of documents, extra ones of any name too; the last returns ids and tokens. Between stages rows are
written as Parquet and read again.
"""

from __future__ import annotations

import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from nucleispark.llm import bpe, decontaminate, language, near_duplicates, queries, substring_dedup
from nucleispark.llm._carry import map_column
from nucleispark.session import on_workers, read, shared_folder


def _slim(docs: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """The documents with columns c0, c1, .. and the new names of the old ones, so that no name clashes with an operator's."""
    on_workers(docs.sparkSession)
    new = {c: f"c{i}" for i, c in enumerate(docs.columns)}
    return docs.toDF(*new.values()), new


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language the model names with enough confidence. Null texts and texts without letters go."""
    slim, at = _slim(docs)
    known = slim.select(*(F.col(at[c]).alias(c) for c in ("doc_id", "text", "lang")))
    model = language.train(language.learnable(known))
    return language.identify(slim, model, text=at["text"], keep=tuple(slim.columns)).filter("not rejected").select(*slim.columns).toDF(*docs.columns)


def near_duplicate_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of near duplicates one row: that of the least id, and of rows that share it, of the least hash of the text.

    Null, empty and wordless texts are in no class and stay; so do rows with a null id.
    """
    slim, at = _slim(docs)
    row = F.when(F.col(at["doc_id"]).isNotNull(), F.struct(F.col(at["doc_id"]).alias("id"), F.xxhash64(F.col(at["text"])).alias("text_key")))
    slim = slim.withColumn("row", row)
    judged = near_duplicates.near_duplicates(slim, id="row", text=at["text"]).filter("row is not null and n_links > 0")
    marks = judged.groupBy("row").agg(F.first(F.col("class_id") == F.col("row")).alias("head"), F.count("*").alias("n")).filter("not head or n > 1")
    marked = slim.join(marks, "row", "left")
    repeated = marked.filter("head").dropDuplicates(["row"])
    return marked.filter("head is null").unionByName(repeated).select(*at.values()).toDF(*docs.columns)


def substring_deduplication(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that an earlier one has; those of which no word is left go. n_chars follows the text.

    Rows that share an id are told apart by their texts. Texts without such a passage stay as they are, null and empty ones too,
    and so do rows with a null id.
    """
    slim, at = _slim(docs)
    found = substring_dedup.repeated_passages(slim.select(F.col(at["doc_id"]).alias("doc_id"), F.col(at["text"]).alias("text")))
    spans = found.groupBy(F.col("doc_id").alias("id"), "text_key").agg(F.collect_set(F.struct("start_word", "end_word")).alias("spans"))
    joined = slim.join(spans, (slim[at["doc_id"]] == spans["id"]) & (F.xxhash64(slim[at["text"]]) == spans["text_key"]), "left")
    cut = map_column(joined.withColumn("x", F.struct(F.col(at["text"]).alias("text"), "spans")), "x", slim.columns, "left string", lambda x: [_cut(x)])
    cut = cut.filter(F.col("left").isNull() | F.regexp_like("left", F.lit(r"[0-9A-Za-z\x{80}-\x{10FFFF}]")))
    changed = {at["text"]: F.coalesce("left", F.col(at["text"]))} | ({at["n_chars"]: F.coalesce(F.length("left").cast("long"), F.col(at["n_chars"]))} if "n_chars" in at else {})
    return cut.select(*(changed.get(c, F.col(c)).alias(c) for c in slim.columns)).toDF(*docs.columns)


def _cut(x: pa.Array) -> pa.Array:
    """What is left of the texts with spans; null where there are none."""
    spans = [[(s["start_word"], s["end_word"]) for s in r or ()] for r in x.field("spans").to_pylist()]
    with_spans = [i for i, s in enumerate(spans) if s]
    left = dict(zip(with_spans, substring_dedup.without_spans(x.field("text").take(pa.array(with_spans, pa.int64())), [spans[i] for i in with_spans]), strict=True))
    return pa.array([left.get(i) for i in range(len(spans))], pa.string())


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no window of a benchmark item: all with null or empty texts, and each of repeated rows. No items: all."""
    slim, at = _slim(docs)
    rest = [c for c in slim.columns if c != at["doc_id"]]
    judged = decontaminate.decontaminate(slim, read(spark, sf_dir, "benchmark"), id=at["doc_id"], text=at["text"], keep=rest)
    return judged.filter(F.size("hit_spans") == 0).select(*slim.columns).toDF(*docs.columns)


def bpe_encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each row's id, token ids and their number, with hashes of the ids and of the text decoded from them; all other columns go.
    Null and empty texts have no tokens; repeated rows stay."""
    on_workers(spark)
    return bpe.encode(docs, queries.tokenizer_path()).drop("decoded")


STAGES = [
    ("language_id", language_id),
    ("near_duplicates", near_duplicate_join),
    ("substring_dedup", substring_deduplication),
    ("decontamination", benchmark_decontamination),
    ("bpe", bpe_encoding),
]
#: SQL can't express training, passages or merges; tests hold the operators against brute-force versions or held-out accuracy, and
#: the stages against planted cases.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`. Stage results go to the session's spark.checkpoint.dir (see `session.shared_folder`)."""
    on_workers(spark)
    folder = f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
