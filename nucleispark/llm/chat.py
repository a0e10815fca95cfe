"""Chat formatting with cumulative-snapshot collapse.

Logs hold a conversation again and again as it grows. Each turn gets a rolling hash of all turns up to it; a
conversation whose whole hash is the hash of a proper prefix of another one is a snapshot of that one. Prefixes and whole
conversations are made distinct before they meet in the anti-join, so a prefix that a third of all logs share is one row
there. What remains, one of each set of equal conversations, is rendered.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

START, END = "<|im_start|>", "<|im_end|>"


def rolling(conversations: DataFrame, *, id: str, turn: str, role: str, text: str) -> DataFrame:
    """(id, pos, role, text, hash): place in the conversation from 1 on and the hash of all turns up to it.

    The hash is the exclusive-or of two 64-bit hashes of each (place, role, text), so a running window gives it.
    Turns go by (turn, role, text), nulls first; null ids are no conversation.
    """
    rows = conversations.select(F.col(id).alias("id"), F.col(turn).alias("turn"), F.col(role).alias("role"), F.col(text).alias("text")).filter("id is not null")
    order = Window.partitionBy("id").orderBy("turn", "role", "text")
    rows = rows.withColumn("pos", F.row_number().over(order))
    upto = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    own = lambda seed: F.xxhash64(F.lit(seed), "pos", F.col("role").isNull(), "role", F.col("text").isNull(), "text")
    return rows.select("id", "pos", "role", "text", F.struct(*(F.bit_xor(own(s)).over(upto).alias(f"h{s}") for s in (1, 2))).alias("hash"))


def maximal(turns: DataFrame) -> DataFrame:
    """(id, n_turns, n_copies) of the conversations that are no proper prefix of another; of equal ones the least id."""
    sizes = turns.groupBy("id").agg(F.max("pos").alias("n"), F.max_by("hash", "pos").alias("hash"))
    whole = sizes.groupBy("n", "hash").agg(F.min("id").alias("id"), F.count("*").alias("n_copies"))
    inner = turns.withColumn("n", F.max("pos").over(Window.partitionBy("id"))).filter("pos < n").select(F.col("pos").alias("n"), "hash").distinct()
    return whole.join(inner, ["n", "hash"], "left_anti").select("id", F.col("n").alias("n_turns"), "n_copies")


def rendered(role: Column, text: Column) -> Column:
    return F.concat(F.lit(START), F.coalesce(role, F.lit("")), F.lit("\n"), F.coalesce(text, F.lit("")), F.lit(END + "\n"))


def format_chats(conversations: DataFrame, *, id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """One row per maximal conversation: id, n_turns, n_copies (equal ones, itself included) and chat, its turns rendered in order.

    Null roles and texts are rendered empty but differ from empty ones. Repeated rows are turns of their own. An empty
    table gives no rows. Other columns are not looked at. The chat is one string, so a single conversation must fit a row.
    """
    turns = rolling(conversations, id=id, turn=turn, role=role, text=text)
    kept = turns.join(maximal(turns), "id")
    chat = F.concat_ws("", F.transform(F.array_sort(F.collect_list(F.struct("pos", rendered(F.col("role"), F.col("text")).alias("t")))), lambda s: s["t"]))
    return kept.groupBy("id", "n_turns", "n_copies").agg(chat.alias("chat")).withColumnRenamed("id", id)
