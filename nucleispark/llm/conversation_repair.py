"""Repair of conversations: the cheapest edits that leave an optional system turn and then user and assistant in turn.

A turn may stay (K), change its role to user or assistant (R, 2) or go (D, 3; blank and repeated ones must), an empty turn of
a user or assistant may come in anywhere (I, 2), and a truncated turn that isn't deleted costs 1. Rows are dealt by
conversation and each is sent to its task twice: the turns' faults, last turn first, and then the turns themselves in order.
mapInArrow reads this stream with one small state: over the faults, backwards, the cost of the cheapest rest from each of the
four places in the grammar, leaving one byte a turn with the first edit of each; over the turns it follows these bytes. Neither
a conversation nor its texts are ever held; the bytes of a giant one go to a temporary file of the task.
"""

from __future__ import annotations

import hashlib
import tempfile
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Bytes of backpointers that are held at a time; further ones wait in a temporary file.
HELD = 1 << 20
_SPACE = " \t\n\x0b\x0c\r"
# Places in the grammar: nothing yet, after the system, the user, the assistant. What comes next, and its role.
_START, _SYSTEM, _USER, _ASSISTANT = range(4)
_NEXT = (_USER, _USER, _ASSISTANT, _USER)
_ROLE = ("", "", "user", "assistant")
#: Cost of the rest where no turn is left; user and system still need empty turns.
_END = (0, 4, 2, 0)
_LETTERS = "DIKR"  # in the order that breaks ties


def damaged(rows: DataFrame, *, id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(id, turn, role, text, gone): the conversations with faults by crc32 of `id:turn` modulo 20: 0 the row is gone, 1 its text empty, 2 without
    `.!?`, 3 there twice, 4 of role user. Null roles and texts are one space, as is a null in what is hashed. Gone rows keep a mark."""
    shown = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    fault = F.crc32(F.concat(shown(id), F.lit(":"), shown(turn)).cast("binary")) % 20
    said = F.when(fault == 1, F.lit("")).when(fault == 2, F.translate(shown(text), ".!?", "")).otherwise(shown(text))
    own = rows.select(F.col(id), F.col(turn), F.when(fault == 4, F.lit("user")).otherwise(shown(role)).alias(role), said.alias(text), (fault == 0).alias("gone"), F.when(fault == 3, 2).otherwise(1).alias("_n"))
    return own.withColumn("_n", F.explode(F.sequence(F.lit(1), "_n"))).drop("_n")


@lru_cache(maxsize=4096)
def _step(kind: int, rest: tuple[int, ...]) -> tuple[int, int, tuple[int, ...]]:
    """Before a turn of that kind, given the costs of what follows it from each place: the first edits of the four places as one byte,
    the least cost, and the costs beyond it. kind: 1 if it must go, 2 if truncated, and 4, 8 or 12 for the initials s, u, a."""
    after = {(4, _START): _SYSTEM, (8, _START): _USER, (8, _SYSTEM): _USER, (8, _ASSISTANT): _USER, (12, _USER): _ASSISTANT}
    extra, options = kind >> 1 & 1, []
    for q in range(4):
        own = [3 + rest[q], None, None, None]
        if not kind & 1:
            to = after.get((kind & 12, q))
            own[2] = None if to is None else extra + rest[to]
            own[3] = 2 + extra + rest[_NEXT[q]]
        options.append(own)
    least = [min(x for x in own if x is not None) for own in options]
    # An inserted turn leads to the next place before the same turn; two of them lead back and never pay, but after the system.
    full = least[:]
    for q in (_USER, _ASSISTANT, _START, _SYSTEM):
        source = least if q in (_USER, _ASSISTANT) else full
        options[q][1] = 2 + source[_NEXT[q]]
        full[q] = min(least[q], options[q][1])
    byte = sum(options[q].index(full[q]) << 2 * q for q in range(4))
    low = min(full)
    return byte, low, tuple(x - low for x in full)


class _Bytes:
    """Bytes that are written forwards and read backwards, at most about HELD of them in memory."""

    def __init__(self):
        self.tail, self.file, self.blocks = bytearray(), None, 0

    def add(self, byte: int) -> None:
        self.tail.append(byte)
        if len(self.tail) == HELD:
            self.file = self.file or tempfile.TemporaryFile()  # noqa: SIM115 - closed in __reversed__ or when the task ends
            self.file.seek(self.blocks * HELD)
            self.file.write(self.tail)
            self.blocks += 1
            self.tail = bytearray()

    def __reversed__(self) -> Iterator[int]:
        yield from reversed(self.tail)
        for i in range(self.blocks - 1, -1, -1):
            self.file.seek(i * HELD)
            yield from reversed(self.file.read(HELD))
        if self.file is not None:
            self.file.close()


class _Conversation:
    """The state of one conversation between batches."""

    def __init__(self):
        self.bytes, self.rest, self.cost, self.n = _Bytes(), _END, 0, 0
        self.back: Iterator[int] | None = None
        self.place, self.edits, self.written = _START, [], 0
        self.hash = hashlib.sha256()
        self.faults = [0, 0, 0]
        self.illegal, self.previous = 0, None
        self.low = self.high = self.turn = None
        self.turns = 0

    def fault(self, kind: int) -> None:
        """The faults of a turn, the last turn first."""
        byte, low, self.rest = _step(kind, self.rest)
        self.cost += low
        self.bytes.add(byte)

    def _write(self, role: str, text: str) -> tuple[int, str, str]:
        self.hash.update(f"{chr(10) * (self.written > 0)}{role}:{text}".encode())
        self.written += 1
        return self.written, role, text

    def _insert(self) -> tuple:
        self.place = _NEXT[self.place]
        self.edits.append("I")
        return (*self._write(_ROLE[self.place], ""), "I")

    def say(self, turn: int | None, role: str, text: str, fault: int) -> Iterator[tuple]:
        """A turn in order; gives the repaired turns (place, role, text, edit) up to it."""
        if self.back is None:
            self.back = reversed(self.bytes)
        if fault:
            self.faults[fault - 1] += 1
        if turn is not None:
            self.low, self.high = turn if self.low is None else self.low, turn
            self.turns += turn != self.turn
            self.turn = turn
        if self.previous is not None:
            self.illegal += self.previous + role[:1] not in ("su", "ua", "au")
        self.previous = role[:1]
        byte = next(self.back)
        while (letter := _LETTERS[byte >> 2 * self.place & 3]) == "I":
            yield self._insert()
        self.edits.append(letter)
        if letter == "D":
            return
        if letter == "K":
            self.place = {"s": _SYSTEM, "u": _USER, "a": _ASSISTANT}[role[:1]]
        else:
            self.place = _NEXT[self.place]
            role = _ROLE[self.place]
        yield (*self._write(role, text), letter)

    def end(self) -> Iterator[tuple]:
        while self.place in (_SYSTEM, _USER):
            yield self._insert()

    def report(self) -> tuple:
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.turns
        return gaps, *self.faults, self.illegal, self.cost + self.rest[_START], "".join(self.edits), self.hash.hexdigest()


_REPORT = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
_TURNS = "place long, role string, text string, edit string"


def _stream(rows: DataFrame, id: str, turn: str, role: str, text: str, gone: str | None) -> DataFrame:
    """(k, phase, turn, role, text, kind, fault): each conversation's faults, last turn first, then its turns; by conversation in one
    partition, in order. Gone rows come in phase 0 without a kind."""
    plain = lambda c: F.coalesce(F.col(c), F.lit(" "))
    lost = F.coalesce(F.col(gone), F.lit(False)) if gone else F.lit(False)
    own = rows.select(F.col(id).alias("k"), F.col(turn).cast("long").alias("turn"), plain(role).alias("role"), plain(text).alias("text"), lost.alias("gone")).repartition("k")
    said = F.md5(F.concat(F.octet_length("role").cast("string"), F.lit(":"), "role", "text").cast("binary"))
    own = own.withColumn("pos", F.row_number().over(Window.partitionBy("k", "gone").orderBy("turn", "role", "text"))).withColumn("said", said)
    again = F.row_number().over(Window.partitionBy("k", "gone", "said").orderBy("pos")) > 1
    cut = F.rtrim("text", F.lit(_SPACE))
    fault = F.when(cut == "", 1).when(again, 2).when(~F.right(cut, F.lit(1)).isin(".", "!", "?"), 3).otherwise(0)
    initial: Column = F.coalesce(F.try_element_at(F.create_map(*(F.lit(x) for pair in (("s", 4), ("u", 8), ("a", 12)) for x in pair)), F.left("role", F.lit(1))), F.lit(0))
    kind = F.when(~F.col("gone"), initial + F.when(F.col("fault").isin(1, 2), 1).when(F.col("fault") == 3, 2).otherwise(0))
    own = own.withColumn("fault", fault).withColumn("kind", kind)
    none = F.lit(None)
    first = F.struct(F.lit(0).alias("phase"), (-F.col("pos")).alias("at"), none.cast("long").alias("turn"), none.cast("string").alias("role"), none.cast("string").alias("text"), "kind", "fault")
    second = F.struct(F.lit(1).alias("phase"), F.col("pos").alias("at"), "turn", "role", "text", "kind", "fault")
    twice = own.select("k", F.inline(F.when(F.col("gone"), F.array(first)).otherwise(F.array(first, second))))
    return twice.sortWithinPartitions("k", "phase", "at").drop("at")


def _run(rows: DataFrame, id: str, turn: str, role: str, text: str, gone: str | None, turns: bool) -> DataFrame:
    stream = _stream(rows, id, turn, role, text, gone)
    key = stream.schema["k"].dataType.simpleString()
    ddl = f"k {key}, {_TURNS if turns else _REPORT}"
    names = [x.split()[0] for x in ddl.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, key, kind = None, None, None
        for batch in batches:
            out: list[tuple] = []
            kind = batch.schema.field("k").type
            for k, phase, at, who, what, code, fault in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if now is None or k != key:
                    if now is not None:
                        last = [(key, *x) for x in now.end()]
                        out += last if turns else [(key, *now.report())]
                    now, key = _Conversation(), k
                if phase == 0:
                    if code is not None:
                        now.fault(code)
                else:
                    made = [(key, *x) for x in now.say(at, who, what, fault)]
                    out += made if turns else []
            yield _batch(out, kind, turns, names)
        if now is not None:
            last = [(key, *x) for x in now.end()]
            yield _batch(last if turns else [(key, *now.report())], kind, turns, names)

    return stream.mapInArrow(run, ddl).withColumnRenamed("k", id)


def _batch(rows: list[tuple], key: pa.DataType, turns: bool, names: list[str]) -> pa.RecordBatch:
    kinds = [key, *([pa.int64(), pa.string(), pa.string(), pa.string()] if turns else [*[pa.int64()] * 6, pa.string(), pa.string()])]
    columns = zip(*rows, strict=True) if rows else [[] for _ in kinds]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)


def repaired_turns(rows: DataFrame, *, id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", gone: str | None = None) -> DataFrame:
    """(id, place from 1 on, role, text, edit K, R or I): the turns of the repaired conversations. Rows as for repair_report."""
    return _run(rows, id, turn, role, text, gone, True)


def repair_report(rows: DataFrame, *, id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", gone: str | None = None) -> DataFrame:
    """One row per conversation: id, gaps (missing turn numbers), rows by their first fault (blank; duplicate: role and text seen before;
    truncated: no end mark), illegal neighbours, cost, audit (the cheapest edits, of equal ones the least in ASCII) and the
    sha256 of the repaired `role:text` lines.

    Turns go by number, nulls first, then role and text; null roles and texts are one space. Rows of a null id are one
    conversation. Repeated rows are turns. A conversation whose rows are all marked in the column `gone` has zeros and the
    empty hash. An empty table gives no rows; other columns are not looked at. One conversation is one task's stream.
    """
    return _run(rows, id, turn, role, text, gone, False)
