"""Token counts under a sentencepiece BPE vocabulary, with a shortcut for whole tokens.

Spaces become U+2581 and one stands before the text. No piece of the vocabulary goes over some borders (a space sign after
another sign, a line feed), and a merge can't either, so pre-tokens between such borders are counted apart. Which
vocabulary strings come out of the merges as one token is proven beforehand, on the driver, by merging each of them; a
pre-token that is one of those counts as 1 without a merge. The rest is cut once more where no piece holds the two
neighbouring characters side by side, and merged: the pair whose piece has the highest score first, of equal ones the leftmost.
Short pre-tokens of a batch are merged together in one flat array.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nucleispark.llm._text import chunks, utf8

SPACE = "▁"
LIMIT = 4096
#: Strings whose counts a worker remembers, and the longest of them in characters.
REMEMBERED, LONGEST = 500_000, 64
_PRE_TOKENS = regex.compile(f"{SPACE}({SPACE}*[^{SPACE}\n]*)|(\n[^{SPACE}\n]*)")


class Pieces:
    """Scores of a sentencepiece BPE model's pieces, and what follows from them."""

    def __init__(self, path: str):
        from sentencepiece import sentencepiece_model_pb2 as pb

        model = pb.ModelProto()
        with open(path, "rb") as f:
            model.ParseFromString(f.read())
        kind, how = pb.ModelProto.SentencePiece, model.normalizer_spec
        plain = not how.precompiled_charsmap and how.add_dummy_prefix and how.escape_whitespaces and not how.remove_extra_whitespaces
        if model.trainer_spec.model_type != pb.TrainerSpec.BPE or not plain or model.trainer_spec.treat_whitespace_as_suffix or any(p.type in (kind.UNUSED, kind.USER_DEFINED) for p in model.pieces):
            raise ValueError("the model must be a BPE model without normalization, unused or user-defined pieces")
        self.score = {p.piece: p.score for p in model.pieces if p.type == kind.NORMAL}
        self.bytes = any(p.type == kind.BYTE for p in model.pieces)
        self.joined = {a + b for p in self.score for a, b in zip(p, p[1:], strict=False)}
        if any(SPACE in p.lstrip(SPACE) for p in self.score) or any("\n" in p for p in self.joined):
            raise ValueError("pieces of the model go over spaces or line feeds")
        names = [*self.score, *sorted({c for p in self.score for c in p} - self.score.keys())]
        number = {p: i for i, p in enumerate(names)}
        level = {s: i for i, s in enumerate(sorted(set(self.score.values()), reverse=True))}
        pairs = sorted((number[p[:i]] << 32 | number[p[i:]], level[s], number[p]) for p, s in self.score.items() for i in range(1, len(p)) if p[:i] in number and p[i:] in number)
        self.keys, self.rank, self.made = (np.array(x, np.int64) for x in zip(*pairs, strict=True))
        # Symbols of characters: their numbers, or else one of four after them by UTF-8 length. What each symbol counts in the end.
        self.of_code = len(names) + np.digitize(np.arange(0x110000), [0x80, 0x800, 0x10000])
        for c in names:
            if len(c) == 1:
                self.of_code[ord(c)] = number[c]
        self.weight = np.array([1 if p in self.score else len(p.encode()) for p in names] + [1, 2, 3, 4])

    def merge(self, text: str) -> list[str]:
        """The symbols that the merges leave of a text."""
        symbols: list[str] = list(text)
        n = len(symbols)
        before, after = list(range(-1, n - 1)), [*range(1, n), -1]
        score, heap = self.score, []

        def push(a: int, b: int) -> None:
            piece = symbols[a] + symbols[b]
            s = score.get(piece)
            if s is not None:
                heapq.heappush(heap, (-s, a, b, len(piece)))

        for i in range(n - 1):
            push(i, i + 1)
        while heap:
            _, a, b, size = heapq.heappop(heap)
            if not symbols[a] or not symbols[b] or after[a] != b or len(symbols[a]) + len(symbols[b]) != size:
                continue
            symbols[a] += symbols[b]
            symbols[b] = ""
            after[a] = after[b]
            if after[b] >= 0:
                before[after[b]] = a
                push(a, after[b])
            if before[a] >= 0:
                push(before[a], a)
        return [s for s in symbols if s]

    def count(self, text: str) -> int:
        """Tokens of a text without cuts; a character that is no piece counts its bytes, or with no byte pieces 1 for a run of such."""
        left = self.merge(text)
        if self.bytes:
            return sum(1 if s in self.score else len(s.encode()) for s in left)
        return sum(s in self.score or i == 0 or left[i - 1] in self.score for i, s in enumerate(left))

    def runs(self, text: str) -> list[str]:
        """The text cut where no piece holds two neighbouring characters."""
        joined, out, at = self.joined, [], 0
        for i in range(1, len(text)):
            if text[i - 1 : i + 1] not in joined:
                out.append(text[at:i])
                at = i
        return [*out, text[at:]]

    def counts(self, texts: list[str], whole: frozenset[str]) -> list[int]:
        """The counts of many texts: short ones are merged together, long ones (without spaces) by themselves, run by run."""
        short = [i for i, t in enumerate(texts) if len(t) <= LONGEST + 1]
        out = [0] * len(texts)
        if self.bytes:
            for i, n in zip(short, self._merge_short([texts[i] for i in short]).tolist(), strict=True):
                out[i] = n
        for i in range(len(texts)) if not self.bytes else (i for i, t in enumerate(texts) if len(t) > LONGEST + 1):
            out[i] = sum(1 if r in whole else self.count(r) for r in self.runs(texts[i])) if self.bytes else self.count(texts[i])
        return out

    def _merge_short(self, texts: list[str]) -> np.ndarray:
        """Counts of texts that are merged side by side in one flat array; a round makes each text's best merge, of equal ones the leftmost."""
        sizes = np.fromiter(map(len, texts), np.int64, len(texts))
        code = np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32)
        symbols, owner = self.of_code[code], np.repeat(np.arange(len(texts)), sizes)
        total = np.zeros(len(texts), np.int64)
        none = np.iinfo(np.int64).max
        rank, made = self._look_up(symbols[:-1], symbols[1:], owner[:-1] == owner[1:])
        rank, made = np.append(rank, none), np.append(made, 0)
        while len(symbols):
            heads = np.flatnonzero(np.append(True, owner[1:] != owner[:-1]))
            least = np.repeat(np.minimum.reduceat(rank, heads), np.diff(np.append(heads, len(symbols))))
            live = least < none
            if not live.all():  # finished texts leave
                total += np.bincount(owner[~live], weights=self.weight[symbols[~live]], minlength=len(texts)).astype(np.int64)
                symbols, owner, rank, made, least = symbols[live], owner[live], rank[live], made[live], least[live]
                if not len(symbols):
                    break
            best = np.flatnonzero(rank == least)
            best = best[np.append(True, owner[best[1:]] != owner[best[:-1]])]
            symbols[best] = made[best]
            keep = np.ones(len(symbols), bool)
            keep[best + 1] = False
            hit = np.zeros(len(symbols), bool)
            hit[best] = True
            symbols, owner, rank, made, hit = symbols[keep], owner[keep], rank[keep], made[keep], hit[keep]
            new = np.flatnonzero(hit | np.append(hit[1:], False))
            new = new[new < len(symbols) - 1]
            rank[-1] = none
            rank[new], made[new] = self._look_up(symbols[new], symbols[new + 1], owner[new] == owner[new + 1])
        return total

    def _look_up(self, left: np.ndarray, right: np.ndarray, same: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        keys = left << 32 | right
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where((self.keys[at] == keys) & same, self.rank[at], np.iinfo(np.int64).max), self.made[at]


@lru_cache(maxsize=2)
def pieces(path: str) -> Pieces:
    return Pieces(path)


@lru_cache(maxsize=2)
def whole_tokens(path: str) -> frozenset[str]:
    """Those pieces that, as a text of their own, are merged to one token: proven by merging each."""
    vocabulary = pieces(path)
    return frozenset(p for p in vocabulary.score if vocabulary.merge(p) == [p])


class PreTokens:
    """A worker's counts of pre-tokens: without the space sign before them, or beginning with a line feed."""

    def __init__(self, vocabulary: Pieces, whole: frozenset[str]):
        self.vocabulary, self.whole = vocabulary, whole
        self.known = {p[1:]: 1 for p in whole if p[0] == SPACE}

    def of_texts(self, texts: list[str]) -> list[int]:
        total, open_keys = [], {}
        for i, t in enumerate(texts):
            parts = _pre_tokens(t)
            n = list(map(self.known.get, parts))
            if None in n:
                open_keys[i] = [p for p, c in zip(parts, n, strict=True) if c is None]
            total.append(sum(filter(None, n)))
        fresh = list(set().union(*open_keys.values()))
        found = dict(zip(fresh, self.vocabulary.counts([x if x[:1] == "\n" else SPACE + x for x in fresh], self.whole), strict=True))
        for i, keys in open_keys.items():
            total[i] += sum(map(found.__getitem__, keys))
        if len(self.known) + len(fresh) <= REMEMBERED:
            self.known.update((x, n) for x, n in found.items() if len(x) <= LONGEST)
        return total


def _pre_tokens(text: str) -> list[str]:
    if not text:
        return []
    if SPACE not in text:
        parts = text.replace("\n", " \n").split(" ")
        if "" not in parts:
            return parts
    return [a or b for a, b in _PRE_TOKENS.findall(SPACE + text.replace(" ", SPACE))]  # runs of spaces belong to one pre-token


def count_tokens(docs: DataFrame, path: str, *, id: str = "doc_id", text: str = "text", limit: int = LIMIT) -> DataFrame:
    """One row per row: id, n_bytes (of the UTF-8 text), n_tokens, over_limit (more tokens than the limit).

    As the library counts them, without begin and end. Null and empty texts have none. Equal rows give equal rows; an empty
    table gives none; other columns, whatever their names, are not looked at. Of a text no part is left out, and memory
    beyond the text itself goes with its longest pre-token. path: the model, at the same place on all executors.
    """
    whole = whole_tokens(path)
    rows = docs.select(F.col(id).alias("k"), F.col(text).alias("t"))
    kind = rows.schema["k"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = _worker_table(path, whole)
        for batch in batches:
            _, at = utf8(batch.column(1))
            n = [x for lo, hi, _, _ in chunks(batch.column(1)) for x in counts.of_texts([t or "" for t in batch.column(1)[lo:hi].to_pylist()])]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(at[1:] - at[:-1], pa.int64()), pa.array(n, pa.int64()), pa.array([x > limit for x in n], pa.bool_())],
                names=["k", "n_bytes", "n_tokens", "over_limit"],
            )

    return rows.mapInArrow(run, f"k {kind}, n_bytes long, n_tokens long, over_limit boolean").withColumnRenamed("k", id)


_tables: dict[str, PreTokens] = {}


def _worker_table(path: str, whole: frozenset[str]) -> PreTokens:
    """A worker's counts, kept for its next task."""
    if path not in _tables:
        _tables.clear()
        _tables[path] = PreTokens(pieces(path), whole)
    return _tables[path]
