"""Vector best-fit packing of token sequences.

Pieces ask for tokens, a document slot and attention cost (the square of their length);
a sequence has a capacity of each. Pieces are placed longest first. Among the sequences
that can take a piece under every constraint, the one left with the smallest weighted
residual norm wins, or the one with the largest weighted dot product of demand and
residual; a new sequence is opened only if none can.

Pieces of one length are alike, and so are sequences with one residual vector. The plan
is therefore made on the histogram of lengths (at most as many rows as a sequence has
tokens, whatever the corpus holds): it moves whole runs of equal pieces into whole runs
of equal sequences. A piece finds its sequence by its rank among the pieces of its
length; ranks come from two-level counting, so that a length that a third of all
documents have is not ranked in one task.

Null and empty texts are documents of the separator alone. Repeated rows are packed each
for itself. Other columns do not matter. An empty table packs to an empty one.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitchvault.llm.common import record, stored
from pitchvault.llm.token_counts import vocabulary
from pitchvault.operators.versions import split_row_number

CAPACITY = 2048
SEPARATOR = 0
SLICES = 1024
MEMO = 300_000  # words whose ids a task remembers at a time


@dataclass(frozen=True)
class Limits:
    """Capacities of a sequence; the defaults of the last two never bind before tokens do."""

    tokens: int = CAPACITY
    documents: int = CAPACITY
    attention: int = CAPACITY * CAPACITY


@dataclass(frozen=True)
class Score:
    """How a sequence is chosen: "norm" or "dot", with weights for the three resources."""

    kind: str = "norm"
    weights: tuple[float, float, float] = (1.0, 1e-3, 1e-3)


@dataclass(frozen=True)
class Step:
    """Pieces ``rank .. rank + count - 1`` of ``length`` go to sequences from ``sequence`` on."""

    length: int
    rank: int
    count: int
    sequence: int
    offset: int


def plan(histogram: dict[int, int], limits: Limits = Limits(), score: Score = Score()) -> tuple[list[Step], int]:
    """Steps for all pieces of the histogram, and the number of sequences."""
    weights = np.array(score.weights)
    total = np.array([limits.tokens, limits.documents, limits.attention], float)
    # Runs of consecutive sequences with equal contents: first, count, residual vector.
    first, count = np.empty(0, np.int64), np.empty(0, np.int64)
    residual = np.empty((0, 3))
    steps: list[Step] = []
    opened = 0
    for length in sorted(histogram, reverse=True):
        left, rank = histogram[length], 0
        demand = np.array([length, 1, length * length], float)
        if (demand > total).any():
            raise ValueError(f"a piece of {length} tokens does not fit into an empty sequence")
        while left:
            fits = np.flatnonzero((residual >= demand).all(axis=1))
            if len(fits):
                if score.kind == "norm":
                    worth = -(((residual[fits] - demand) / total) ** 2 @ weights)
                else:
                    worth = (residual[fits] / total) @ (weights * demand / total)
                i = fits[int(np.argmax(worth))]
            else:  # each new sequence takes as many of this length as it holds, one step at a time
                per = int(min(total // demand))
                first, count = np.append(first, opened), np.append(count, -(-left // per))
                residual = np.vstack([residual, total])
                i = len(first) - 1
                opened += int(count[i])
            n = int(min(left, count[i]))
            steps.append(Step(length, rank, n, int(first[i]), int(limits.tokens - residual[i][0])))
            if n < count[i]:  # the rest of the run stays as it was
                first, count = np.append(first, first[i] + n), np.append(count, count[i] - n)
                residual = np.vstack([residual, residual[i]])
                count[i] = n
            residual[i] -= demand
            left, rank = left - n, rank + n
        keep = residual[:, 0] > 0
        first, count, residual = first[keep], count[keep], residual[keep]
    return steps, opened


_ODD_SPACE = re.compile(r"\s \s|\s \Z")


@lru_cache(maxsize=2)
def _encoder(vocab: tuple[tuple[bytes, int], ...], special: tuple[tuple[str, int], ...], pattern: str):
    import tiktoken

    return tiktoken.Encoding("pieces", pat_str=pattern, mergeable_ranks=dict(vocab), special_tokens=dict(special))


class _Ids(dict):
    """Ids of a stretch of text as little-endian 32-bit numbers, remembered for some time."""

    def __init__(self, encoder):
        self.encoder = encoder

    def encode(self, text: str) -> bytes:
        return np.array(self.encoder.encode(text, allowed_special="all"), "<u4").tobytes()

    def __missing__(self, stretch: str) -> bytes:
        if len(self) >= MEMO:
            self.clear()
        out = self.encode(stretch)
        if len(stretch) < 64:
            self[stretch] = out
        return out


def ids_of(text: str, memo: _Ids, special: tuple[str, ...] = ()) -> bytes:
    """Ids of ``text``.

    The vocabulary's pattern always cuts before a space that starts a run of white space or
    ends one, so words are encoded apart and remembered. Texts with a space inside a run of
    white space, or with a special token, are encoded whole.
    """
    if _ODD_SPACE.search(text) or any(s in text for s in special):
        return memo.encode(text)
    head, *rest = text.split(" ")
    return b"".join([memo[head] if head else b"", *map(memo.__getitem__, [" " + w for w in rest])])


# The pre-tokenizer's expression of byte-level vocabularies (a fixed value).
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def _specials(path: str) -> tuple[tuple[str, int], ...]:
    import json

    with open(path, encoding="utf-8") as f:
        return tuple((t["content"], t["id"]) for t in json.load(f).get("added_tokens", ()))


def pieces(docs: DataFrame, path: str, capacity: int = CAPACITY, separator: int = SEPARATOR) -> DataFrame:
    """doc_id, piece, start, length and ids_crc32 of every piece.

    The vocabulary is read from ``path`` here and travels with the task.
    """
    vocab, special = tuple(vocabulary(path).items()), _specials(path)
    names = tuple(s for s, _ in special)
    fields = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())])
    end = np.array([separator], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = _Ids(_encoder(vocab, special, PATTERN))
        for batch in batches:
            rows = []
            for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text"), strict=True):
                ids = ids_of(text.as_py(), memo, names) + end
                n = len(ids) // 4
                cuts = [0, *range(n % capacity or min(n, capacity), n + 1, capacity)]
                for k, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)):
                    rows.append((doc, k, a, b - a, zlib.crc32(ids[4 * a : 4 * b])))
            if rows:
                yield record(fields, *map(list, zip(*rows, strict=True)))

    texts = docs.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text"))
    return texts.mapInArrow(run, "doc_id long, piece int, start long, length long, ids_crc32 long")


def pack(cut: DataFrame, limits: Limits = Limits(), score: Score = Score(), length: str = "length") -> DataFrame:
    """``cut`` with ``sequence_id`` and ``offset``.

    A written table of pieces, since its histogram is taken before its rows are placed.
    """
    rows = cut.groupBy(length).count().collect()  # one row per length, at most limits.tokens
    steps, _ = plan({r[length]: r["count"] for r in rows}, limits, score)
    of = {n: [s for s in steps if s.length == n] for n in {s.length for s in steps}}
    by = {n: tuple(np.array([getattr(s, f) for s in ss], np.int64) for f in ("rank", "sequence", "offset")) for n, ss in of.items()}

    names = cut.columns

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths, ranks = (batch.column(c).to_numpy(zero_copy_only=False) for c in (length, "__rank"))
            sequence, offset = np.empty(len(ranks), np.int64), np.empty(len(ranks), np.int64)
            for n in np.unique(lengths):
                rank, to, at = by[int(n)]
                of_n = lengths == n
                step = np.searchsorted(rank, ranks[of_n] - 1, "right") - 1
                sequence[of_n] = to[step] + ranks[of_n] - 1 - rank[step]
                offset[of_n] = at[step]
            kept = [batch.column(c) for c in names]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(sequence), pa.array(offset)], names=[*names, "sequence_id", "offset"])

    # Ranks within a length are counted slice by slice of the documents.
    slices = F.pmod(F.xxhash64("doc_id", "piece"), F.lit(SLICES))
    order = [slices, *(F.col(c) for c in cut.columns)]
    ranked = split_row_number(cut, [length], order, [(slices, "asc")], "__rank")
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in cut.schema)
    return ranked.mapInArrow(place, f"{fields}, sequence_id long, offset long")


def pack_documents(docs: DataFrame, path: str, limits: Limits = Limits(), score: Score = Score()) -> DataFrame:
    """Token pieces of ``docs`` with the sequence and the offset each is packed at."""
    return pack(stored(pieces(docs, path, limits.tokens), "pieces"), limits, score)
