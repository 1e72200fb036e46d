"""Benchmark decontamination: a prefix-filtered set join of item windows with documents.

A window is 13 consecutive words of an item, or the whole of a shorter item. Its shingles
are ordered by how often they occur in the documents, rarest first. A document that holds
a whole window holds its rarest shingle, so for containment of all shingles a prefix of
one token is necessary and enough to join on. Each joint token fixes where the window
would lie; windows that would start before the document or end after it drop out, and the
words of the rest are compared one by one.

Items without words have no windows and are never found. Documents that are null or have
no words give zeros. Repeated rows are judged each for itself; an item listed twice
counts as one. Other columns do not matter and pass through ``clean`` untouched, whatever their names.

Benchmark windows go to the tasks in blocks of ``BLOCK`` windows, a bounded size; if there
are more, documents are read once per block and their hits united.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitchvault.llm.common import LOWER, TEXT, chunks, columns_of, free_name, grams, map_batches, record, stored, table_of, words

WINDOW = 13
SHINGLE = 3
BLOCK = 100_000  # windows that a task holds at once

INSIDE = table_of([*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)])
_APART = bytes(b if INSIDE[b] else 32 for b in range(256))


def plain_words(text: str | None) -> list[bytes]:
    """Words of a text, A-Z lower-cased."""
    return (text or "").encode().lower().translate(_APART).split()


@dataclass
class Windows:
    """A block of distinct windows, by their words."""

    words: list[tuple[bytes, ...]]
    items: list[tuple[int, ...]]
    shingles: dict[int, np.ndarray] = field(default_factory=dict)  # size to sorted hashes
    prefix: dict[int, tuple[np.ndarray, list[list[tuple[int, int]]]]] = field(default_factory=dict)

    def hashed(self) -> list[tuple[int, np.ndarray]]:
        """(shingle size, shingle hashes in order) of every window."""
        out = []
        for w in self.words:
            raw = np.frombuffer(b" ".join(w), np.uint8)
            _, _, h, _ = words(raw, np.array([0, len(raw)]), INSIDE)
            size = min(SHINGLE, len(w))
            out.append((size, grams(h, size)))
        return out


def windows_of(items: list[tuple[int, str | None]], window: int = WINDOW) -> list[tuple[tuple[bytes, ...], tuple[int, ...]]]:
    """Distinct windows with the items that have them."""
    found: dict[tuple[bytes, ...], set[int]] = {}
    for item, text in items:
        w = plain_words(text)
        if w:
            for i in range(max(1, len(w) - window + 1)):
                found.setdefault(tuple(w[i : i + window]), set()).add(item)
    return [(k, tuple(sorted(v, key=str))) for k, v in found.items()]


def _places(known: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where ``hashes`` holds a known one, and which."""
    if not len(hashes) or not len(known):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    i = np.minimum(np.searchsorted(known, hashes), len(known) - 1)
    at = np.flatnonzero(known[i] == hashes)
    return at, i[at]


def shingle_counts(docs: DataFrame, known: dict[int, np.ndarray]) -> dict[tuple[int, int], int]:
    """Occurrences in all documents of the given shingles, (size, hash) to count.

    Every task counts for itself; the counts, as many as there are shingles in a block,
    are added up by Spark.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = {size: np.zeros(len(h), np.int64) for size, h in known.items()}
        for batch in batches:
            for _, raw, offsets in chunks(batch):
                _, _, hashes, _ = words(LOWER[raw], offsets, INSIDE)
                for size, h in known.items():  # a shingle over two documents does no harm to an order
                    counts[size] += np.bincount(_places(h, grams(hashes, size))[1], minlength=len(h))
        for size, n in counts.items():
            some = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(some), size, np.int32)), pa.array(known[size][some].view(np.int64)), pa.array(n[some])],
                names=["size", "shingle", "n"])

    rows = docs.select(F.expr(TEXT)).mapInArrow(run, "size int, shingle long, n long").groupBy("size", "shingle").agg(F.sum("n").alias("n"))
    return {(r["size"], r["shingle"] % 2**64): r["n"] for r in rows.toLocalIterator()}


def block_of(docs: DataFrame, windows: list[tuple[tuple[bytes, ...], tuple[int, ...]]]) -> Windows:
    """Windows with the prefix token of each: its rarest shingle in the documents."""
    out = Windows([w for w, _ in windows], [i for _, i in windows])
    hashed = out.hashed()
    sizes = {size for size, _ in hashed}
    known = {s: np.unique(np.concatenate([h for size, h in hashed if size == s])) for s in sizes}
    counts = shingle_counts(docs, known)
    tokens: dict[int, dict[int, list[tuple[int, int]]]] = {s: {} for s in sizes}
    for number, (size, h) in enumerate(hashed):
        place = min(range(len(h)), key=lambda i: (counts.get((size, int(h[i])), 0), int(h[i])))
        tokens[size].setdefault(int(h[place]), []).append((number, place))
    for s, by in tokens.items():
        order = sorted(by)
        out.prefix[s] = (np.array(order, np.uint64), [by[t] for t in order])
    return out


def find(block: Windows, text: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[int, list[tuple[int, int, int]]]]:
    """(number of words, [(first word, length, window)]) of each row of a chunk."""
    low = LOWER[text]
    starts, lengths, hashes, first = words(low, offsets, INSIDE)
    found: list[list[tuple[int, int, int]]] = [[] for _ in range(len(offsets) - 1)]
    for size, (known, at_token) in block.prefix.items():
        places, which = _places(known, grams(hashes, size))
        rows = np.searchsorted(first, places, "right") - 1
        for p, t, row in zip(places.tolist(), which.tolist(), rows.tolist(), strict=True):
            for number, offset in at_token[t]:
                begin, window = p - offset, block.words[number]
                if begin < first[row] or begin + len(window) > first[row + 1]:
                    continue  # it would not lie in the document
                if all(low[starts[begin + i] : starts[begin + i] + lengths[begin + i]].tobytes() == w for i, w in enumerate(window)):
                    found[row].append((begin - int(first[row]), len(window), number))
    for row, hits in enumerate(found):
        yield int(first[row + 1] - first[row]), hits


def covered(spans: list[tuple[int, int]]) -> int:
    """Words in the union of (start, length) spans."""
    total = end = 0
    for start, length in sorted(spans):
        total += max(0, start + length - max(start, end))
        end = max(end, start + length)
    return total


CONTAMINATED = "n_hit > 0 AND 20 * n_hit >= n_words"
HIT = "doc_id long, n_words long, n_hit long, n_items long, items_sha256 string"


def _digest(items: set[str]) -> str:
    return hashlib.sha256(",".join(sorted(items)).encode()).hexdigest()


def hits(docs: DataFrame, block: Windows, spans: bool = False) -> DataFrame:
    """Documents against one block; with ``spans`` the word spans and items themselves."""
    schema = HIT + (", spans array<array<long>>, items array<string>" if spans else "")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, raw, offsets in chunks(batch):
                rows = []
                for n, got in find(block, raw, offsets):
                    items = {str(i) for _, _, w in got for i in block.items[w]}
                    where = sorted({(s, k) for s, k, _ in got})
                    row = (n, covered(where), len(items), _digest(items))
                    rows.append((*row, [list(x) for x in where], sorted(items)) if spans else row)
                ids = batch.column("doc_id").slice(start, len(rows))
                types = [pa.int64()] * 4 + [pa.string()] + ([pa.list_(pa.list_(pa.int64())), pa.list_(pa.string())] if spans else [])
                names = ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "spans", "items"]
                fields = pa.schema(list(zip(names, types, strict=False)))
                yield record(fields, ids, *map(list, zip(*rows, strict=True)))

    return docs.select(F.col("doc_id").cast("long"), F.expr(TEXT)).mapInArrow(run, schema)


def _over_blocks(numbered: DataFrame, row: str, blocks: list[Windows]) -> DataFrame:
    """Hits of several blocks of windows for each row of ``numbered``, with its number ``row`` as doc_id."""
    def run(_, batch):
        rows = batch.to_dict("records")
        where = [(int(s), int(k)) for r in rows for s, k in r["spans"]]
        items = {i for r in rows for i in r["items"]}
        first = rows[0]
        return type(batch)([{"doc_id": first["doc_id"], "n_words": first["n_words"], "n_hit": covered(where), "n_items": len(items), "items_sha256": _digest(items)}])

    texts = numbered.select(F.col(row).alias("doc_id"), "text")
    both, *more = [stored(hits(texts, b, spans=True), "hits") for b in blocks]
    for b in more:
        both = both.unionByName(b)
    return both.groupBy("doc_id").applyInPandas(run, HIT)


def _numbered(docs: DataFrame) -> tuple[DataFrame, str]:
    """``docs``, written, with a number for every row, and the name of that column."""
    row = free_name(docs, "row")
    return stored(docs.withColumn(row, F.monotonically_increasing_id()), "numbered"), row


def blocks_of(docs: DataFrame, benchmark: DataFrame, window: int, block: int) -> list[Windows]:
    """The benchmark's windows in blocks of about ``block``, each with its prefix tokens."""
    # Items are cut into windows block by block; a block of items has about `block` windows.
    parts: list[Windows] = []
    pending: list[tuple[int, str | None]] = []
    size = 0
    items = benchmark.select("item_id", "text").distinct()
    for r in items.toLocalIterator():
        pending.append((r["item_id"], r["text"]))
        size += len(r["text"] or "") // 2 + 1
        if size >= block:
            parts.append(block_of(docs, windows_of(pending, window)))
            pending, size = [], 0
    if pending or not parts:
        parts.append(block_of(docs, windows_of(pending, window)))
    return parts


def clean(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block: int = BLOCK) -> DataFrame:
    """The rows of ``docs`` that are not contaminated, with all their columns.

    With one block of windows, rows pass through a single scan; with more, the verdicts are
    joined back by the number of the row. Either way every row is judged for itself.
    """
    parts = blocks_of(docs, benchmark, window, block)
    if len(parts) > 1:
        numbered, row = _numbered(docs)
        bad = _over_blocks(numbered, row, parts).filter(CONTAMINATED).select(F.col("doc_id").alias(row))
        return numbered.join(bad, row, "left_anti").select(*columns_of(docs))
    names, windows, bytes_ = docs.columns, parts[0], free_name(docs, "raw")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, raw, offsets in chunks(batch, bytes_):
                keep = []
                for n, got in find(windows, raw, offsets):
                    hit = covered(sorted({(s, k) for s, k, _ in got}))
                    keep.append(not (hit > 0 and 20 * hit >= n))
                kept = batch.slice(start, len(keep)).select(names).filter(pa.array(keep, pa.bool_()))
                yield kept

    return map_batches(docs.withColumn(bytes_, F.expr("CAST(coalesce(text, '') AS BINARY)")), run, docs.schema)


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block: int = BLOCK) -> DataFrame:
    """Per document: n_words, n_hit, n_items, items_sha256 and ``contaminated``.

    A document is contaminated if a word is hit and at least a twentieth of its words are.
    """
    parts = blocks_of(docs, benchmark, window, block)
    if len(parts) == 1:
        out = hits(docs, parts[0])
    else:
        numbered, row = _numbered(docs.select(F.col("doc_id").cast("long"), "text"))
        found = _over_blocks(numbered, row, parts).withColumnRenamed("doc_id", row)
        out = found.join(numbered.select(row, "doc_id"), row).select("doc_id", "n_words", "n_hit", "n_items", "items_sha256")
    return out.withColumn("contaminated", F.expr(CONTAMINATED))
