"""Removal of repeated byte strings by a suffix array over sampled suffixes.

Every byte covered by a ``SPAN``-byte string that also starts earlier is removed: earlier in
the same document, or in one with a smaller doc_id. Strings are judged on the input.

A string's anchor is the place of its least 32-byte gram under a hash. Equal strings have
their anchors at the same place, so each string is looked for among the strings of its
anchor's gram alone, and one suffix in 35 or so is enough:

1. Texts equal to an earlier one are removed whole. Anchors of all texts meet by gram hash;
   those that occur once are done. A batch of documents sends each gram once, whatever
   number of its documents hold it.
2. For the rest, the bytes around the anchor travel, again once per batch and context: what
   repeats a context within its batch is removed there and then.
3. Suffixes from the anchors, and reversed prefixes up to them, are put in order by
   deep-shallow sorting; the common prefixes of neighbours tell for every length which are
   equal. A string ``a`` bytes before its anchor equals another if both the prefixes of
   length ``a`` and the suffixes of length ``SPAN - a`` do; the first of each class stays.
4. The removed strings of a document are united.

A null text is empty. Texts under SPAN bytes lose nothing. If a doc_id is repeated or null,
rows are documents of their own, in the order of doc_id (null last) and a hash of the
text. Other columns do not matter.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitchvault.llm.common import _BYTE, TEXT, chunks, fixed, mix, stored
from pitchvault.llm.deep_shallow import deep_shallow

SPAN = 100
GRAM = 32
LEFT = SPAN - GRAM  # an anchor is at most so far into its string

_HALVES = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F)]


def gram_hashes(text: np.ndarray) -> np.ndarray:
    """A 64-bit hash of every ``GRAM`` bytes, doubling the length step by step."""
    h, step = _BYTE[text], 1
    for odd in _HALVES:
        h = h[:-step] * odd + h[step:]
        step *= 2
    return mix(h)


def anchors(text: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
    """(row, position in the chunk, least and greatest distance into a string, gram hash).

    A string at j has its anchor at the least gram hash of j .. j + LEFT, leftmost if equal.
    """
    none = np.empty(0, np.int64)
    if len(text) < SPAN:
        return none, none, none, none, none.astype(np.uint64)
    hashes = gram_hashes(text)
    least = (hashes & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(hashes), dtype=np.uint64)
    width = 1
    while 2 * width <= LEFT + 1:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    rest = LEFT + 1 - width
    if rest:
        least = np.minimum(least[:-rest], least[rest:])
    at = (least & np.uint64(0xFFFFFFFF)).astype(np.int64)
    n = np.diff(offsets)
    strings = np.maximum(n - SPAN + 1, 0)
    begins = np.cumsum(strings) - strings
    where = np.arange(strings.sum()) - np.repeat(begins - offsets[:-1], strings)
    row = np.repeat(np.arange(len(n)), strings)
    place = at[where]
    if not len(place):
        return none, none, none, none, none.astype(np.uint64)
    first = np.flatnonzero(np.concatenate([[True], (place[1:] != place[:-1]) | (row[1:] != row[:-1])]))
    last = np.concatenate([first[1:], [len(place)]]) - 1
    place = place[first]
    return row[first], place, place - where[last], place - where[first], hashes[place]


def _pack(cols: dict[str, np.ndarray], bucket: np.ndarray) -> pa.RecordBatch:
    """One row per bucket with its entries of every column as bytes."""
    order = np.argsort(bucket, kind="stable")
    bucket = bucket[order]
    cuts = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]])) if len(bucket) else np.empty(0, np.int64)
    ends = np.append(cuts[1:], len(bucket))[: len(cuts)]
    out = [pa.array(bucket[cuts].astype(np.int64))]
    for c in cols.values():
        c = c[order]
        out.append(pa.array([c[a:b].tobytes() for a, b in zip(cuts, ends, strict=True)], pa.binary()))
    return pa.RecordBatch.from_arrays(out, names=["bucket", *cols])


def gram_table(docs: DataFrame, buckets: int) -> DataFrame:
    """Grams of anchors by bucket of their hash, whose they are, and whether met twice already.

    Within a batch of rows a gram is sent to its bucket once, however many of the rows hold
    it. The other rows know by then that it is shared; they go to a bucket of the batch
    below zero.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("key").to_numpy(zero_copy_only=False)
            owner, gram = [], []
            for first, raw, offsets in chunks(batch):
                row, _, _, _, h = anchors(raw, offsets)
                owner.append(ids[first + row])
                gram.append(h)
            if not owner:
                continue
            owner, gram = np.concatenate(owner), np.concatenate(gram)
            order = np.argsort(gram, kind="stable")
            owner, gram = owner[order], gram[order]
            new = np.concatenate([[True], gram[1:] != gram[:-1]]) if len(gram) else np.empty(0, bool)
            twice = (new & ~np.append(new[1:], True)).astype(np.uint8) if len(gram) else np.empty(0, np.uint8)
            bucket = np.where(new, (gram % np.uint64(buckets)).astype(np.int64), -1 - int(ids[0]) % buckets)
            yield _pack({"gram": gram, "owner": owner, "twice": twice}, bucket)

    return docs.mapInArrow(run, "bucket long, gram binary, owner binary, twice binary")


def _by_owner(gram: np.ndarray, owner: np.ndarray) -> pd.DataFrame:
    """(key, grams): the distinct grams of each owner as bytes."""
    order = np.lexsort((gram, owner))
    gram, owner = gram[order], owner[order]
    if not len(owner):
        return pd.DataFrame({"key": np.empty(0, np.int64), "grams": np.empty(0, object)})
    cuts = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
    parts = np.split(gram, cuts[1:])
    return pd.DataFrame({"key": owner[cuts], "grams": [np.unique(p).tobytes() for p in parts]})


def shared_grams(table: DataFrame) -> DataFrame:
    """(key, grams) of the grams that occur at several places, in pieces."""
    def meet(bucket: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        gram, owner, twice = (np.concatenate([fixed(x, t) for x in rows[c]]) for c, t in (("gram", "<u8"), ("owner", "<i8"), ("twice", "u1")))
        if bucket[0] < 0:
            return _by_owner(gram, owner)
        order = np.argsort(gram, kind="stable")
        gram, owner, twice = gram[order], owner[order], twice[order]
        new = np.concatenate([[True], gram[1:] != gram[:-1]])
        several = ~(new & np.append(new[1:], True)) | (twice > 0)
        return _by_owner(gram[several], owner[several])

    return table.groupBy("bucket").applyInPandas(meet, "key long, grams binary")


_CONTEXT = LEFT + SPAN


def _contexts(text: np.ndarray, at: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """The LEFT bytes before each place, reversed, and SPAN from it on; zero beyond the row."""
    steps = np.concatenate([-1 - np.arange(LEFT), np.arange(SPAN)])
    where = at[:, None] + steps
    inside = (where >= begin[:, None]) & (where < end[:, None])
    return np.where(inside, text[np.clip(where, 0, len(text) - 1)], 0).astype(np.uint8)


def _spans(key: np.ndarray, start: np.ndarray, end: np.ndarray) -> pd.DataFrame:
    """One row per document with its (start, end) pairs as bytes."""
    pairs = np.stack([start, end], axis=1).astype("<i8") if len(start) else np.empty((0, 2), "<i8")
    out = _pack({"spans": np.ascontiguousarray(pairs).view("V16").reshape(-1)}, key)
    return pd.DataFrame({"key": out.column(0).to_numpy(zero_copy_only=False), "spans": out.column(1).to_pylist()})


def context_table(touched: DataFrame, buckets: int) -> DataFrame:
    """Contexts of anchors with shared grams, by bucket of the gram.

    A context that the batch has met in an earlier place is settled: all its strings occur
    there. Those go to a bucket of the batch below zero, as (key, start, end).
    """
    names = ["bucket", "key", "at", "low", "high", "context"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, sets = batch.column("key").to_numpy(zero_copy_only=False), batch.column("grams")
            parts = []
            for first, raw, offsets in chunks(batch):
                row, at, low, high, gram = anchors(raw, offsets)
                cuts = np.searchsorted(row, np.arange(len(offsets)))
                kept = np.zeros(len(row), bool)
                for i in range(len(offsets) - 1):
                    a, b = cuts[i], cuts[i + 1]
                    if a < b:
                        own = np.concatenate([fixed(g, "<u8") for g in sets[first + i].as_py()])
                        kept[a:b] = np.isin(gram[a:b], own)
                row, at, low, high, gram = (c[kept] for c in (row, at, low, high, gram))
                if len(row):
                    around = _contexts(raw, at, offsets[row], offsets[row + 1])
                    parts.append((gram, keys[first + row], at - offsets[row], low, high, around))
            if not parts:
                continue
            gram, key, at, low, high, around = (np.concatenate(c) for c in zip(*parts, strict=True))
            order = np.lexsort((at, key))
            seen: set[bytes] = set()
            new = np.zeros(len(key), bool)
            for i in order.tolist():
                k = around[i].tobytes() + bytes((low[i], high[i]))
                if k not in seen:
                    seen.add(k)
                    new[i] = True
            old = ~new
            bare = np.empty(0, "V1")
            done = {"key": key[old], "at": at[old] - high[old], "end": at[old] - low[old] + SPAN}
            if old.any():
                blobs = [done["key"], done["at"], bare, bare, done["end"]]
                yield pa.RecordBatch.from_arrays([pa.array([-1 - int(keys[0]) % buckets]), *(pa.array([x.tobytes()], pa.binary()) for x in blobs)], names=names)
            cols = {"key": key[new], "at": at[new], "low": low[new].astype(np.uint8), "high": high[new].astype(np.uint8), "context": np.ascontiguousarray(around[new]).view(f"V{_CONTEXT}").reshape(-1)}
            yield _pack(cols, (gram[new] % np.uint64(buckets)).astype(np.int64))

    return touched.mapInArrow(run, ", ".join(f"{n} {'long' if n == 'bucket' else 'binary'}" for n in names))


def repeats(key: np.ndarray, at: np.ndarray, low: np.ndarray, high: np.ndarray, around: np.ndarray) -> np.ndarray:
    """For anchors in document order: whether the string ``a`` bytes before each occurs earlier."""
    n = len(key)
    before, after = around[:, :LEFT], around[:, LEFT:]
    order_after, lcp_after = deep_shallow(np.ascontiguousarray(after))
    order_before, lcp_before = deep_shallow(np.ascontiguousarray(before))
    gone = np.zeros((n, LEFT + 1), bool)

    def classes(order: np.ndarray, lcp: np.ndarray, length: int) -> np.ndarray:
        out = np.empty(n, np.int64)
        out[order] = np.concatenate([[0], np.cumsum(lcp < length)])
        return out

    for a in range(LEFT + 1):
        mine = np.flatnonzero((low <= a) & (a <= high))
        if len(mine) < 2:
            continue
        both = classes(order_after, lcp_after, SPAN - a)[mine] * n + classes(order_before, lcp_before, a)[mine]
        gone[mine, a] = True
        gone[mine[np.unique(both, return_index=True)[1]], a] = False
    return gone


def removed_spans(contexts: DataFrame) -> DataFrame:
    """(key, spans) of the strings that repeat earlier ones."""
    def resolve(bucket: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        key, at = (np.concatenate([fixed(x, "<i8") for x in rows[c]]) for c in ("key", "at"))
        if bucket[0] < 0:
            return _spans(key, at, np.concatenate([fixed(x, "<i8") for x in rows["context"]]))
        low, high = (np.concatenate([fixed(x, "u1") for x in rows[c]]).astype(np.int64) for c in ("low", "high"))
        around = np.concatenate([fixed(x, "u1") for x in rows["context"]]).reshape(-1, _CONTEXT)
        order = np.lexsort((at, key))
        key, at, low, high, around = (c[order] for c in (key, at, low, high, around))
        gone = repeats(key, at, low, high, around)
        edge = np.diff(np.pad(gone, ((0, 0), (1, 1))).astype(np.int8), axis=1)
        row, first = np.nonzero(edge == 1)
        last = np.nonzero(edge == -1)[1] - 1
        return _spans(key[row], at[row] - last, at[row] - first + SPAN)

    return contexts.groupBy("bucket").applyInPandas(resolve, "key long, spans binary")


def cut(text: bytes, spans: np.ndarray) -> tuple[int, int, bytes]:
    """(bytes removed, maximal runs removed, what is left) for (start, end) rows."""
    spans = spans[np.argsort(spans[:, 0], kind="stable")]
    ends = np.maximum.accumulate(spans[:, 1])
    new = np.concatenate([[True], spans[1:, 0] > ends[:-1]])
    starts, stops = spans[new, 0], ends[np.append(new[1:], True)]
    left, done = [], 0
    for a, b in zip(starts.tolist(), stops.tolist(), strict=True):
        left.append(text[done:a])
        done = b
    return int((stops - starts).sum()), len(starts), b"".join([*left, text[done:]])


def _numbered(docs: DataFrame) -> DataFrame:
    """Documents with a ``key`` that orders them; doc_id itself where it names them."""
    docs = docs.select(F.col("doc_id").cast("long"), F.expr(TEXT))
    ids = docs.select("doc_id")
    if ids.filter("doc_id IS NULL").union(ids.groupBy("doc_id").count().filter("count > 1").select("doc_id")).isEmpty():
        return docs.withColumn("key", F.col("doc_id"))
    # Ranges of doc_id go to partitions in order, and the number grows with the partition.
    ranged = docs.repartitionByRange(F.col("doc_id").asc_nulls_last(), F.xxhash64("text"))
    ordered = ranged.sortWithinPartitions(F.col("doc_id").asc_nulls_last(), F.xxhash64("text"))
    return stored(ordered.withColumn("key", F.monotonically_increasing_id()), "numbered")


def remove_repeats(docs: DataFrame, texts: bool = False) -> DataFrame:
    """Per document: n_bytes, n_removed, n_spans, kept_sha256; with ``texts`` what is left as well."""
    docs = _numbered(docs)
    facts = stored(docs.select("key", "doc_id", F.length("text").cast("long").alias("n_bytes"), F.sha2("text", 256).alias("sha")), "facts")
    first = facts.filter(F.col("n_bytes") >= SPAN).groupBy("sha").agg(F.min("key").alias("first"))
    facts = stored(facts.join(first, "sha", "left").withColumn("copy", F.coalesce(F.col("first") < F.col("key"), F.lit(False))).drop("first"), "facts")

    spark = docs.sparkSession
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), docs.rdd.getNumPartitions())
    own = shared_grams(gram_table(docs.select("key", "text"), buckets)).groupBy("key").agg(F.collect_list("grams").alias("grams"))
    own = own.join(facts.filter("NOT copy").select("key"), "key")
    contexts = context_table(docs.select("key", "text").join(own, "key"), buckets)
    gone = removed_spans(contexts).groupBy("key").agg(F.collect_list("spans").alias("spans"))

    def rest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for t, s in zip(batch.column("text"), batch.column("spans"), strict=True):
                pairs = np.concatenate([fixed(x, "<i8") for x in s.as_py()]).reshape(-1, 2)
                n, k, kept = cut(t.as_py(), pairs)
                rows.append((n, k, hashlib.sha256(kept).hexdigest(), kept if texts else None))
            cols = list(zip(*rows, strict=True)) if rows else [[], [], [], []]
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.binary()]
            yield pa.RecordBatch.from_arrays([batch.column("key"), *(pa.array(list(c), k) for c, k in zip(cols, kinds, strict=True))], names=["key", "cut_bytes", "cut_spans", "cut_sha", "kept"])

    changed = docs.select("key", "text").join(gone, "key").select("key", "text", "spans").mapInArrow(
        rest, "key long, cut_bytes long, cut_spans long, cut_sha string, kept binary")
    out = facts.join(changed, "key", "left")
    result = out.select(
        "doc_id", "n_bytes",
        F.when(F.col("copy"), F.col("n_bytes")).otherwise(F.coalesce("cut_bytes", F.lit(0))).cast("long").alias("n_removed"),
        F.when(F.col("copy"), F.lit(1)).otherwise(F.coalesce("cut_spans", F.lit(0))).cast("long").alias("n_spans"),
        F.when(F.col("copy"), F.lit(hashlib.sha256(b"").hexdigest())).otherwise(F.coalesce("cut_sha", "sha")).alias("kept_sha256"),
        *(["key", "copy", "kept"] if texts else []),
    )
    if not texts:
        return result
    whole = result.join(docs.select("key", "text"), "key")
    left = F.when(F.col("copy"), F.lit(b"")).otherwise(F.coalesce("kept", "text")).cast("string")
    return whole.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", left.alias("text"))
