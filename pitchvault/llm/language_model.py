"""Word trigrams with deleted interpolation, counted and looked up by hash range.

Texts are split into chunks of some megabytes, each wholly learned from, wholly kept for
the weights, or wholly held out. The model of a word after two others is nested:

    P3 = a[c(u v)] c(u v w) / c(u v) + (1 - a) P2
    P2 = b[c(v)] c(v w) / c(v) + (1 - b) P1
    P1 = d c(w) / N + (1 - d) / (V + 1)

The weights ``a`` and ``b`` depend on how often the context was seen, in octaves. They are
learned by expectation-maximisation: one in ``KEPT`` of the training texts is deleted from
the counts, its words are predicted from the others' counts, and every weight becomes its
share of the expected uses until the likelihood stands still. The final counts are those of
all training texts.

How the counts meet the texts: every chunk sends its distinct n-grams, as sorted 64-bit
hashes with their counts, to groups by hash range. A group adds up and answers each sender
with the totals, in the sender's order. Trigrams follow when the pairs are answered: where a
trigram's first or last pair is in no other chunk (to a held-out one: was never learned from),
nor is the trigram, and it need not be sent. No group depends on how frequent a word is, as a
chunk sends an n-gram once; there are as many groups as the corpus needs. The chunks are a
table in buckets, so that texts are read in place and never shuffled.

Hashes have 32 bits more than the corpus' number of words, 64 at most: a lookup meets
another n-gram's count with a chance of about one in a billion, at every size.

Null and empty texts are an end and nothing else. A null id counts as an empty one where
texts are dealt out. Repeated rows count each for itself. Without training texts every
count is 0 and every weight stays at a half. Only ``doc_id``, ``text`` and the columns of the given
condition are read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pitchvault.llm.blobs import pack, steps, unpack
from pitchvault.llm.common import LOWER, TEXT, chunks, mix, stored, table_of, words
from pitchvault.sources.tables import append_bucketed, bucketed_table, scratch

INSIDE = 1 - table_of([0x20, *range(0x09, 0x0E)])
START, END = np.uint64(0x5354415254), np.uint64(0x454E44)

CHUNK = 8 << 20  # bytes of text counted and scored at once
MET = 2_000_000  # n-grams that a group is meant to hold
KEPT = 16  # one in so many training texts is kept for the weights
OCTAVES = 64
ROUNDS, STILL = 40, 1e-6  # of expectation-maximisation; gain in log-likelihood a word to stop at

COUNTED, DELETED, HELD_OUT = 0, 1, 2  # kinds of chunks


class Weights(NamedTuple):
    """Shares of the higher order, by octave of the context's count (0: not seen)."""

    trigram: tuple[float, ...]
    bigram: tuple[float, ...]
    word: float


def _grams(table: pa.Table, bits: int) -> tuple[list[np.ndarray], np.ndarray]:
    """Hashes of the 1-, 2- and 3-grams that end at every token, and where every text begins."""
    found, tokens = [], []
    for batch in table.select(["text"]).combine_chunks().to_batches():
        for _, raw, offsets in chunks(batch):
            _, _, h, first = words(LOWER[raw], offsets, INSIDE)
            rows = len(offsets) - 1
            at = np.arange(len(h)) + np.repeat(np.arange(rows), np.diff(first))
            w = np.full(len(h) + rows, END, np.uint64)
            w[at] = h
            found.append(w)
            tokens.append(np.diff(first) + 1)
    w = np.concatenate(found)
    begins = np.cumsum(np.concatenate([[0], *tokens]))[:-1]
    v = np.append(START, w[:-1])
    v[begins] = START
    u = np.append(START, v[:-1])
    u[begins] = START
    pair = mix(v * np.uint64(3) + w)
    less = np.uint64(64 - bits)
    return [mix(w) >> less, pair >> less, mix(u * np.uint64(5) + pair) >> less], begins


class Ranges(NamedTuple):
    """Equal ranges of the hashes: their number, and the hashes' bits."""

    groups: int
    bits: int

    def bounds(self, keys: np.ndarray) -> np.ndarray:
        """Where ascending hashes pass from one range to the next."""
        upper = keys >> np.uint64(self.bits - 32)
        return np.searchsorted(upper * np.uint64(self.groups) >> np.uint64(32), np.arange(self.groups + 1, dtype=np.uint64))


def _requests(chunk: int, kind: int, grams: list[tuple[int, np.ndarray]], ranges: Ranges) -> pa.Table:
    """Distinct hashes of each order with their counts in the chunk, by slot."""
    slots, blobs = [], []
    for order, keys in grams:
        keys, counts = np.unique(keys, return_counts=True)
        if kind == HELD_OUT:
            counts = np.zeros_like(counts)
        bounds = ranges.bounds(keys)
        for g in np.flatnonzero(np.diff(bounds)).tolist():
            some = keys[bounds[g] : bounds[g + 1]]
            slots.append(order * ranges.groups + g)
            blobs.append(pack(some[:1], steps(some)[1:], counts[bounds[g] : bounds[g + 1]]))
    n = len(slots)
    return pa.table({
        "slot": pa.array(slots, pa.int32()), "chunk": pa.array([chunk] * n, pa.int64()),
        "kind": pa.array([kind] * n, pa.int32()), "grams": pa.array(blobs, pa.binary())})


def _sent(texts: pa.Table, ranges: Ranges) -> pa.Table:
    chunk, kind = texts.column("chunk")[0].as_py(), texts.column("kind")[0].as_py()
    return _requests(chunk, kind, list(enumerate(_grams(texts, ranges.bits)[0][:2])), ranges)


def _sent_open(texts: pa.Table, answers: pa.Table, ranges: Ranges) -> pa.Table:
    """The trigrams whose count is not settled by those of their pairs."""
    if not texts.num_rows:
        return _requests(0, 0, [], ranges)
    chunk, kind = texts.column("chunk")[0].as_py(), texts.column("kind")[0].as_py()
    grams, begins = _grams(texts, ranges.bits)
    settled = _settled(_found(grams[1], 1, kind, answers, ranges)[2], begins)
    return _requests(chunk, kind, [(2, grams[2][~settled])], ranges)


def _answered(table: pa.Table) -> pa.Table:
    """Totals for every sender of one slot, and a row of the slot's sums without a chunk."""
    parts = [unpack(b) for b in table.column("grams").to_pylist()]
    kinds = table.column("kind").to_pylist()
    keys, place = np.unique(
        np.concatenate([np.cumsum(np.concatenate(p[:2]), dtype=np.uint64) for p in parts]), return_inverse=True)
    ends = np.cumsum([len(p[2]) for p in parts])
    counts = np.concatenate([p[2] for p in parts]).astype(np.float64)  # whole numbers below 2 ** 53
    of = np.repeat(kinds, np.diff(ends, prepend=0))
    counted, deleted = (
        np.bincount(place, np.where(of == k, counts, 0), len(keys)).astype(np.int64) for k in (COUNTED, DELETED))
    total = counted + deleted
    elsewhere = np.zeros(len(keys), np.uint8)  # in held-out chunks, which ask for counts they do not have
    elsewhere[place[of == HELD_OUT]] = 1
    blobs = []
    for last, p in zip(ends, parts, strict=True):
        mine = place[last - len(p[2]) : last]
        blobs.append(pack(total[mine], deleted[mine], elsewhere[mine]))
    slot = table.column("slot")[0].as_py()
    n = len(blobs)
    sums = [int(x) for x in (total.sum(), (total > 0).sum(), counted.sum(), (counted > 0).sum())]
    columns = {
        "slot": pa.array([slot] * (n + 1), pa.int32()), "chunk": pa.array([*table.column("chunk").to_pylist(), None], pa.int64()),
        "kind": pa.array([*kinds, None], pa.int32()), "totals": pa.array([*blobs, None], pa.binary())}
    for name, x in zip(("n", "v", "n_counted", "v_counted"), sums, strict=True):
        columns[name] = pa.array([None] * n + [x], pa.int64())
    return pa.table(columns)


class _Seen(NamedTuple):
    """Counts at every token: of its 1-, 2- and 3-gram and of the two contexts."""

    grams: list[np.ndarray]
    bigram_context: np.ndarray
    trigram_context: np.ndarray
    begins: np.ndarray


def _found(keys: np.ndarray, order: int, kind: int, answers: pa.Table, ranges: Ranges) -> tuple[np.ndarray, ...]:
    """At every token: its n-gram's total, the part that is not of deleted texts, and if training chunks other than this one or held-out ones have it."""
    distinct, place, own = np.unique(keys, return_inverse=True, return_counts=True)
    slots = np.array(answers.column("slot").to_pylist(), np.int64)
    mine = np.flatnonzero(slots // ranges.groups == order)
    parts = [unpack(answers.column("totals")[int(i)].as_py()) for i in mine[np.argsort(slots[mine])]]
    totals, deleted, elsewhere = (np.concatenate([np.empty(0, np.uint64), *[p[i] for p in parts]]) for i in range(3))
    if len(distinct) != len(totals):
        raise RuntimeError("a chunk was answered for other texts than it holds")
    abroad = totals > 0 if kind == HELD_OUT else (totals != own.astype(np.uint64)) | (elsewhere > 0)
    return totals.astype(np.float64)[place], (totals - deleted).astype(np.float64)[place], abroad[place]


def _settled(abroad: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """Where no other chunk has a trigram's first or last pair, or would ask for it; nor then the trigram."""
    whole = ~abroad
    before = np.append(False, whole[:-1])
    before[begins] = False
    return whole | before


def _looked_up(texts: pa.Table, answers: pa.Table, ranges: Ranges, which: int) -> _Seen:
    """Counts of all training texts (``which`` 0), or without those deleted (1)."""
    kind = texts.column("kind")[0].as_py()
    grams, begins = _grams(texts, ranges.bits)
    one = _found(grams[0], 0, kind, answers, ranges)[which]
    both = _found(grams[1], 1, kind, answers, ranges)
    two = both[which]
    settled = _settled(both[2], begins)
    _, place, own = np.unique(grams[2], return_inverse=True, return_counts=True)
    # Of a settled trigram, nothing is counted outside of this chunk.
    three = np.zeros(len(one)) if kind == HELD_OUT or which else own.astype(np.float64)[place]
    three[~settled] = _found(grams[2][~settled], 2, kind, answers, ranges)[which]
    ends = np.append(begins[1:], len(one)) - 1
    texts_counted = one[ends[0]]  # an end per text
    v, uv = np.append(0.0, one[:-1]), np.append(0.0, two[:-1])
    v[begins] = uv[begins] = texts_counted
    return _Seen([one, two, three], v, uv, begins)


def _ratio(a: np.ndarray, b: np.ndarray | float) -> np.ndarray:
    return np.divide(a, b, out=np.zeros_like(a), where=b > 0)


def _estimates(seen: _Seen, n: int) -> tuple[np.ndarray, ...]:
    """Octaves of both contexts, and the three maximum-likelihood estimates."""
    one, two, three = seen.grams
    return (
        np.frexp(seen.trigram_context)[1], np.frexp(seen.bigram_context)[1],
        _ratio(three, seen.trigram_context), _ratio(two, seen.bigram_context), one / max(n, 1))


def _events(texts: pa.Table, answers: pa.Table, ranges: Ranges, n: int) -> pa.Table:
    names = ("b3", "b2", "p3", "p2", "p1")
    if not texts.num_rows:
        return pa.table({**{c: pa.array([], pa.int32()) for c in names[:2]}, **{c: pa.array([], pa.float64()) for c in names[2:]}, "times": pa.array([], pa.int64())})
    seen = _looked_up(texts, answers, ranges, 1)
    columns = _estimates(seen, n)
    alike = np.zeros(len(columns[0]), np.uint64)
    for c in (*seen.grams, seen.bigram_context, seen.trigram_context):
        alike = mix(alike * np.uint64(3) + c.astype(np.uint64))
    _, first, times = np.unique(alike, return_index=True, return_counts=True)
    return pa.table({
        **{name: c[first] if name.startswith("p") else c[first].astype(np.int32) for name, c in zip(names, columns, strict=True)},
        "times": times.astype(np.int64)})


def _filled(values: dict[int, float]) -> tuple[float, ...]:
    """Weights by octave; octaves that no event fell into take the next lower one's, 0 has none."""
    out = [0.0]
    for i in range(1, OCTAVES):
        out.append(values.get(i, out[-1] if i > 1 else 0.5))
    return tuple(out)


def learn_weights(events: DataFrame, v: int, rounds: int = ROUNDS) -> tuple[Weights, list[float]]:
    """Weights by expectation-maximisation over events (b3, b2, p3, p2, p1, times); and the log-likelihoods a word.

    One use and one passing-over are added to every weight's, which keeps it between 0 and 1.
    A round is one aggregation to at most ``OCTAVES`` squared rows.
    """
    weights, told = Weights(_filled({}), _filled({}), 0.5), []
    for _ in range(rounds):
        a, b = (F.element_at(F.array(*map(F.lit, w)), F.col(c) + 1) for w, c in ((weights.trigram, "b3"), (weights.bigram, "b2")))
        d = weights.word
        parts = events.select(
            "b3", "b2", "times", (a * F.col("p3")).alias("x3"), ((1 - a) * b * F.col("p2")).alias("x2"),
            ((1 - a) * (1 - b) * d * F.col("p1")).alias("x1"), ((1 - a) * (1 - b) * (1 - d) / (v + 1)).alias("x0"))
        p = F.col("x3") + F.col("x2") + F.col("x1") + F.col("x0")
        sums = [F.sum(F.col("times") * F.col(x) / p).alias(x) for x in ("x3", "x2", "x1", "x0")]
        rows = parts.groupBy("b3", "b2").agg(
            F.sum("times").alias("times"), F.sum(F.col("times") * F.ln(p)).alias("ll"), *sums).collect()
        n = sum(r["times"] for r in rows)
        if not n:
            break
        told.append(math.fsum(r["ll"] for r in rows) / n)

        def share(octave: str, used: str, reached: list[str]) -> tuple[float, ...]:
            up: dict[int, list[float]] = {}
            for r in rows:
                s = up.setdefault(r[octave], [1.0, 2.0])
                s[0] += r[used]
                s[1] += sum(r[x] for x in reached)
            return _filled({k: x / y for k, (x, y) in up.items() if k})

        word = (1 + sum(r["x1"] for r in rows)) / (2 + sum(r["x1"] + r["x0"] for r in rows))
        weights = Weights(share("b3", "x3", ["x3", "x2", "x1", "x0"]), share("b2", "x2", ["x2", "x1", "x0"]), word)
        if len(told) > 1 and told[-1] - told[-2] < STILL:
            break
    return weights, told


def _scored(texts: pa.Table, answers: pa.Table, ranges: Ranges, weights: Weights, n: int, v: int) -> pa.Table:
    if not texts.num_rows:
        return pa.table({"doc_id": pa.array([], pa.int64()), "held_out": pa.array([], pa.bool_()),
                         **{c: pa.array([], pa.int64()) for c in ("n_tokens", "n_known", "train_tokens")},
                         "base_score": pa.array([], pa.float64()), "score": pa.array([], pa.float64())})
    seen = _looked_up(texts, answers, ranges, 0)
    b3, b2, p3, p2, p1 = _estimates(seen, n)
    one, begins = seen.grams[0], seen.begins
    a, b, d = np.array(weights.trigram)[b3], np.array(weights.bigram)[b2], weights.word
    p = a * p3 + (1 - a) * (b * p2 + (1 - b) * (d * p1 + (1 - d) / (v + 1)))
    base = np.log10((one + 1) / (n + (v + 1)))
    rows = len(begins)
    return pa.table({
        "doc_id": texts.column("doc_id"),
        "held_out": pa.array([texts.column("kind")[0].as_py() == HELD_OUT] * rows),
        "n_tokens": np.diff(begins, append=len(one)).astype(np.int64),
        "n_known": np.add.reduceat((one > 0).astype(np.int64), begins),
        "train_tokens": np.full(rows, n, np.int64),
        "base_score": np.add.reduceat(base, begins), "score": np.add.reduceat(np.log10(p), begins)})


def _in_chunks(rows: DataFrame, size: int) -> DataFrame:
    """Rows with the number of a chunk of one kind and about ``size`` bytes, within one task's rows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId() << 32
        filled, current, made = [size] * 3, [0] * 3, 0
        for batch in batches:
            lengths = pc.binary_length(batch.column("text")).to_pylist()
            numbers = []
            for kind, length in zip(batch.column("kind").to_pylist(), lengths, strict=True):
                if filled[kind] >= size:
                    filled[kind], current[kind], made = 0, task + made, made + 1
                filled[kind] += length + 16
                numbers.append(current[kind])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(numbers, pa.int64())], [*batch.schema.names, "chunk"])

    return rows.mapInArrow(run, "doc_id long, text binary, kind int, chunk long")


def score_texts(docs: DataFrame, held_out: Column, kept: int = KEPT) -> DataFrame:
    """Score all texts by a model learned from those that are not ``held_out``.

    Per row: doc_id, held_out, n_tokens (words and one end), n_known (tokens seen in
    training), train_tokens, base_score (add-one unigram) and score, both log10.
    """
    spark = docs.sparkSession
    draw = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    kind = (
        F.when(held_out, HELD_OUT)
        .when(F.xxhash64(draw) % kept == 0, DELETED).otherwise(COUNTED)
    )
    rows = docs.select(F.col("doc_id").cast("long"), F.expr(TEXT), kind.cast("int").alias("kind"))
    size = docs.agg(F.sum(F.octet_length("text") + 1)).first()[0] or 0
    n_words = size // 5 + 1
    ranges = Ranges(n_words // MET + 1, min(32 + n_words.bit_length(), 64))
    buckets = min(size // CHUNK + 1, 100_000)

    chunked = _in_chunks(rows, CHUNK)
    name = bucketed_table(spark, scratch(spark, "lm-texts"), chunked.schema, ["chunk"], buckets)
    append_bucketed(chunked, name)
    texts = spark.table(name)
    request = "slot int, chunk long, kind int, grams binary"
    answer = "slot int, chunk long, kind int, totals binary, n long, v long, n_counted long, v_counted long"

    def answered(sent: DataFrame, slots: int) -> DataFrame:
        return stored(sent.repartition(slots, "slot").groupBy("slot").applyInArrow(_answered, answer), "lm-answers")

    def asked(answers: DataFrame) -> DataFrame:
        return answers.select("chunk", "kind", "slot", "totals").filter("chunk IS NOT NULL")

    small = answered(texts.groupBy("chunk").applyInArrow(lambda t: _sent(t, ranges), request), 2 * ranges.groups)
    sums = small.filter(F.col("chunk").isNull() & (F.col("slot") < ranges.groups)).agg(
        *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("n", "v", "n_counted", "v_counted")]).first()
    n, v = sums["n"], sums["v"]
    sent = texts.groupBy("chunk").cogroup(asked(small).groupBy("chunk")).applyInArrow(
        lambda t, r: _sent_open(t, r, ranges), request)
    told = asked(small).unionByName(asked(answered(sent, ranges.groups)))

    deleted, counted = f"kind = {DELETED}", sums["n_counted"]
    events = texts.filter(deleted).groupBy("chunk").cogroup(told.filter(deleted).groupBy("chunk")).applyInArrow(
        lambda t, r: _events(t, r, ranges, counted), "b3 int, b2 int, p3 double, p2 double, p1 double, times long")
    weights, _ = learn_weights(stored(events, "lm-events"), sums["v_counted"])

    scored = texts.groupBy("chunk").cogroup(told.groupBy("chunk")).applyInArrow(
        lambda t, r: _scored(t, r, ranges, weights, n, v),
        "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")
    done = stored(scored, "lm-scores")
    spark.sql(f"DROP TABLE {name}")
    return done


def report(docs: DataFrame) -> DataFrame:
    """Scores of all texts; those whose id's CRC-32 leaves 2 by 7 are not learned from."""
    draw = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    return score_texts(docs, draw % 7 == 2)
