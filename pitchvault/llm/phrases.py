"""Collocations from a weighted de Bruijn graph of word triples.

Texts are cut into pieces at punctuation and line ends, pieces into words. A node is a
pair of adjacent words, an edge the triple that leads from a node to the next; a piece
ends with edges to an end mark, so that every word begins exactly one edge. Only edges
are counted over the corpus:

* A task counts the edges of some million words at a time and sends them, as packed
  arrays, to groups by the hash of their node. A group adds them up. A node's count is its
  outgoing flow, the edges to the end mark being the correction for piece ends; a word's
  count is the flow of the nodes that begin with it.
* Groups hold nodes by hash and each sender's edges once, so that a frequent word, phrase
  or language is spread over all groups.
* Where a node has one edge in and one out that carry all its flow, the path goes
  through. Such unary paths are compacted by doubling pointers, in as many rounds as the
  length of the longest path (within one piece) has bits. Only the ends of a path need
  the count of their node looked up; its inner pairs always lie in a longer phrase of the
  same count.

Words are known by 64-bit hashes of language and word; two words with one hash in any
candidate are an error (another ``seed`` then helps). Null and empty texts have no words,
a null language is ``und``. Repeated rows count each for itself. Only ``text`` and the
language column are read. Nothing is sampled; without rows the result is empty.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from pitchvault.llm.blobs import pack, steps, unpack
from pitchvault.llm.common import LOWER, TEXT, chunks, mix, record, settings, stored, table_of, words

BREAKS = table_of([*b".,;:!?", *range(0x0A, 0x0E)]).astype(bool)
INSIDE = 1 - table_of([0x20, 0x09, *b".,;:!?", *range(0x0A, 0x0E)])
END = np.uint64(0)  # not the hash of any word

SENT = 1_000_000  # words whose edges a task counts at a time; ids of 21 bits must do
MET = 1_000_000  # edges that a group is meant to hold
KNOWN = 2_000_000  # words that a task remembers to have sent
PARTS = 8  # parts of a language that are ranked apart first


class Graph(NamedTuple):
    """Frequent nodes and edges (counts of at least ``least``), all word counts, and languages."""

    nodes: DataFrame  # h1, h2, f, out: count and heaviest outgoing edge
    edges: DataFrame  # h1, h2, h3, f
    words: DataFrame  # h, f
    names: DataFrame  # h, lang, word
    sizes: DataFrame  # lang, n


def _hashed(raw: np.ndarray, offsets: np.ndarray, lang: np.ndarray, seed: int) -> tuple[np.ndarray, ...]:
    """Words of a chunk: starts, lengths, hashes with the row's language, row."""
    starts, lengths, h, first = words(raw, offsets, INSIDE)
    row = np.repeat(np.arange(len(lang)), np.diff(first))
    h = mix(h + mix(lang + np.uint64(seed))[row])
    h[h == END] = 1
    return starts, lengths, h, row


def _followed(raw: np.ndarray, starts: np.ndarray, row: np.ndarray) -> list[np.ndarray]:
    """For every word, whether its piece goes on by one word, and by two."""
    piece = np.cumsum(BREAKS[raw])[starts]
    out = []
    for j in (1, 2):
        same = np.zeros(len(row), bool)
        same[:-j] = (piece[j:] == piece[:-j]) & (row[j:] == row[:-j])
        out.append(same)
    return out


def _packed(h: np.ndarray, one: np.ndarray, two: np.ndarray, n: int, groups: int) -> Iterator[tuple[int, bytes]]:
    """Counted edges of the first ``n`` words, by group of their node: the words' hashes, three places in them, counts."""
    hashes, ids = np.unique(h, return_inverse=True)
    hashes, ids = np.append(END, hashes), np.append(ids.astype(np.uint64) + np.uint64(1), np.zeros(2, np.uint64))
    key = ids[:n] << np.uint64(42)
    key |= np.where(one[:n], ids[1 : n + 1], 0) << np.uint64(21)
    key |= np.where(two[:n], ids[2 : n + 2], 0)
    key, count = np.unique(key, return_counts=True)
    low = np.uint64((1 << 21) - 1)
    a, b, c = key >> np.uint64(42), key >> np.uint64(21) & low, key & low
    group = mix(hashes[a.astype(np.int64)] * np.uint64(3) + hashes[b.astype(np.int64)]) % np.uint64(groups)
    order = np.argsort(group, kind="stable")
    bounds = np.searchsorted(group[order], np.arange(groups + 1, dtype=np.uint64))
    for g in np.flatnonzero(np.diff(bounds)).tolist():
        mine = order[bounds[g] : bounds[g + 1]]
        used, place = np.unique(np.concatenate([a[mine], b[mine], c[mine]]), return_inverse=True)
        x, y, z = place.reshape(3, -1)
        yield g, pack(steps(hashes[used.astype(np.int64)]), steps(x), y, z, count[mine])


def _merged(blobs: list[bytes], least: int) -> pa.Table:
    """One group's frequent nodes and edges, and the flow of its nodes by first word."""
    parts = [unpack(b) for b in blobs]
    dictionaries = [np.cumsum(p[0], dtype=np.uint64) for p in parts]
    hashes = np.unique(np.concatenate(dictionaries))
    place = [np.searchsorted(hashes, d).astype(np.uint64) for d in dictionaries]
    a = np.concatenate([w[np.cumsum(p[1], dtype=np.int64)] for w, p in zip(place, parts, strict=True)])
    b, c = (np.concatenate([w[p[i].astype(np.int64)] for w, p in zip(place, parts, strict=True)]) for i in (2, 3))
    f = np.concatenate([p[4] for p in parts])
    node = a << np.uint64(32) | b
    order = np.lexsort((c, node))
    node, c, f = node[order], c[order], f[order]
    first = np.flatnonzero(np.append(True, (node[1:] != node[:-1]) | (c[1:] != c[:-1])))
    node, c, f = node[first], c[first], np.add.reduceat(f, first)
    starts = np.flatnonzero(np.append(True, node[1:] != node[:-1]))
    flow = np.add.reduceat(f, starts)
    of_node = node[starts]
    inner = hashes[c.astype(np.int64)] != END
    out = np.maximum.reduceat(np.where(inner, f, 0), starts)

    word = of_node >> np.uint64(32)
    heads = np.flatnonzero(np.append(True, word[1:] != word[:-1]))
    low = np.uint64((1 << 32) - 1)

    def named(ids: np.ndarray) -> np.ndarray:
        return hashes[ids.astype(np.int64)].view(np.int64)

    pair = (flow >= least) & (hashes[(of_node & low).astype(np.int64)] != END)
    triple = (f >= least) & inner
    zeros = [np.zeros(int(n), np.int64) for n in (len(heads), pair.sum(), triple.sum())]
    columns = {
        "size": [np.full(len(z), i + 1, np.int32) for i, z in enumerate(zeros)],
        "h1": [named(word[heads]), named(of_node[pair] >> np.uint64(32)), named(node[triple] >> np.uint64(32))],
        "h2": [zeros[0], named(of_node[pair] & low), named(node[triple] & low)],
        "h3": [zeros[0], zeros[1], named(c[triple])],
        "f": [np.add.reduceat(flow, heads).astype(np.int64), flow[pair].astype(np.int64), f[triple].astype(np.int64)],
        "out": [zeros[0], out[pair].astype(np.int64), zeros[2]],
    }
    return pa.table({k: np.concatenate(v) for k, v in columns.items()})


def phrase_graph(docs: DataFrame, by: str = "lang", least: int = 10, seed: int = 0) -> Graph:
    """The weighted graph of all texts, frequent parts only, with the counts of all words."""
    lang = F.coalesce(F.col(by).cast("string"), F.lit("und"))
    rows = docs.select(lang.alias("lang"), F.xxhash64(lang).alias("by"), F.expr(TEXT))
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    groups = size // 5 // MET + 1
    sent = pa.schema([("group", pa.int32()), ("edges", pa.binary())])
    told = pa.schema([("lang", pa.string()), ("h", pa.int64()), ("word", pa.string()), ("n", pa.int64())])

    def edges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0

        def flush() -> Iterator[pa.RecordBatch]:
            h, one, two = (np.concatenate(x) for x in zip(*held, strict=True))
            for i in range(0, len(h), SENT):
                some = slice(i, i + SENT + 2)
                blobs = _packed(h[some], one[some], two[some], min(SENT, len(h) - i), groups)
                yield record(sent, *map(list, zip(*blobs, strict=True)))

        for batch in batches:
            of_row = batch.column("by").to_numpy().view(np.uint64)
            for first, raw, offsets in chunks(batch):
                low = LOWER[raw]
                starts, _, h, row = _hashed(low, offsets, of_row[first : first + len(offsets) - 1], seed)
                if len(h):
                    held.append((h, *_followed(low, starts, row)))
                    n += len(h)
                if n >= SENT:
                    yield from flush()
                    held, n = [], 0
        if n:
            yield from flush()

    def vocabulary(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, totals = np.empty(0, np.uint64), {}
        for batch in batches:
            of_row = batch.column("by").to_numpy().view(np.uint64)
            for first, raw, offsets in chunks(batch):
                low = LOWER[raw]
                rows = len(offsets) - 1
                starts, lengths, h, row = _hashed(low, offsets, of_row[first : first + rows], seed)
                names = batch.column("lang").slice(first, rows).to_pylist()
                for name, n in zip(names, np.bincount(row, minlength=rows).tolist(), strict=True):
                    totals[name] = totals.get(name, 0) + n
                # Words of one hash are told apart by their length, their bytes' sum and their last byte.
                upto = np.cumsum(np.append(0, low), dtype=np.uint64)
                ends = starts + lengths
                told_apart = mix((upto[ends] - upto[starts]) << np.uint64(32) | lengths.astype(np.uint64) << np.uint64(8) | low[ends - 1])
                fresh, at = np.unique(h * np.uint64(3) + told_apart, return_index=True)
                place = np.searchsorted(known, fresh)
                new = np.append(known, ~fresh[-1:])[place] != fresh
                at = at[new]
                # Two ascending runs, which a stable sort merges.
                known = np.sort(np.concatenate([known, fresh[new]]), kind="stable") if len(known) < KNOWN else fresh[new]
                text = low.tobytes()
                found = [text[a:b] for a, b in zip(starts[at].tolist(), ends[at].tolist(), strict=True)]
                yield record(told, [names[i] for i in row[at].tolist()], h[at].view(np.int64), found, [None] * len(at))
        yield record(told, list(totals), [None] * len(totals), [None] * len(totals), list(totals.values()))

    met = rows.select("by", "text").mapInArrow(edges, "group int, edges binary")
    # As many tasks as groups: what a task reads does not grow with the corpus.
    merged = met.repartition(groups, "group").groupBy("group").applyInArrow(
        lambda t: _merged(t.column("edges").to_pylist(), least), "size int, h1 long, h2 long, h3 long, f long, out long")
    counted = stored(merged, "phrase-graph")
    spelled = stored(rows.mapInArrow(vocabulary, "lang string, h long, word string, n long"), "phrase-words")
    return Graph(
        counted.filter("size = 2").select("h1", "h2", "f", "out"),
        counted.filter("size = 3").select("h1", "h2", "h3", "f"),
        counted.filter("size = 1").groupBy(F.col("h1").alias("h")).agg(F.sum("f").alias("f")),
        spelled.filter("h IS NOT NULL").select("h", "lang", "word").distinct(),
        spelled.filter("h IS NULL").groupBy("lang").agg(F.sum("n").alias("n")).filter("n > 0"),
    )


def with_heaviest_in(graph: Graph) -> DataFrame:
    """Frequent nodes with their heaviest frequent edge in either direction, and whether they are unary."""
    into = graph.edges.groupBy(F.col("h2").alias("h1"), F.col("h3").alias("h2")).agg(F.max("f").alias("into"))
    return graph.nodes.join(into, ["h1", "h2"], "left").withColumn("into", F.coalesce("into", F.lit(0))).withColumn(
        "unary", (F.col("f") == F.col("out")) & (F.col("f") == F.col("into")))


def compact_paths(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """Maximal unary paths of the frequent graph: hashes of their words, and the count that all their edges share.

    A unary node's flow is that of its one edge in and its one edge out. Circles of such
    nodes cannot be: some piece would have to begin or end in them.
    """
    inner = nodes.filter("unary").select("h1", "h2")
    ahead = inner.select(F.col("h1").alias("h2"), F.col("h2").alias("h3"), F.lit(True).alias("open"))
    # From every unary node to the next one, while that is unary too.
    onward = edges.join(inner, ["h1", "h2"]).join(ahead, ["h2", "h3"], "left").select(
        "h1", "h2", F.when(F.col("open"), F.col("h2")).otherwise(F.col("h1")).alias("to1"),
        F.when(F.col("open"), F.col("h3")).otherwise(F.col("h2")).alias("to2"),
        F.when(F.col("open"), 1).otherwise(0).alias("far"), F.coalesce("open", F.lit(False)).alias("open"))
    pointers = stored(onward, "phrase-pointers")
    while not pointers.filter("open").isEmpty():
        there = pointers.select(
            F.col("h1").alias("to1"), F.col("h2").alias("to2"), F.col("to1").alias("on1"), F.col("to2").alias("on2"),
            F.col("far").alias("more"), F.col("open").alias("still"))
        moved = pointers.filter("open").join(there, ["to1", "to2"]).select(
            "h1", "h2", F.col("on1").alias("to1"), F.col("on2").alias("to2"), (F.col("far") + F.col("more")).alias("far"),
            F.col("still").alias("open"))
        pointers = stored(pointers.filter("NOT open").unionByName(moved), "phrase-pointers")

    # The last unary node of a path names it; an edge lies so many steps before that node.
    end = pointers.select("h1", "h2", "to1", "to2", "far")
    head = end.select(F.col("h1").alias("h2"), F.col("h2").alias("h3"), F.col("to1").alias("e1"), F.col("to2").alias("e2"),
                      (F.col("far") + 1).alias("left"))
    tail = end.filter("far = 0").select("h1", "h2", F.lit(True).alias("last"))
    placed = edges.join(head, ["h2", "h3"], "left").join(tail, ["h1", "h2"], "left").select(
        "h1", "h2", "h3", "f",
        F.coalesce("e1", F.when(F.col("last"), F.col("h1"))).alias("e1"),
        F.coalesce("e2", F.when(F.col("last"), F.col("h2"))).alias("e2"), F.coalesce("left", F.lit(0)).alias("left"))
    alone = placed.filter("e1 IS NULL").select(F.array("h1", "h2", "h3").alias("path"), "f")
    steps_ = F.sort_array(F.collect_list(F.struct(-F.col("left"), "h1", "h2", "h3")))
    long = placed.filter("e1 IS NOT NULL").groupBy("e1", "e2").agg(steps_.alias("s"), F.min("f").alias("f")).select(
        F.concat(F.array(F.col("s")[0]["h1"], F.col("s")[0]["h2"]), F.col("s.h3")).alias("path"), "f")
    return alone.unionByName(long)


def _triples(paths: DataFrame, nodes: DataFrame) -> DataFrame:
    """Every triple on a path, with the counts of its first and its last pair."""
    n = F.size("path")
    first = nodes.select(F.col("h1").alias("a1"), F.col("h2").alias("a2"), F.col("f").alias("front"))
    last = nodes.select(F.col("h1").alias("z1"), F.col("h2").alias("z2"), F.col("f").alias("back"))
    ends = (
        paths.withColumns({
            "a1": F.element_at("path", 1), "a2": F.element_at("path", 2),
            "z1": F.element_at("path", -2), "z2": F.element_at("path", -1)})
        .join(first, ["a1", "a2"]).join(last, ["z1", "z2"])
    )
    at = F.explode(F.sequence(F.lit(0), n - 3)).alias("i")
    return ends.select("path", "f", "front", "back", n.alias("n"), at).select(
        *[F.get("path", F.col("i") + j).alias(f"h{j + 1}") for j in range(3)], "f",
        F.when(F.col("i") == 0, F.col("front")).otherwise(F.col("f")).alias("l2"),
        F.when(F.col("i") == F.col("n") - 3, F.col("back")).otherwise(F.col("f")).alias("r1"))


def score(a: str, l: str, r: str) -> Column:
    """floor(1,000,000 * a * a / (l * r)), exactly, for counts below 10 ** 15."""
    big = [f"CAST({x} AS DECIMAL(15, 0))" for x in (a, l, r)]
    return F.expr(f"(1000000 * ({big[0]} * {big[0]})) DIV ({big[1]} * {big[2]})")


def collocations(
    docs: DataFrame, by: str = "lang", least: int = 10, covered_percent: int = 50, top: int = 2000, seed: int = 0,
) -> DataFrame:
    """Per language, the ``top`` phrases of two or three words that hold together best.

    A pair that a frequent triple around it covers by ``covered_percent`` is left out.
    """
    graph = phrase_graph(docs, by, least, seed)
    nodes = stored(with_heaviest_in(graph), "phrase-nodes")
    paths = compact_paths(nodes, graph.edges)

    triples = _triples(paths, nodes)
    covered = 100 * F.greatest("out", "into") >= covered_percent * F.col("f")
    pairs = nodes.filter(~F.col("unary") & ~((F.greatest("out", "into") >= least) & covered))
    candidates = triples.unionByName(pairs.select("h1", "h2", "f"), allowMissingColumns=True)

    # A candidate's words are as frequent as it is at least.
    known = graph.words.filter(F.col("f") >= least).join(graph.names, "h")
    spelled = stored(known.select("h", "f", "lang", "word"), "phrase-known")
    if not spelled.groupBy("h").count().filter("count > 1").isEmpty():
        raise ValueError(f"two words share a hash; take another seed than {seed}")

    for j in (1, 2, 3):
        of = spelled.select(F.col("h").alias(f"h{j}"), F.col("f").alias(f"f{j}"), F.col("word").alias(f"w{j}"),
                            *(["lang"] if j == 1 else []))
        candidates = candidates.join(of, f"h{j}", "left" if j == 3 else "inner")
    cut1 = F.struct(score("f", "f1", "coalesce(r1, f2)").alias("score"), F.lit(1).alias("k"),
                    F.col("f1").alias("l"), F.coalesce("r1", "f2").alias("r"))
    cut2 = F.struct(score("f", "l2", "f3").alias("score"), F.lit(2).alias("k"), F.col("l2").alias("l"), F.col("f3").alias("r"))
    best = F.when(F.col("w3").isNull(), cut1).otherwise(F.least(cut1, cut2)).alias("cut")
    scored = candidates.select("lang", F.concat_ws(" ", "w1", "w2", "w3").alias("phrase"), F.col("f").alias("a"), best).select(
        "lang", "phrase", "a", "cut.l", "cut.r", "cut.score")
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    # Every task keeps its own first ``top`` rows of a part of a language before they meet;
    # a language's last task reads those of its parts, however many tasks there were.
    with settings(docs.sparkSession, {"spark.sql.optimizer.windowGroupLimitThreshold": str(top)}):
        part = W.partitionBy("lang", "part").orderBy(*order)
        first = scored.withColumn("part", F.pmod(F.hash("phrase"), F.lit(PARTS))).withColumn("rank", F.row_number().over(part))
        first = first.filter(F.col("rank") <= top).drop("rank", "part")
        ranked = first.withColumn("rank", F.row_number().over(W.partitionBy("lang").orderBy(*order))).filter(F.col("rank") <= top)
        return stored(
            ranked.join(graph.sizes, "lang").select("lang", F.col("rank").cast("long"), "phrase", "a", "l", "r", "n", "score"),
            "phrases")
