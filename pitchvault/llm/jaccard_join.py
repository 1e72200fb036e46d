"""N-gram Jaccard self-join of documents by signature trees.

A document is the set of its distinct 5-word shingles; sets link at a similarity of 0.8 or
more. The result is each document's class, the documents it reaches through links.

1. Equal sets fall together; one document stands for them.
2. Two linked sets share a token among the first fifth of their tokens in any fixed order,
   and it is in the first ninth of the smaller one. Tokens are ordered by how often they
   occur in the corpus (counted in a sketch of fixed size; any order gives the same
   result, a rarity order the fewest meetings). Sets that meet so are joined into regions
   by stars, one star per token and size class, never pair by pair.
3. Where the sketch cannot tell rare tokens from frequent ones, chance meetings chain sets
   into large regions. A region of more sets than ``BLOCK`` is parted: linked sets share so
   many tokens of their prefixes, not one only, and sets are held together only if they do.
4. Each region is a signature tree, joined with itself by dual traversal. A region that is
   still too large is cut into blocks: each block for itself, then every block with
   the first, then those pairs of blocks that earlier rounds have not fully connected.

Words are runs of bytes other than space and 09-0D, A-Z lower-cased. With fewer than five
words the whole sequence is the only shingle; without words, or a null text, the set is
empty and links with nothing. Tokens are 64-bit hashes of shingles. Repeated rows come out
once each, in one class. Rows without doc_id take part in nothing and have no class.
Other columns do not matter.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from pitchvault.llm.common import BLOOM, LOWER, TEXT, chunks, fixed, free_shuffles, grams, record, settings, stored, table_of, words
from pitchvault.llm.graph import components
from pitchvault.llm.signature_tree import SignatureTree

SHINGLE = 5
BLOCK = 4096  # sets in one tree
BLOCK_TOKENS = 4_000_000  # tokens in one tree
FEW = 16  # sets of a token whose pairs are counted
CELLS = 1 << 22  # of the sketch of token counts, 16 MB whatever the corpus holds
_PART = 1 << 16  # cells in a row of the sketch

HASH = "xxhash64(text) AS text_hash"
INSIDE = 1 - table_of([0x20, *range(0x09, 0x0E)])


def shingles(text: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Shingle hashes of a chunk, and where each row's begin."""
    _, _, hashes, first = words(LOWER[text], offsets, INSIDE)
    counts = np.diff(first)
    n = np.where(counts >= SHINGLE, counts - SHINGLE + 1, np.minimum(counts, 1))
    begins = np.concatenate([[0], np.cumsum(n)])
    at = np.arange(begins[-1]) - np.repeat(begins[:-1] - first[:-1], n)
    out = np.empty(len(at), np.uint64)
    full = np.repeat(counts >= SHINGLE, n)
    if full.any():
        out[full] = grams(hashes, SHINGLE)[at[full]]
    for row in np.flatnonzero((counts > 0) & (counts < SHINGLE)):
        out[begins[row]] = grams(hashes[first[row] : first[row + 1]], int(counts[row]))[0]
    return out, begins


def distinct(tokens: np.ndarray) -> np.ndarray:
    if len(tokens) < 2:
        return tokens
    tokens = np.sort(tokens)
    return tokens[np.concatenate([[True], tokens[1:] != tokens[:-1]])]


def token_set(text: bytes) -> np.ndarray:
    raw = np.frombuffer(text, np.uint8)
    return distinct(shingles(raw, np.array([0, len(raw)]))[0])


def _cell(tokens: np.ndarray) -> np.ndarray:
    return (tokens >> np.uint64(64 - CELLS.bit_length() + 1)).astype(np.int64)


def sketch(docs: DataFrame) -> np.ndarray:
    """Occurrences of tokens in all documents by cell; its size does not depend on the corpus.

    Every task fills a sketch; Spark adds them up in levels of 128, a slice of cells apart.
    """
    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        cells, waiting, size = np.zeros(CELLS, np.int64), [], 0
        for batch in batches:
            for _, raw, offsets in chunks(batch):
                waiting.append(_cell(shingles(raw, offsets)[0]))
                size += len(waiting[-1])
                if size >= CELLS // 2:
                    cells += np.bincount(np.concatenate(waiting), minlength=CELLS)
                    waiting, size = [], 0
        if waiting:
            cells += np.bincount(np.concatenate(waiting), minlength=CELLS)
        task, parts = TaskContext.get().partitionId(), cells.reshape(-1, _PART)
        yield pa.RecordBatch.from_arrays(
            [pa.array([task] * len(parts), pa.int64()), pa.array(range(len(parts)), pa.int64()), pa.array([_packed(p) for p in parts])],
            names=["task", "part", "cells"])

    def add(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        total = sum(_unpacked(c) for c in rows["cells"])
        return pd.DataFrame({"task": [key[1]], "part": [key[0]], "cells": [_packed(total)]})

    schema = "task long, part long, cells binary"
    rows = docs.select(F.expr(TEXT)).mapInArrow(fill, schema)
    for _ in range(3):
        rows = rows.withColumn("task", F.expr("task DIV 128")).groupBy("part", "task").applyInPandas(add, schema)
    out = np.zeros(CELLS, np.int64)
    for r in rows.collect():  # CELLS numbers in all
        out[r["part"] * _PART : (r["part"] + 1) * _PART] += _unpacked(r["cells"])
    return out


def _packed(cells: np.ndarray) -> bytes:
    return zlib.compress(cells.astype("<i8").tobytes(), 1)


def _unpacked(raw: bytes) -> np.ndarray:
    return fixed(zlib.decompress(raw), "<i8")


def prefixes(docs: DataFrame, counts: np.ndarray) -> DataFrame:
    """doc_id, text_hash, n, node (a hash of the whole set), and the rarest fifth of its tokens.

    ``hot`` tells how many of the last tokens of the prefix may be too frequent for one task.
    Of equal sets in a batch only the first that has a doc_id comes with its prefix.
    """
    rarity = np.minimum(counts, 2**31 - 1).astype(np.int32)
    hot_from = 4 * int(rarity.mean()) + 1000
    fields = pa.schema([("doc_id", pa.int64()), ("text_hash", pa.int64()), ("n", pa.int64()), ("node", pa.int64()), ("prefix", pa.list_(pa.int64())), ("hot", pa.int32())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen: set[int] = set()
            for start, raw, offsets in chunks(batch):
                tokens, begins = shingles(raw, offsets)
                named = batch.column("doc_id").slice(start, len(offsets) - 1).is_valid().to_pylist()
                rows = []
                for a, b, has_id in zip(begins, begins[1:], named, strict=False):
                    s = distinct(tokens[a:b])
                    n = len(s)
                    node = int.from_bytes(hashlib.blake2b(s.tobytes(), digest_size=8).digest(), "little", signed=True)
                    if node in seen or not has_id:
                        rows.append((n, node, None, 0))
                        continue
                    seen.add(node)
                    take = n - -(-4 * n // 5) + 1 if n else 0
                    often = rarity[_cell(s)]
                    rare = np.argsort(often, kind="stable")[:take]
                    rows.append((n, node, s[rare].view(np.int64), int((often[rare] > hot_from).sum())))
                own = batch.slice(start, len(rows))
                yield record(fields, own.column("doc_id"), own.column("text_hash"), *map(list, zip(*rows, strict=True)))

    return docs.select("doc_id", F.expr(HASH), F.expr(TEXT)).mapInArrow(
        run, "doc_id long, text_hash long, n long, node long, prefix array<long>, hot int")


def regions(sets: DataFrame) -> DataFrame:
    """(node, region) of sets that may link with another; all links lie within regions.

    Let a be the smaller of two linked sets and t the first token, in the common order,
    that both hold. t is among the first ninth of a and the first fifth of b, and b has a
    size class of a's or the next. Each (t, class) with such an a has a star around its
    least a; every set with t in its prefix joins the stars of its class and the one below.

    The sketch bounds how many sets hold a token. Where the bound is a small part of the
    corpus, the sets of a token meet in one task; tokens beyond it are counted before the
    shuffle and joined back, so that Spark can split them.
    """
    size_class = F.floor(F.log("n") / F.log(F.lit(1.25))).cast("int")
    rows = sets.filter("n > 0").select(
        "node", "n", size_class.alias("c"), (F.size("prefix") - F.col("hot")).alias("cold"), F.posexplode("prefix").alias("pos", "token"))
    rows = rows.withColumn("centre", F.when(F.expr("9 * pos <= n"), F.col("node")))

    w = W.partitionBy("token")
    of_class = w.orderBy("c").rangeBetween(0, 0)
    of_below = w.orderBy("c").rangeBetween(-1, -1)
    cold = (
        rows.filter("pos < cold").select("token", "node", "c", "centre")
        .withColumns({"least": F.min("node").over(w), "most": F.max("node").over(w)})
        .filter("least != most")
        .select("node", F.array(F.min("centre").over(of_class), F.min("centre").over(of_below)).alias("stars"))
        .select("node", F.explode("stars").alias("centre"))
    )

    often = rows.filter("pos >= cold")
    centres = often.filter("centre IS NOT NULL").groupBy("token", "c").agg(F.min("centre").alias("centre"))
    stars = centres.union(centres.select("token", F.col("c") + 1, "centre"))
    hot = often.select("token", "c", "node").join(stars, ["token", "c"]).select("node", "centre")

    edges = cold.union(hot).filter("node != centre").select(F.col("node").alias("a"), F.col("centre").alias("b")).distinct()
    return components(edges).withColumnRenamed("component", "region")


def shared_prefixes(sets: DataFrame) -> DataFrame:
    """Edges (a, b) between ``sets`` (node, n, prefix, hot; one row each): what links is connected.

    Let p(n) = n - ceil(4 n / 5) + 1 be the size of a prefix. Of the tokens that two linked
    sets of sizes m <= n share, at least ceil(4 (m + n) / 9), those up to the end of the
    prefix that ends first are in both prefixes, and at most n - p(n) come later. So the
    prefixes share as many as are left, and at least one. Tokens of up to ``FEW`` sets give
    their pairs, which are counted; the sets of a more frequent token, of one size class
    or the next, are joined by a star whatever else they share.
    """
    size_class = F.floor(F.log("n") / F.log(F.lit(1.25))).cast("int")
    rows = sets.select(
        "node", "n", size_class.alias("c"), (F.size("prefix") - F.col("hot")).alias("cold"), F.posexplode("prefix").alias("pos", "token"))

    w = W.partitionBy("token")
    cold = rows.filter("pos < cold").select("token", "node", "n", "c").withColumn("sets", F.count(F.lit(1)).over(w))
    cold = stored(cold.filter("sets > 1"), "met")
    few = cold.filter(F.col("sets") <= FEW).groupBy("token").agg(F.sort_array(F.collect_list(F.struct("node", "n"))).alias("x"))
    pairs = (
        few.select("x", F.posexplode("x").alias("at", "a")).select("a", F.explode(F.expr("slice(x, at + 2, size(x))")).alias("b"))
        .filter("5 * a.n >= 4 * b.n AND 5 * b.n >= 4 * a.n")
        .groupBy("a", "b").agg(F.count(F.lit(1)).alias("shared"))
        .filter("shared >= (4 * (a.n + b.n) + 8) DIV 9 - (4 * greatest(a.n, b.n) + 4) DIV 5 + 1")
        .select(F.col("a.node").alias("a"), F.col("b.node").alias("b"))
    )

    many = cold.filter(F.col("sets") > FEW).select("token", "node", "c")
    often = many.union(rows.filter("pos >= cold").select("token", "node", "c"))
    centres = often.groupBy("token", "c").agg(F.min("node").alias("centre"))
    stars = centres.union(centres.select("token", F.col("c") + 1, "centre"))
    met = often.join(stars, ["token", "c"]).filter("node != centre").select(F.col("node").alias("a"), F.col("centre").alias("b"))
    return pairs.union(met).distinct()


def parted(members: DataFrame, sets: DataFrame) -> DataFrame:
    """``members`` with the regions of several blocks parted by ``shared_prefixes``; sets without an edge have none."""
    wide = members.filter("blocks > 1")
    held = sets.join(wide.select("node"), "node").groupBy("node").agg(F.first(F.struct("n", "prefix", "hot")).alias("held"))
    with settings(members.sparkSession, BLOOM):
        held = stored(held.select("node", "held.*"), "wide")
    region = components(shared_prefixes(held)).withColumnRenamed("component", "region")
    finer = with_blocks(wide.drop("region", "blocks", "block").join(region, "node"))
    return members.filter("blocks = 1").unionByName(finer)


def _tree(rows: pd.DataFrame) -> tuple[pd.DataFrame, SignatureTree]:
    # A document row that is repeated brings its text as often.
    rows = rows.drop_duplicates("node").sort_values("node").reset_index(drop=True)
    return rows, SignatureTree([token_set(t) for t in rows["text"]], rows["class"].tolist())


def _tree_classes(rows: pd.DataFrame) -> pd.DataFrame:
    """The class of each set of one tree."""
    rows, tree = _tree(rows)
    tree.links()
    ids = rows["node"].to_numpy()
    return pd.DataFrame({"node": ids, "class": [ids[tree._find(i)] for i in range(len(ids))]}, dtype="int64")


def _links_across(rows: pd.DataFrame) -> pd.DataFrame:
    """Links between the blocks of one tree."""
    rows, tree = _tree(rows)
    ids = rows["node"].to_numpy()
    found = tree.links(rows["block"].to_numpy())
    return pd.DataFrame({"a": [ids[i] for i, _ in found], "b": [ids[j] for _, j in found]}, dtype="int64")


LINKS = "a long, b long"


def _settle(members: DataFrame, links: DataFrame) -> DataFrame:
    """``members`` with the class that ``links`` give."""
    found = components(links).select("node", F.col("component").alias("__class"))
    out = members.drop("class").join(found, "node", "left")
    return stored(out.withColumn("class", F.coalesce("__class", "node")).drop("__class"), "classes")


def with_blocks(members: DataFrame) -> DataFrame:
    """``members`` (node, n, region, ...) with the number of blocks of the region and the own block."""
    sizes = members.groupBy("region").agg(F.count(F.lit(1)).alias("__k"), F.sum("n").alias("__n"))
    blocks = F.greatest(F.ceil(F.col("__k") / BLOCK), F.ceil(F.col("__n") / BLOCK_TOKENS))
    cut = members.join(sizes.select("region", blocks.alias("blocks")), "region")
    return cut.withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")))


def tree_classes(members: DataFrame, texts: DataFrame) -> DataFrame:
    """(node, class) of ``members`` (node, region, blocks, block); ``texts`` adds text as bytes."""
    alone = texts.withColumn("class", F.col("node")).select("region", "block", "node", "text", "class")
    # Few documents are in a region: a Bloom filter keeps the other texts from the shuffle.
    # Their list grows with the corpus, so it is merged with the texts at every size.
    with settings(members.sparkSession, BLOOM):
        within = stored(alone.groupBy("region", "block").applyInPandas(_tree_classes, "node long, class long"), "classes")
    if members.filter("blocks > 1").isEmpty():
        return within

    # Regions of several blocks: classes within blocks are links to start from.
    with settings(members.sparkSession, BLOOM):
        large = stored(texts.filter("blocks > 1").select("node", "text"), "large")
    wide = members.filter("blocks > 1").select("node", "region", "block")
    now = stored(wide.join(within, "node"), "classes")
    links = now.select(F.col("node").alias("a"), F.col("class").alias("b"))

    def round_of(pairs: DataFrame) -> DataFrame:
        """Links across the given pairs (region, i, j) of blocks."""
        sides = pairs.select("region", "i", "j", F.explode(F.array("i", "j")).alias("block"))
        rows = sides.join(now, ["region", "block"]).join(large, "node")
        return stored(rows.groupBy("region", "i", "j").applyInPandas(_links_across, LINKS), "links")

    def per_block() -> DataFrame:
        return stored(now.groupBy("region", "block").agg(F.min("class").alias("low"), F.max("class").alias("high")), "per-block")

    links = links.union(round_of(per_block().filter("block > 0").select("region", F.lit(0).cast("long").alias("i"), F.col("block").alias("j"))))
    now = _settle(now, links)
    ends = per_block()
    a, b = (ends.select("region", *[F.col(c).alias(c + s) for c in ("block", "low", "high")]) for s in "xy")
    open_pairs = (
        a.join(b, "region").filter("blockx > 0 AND blockx < blocky AND NOT (lowx = highx AND lowy = highy AND lowx = lowy)")
        .select("region", F.col("blockx").alias("i"), F.col("blocky").alias("j"))
    )
    if not open_pairs.isEmpty():
        now = _settle(now, links.union(round_of(open_pairs)))
    joined = within.join(now.select("node", F.col("class").alias("__wide")), "node", "left")
    return joined.select("node", F.coalesce("__wide", "class").alias("class"))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id: the least doc_id that links reach, its own included."""
    docs = docs.select(F.col("doc_id").cast("long"), "text")
    sets = stored(prefixes(docs, sketch(docs)), "sets")
    named = sets.filter("doc_id IS NOT NULL AND n > 0")
    first = named.groupBy("node").agg(F.min(F.struct("doc_id", "text_hash")).alias("first"), F.first("n").alias("n"))
    first = stored(first.select("node", "n", "first.*"), "distinct-sets")
    held = named.filter("prefix IS NOT NULL").select("node", "n", "prefix", "hot")
    members = stored(with_blocks(first.join(regions(held), "node")), "members")
    if not members.filter("blocks > 1").isEmpty():
        members = stored(parted(members, held), "members")
    free_shuffles(docs.sparkSession)  # those of the prefixes are the largest
    wanted = members.filter("n > 0").select("doc_id", "text_hash", "node", "region", "blocks", "block")
    texts = docs.select("doc_id", F.expr(HASH), F.expr(TEXT)).join(wanted, ["doc_id", "text_hash"])
    classes = tree_classes(members, texts).select("node", "class")

    in_class = first.join(classes, "node", "left").withColumn("class", F.coalesce("class", "node"))
    named_class = in_class.groupBy("class").agg(F.min("doc_id").alias("component_id"))
    of_node = in_class.select("node", "class").join(named_class, "class").select("node", "component_id")
    all_rows = sets.select("doc_id", F.col("n").alias("n_shingles"), F.when(F.expr("n > 0"), F.col("node")).alias("node"))
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
    return all_rows.join(of_node, "node", "left").select("doc_id", "n_shingles", component.alias("component_id"))
