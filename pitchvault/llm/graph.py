"""Connected components of an edge table, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from pitchvault.llm.common import stored


def _stars(edges: DataFrame, large: bool) -> DataFrame:
    """Link neighbours to the least node of each neighbourhood.

    Large stars move the larger neighbours of a node, small stars the others. The minimum
    per node combines before the shuffle; the join back is one that can split a hot node.
    """
    if large:
        ends = F.array(F.struct(F.col("a").alias("a"), F.col("b").alias("b")), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))
        pairs = edges.select(F.inline(ends))
    else:
        pairs = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = pairs.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
    joined = pairs.join(least, "a")
    if large:
        return joined.filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return joined.select(F.inline(F.array(
        F.struct(F.col("b").alias("a"), F.col("m").alias("b")), F.struct(F.col("a").alias("a"), F.col("m").alias("b")),
    ))).filter("a != b")


def _written(edges: DataFrame) -> tuple[DataFrame, tuple]:
    """The distinct edges as a written table, and their number and a sum of hashes."""
    seen = Observation()
    once = edges.distinct().observe(seen, F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h"))
    out = stored(once, "edges")
    return out, (seen.get["n"], seen.get["h"])


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """(node, component) for every node of ``edges`` (a, b); the component is its least node.

    Rounds of large and small stars until the edges stop changing; every component is
    then a star around its least node. Each round is a written table.
    """
    now, before = _written(edges.filter("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")))
    if before[0]:
        for _ in range(rounds):
            now, after = _written(_stars(_stars(now, True), False))
            if after == before:
                break
            before = after
        else:
            raise RuntimeError(f"components did not settle in {rounds} rounds")
    stars = now.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return stars.union(stars.select("component", "component").distinct())
