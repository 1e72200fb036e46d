"""Rating a long history piece by piece, with the ratings carried on in written tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitchvault.operators.elo import elo_history, played, ratings_after
from pitchvault.sources.tables import append_table, export_mart, read_table


def connected_teams(matches: DataFrame, pool: str, root: str) -> DataFrame:
    """``(pool, team_title, grp)``: teams share a group if a chain of matches connects them.

    Every team takes the smallest name in its neighbourhood until nothing changes. Each
    round is written, so it neither grows the plan nor is lost with an executor; the
    number of rounds is the length of the longest such chain, short for a piece of a
    season.
    """
    spark = matches.sparkSession
    # Both directions of a match from one scan, told apart once.
    both = matches.select(pool, F.inline(F.array(
        F.struct(F.col("home_team_title").alias("a"), F.col("away_team_title").alias("b")),
        F.struct(F.col("away_team_title").alias("a"), F.col("home_team_title").alias("b"))))).distinct()
    export_mart(both, f"{root}/edges")
    edges = spark.read.parquet(f"{root}/edges")
    labels = edges.groupBy(pool, F.col("a").alias("team_title")).agg(F.least(F.min("b"), F.min("a")).alias("grp"))
    labels, step = labels.withColumn("moved", F.lit(True)), 0
    while True:
        path = f"{root}/labels-{step}"
        export_mart(labels, path)
        # Counted where it is written: a round is worked out once.
        now = spark.read.parquet(path)
        if now.filter("moved").isEmpty():
            return now.drop("moved")
        near = edges.join(now.select(pool, F.col("team_title").alias("b"), "grp"), [pool, "b"])
        best = near.groupBy(pool, F.col("a").alias("team_title")).agg(F.min("grp").alias("near"))
        labels, step = now.join(best, [pool, "team_title"]).select(
            pool, "team_title", F.least("grp", "near").alias("grp"), (F.col("near") < F.col("grp")).alias("moved")), step + 1


def rate_in_pieces(
    matches: DataFrame,
    cuts: Sequence,
    root: str,
    pool: str = "league_id",
    tie_break: Sequence[str] = ("match_hk",),
    **formula,
) -> DataFrame | None:
    """``elo_history`` worked out between consecutive dates of ``cuts``, oldest piece first.

    A piece starts from the ratings the one before it wrote below ``root``. Within a piece
    the teams that no chain of matches connects do not affect each other, so each such
    group is a stream of its own: a pool of many teams spreads over many tasks, and no
    task reads more than its group's matches of one piece.

    The rows equal those of ``elo_history`` but for ``match_seq``, which here numbers the
    matches of a pool within a group and piece; it grows along each team's matches. The
    written history is at ``<root>/history``; without any played match there is none.
    """
    spark = matches.sparkSession
    # Text that is never NULL stands for the pool inside.
    games = played(matches).withColumn("__pool", F.to_json(F.struct(F.col(pool).alias("p"))))
    edges = [None, *cuts, None]
    ratings = None
    for i, (low, high) in enumerate(zip(edges, edges[1:])):
        piece = games
        if low is not None:
            piece = piece.filter(F.col("match_date") >= F.lit(low))
        if high is not None:
            piece = piece.filter(F.col("match_date") < F.lit(high))
        if piece.isEmpty():
            continue
        work = f"{root}/piece-{i}"
        groups = connected_teams(piece, "__pool", f"{work}/groups").select(
            "__pool", "team_title", F.to_json(F.struct("__pool", "grp")).alias("__stream"))
        named = piece.join(groups.withColumnRenamed("team_title", "home_team_title"), ["__pool", "home_team_title"])
        seeds = None if ratings is None else ratings.join(groups, ["__pool", "team_title"])
        rated = elo_history(named, "__stream", tie_break=tie_break, ratings=seeds, **formula)
        export_mart(rated.withColumn("__pool", F.get_json_object("__stream", "$.__pool")).drop("__stream"), f"{work}/history")
        done = spark.read.parquet(f"{work}/history")
        plain = F.get_json_object("__pool", "$.p").cast(matches.schema[pool].dataType)
        append_table(done.withColumn(pool, plain).drop("__pool"), f"{root}/history")
        newest = ratings_after(done, "__pool")
        if ratings is not None:
            newest = newest.unionByName(ratings.join(newest, ["team_title", "__pool"], "left_anti"))
        export_mart(newest, f"{work}/ratings")
        ratings = spark.read.parquet(f"{work}/ratings")
    return read_table(spark, f"{root}/history")
