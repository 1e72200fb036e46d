"""Ratings after corrected results: only the matches that a correction reaches are rated again.

A correction changes the ratings of both teams from that match on, and through their later
matches those of their opponents. The reach is found by rounds: every team has the moment from
which its rating is in doubt, first that of its earliest changed match; a match of a team in
doubt puts its opponent in doubt too. It stands when a round moves no team's moment. The rounds are at
most as many as matches follow each other in a chain of opponents, in a league some ten.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from pitchvault.operators.elo import elo_history, played
from pitchvault.operators.reshape import unpivot_sides
from pitchvault.operators.versions import split_row_number
from pitchvault.sources.tables import append_bucketed, bucketed_table, export_mart, scratch

SAME = ["pool", "match_date", "home", "away", "again"]  # a match; ``again`` tells repeated ones apart
MOMENT = ["match_date", "home", "tie"]  # the order of a pool's matches


def _written(df: DataFrame, name: str) -> DataFrame:
    path = scratch(df.sparkSession, name)
    export_mart(df, path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _matches(matches: DataFrame, pool: str, tie_break: Sequence[str]) -> DataFrame:
    """Played matches with their place in the order."""
    tie = F.struct(*tie_break)
    rows = played(matches).select(
        F.col(pool).alias("pool"), F.col("match_date").cast("date"), F.col("home_team_title").alias("home"),
        F.col("away_team_title").alias("away"), F.col("home_goals").cast("int"), F.col("away_goals").cast("int"),
        F.col("season_year").cast("int"), tie.alias("tie"))
    repeated = W.partitionBy("pool", "match_date", "home", "away").orderBy("tie")
    return rows.withColumns({"again": F.row_number().over(repeated), "moment": F.struct(*MOMENT)})


def _by_match(history: DataFrame, pool: str) -> DataFrame:
    """One row per match of a history, with both sides' ratings."""
    def of(is_home: int, c: str):
        return F.max(F.when(F.col("is_home") == is_home, F.col(c)))

    rows = history.groupBy(F.col(pool).alias("pool"), "match_seq").agg(
        F.max("match_date").alias("match_date"), of(1, "team_title").alias("home"), of(1, "opponent_title").alias("away"),
        of(1, "goals_for").alias("old_home_goals"), of(1, "goals_against").alias("old_away_goals"),
        *[of(i, f"rating_{when}").alias(f"{side}_{when}") for i, side in ((1, "home"), (0, "away")) for when in ("before", "after")])
    repeated = W.partitionBy("pool", "match_date", "home", "away").orderBy("match_seq")
    return rows.withColumn("again", F.row_number().over(repeated)).drop("match_seq")


def _sides(matches: DataFrame) -> DataFrame:
    return matches.select("pool", F.explode(F.array("home", "away")).alias("team"), "moment")


def compared(history: DataFrame, matches: DataFrame, pool: str = "league_id", tie_break: Sequence[str] = ("match_hk",)) -> DataFrame:
    """Matches next to what the history says of them: ``changed`` if it does not know them, or by another score.

    Matches that only the history knows are ``gone``; their moment is the first of their day and home team.
    """
    both = _matches(matches, pool, tie_break).withColumn("here", F.lit(True)).join(
        _by_match(history, pool).withColumn("there", F.lit(True)), SAME, "full")
    same = F.col("home_goals").eqNullSafe(F.col("old_home_goals")) & F.col("away_goals").eqNullSafe(F.col("old_away_goals"))
    tie = both.schema["moment"].dataType["tie"].dataType
    first = F.struct("match_date", "home", F.lit(None).cast(tie).alias("tie"))
    return both.withColumns({
        "gone": F.col("here").isNull(), "changed": F.col("here").isNotNull() & (F.col("there").isNull() | ~same),
        "moment": F.coalesce("moment", first)}).drop("here", "there", "tie")


BUCKET_ROWS = 1_000_000


def _met(matches: DataFrame) -> str:
    """Name of a table of every team's opponents and moments, in buckets of the opponent: rounds read it as it lies."""
    spark = matches.sparkSession
    buckets = max(8, -(-2 * matches.count() // BUCKET_ROWS))
    met = unpivot_sides(
        matches, {"home": {"team": "home", "opponent": "away"}, "away": {"team": "away", "opponent": "home"}}, keep=["pool", "moment"])
    name = bucketed_table(spark, scratch(spark, "elo-met"), met.schema, ["pool", "opponent"], buckets)
    append_bucketed(met.repartition(buckets, "pool", "opponent"), name)
    return name


def reached(rows: DataFrame) -> DataFrame:
    """Per team in doubt, the moment ``since`` which it is, from ``compared`` rows.

    A round looks at the teams whose moment moved in the round before, and at their matches between
    the new moment and the one before only; the matches are shuffled once for all rounds.
    """
    spark = rows.sparkSession
    name = _met(rows.filter("NOT gone"))
    start = _sides(rows.filter("changed OR gone")).groupBy("pool", "team").agg(F.min("moment").alias("since"))
    doubt = _written(start.withColumn("before", F.lit(None).cast(start.schema["since"].dataType)).withColumn("moved", F.lit(True)), "elo-doubt")
    while not (moved := doubt.filter("moved")).isEmpty():
        moved = moved.select("pool", F.col("team").alias("opponent"), "since", "before")
        hit = spark.table(name).join(moved, ["pool", "opponent"]).filter(
            (F.col("moment") >= F.col("since")) & (F.col("before").isNull() | (F.col("moment") < F.col("before"))))
        new = hit.groupBy("pool", "team").agg(F.min("moment").alias("since"))
        held = doubt.select("pool", "team", "since", F.col("since").alias("before"))
        both = held.unionByName(new, allowMissingColumns=True).groupBy("pool", "team").agg(
            F.min("since").alias("since"), F.min("before").alias("before"))
        doubt = _written(both.withColumn("moved", F.col("before").isNull() | (F.col("since") < F.col("before"))), "elo-doubt")
    spark.sql(f"DROP TABLE {name}")
    return doubt.select("pool", "team", "since")


def correct_history(
    history: DataFrame, matches: DataFrame, pool: str = "league_id", tie_break: Sequence[str] = ("match_hk",), **rating,
) -> tuple[DataFrame, int]:
    """The history of ``matches``, given the ``history`` of other scores, fewer or more matches; and how many were rated.

    What a correction does not reach is taken from the given history. ``rating`` goes to ``elo_history``.
    """
    rows = _written(compared(history, matches, pool, tie_break), "elo-compared")
    doubt = reached(rows)
    here = rows.filter("NOT gone")
    for side in ("home", "away"):
        since = doubt.select("pool", F.col("team").alias(side), F.col("since").alias(f"{side}_since"))
        here = here.join(since, ["pool", side], "left")
    late = F.coalesce(F.col("moment") >= F.col("home_since"), F.lit(False)) | F.coalesce(
        F.col("moment") >= F.col("away_since"), F.lit(False))
    here = _written(here.withColumn("late", late).drop("home_since", "away_since"), "elo-split")
    kept, again = here.filter("NOT late"), here.filter("late")

    def side(me: str, other: str, is_home: int) -> DataFrame:
        return kept.select(
            F.col("pool").alias(pool), "season_year", "match_date", "moment", F.col(me).alias("team_title"),
            F.col(other).alias("opponent_title"), F.lit(is_home).alias("is_home"), F.col(f"{me}_goals").alias("goals_for"),
            F.col(f"{other}_goals").alias("goals_against"), F.col(f"{me}_before").alias("rating_before"),
            F.col(f"{me}_after").alias("rating_after"))

    old = side("home", "away", 1).unionByName(side("away", "home", 0))
    in_doubt = doubt.select(F.col("pool").alias(pool), F.col("team").alias("team_title"))
    seeds = old.join(in_doubt, [pool, "team_title"], "left_semi").groupBy(pool, "team_title").agg(
        F.max_by("rating_after", "moment").alias("rating")).withColumn("match_seq", F.lit(0).cast("long"))
    facts = again.select(
        F.col("pool").alias(pool), "season_year", "match_date", F.col("home").alias("home_team_title"),
        F.col("away").alias("away_team_title"), "home_goals", "away_goals", "moment.tie")
    rated = elo_history(facts, pool, tie_break=("tie",), ratings=seeds, **rating)

    # The new rows get their moments back, then all matches are numbered in their order.
    home = F.when(F.col("is_home") == 1, F.col("team_title")).otherwise(F.col("opponent_title"))
    away = F.when(F.col("is_home") == 1, F.col("opponent_title")).otherwise(F.col("team_title"))
    repeated = W.partitionBy(pool, "match_date", "home", "away", "is_home").orderBy("match_seq")
    told = rated.withColumns({"home": home, "away": away}).withColumn("turn", F.row_number().over(repeated))
    place = W.partitionBy("pool", "match_date", "home", "away").orderBy("again")
    moments = again.select(F.col("pool").alias(pool), "match_date", "home", "away", "moment", F.row_number().over(place).alias("turn"))
    new = told.join(moments, [pool, "match_date", "home", "away", "turn"]).select(*old.columns)
    every = old.unionByName(new)
    numbered = split_row_number(
        here.select(F.col("pool").alias(pool), "moment", "match_date"), [pool], [F.col("moment").asc()],
        [(F.date_trunc("month", "match_date"), "asc")], "match_seq").select(pool, "moment", F.col("match_seq").cast("long"))
    out = every.join(numbered, [pool, "moment"]).drop("moment").withColumn("rating_delta", F.col("rating_after") - F.col("rating_before"))
    return out.select(*[c for c in history.columns if c in out.columns]), again.count()
