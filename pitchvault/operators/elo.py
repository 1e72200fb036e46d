"""Elo ratings: a sequential fold per pool, and aggregates over its history."""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from pitchvault.operators.reshape import unpivot_sides
from pitchvault.operators.versions import latest, top_n

# Fixed values of the rating formula.
K_FACTOR = 20.0
HOME_ADVANTAGE = 100.0
START_RATING = 1500.0
RATING_SCALE = 400.0


def played(matches: DataFrame) -> DataFrame:
    """Matches with both scores."""
    return matches.dropna(subset=["home_goals", "away_goals"])


def expected_home(home: float, away: float, advantage: float = HOME_ADVANTAGE) -> float:
    """Expected score of the home side, between 0 and 1."""
    gap = away - home - advantage
    return 1.0 / (1.0 + 10.0 ** (gap / RATING_SCALE))


def margin_factor(margin: int) -> float:
    """Weight of a win by ``margin`` goals."""
    return 1.0 if margin < 2 else math.log(margin + 1)


def _fold(k: float, advantage: float, start: float, schema: pa.Schema):
    """Per-partition fold; memory holds the ratings of the pool at hand and one batch."""
    rated = ("match_seq", "home_before", "home_after", "away_before", "away_after")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pool, ratings, seq = None, {}, 0
        for batch in batches:
            # The other columns are passed on as they are.
            read = ("pool", "home", "away", "home_goals", "away_goals", "seed", "seed_seq")
            col = {name: batch.column(name).to_pylist() for name in read}
            keep, out = [], {c: [] for c in rated}
            sides = zip(col["pool"], col["home"], col["away"], col["home_goals"], col["away_goals"], col["seed"], col["seed_seq"])
            for i, (p, home, away, gh, ga, seed, seed_seq) in enumerate(sides):
                if p != pool:
                    pool, ratings, seq = p, {}, 0
                if seed is not None:
                    ratings[home], seq = seed, max(seq, seed_seq)
                    continue
                seq += 1
                rh, ra = ratings.get(home, start), ratings.get(away, start)
                eh = expected_home(rh, ra, advantage)
                won = 1.0 if gh > ga else 0.0 if gh < ga else 0.5
                weight = k * margin_factor(abs(gh - ga))
                ratings[home] = rh_new = rh + weight * (won - eh)
                ratings[away] = ra_new = ra + weight * ((1.0 - won) - (1.0 - eh))
                keep.append(i)
                for c, v in zip(rated, (seq, rh, rh_new, ra, ra_new)):
                    out[c].append(v)
            matches = batch.take(pa.array(keep, pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [pa.array(out[f.name], f.type) if f.name in out else matches.column(f.name) for f in schema],
                schema=schema,
            )

    return run


def elo_history(
    matches: DataFrame,
    pool: str = "league_id",
    k: float = K_FACTOR,
    home_advantage: float = HOME_ADVANTAGE,
    start: float = START_RATING,
    tie_break: Sequence[str] = ("match_hk",),
    ratings: DataFrame | None = None,
) -> DataFrame:
    """Two rows per played match, with the rating of the side before and after it.

    Matches of a pool run in order of date, home team and ``tie_break``. The rating of a
    match needs those of the matches before it, so a pool is one ordered stream; pools
    run in parallel. The stream is sorted outside the heap and never gathered: a task
    holds one batch and the ratings of one pool's teams.

    ``match_seq`` numbers the matches of a pool. ``ratings`` (``ratings_after`` of an
    earlier history) carries on from there, with matches that all lie after it; so a long
    history can be rated in pieces, and a daily run rates the new matches only.
    """
    ordered = (
        played(matches)
        .select(
            F.col(pool).alias("pool"), F.col("season_year").cast("int"), F.col("match_date").cast("date"),
            F.col("home_team_title").alias("home"), F.col("away_team_title").alias("away"),
            F.col("home_goals").cast("int"), F.col("away_goals").cast("int"),
            F.lit(None).cast("double").alias("seed"), F.lit(None).cast("long").alias("seed_seq"), *tie_break,
        )
    )
    if ratings is not None:
        seeds = ratings.select(
            F.col(pool).alias("pool"), F.col("team_title").alias("home"),
            F.col("rating").alias("seed"), F.col("match_seq").alias("seed_seq"),
        )
        ordered = ordered.unionByName(seeds, allowMissingColumns=True)
    # A fixed count: sized by bytes, the pools would be merged into few tasks, but the
    # cost here is the arithmetic per row.
    tasks = int(ordered.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = (
        ordered.repartition(tasks, "pool")
        .sortWithinPartitions("pool", F.col("seed").isNull(), "match_date", "home", *tie_break)
        .drop(*tie_break)
    )
    kept = [f for f in ordered.schema.fields if f.name not in ("seed", "seed_seq")]
    schema = T.StructType([
        *kept, T.StructField("match_seq", T.LongType()),
        *[T.StructField(c, T.DoubleType()) for c in ("home_before", "home_after", "away_before", "away_after")],
    ])
    rated = ordered.mapInArrow(_fold(k, home_advantage, start, to_arrow_schema(schema)), schema)

    def side(me: str, other: str, is_home: int) -> dict:
        return {
            "team_title": me, "opponent_title": other, "is_home": F.lit(is_home),
            "goals_for": f"{me}_goals", "goals_against": f"{other}_goals",
            "rating_before": f"{me}_before", "rating_after": f"{me}_after",
        }

    return unpivot_sides(
        rated,
        {"home": side("home", "away", 1), "away": side("away", "home", 0)},
        keep=[F.col("pool").alias(pool), "season_year", "match_date", "match_seq"],
    ).withColumn("rating_delta", F.col("rating_after") - F.col("rating_before"))


def ratings_after(history: DataFrame, pool: str = "league_id") -> DataFrame:
    """Last rating per team, with the number of its match, to carry on from."""
    return history.groupBy("team_title", pool).agg(
        F.max_by("rating_after", "match_seq").alias("rating"), F.max("match_seq").alias("match_seq"),
    )


def elo_current(history: DataFrame, pool: str = "league_id") -> DataFrame:
    """Final and peak rating per team, with the first date of the peak.

    Both are picked before the one shuffle, which takes a row per team and task.
    """
    keys = ["team_title", pool]
    finals = history.groupBy(*keys).agg(
        F.max_by("rating_after", "match_seq").alias("current_rating"),
        F.count(F.lit(1)).cast("int").alias("matches_played"),
        F.max_by("match_date", "match_seq").alias("last_match_date"),
    )
    peaks = latest(
        history.select(*keys, F.col("match_date").alias("peak_match_date"), F.col("rating_after").alias("peak_rating"), "match_seq"),
        keys, [F.col("peak_rating").desc(), F.col("match_seq").asc()]).drop("match_seq")
    return finals.join(peaks, keys).select(
        *keys, "current_rating", "peak_rating", "peak_match_date", "matches_played", "last_match_date")


def top_teams(history: DataFrame, n: int = 3, pool: str = "league_id") -> DataFrame:
    """The ``n`` best teams of each pool by final rating; ties go to the team seen first."""
    finals = history.groupBy("team_title", pool).agg(
        F.max_by("rating_after", "match_seq").alias("rating"),
        F.min(2 * F.col("match_seq") + 1 - F.col("is_home")).alias("seen"),
    )
    return top_n(finals, [pool], [F.col("rating").desc(), F.col("seen").asc()], n).select("team_title", pool)


def flag_top(
    history: DataFrame, n: int = 3, pool: str = "league_id", out: str = "is_top3_in_league", best: DataFrame | None = None,
) -> DataFrame:
    """Mark every history row of the pool's best teams with 1, the others with 0.

    ``best`` gives the ``top_teams`` as a table. They are few, and where their size is known they are
    sent to the history, which is then not shuffled.
    """
    best = (top_teams(history, n, pool) if best is None else best).withColumn(out, F.lit(1))
    return history.join(best, ["team_title", pool], "left").fillna(0, [out])
