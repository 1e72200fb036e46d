"""Dashboard queries over the marts. Ties are settled by the entity key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Defaults of the dashboard filters (fixed values).
DEFAULT_LEAGUE = "epl"
DEFAULT_SEASON = 2025


def native_filter(df: DataFrame, league: str | None = None, season: int | None = None) -> DataFrame:
    """League and season filter; ``None`` lets everything through.

    A warehouse writes its marts in the order of their contracts, most of them by league and
    season first, so on written marts the filters skip files and row groups.
    """
    if league is not None:
        df = df.filter(F.col("league_id") == league)
    if season is not None:
        df = df.filter(F.col("season_year") == season)
    return df


def _top(df: DataFrame, order_by: Sequence[Column], n: int, columns: Sequence) -> DataFrame:
    return df.orderBy(*order_by).limit(n).select(*columns)


def league_table_top(league_table: DataFrame, league: str = DEFAULT_LEAGUE, season: int = DEFAULT_SEASON, n: int = 5) -> DataFrame:
    return _top(
        native_filter(league_table, league, season), [F.col("position").asc()], n,
        ["team_title", "position", "pts", F.round("xpts", 2).alias("xpts"), "ppda"],
    )


def top_scorers(scorers: DataFrame, league: str | None = DEFAULT_LEAGUE, season: int | None = DEFAULT_SEASON, n: int = 5) -> DataFrame:
    return _top(
        native_filter(scorers, league, season),
        [F.col("goals").desc_nulls_last(), F.col("player_bk").asc(), F.col("league_id").asc(), F.col("season_year").asc()], n,
        ["player_name", "teams_concat", "league_id", "season_year", "goals", F.round("xg", 1).alias("xg")],
    )


def weekly_total_xg(match_facts: DataFrame, league: str | None = DEFAULT_LEAGUE, season: int | None = DEFAULT_SEASON) -> DataFrame:
    week = F.to_date(F.date_trunc("week", "match_datetime")).alias("week")
    return native_filter(match_facts, league, season).groupBy(week).agg(
        F.round(F.avg("total_xg"), 3).alias("avg_total_xg"), F.count(F.lit(1)).alias("matches")
    ).orderBy("week")


def top_overperformers(overperformers: DataFrame, league: str | None = DEFAULT_LEAGUE, season: int | None = DEFAULT_SEASON, n: int = 5) -> DataFrame:
    return _top(
        native_filter(overperformers, league, season),
        [F.col("goals_minus_xg").desc_nulls_last(), F.col("player_bk").asc(), F.col("league_id").asc(), F.col("season_year").asc()], n,
        ["player_name", "team_title", "goals", "xg", "goals_minus_xg", "overperf_pct_rank"],
    )


def top_teams_by_xg(trend: DataFrame, league: str | None = DEFAULT_LEAGUE, season: int | None = DEFAULT_SEASON, n: int = 10) -> DataFrame:
    return _top(
        native_filter(trend, league, season),
        [F.col("avg_xg_for").desc_nulls_last(), F.col("team_title").asc(), F.col("league_id").asc(), F.col("season_year").asc()], n,
        ["team_title", "league_id", "season_year", "avg_xg_for", "avg_xg_against"],
    )


def top_matches_by_xg(match_facts: DataFrame, league: str | None = DEFAULT_LEAGUE, season: int | None = DEFAULT_SEASON, n: int = 10) -> DataFrame:
    return _top(
        native_filter(match_facts, league, season),
        [F.col("total_xg").desc_nulls_last(), F.col("match_hk").asc()], n,
        ["match_hk", "match_date", "home_team_title", "away_team_title", "home_goals", "away_goals", "total_xg"],
    )


def top_teams_by_elo(elo: DataFrame, league: str | None = DEFAULT_LEAGUE, n: int = 10) -> DataFrame:
    """Best current ratings; ``league=None`` ranks across leagues."""
    return _top(
        native_filter(elo, league),
        [F.col("current_rating").desc(), F.col("team_title").asc(), F.col("league_id").asc()], n,
        ["team_title", "league_id", F.round("current_rating", 1).alias("elo"), F.round("peak_rating", 1).alias("peak")],
    )


def elo_evolution(history: DataFrame, league: str | None = None) -> DataFrame:
    """Rating lines of each league's flagged teams."""
    return native_filter(history, league).filter("is_top3_in_league = 1").select(
        "league_id", "team_title", "match_date", "rating_after"
    ).orderBy("league_id", "team_title", "match_date")


def points_surplus(league_table: DataFrame, n: int = 15) -> DataFrame:
    """Largest gaps between points and expected points, either way."""
    return _top(
        league_table,
        [F.abs("pts_overperf").desc_nulls_last(), F.col("team_bk").asc(), F.col("league_id").asc(), F.col("season_year").asc()], n,
        ["team_title", "league_id", "season_year", "pts", "xpts", "pts_overperf"],
    )


def upsets(match_facts: DataFrame, n: int = 15) -> DataFrame:
    """Decided matches whose expected goals favoured the loser, widest gap first."""
    against = F.signum("xg_diff") == -F.signum(F.col("goal_diff").cast("double"))
    decided = F.col("goal_diff") != 0
    return _top(
        match_facts.filter(decided & against),
        [F.abs("xg_diff").desc(), F.col("match_hk").asc()], n,
        ["match_hk", "match_date", "league_id", "home_team_title", "away_team_title", "goal_diff", "xg_diff"],
    )
