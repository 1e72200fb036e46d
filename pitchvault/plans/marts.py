"""Marts over the business vault and the match satellite."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitchvault.functions.hashing import link_key, short_key
from pitchvault.operators.elo import elo_current, elo_history, flag_top, top_teams
from pitchvault.operators.reshape import unpivot_sides
from pitchvault.operators.versions import coarse, latest, percent_ranks, split_percent_rank, split_row_number

MIN_MINUTES = 450
FOCUS_TEAM = "Barcelona"
FOCUS_LEAGUE = "la_liga"
TEAM_ARROW = " → "


def mart_league_table(pit_teams: DataFrame) -> DataFrame:
    """League position per season by points, goal difference and goals; the key settles ties."""
    base = pit_teams.select(
        "team_bk", "team_title", "league_id", "season_year",
        F.col("matches").alias("gp"), F.col("wins").alias("w"), F.col("draws").alias("d"),
        F.col("losses").alias("l"), F.col("goals_for").alias("gf"), F.col("goals_against").alias("ga"),
        (F.col("goals_for") - F.col("goals_against")).alias("gd"),
        F.col("points").alias("pts"), "xpts", "xg_for", "xg_against", "npxg_diff", "ppda", "oppda",
        F.round(F.col("points") - F.col("xpts"), 2).alias("pts_overperf"),
    )
    best_first = [F.col(c).desc_nulls_first() for c in ("pts", "gd", "gf")]
    return split_row_number(
        base, ["league_id", "season_year"], [*best_first, F.col("team_bk").asc()],
        split=[(coarse("pts"), "desc")], out="position",
    )


def mart_top_scorers(pit_players: DataFrame, bridge: DataFrame) -> DataFrame:
    """Season figures per player with the names of the teams, in alphabetical order."""
    # One key in place of three: teams are brought together by it, and figures meet them.
    season = F.unhex(link_key("hub_player_hk", "hub_competition_hk", "hub_season_hk")).alias("__season")
    listed = F.expr(f"listagg(team_title, '{TEAM_ARROW}') WITHIN GROUP (ORDER BY team_title)")
    teams = bridge.select(season, "team_title").groupBy("__season").agg(listed.alias("teams_concat"), F.count(F.lit(1)).alias("teams_count"))
    xg = F.col("xg")
    return pit_players.select("*", season).join(teams, "__season", "left").select(
        "player_bk", "player_name",
        F.coalesce("teams_concat", "player_name").alias("teams_concat"),
        F.coalesce("teams_count", F.lit(1)).alias("teams_count"),
        "league_id", "season_year", "position", "games", "minutes", "goals", "assists",
        "shots", "key_passes", "xg", "xa", "npxg", "npg",
        F.when(xg > 0, F.round(F.col("goals") / xg, 2)).alias("goals_per_xg"),
    )


def newest_matches(sat_match_xg: DataFrame) -> DataFrame:
    """One row per match: its newest version."""
    order = [F.col("ldts").desc_nulls_first(), F.col("sat_match_xg_hashdiff").desc()]
    return latest(sat_match_xg, ["hub_match_hk"], order)


def mart_match_facts(sat_match_xg: DataFrame) -> DataFrame:
    """One wide row per match; a match without a score counts as a draw."""
    goals, xg = ("home_goals", "away_goals"), ("home_xg", "away_xg")
    h, a = (F.col(c) for c in goals)
    xh, xa = (F.col(c) for c in xg)
    return newest_matches(sat_match_xg).select(
        F.col("hub_match_hk").alias("match_hk"), "match_datetime",
        F.to_date("match_datetime").alias("match_date"),
        "league_id", "season_year", "home_team_title", "away_team_title", *goals, *xg,
        (h - a).alias("goal_diff"),
        F.round(xh - xa, 3).alias("xg_diff"),
        F.when(h > a, "home").when(h < a, "away").otherwise("draw").alias("result"),
        (h + a).alias("total_goals"),
        F.round(xh + xa, 3).alias("total_xg"),
    )


def surplus_ranks(pit_players: DataFrame, min_minutes: int = MIN_MINUTES) -> DataFrame:
    """Percent ranks of the different surpluses of goals among a season's regular players; surpluses are few."""
    return percent_ranks(
        pit_players.filter(F.col("minutes") >= min_minutes), ["league_id", "season_year"], F.col("goals") - F.col("xg"))


def mart_player_overperformers(
    pit_players: DataFrame, min_minutes: int = MIN_MINUTES, ranks: DataFrame | None = None,
) -> DataFrame:
    """Goals above expectation with their percent rank among the season's regular players.

    ``ranks`` gives their ``surplus_ranks`` as a table.
    """
    regular = pit_players.filter(F.col("minutes") >= min_minutes)
    surplus = F.col("goals") - F.col("xg")
    ranked = split_percent_rank(regular, ["league_id", "season_year"], surplus, "rank_share", ranks)
    return ranked.select(
        F.col("hub_player_hk").alias("player_hk"), "player_bk", "player_name",
        F.col("team_title_raw").alias("team_title"), "league_id", "season_year", "position",
        "minutes", "games", "goals", "xg", "assists", "xa", "npxg", "npg",
        F.round(surplus, 3).alias("goals_minus_xg"),
        F.round(F.col("assists") - F.col("xa"), 3).alias("assists_minus_xa"),
        F.round(F.col("rank_share").cast("decimal(28,18)"), 4).alias("overperf_pct_rank"),
    )


def mart_team_xg_trend(sat_match_xg: DataFrame) -> DataFrame:
    """Mean, spread and maximum of expected goals per team and season."""
    return xg_trend(newest_matches(sat_match_xg))


def xg_trend(matches: DataFrame) -> DataFrame:
    """``mart_team_xg_trend`` from one row per match, like the match facts."""
    def side(me: str, other: str) -> dict:
        return {
            "team_title": f"{me}_team_title", "xg_for": f"{me}_xg", "xg_against": f"{other}_xg",
            "gf": f"{me}_goals", "ga": f"{other}_goals",
        }

    sides = unpivot_sides(
        matches,
        {"home": side("home", "away"), "away": side("away", "home")},
        keep=["league_id", "season_year"],
    )
    both = ("xg_for", "xg_against")
    spread = {c: F.stddev_samp(c).cast("decimal(28,18)") for c in both}
    return sides.groupBy("league_id", "season_year", "team_title").agg(
        F.count(F.lit(1)).alias("matches"),
        *[F.round(F.avg(c), 3).alias(f"avg_{c}") for c in both],
        *[F.round(spread[c], 3).alias(f"std_{c}") for c in both],
        *[F.round(F.max(c), 3).alias(f"max_{c}") for c in both],
        F.sum("gf").alias("total_gf"),
        F.sum("ga").alias("total_ga"),
        F.round(F.sum("gf") - F.sum("xg_for"), 3).alias("gf_minus_xg"),
        F.round(F.sum("ga") - F.sum("xg_against"), 3).alias("ga_minus_xga"),
    )


def season_of(ts):
    """Year a season starts in: it turns over with July."""
    return F.year(ts) - F.when(F.month(ts) >= 7, 0).otherwise(1)


def mart_team_history(stg_matches_b: DataFrame, team: str = FOCUS_TEAM, league: str = FOCUS_LEAGUE) -> DataFrame:
    """Results of one team by season, from its point of view, newest season first."""
    at_home = F.col("home_team") == team
    mine = (
        stg_matches_b
        .filter((F.col("league_id") == league) & (F.col("match_status") == "available"))
        .filter(at_home | (F.col("away_team") == team))
        .dropna(subset=["home_goals", "away_goals", "match_ts"])
        .select(
            season_of("match_ts").alias("season_year"),
            F.when(at_home, F.col("home_goals")).otherwise(F.col("away_goals")).alias("scored"),
            F.when(at_home, F.col("away_goals")).otherwise(F.col("home_goals")).alias("conceded"),
        )
    )
    s, c = F.col("scored"), F.col("conceded")
    counts = {
        "matches_played": F.count(F.lit(1)),
        "wins": F.count_if(s > c), "draws": F.count_if(s == c), "losses": F.count_if(s < c),
        "goals_scored": F.sum(s), "goals_conceded": F.sum(c),
    }
    mean = {"avg_goals_scored": s, "avg_goals_conceded": c}
    return mine.groupBy("season_year").agg(
        *[e.cast("int").alias(name) for name, e in counts.items()],
        *[F.round(F.avg(e.cast("decimal(10,0)")), 2).cast("double").alias(name) for name, e in mean.items()],
    ).orderBy(F.col("season_year").desc())


HISTORY_COLUMNS = [
    "team_title", "league_id", "season_year", "match_date", "opponent_title", "is_home",
    "goals_for", "goals_against", "rating_before", "rating_after", "rating_delta",
    "is_top3_in_league",
]


def mart_team_elo_history(history: DataFrame, best: DataFrame | None = None) -> DataFrame:
    """Rating history with the flag of each league's three best teams."""
    return flag_top(history, best=best).select(*HISTORY_COLUMNS)


def mart_team_elo_current(history: DataFrame) -> DataFrame:
    """Final rating, peak and dates per team."""
    return elo_current(history)


def builders(focus_team: str = FOCUS_TEAM, focus_league: str = FOCUS_LEAGUE) -> dict:
    """Builders of all marts. ``elo_history`` is the numbered history behind the rating marts."""
    return {
        "mart_league_table": lambda m: mart_league_table(m["pit_team_season"]),
        "mart_top_scorers": lambda m: mart_top_scorers(m["pit_player_season"], m["br_player_team_season"]),
        "mart_match_facts": lambda m: mart_match_facts(m["sat_match_xg"]),
        "mart_player_overperformers": lambda m: mart_player_overperformers(m["pit_player_season"]),
        "mart_team_xg_trend": lambda m: xg_trend(m["mart_match_facts"]),
        # The keys of the matches settle ties as bytes, in the order of their digits.
        "elo_history": lambda m: elo_history(m["mart_match_facts"].withColumn("match_hk", short_key(F.col("match_hk")))),
        "mart_team_elo_history": lambda m: mart_team_elo_history(m["elo_history"], m["elo_best"]),
        "elo_best": lambda m: top_teams(m["elo_history"]),
        "mart_team_elo_current": lambda m: mart_team_elo_current(m["elo_history"]),
        "mart_sb_la_liga_history": lambda m: mart_team_history(m["stg_sb_matches"], focus_team, focus_league),
    }
