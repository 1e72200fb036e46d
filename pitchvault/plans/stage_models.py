"""Stage models of the football warehouse: keys, hashdiffs and typed payload, nothing stored.

Inputs are the stage tables (key columns, ``loaded_at`` and ``raw_payload``); the payload
may be JSON text, a struct or a variant.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitchvault.functions.hashing import (
    business_key,
    hash_key,
    hashdiff,
    link_key,
    normalise_key,
    utc_text,
)
from pitchvault.functions.payload import METRIC, extract
from pitchvault.operators.lookup import map_slug
from pitchvault.operators.matching import same_as
from pitchvault.operators.reshape import explode_delimited, unpivot_sides
from pitchvault.operators.vault import with_lineage
from pitchvault.plans.models import Models

# Source names inside keys, club prefixes, and the leagues served.
SOURCE_A = "understat"
SOURCE_B = "sb"
CLUB_PREFIX = "^(afc |fc |cf |ac |as )"
LEAGUES = {
    ("England", "Premier League"): "epl",
    ("Spain", "La Liga"): "la_liga",
    ("Italy", "Serie A"): "serie_a",
    ("Germany", "1. Bundesliga"): "bundesliga",
    ("France", "Ligue 1"): "ligue_1",
    ("Europe", "Champions League"): "ucl",
}


def _texts(fields: Mapping[str, str]) -> dict:
    """Read payload paths as text under ``__t_<name>``, for hashing and casting."""
    return {f"__t_{name}": (path, "string") for name, path in fields.items()}


def _raw(name: str):
    return F.col(f"__t_{name}")


def _brought(df: DataFrame, key: str) -> list[str]:
    """The hub key, if the stage table brings it: rows that are dealt out by it then stay where they lie."""
    return [c for c in df.columns if c == key]


def _season_key():
    return hash_key("season")


def _league_key():
    return hash_key(normalise_key("league_id"))


def stg_sb_competitions(competitions: DataFrame, mapping: Mapping[tuple, str] = LEAGUES) -> DataFrame:
    """Competitions of the second source by league slug; others are dropped."""
    mapped = map_slug(competitions, ["country_name", "competition_name"], mapping, "league_id")
    return with_lineage(mapped, F.col("loaded_at"), SOURCE_B).select(
        hash_key("league_id").alias("hub_competition_hk"), "league_id", "ldts", "rsrc"
    )


def stg_sb_matches(matches: DataFrame) -> DataFrame:
    """Matches of the second source with score and status."""
    typed = extract(matches, "raw_payload", {
        "home_goals": ("home_score", "int"),
        "away_goals": ("away_score", "int"),
        "home_team": ("home_team", "string"),
        "away_team": ("away_team", "string"),
        "match_status": ("match_status", "string"),
        "match_ts": ("match_date", "timestamp"),
    })
    payload = ["home_goals", "away_goals", "home_team", "away_team", "match_status", "match_ts"]
    return with_lineage(typed, F.col("loaded_at"), SOURCE_B).select(
        hash_key("match_id", source=SOURCE_B).alias("hub_match_hk"),
        _league_key().alias("hub_competition_hk"),
        F.col("match_id").cast("string").alias("match_id"),
        business_key(SOURCE_B, "match_id").alias("match_bk"),
        "league_id", *payload,
        hashdiff("home_goals", "away_goals", "match_status", utc_text("match_ts"))
        .alias("sat_match_score_hashdiff"),
        "ldts", "rsrc",
    )


def stg_understat_matches(matches: DataFrame) -> DataFrame:
    """Matches of the first source with goals, expected goals and team titles."""
    read = extract(matches, "raw_payload", _texts({
        "h_title": "h.title", "a_title": "a.title", "h_id": "h.id", "a_id": "a.id",
        "h_goals": "goals.h", "a_goals": "goals.a", "h_xg": "xG.h", "a_xg": "xG.a",
        "datetime": "datetime",
    }))
    own = {} if _brought(matches, "hub_match_hk") else {"hub_match_hk": hash_key("match_id", source=SOURCE_A)}
    keyed = read.withColumns({
        **own,
        "hub_competition_hk": _league_key(),
        "hub_season_hk": _season_key(),
    })
    return with_lineage(keyed, F.col("loaded_at"), SOURCE_A).select(
        "hub_match_hk", "hub_competition_hk", "hub_season_hk",
        link_key("hub_match_hk", "hub_competition_hk", "hub_season_hk").alias("lnk_match_comp_season_hk"),
        business_key(SOURCE_A, "match_id").alias("match_bk"),
        F.col("season").alias("season_year"),
        "league_id",
        _raw("h_title").alias("home_team_title"),
        _raw("a_title").alias("away_team_title"),
        _raw("h_id").alias("home_understat_team_id"),
        _raw("a_id").alias("away_understat_team_id"),
        _raw("h_goals").cast("int").alias("home_goals"),
        _raw("a_goals").cast("int").alias("away_goals"),
        _raw("h_xg").cast(METRIC).alias("home_xg"),
        _raw("a_xg").cast(METRIC).alias("away_xg"),
        _raw("datetime").cast("timestamp_ntz").alias("match_datetime"),
        hashdiff(
            _raw("h_xg"), _raw("a_xg"), _raw("h_goals"), _raw("a_goals"), "league_id", "season"
        ).alias("sat_match_xg_hashdiff"),
        hashdiff(_raw("h_goals"), _raw("a_goals"), _raw("datetime"))
        .alias("sat_match_score_understat_hashdiff"),
        "ldts", "rsrc",
    )


def stg_understat_players(players: DataFrame) -> DataFrame:
    """Season figures per player and league. The hashdiff covers the listed figures only."""
    metrics = {"xg": "xG", "xa": "xA", "npxg": "npxG", "xg_chain": "xGChain", "xg_buildup": "xGBuildup"}
    counts = {
        "npg": "npg", "goals": "goals", "assists": "assists", "shots": "shots",
        "key_passes": "key_passes", "games": "games", "minutes": "time",
    }
    read = extract(players, "raw_payload", {
        **_texts(metrics),
        **{name: (path, "int") for name, path in counts.items()},
        "team_title": ("team_title", "string"),
        "position": ("position", "string"),
    })
    versioned = [
        *[_raw(m) for m in ("xg", "xa", "npxg", "xg_chain", "xg_buildup")],
        "goals", "assists", "games", "minutes", "league_id", "season",
    ]
    return with_lineage(read, F.col("loaded_at"), SOURCE_A).select(
        hash_key("player_id", source=SOURCE_A).alias("hub_player_hk"),
        _season_key().alias("hub_season_hk"),
        _league_key().alias("hub_competition_hk"),
        business_key(SOURCE_A, "player_id").alias("player_bk"),
        F.col("season").alias("season_year"),
        "league_id", "player_name", "team_title",
        *[_raw(m).cast(METRIC).alias(m) for m in metrics],
        *counts, "position",
        hashdiff(*versioned).alias("sat_player_xg_hashdiff"),
        "ldts", "rsrc",
    )


def stg_understat_teams(teams: DataFrame) -> DataFrame:
    """Season figures per team and league, with the link and both satellite hashdiffs."""
    metrics = {
        "xg_for": "xG", "npxg_for": "NPxG", "xg_against": "xGA", "npxg_against": "NPxGA",
        "npxg_diff": "NPxGD", "ppda": "PPDA", "oppda": "OPPDA", "xpts": "xPTS",
    }
    counts = {
        "deep_completions": "DC", "opp_deep_completions": "ODC", "matches": "M", "wins": "W",
        "draws": "D", "losses": "L", "points": "PTS", "goals_for": "G", "goals_against": "GA",
    }
    read = extract(teams, "raw_payload", _texts({**metrics, **counts}))
    title = normalise_key("team_title")
    keyed = read.withColumns({
        "hub_team_hk": hash_key(title, source=SOURCE_A),
        "hub_season_hk": _season_key(),
        "hub_competition_hk": _league_key(),
    })
    versioned = [
        *[_raw(c) for c in (
            "xg_for", "npxg_for", "xg_against", "ppda", "oppda", "xpts",
            "matches", "goals_for", "goals_against")],
        "league_id", "season",
    ]
    return with_lineage(keyed, F.col("loaded_at"), SOURCE_A).select(
        "hub_team_hk", "hub_season_hk", "hub_competition_hk",
        link_key("hub_team_hk", "hub_competition_hk", "hub_season_hk").alias("lnk_team_comp_season_hk"),
        business_key(SOURCE_A, title).alias("team_bk"),
        F.col("season").alias("season_year"),
        "league_id", "team_title",
        *[_raw(m).cast(METRIC).alias(m) for m in metrics],
        *[_raw(c).cast("int").alias(c) for c in counts],
        hashdiff(*versioned).alias("sat_team_xg_hashdiff"),
        hashdiff("team_title", normalise_key("league_id")).alias("sat_team_details_hashdiff"),
        "ldts", "rsrc",
    )


def stg_understat_matches_teams(matches: DataFrame) -> DataFrame:
    """One row per match and side; a side without a title is dropped."""
    read = extract(matches, "raw_payload", _texts({"home": "h.title", "away": "a.title"}))
    sides = unpivot_sides(
        read, {r: {"team_title": _raw(r)} for r in ("home", "away")},
        keep=["match_id", "loaded_at", *(brought := _brought(matches, "hub_match_hk"))], role="team_role", required=["team_title"],
    )
    keyed = sides.withColumns({
        **({} if brought else {"hub_match_hk": hash_key("match_id", source=SOURCE_A)}),
        "hub_team_hk": hash_key(normalise_key("team_title"), source=SOURCE_A),
    })
    return with_lineage(keyed, F.col("loaded_at"), SOURCE_A).select(
        "hub_match_hk", "hub_team_hk",
        link_key("hub_match_hk", "hub_team_hk", role="team_role").alias("lnk_match_team_hk"),
        "team_role", "ldts", "rsrc",
    )


def stg_understat_player_team(players: DataFrame) -> DataFrame:
    """One row per player, team and season; a transfer lists several teams in one text."""
    read = extract(players, "raw_payload", {"team_title": ("team_title", "string")}).select(
        hash_key("player_id", source=SOURCE_A).alias("hub_player_hk"), _season_key().alias("hub_season_hk"),
        business_key(SOURCE_A, "player_id").alias("player_bk"), F.col("season").alias("season_year"),
        F.col("loaded_at").alias("ldts"), "team_title")
    # Brought together as lists: what is grouped or joined by player and season after this is not shuffled again.
    return player_teams(read.repartition("hub_player_hk", "hub_season_hk"))


def player_teams(stg_players: DataFrame) -> DataFrame:
    """``stg_understat_player_team`` from the staged players, lying as these lie."""
    teams = explode_delimited(
        stg_players.withColumnRenamed("team_title", "__teams"), "__teams", "team_title",
        ["hub_player_hk", "hub_season_hk", "player_bk", "season_year", "ldts"])
    keyed = teams.withColumn("hub_team_hk", hash_key(F.lower("team_title"), source=SOURCE_A))
    return keyed.select(
        "hub_player_hk", "hub_team_hk", "hub_season_hk",
        link_key("hub_player_hk", "hub_team_hk", "hub_season_hk").alias("lnk_player_team_hk"),
        "team_title", "season_year", "ldts", F.lit(SOURCE_A).alias("rsrc"),
    )


def stg_match_same_as(stg_matches_a: DataFrame, matches_b: DataFrame) -> DataFrame:
    """The same match in both sources: same day and league, agreeing team names.

    Takes the staged first source and the stage table of the second.
    """
    a = stg_matches_a.select(
        F.to_date("match_datetime").alias("match_date"), "league_id",
        F.col("home_team_title").alias("home"), F.col("away_team_title").alias("away"),
        F.col("hub_match_hk").alias("hub_match_hk_understat"), F.col("ldts").alias("ldts_a"),
    )
    named = extract(matches_b, "raw_payload", {
        "home": ("home_team", "string"), "away": ("away_team", "string"),
    })
    b = named.select(
        "match_date", "league_id", "home", "away",
        hash_key("match_id", source=SOURCE_B).alias("hub_match_hk_sb"),
        F.col("loaded_at").alias("ldts_b"),
    )
    pairs = same_as(
        a, b, ["match_date", "league_id"], ["home", "away"], CLUB_PREFIX,
        keep_left=["hub_match_hk_understat", "ldts_a"], keep_right=["hub_match_hk_sb", "ldts_b"],
    )
    return with_lineage(pairs, F.greatest("ldts_a", "ldts_b"), "derived").select(
        link_key("hub_match_hk_understat", "hub_match_hk_sb").alias("lnk_match_same_as_hk"),
        "hub_match_hk_understat", "hub_match_hk_sb", "ldts", "rsrc",
    )


def stage_builders(mapping: Mapping[tuple, str] = LEAGUES) -> dict:
    """Builders of all stage models over the five stage tables."""
    return {
        "stg_sb_competitions": lambda m: stg_sb_competitions(m["sb_competitions"], mapping),
        "stg_sb_matches": lambda m: stg_sb_matches(m["sb_matches"]),
        "stg_understat_matches": lambda m: stg_understat_matches(m["understat_matches"]),
        "stg_understat_players": lambda m: stg_understat_players(m["understat_players"]),
        "stg_understat_teams": lambda m: stg_understat_teams(m["understat_teams"]),
        "stg_understat_matches_teams": lambda m: stg_understat_matches_teams(m["understat_matches"]),
        "stg_understat_player_team": lambda m: player_teams(m["stg_understat_players"]),
        "stg_match_same_as": lambda m: stg_match_same_as(m["stg_understat_matches"], m["sb_matches"]),
    }


def stage_models(tables: Mapping[str, DataFrame], mapping: Mapping[tuple, str] = LEAGUES) -> Models:
    """All stage models over the given stage tables."""
    return Models(stage_builders(mapping), tables)
