"""Raw-vault model set: five hubs, five links, six satellites."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame

from pitchvault.operators.vault import load_hub, load_link, load_sat
from pitchvault.plans.models import Models


@dataclass(frozen=True)
class Hub:
    key: str
    business_keys: tuple[str, ...]
    sources: tuple[str, ...]
    #: A key is on few rows of a load.
    single: bool = False


@dataclass(frozen=True)
class Link:
    key: str
    hub_keys: tuple[str, ...]
    source: str
    attrs: tuple[str, ...] = ()
    #: Hub keys by which the stage model may be dealt out.
    together: tuple[str, ...] = ()


@dataclass(frozen=True)
class Sat:
    key: str
    hashdiff: str
    payload: tuple[str, ...]
    source: str
    context: tuple[str, ...] = ()
    #: The stage table has one row per load for what is versioned.
    keyed: bool = True


HUBS = {
    "hub_team": Hub("hub_team_hk", ("team_bk",), ("stg_understat_teams",)),
    "hub_player": Hub("hub_player_hk", ("player_bk",), ("stg_understat_players",)),
    "hub_match": Hub("hub_match_hk", ("match_bk",), ("stg_sb_matches", "stg_understat_matches"), single=True),
    "hub_competition": Hub(
        "hub_competition_hk", ("league_id",),
        ("stg_sb_competitions", "stg_understat_teams", "stg_understat_players")),
    "hub_season": Hub("hub_season_hk", ("season_year",), ("stg_understat_players", "stg_understat_teams")),
}

LINKS = {
    "lnk_match_team": Link(
        "lnk_match_team_hk", ("hub_match_hk", "hub_team_hk"), "stg_understat_matches_teams", ("team_role",),
        together=("hub_match_hk",)),
    "lnk_team_competition_season": Link(
        "lnk_team_comp_season_hk", ("hub_team_hk", "hub_competition_hk", "hub_season_hk"),
        "stg_understat_teams", together=("hub_team_hk",)),
    "lnk_player_team": Link(
        "lnk_player_team_hk", ("hub_player_hk", "hub_team_hk", "hub_season_hk"), "stg_understat_player_team",
        together=("hub_player_hk", "hub_season_hk")),
    "lnk_match_competition_season": Link(
        "lnk_match_comp_season_hk", ("hub_match_hk", "hub_competition_hk", "hub_season_hk"),
        "stg_understat_matches", together=("hub_match_hk",)),
    "lnk_match_same_as": Link(
        "lnk_match_same_as_hk", ("hub_match_hk_understat", "hub_match_hk_sb"), "stg_match_same_as"),
}

# Season satellites hold one active row per parent, league and season.
SEASON = ("league_id", "season_year")

SATS = {
    "sat_match_score": Sat(
        "hub_match_hk", "sat_match_score_hashdiff",
        ("home_goals", "away_goals", "match_status", "match_ts"), "stg_sb_matches"),
    "sat_match_score_understat": Sat(
        "hub_match_hk", "sat_match_score_understat_hashdiff",
        ("home_goals", "away_goals", "match_datetime"), "stg_understat_matches"),
    "sat_match_xg": Sat(
        "hub_match_hk", "sat_match_xg_hashdiff",
        ("home_xg", "away_xg", "home_goals", "away_goals", "home_team_title", "away_team_title",
         "match_datetime", "league_id", "season_year"),
        "stg_understat_matches"),
    "sat_player_xg": Sat(
        "hub_player_hk", "sat_player_xg_hashdiff",
        ("xg", "xa", "npxg", "npg", "xg_chain", "xg_buildup", "goals", "assists", "shots", "key_passes",
         "games", "minutes", "position", "player_name", "team_title", "league_id", "season_year"),
        "stg_understat_players", SEASON),
    "sat_team_details": Sat(
        "hub_team_hk", "sat_team_details_hashdiff", ("team_title", "league_id"), "stg_understat_teams",
        keyed=True),  # a team comes once per league and season of a load
    "sat_team_xg": Sat(
        "hub_team_hk", "sat_team_xg_hashdiff",
        ("xg_for", "npxg_for", "xg_against", "npxg_against", "npxg_diff", "ppda", "oppda",
         "deep_completions", "opp_deep_completions", "xpts", "matches", "wins", "draws", "losses",
         "points", "goals_for", "goals_against", "league_id", "season_year"),
        "stg_understat_teams", SEASON),
}

TABLES = (*HUBS, *LINKS, *SATS)


def load(
    name: str, stage: Mapping[str, DataFrame], existing: DataFrame | None = None,
    buckets: int | None = None, parts: int | None = None,
) -> DataFrame:
    """Rows to append to one raw-vault table.

    ``buckets`` of the stored hubs and links, ``parts`` of the stored satellites.
    """
    if name in HUBS:
        h = HUBS[name]
        return load_hub([stage[s] for s in h.sources], h.key, h.business_keys, existing, buckets, h.single)
    if name in LINKS:
        link = LINKS[name]
        return load_link(stage[link.source], link.key, link.hub_keys, existing, link.attrs, buckets, link.together)
    s = SATS[name]
    return load_sat(stage[s.source], s.key, s.hashdiff, s.payload, existing, s.context, keyed=s.keyed, parts=parts)


def builders(existing: Mapping[str, DataFrame] | None = None) -> dict:
    known = existing or {}
    return {name: lambda m, n=name: load(n, m, known.get(n)) for name in TABLES}


def raw_vault(stage: Mapping[str, DataFrame], existing: Mapping[str, DataFrame] | None = None) -> Models:
    """Rows to append to every raw-vault table."""
    return Models(builders(existing), stage)
