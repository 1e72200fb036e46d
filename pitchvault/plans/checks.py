"""Data checks of the vault and the marts."""

from __future__ import annotations

from pitchvault.operators.quality import TableChecks
from pitchvault.plans.raw_vault import HUBS, LINKS, SATS

_HUB_OF = {hub.key: name for name, hub in HUBS.items()} | {
    "hub_match_hk_understat": "hub_match", "hub_match_hk_sb": "hub_match",
}


def _parents(*keys: str) -> dict[str, tuple[str, str]]:
    return {k: (_HUB_OF[k], HUBS[_HUB_OF[k]].key) for k in keys}


def _raw_vault() -> dict[str, TableChecks]:
    lineage = ("ldts", "rsrc")
    out = {
        name: TableChecks(not_null=(h.key, *h.business_keys, *lineage), unique=(h.key,))
        for name, h in HUBS.items()
    }
    for name, link in LINKS.items():
        out[name] = TableChecks(
            not_null=(link.key, *link.hub_keys, *link.attrs, *lineage), unique=(link.key,),
            accepted={a: ("home", "away") for a in link.attrs}, relationships=_parents(*link.hub_keys),
        )
    for name, s in SATS.items():
        described = ("team_title",) if name == "sat_team_details" else ()
        out[name] = TableChecks(
            not_null=(s.key, s.hashdiff, *described, *lineage), relationships=_parents(s.key)
        )
    return out


RAW_VAULT = _raw_vault()

_SEASON_HUBS = ("hub_competition_hk", "hub_season_hk")

BUSINESS_VAULT = {
    "pit_team_season": TableChecks(
        not_null=("pit_team_season_hk", "hub_team_hk", *_SEASON_HUBS, "league_id", "season_year"),
        unique=("pit_team_season_hk",), relationships=_parents("hub_team_hk", *_SEASON_HUBS)),
    "pit_player_season": TableChecks(
        not_null=("pit_player_season_hk", "hub_player_hk", *_SEASON_HUBS),
        unique=("pit_player_season_hk",), relationships=_parents("hub_player_hk", *_SEASON_HUBS)),
    "br_player_team_season": TableChecks(
        not_null=("br_hk", "hub_player_hk", "hub_team_hk", *_SEASON_HUBS),
        relationships=_parents("hub_player_hk", "hub_team_hk", *_SEASON_HUBS)),
    "br_team_competition_season": TableChecks(
        not_null=("br_hk", "hub_team_hk", *_SEASON_HUBS), unique=("br_hk",)),
}

MARTS = {
    "mart_league_table": TableChecks(
        not_null=("team_bk", "league_id", "season_year", "position", "pts"),
        combinations=(("team_bk", "league_id", "season_year"),)),
    "mart_top_scorers": TableChecks(
        not_null=("player_bk", "league_id", "season_year"),
        combinations=(("player_bk", "league_id", "season_year"),)),
    "mart_match_facts": TableChecks(
        not_null=("match_hk", "league_id", "season_year", "match_datetime"), unique=("match_hk",),
        accepted={"result": ("home", "away", "draw")}),
    "mart_player_overperformers": TableChecks(
        not_null=("player_hk", "league_id", "season_year"),
        combinations=(("player_hk", "league_id", "season_year"),), expressions=("minutes >= 450",)),
    "mart_sb_la_liga_history": TableChecks(
        not_null=("season_year", "matches_played"), unique=("season_year",),
        expressions=("wins + draws + losses = matches_played",)),
    "mart_team_xg_trend": TableChecks(
        not_null=("team_title", "league_id", "season_year"),
        combinations=(("team_title", "league_id", "season_year"),), expressions=("matches > 0",)),
}

ALL = {**RAW_VAULT, **BUSINESS_VAULT, **MARTS}
