"""Business vault: point-in-time and bridge tables, rebuilt in full."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitchvault.functions.hashing import key_text, link_key, short_key
from pitchvault.operators.versions import latest
from pitchvault.plans.models import Models


def _newest(sat: DataFrame, keys: list[str], hashdiff: str) -> DataFrame:
    """Newest version per key; the hashdiff settles equal load times."""
    order = [F.col("ldts").desc_nulls_first()]
    if hashdiff in sat.columns:
        order.append(F.col(hashdiff).desc())
    return latest(sat, keys, order)


def _seasons(df: DataFrame, key: str, out: str) -> DataFrame:
    """The rows of a key as one list, at most one per league and season.

    Rows that lie by the key are listed and then joined by it where they are; a join by key, league and
    season would shuffle them.
    """
    return df.groupBy(key).agg(F.collect_list(F.struct(*[c for c in df.columns if c != key])).alias(out))


def pit_team_season(vault: Mapping[str, DataFrame]) -> DataFrame:
    """Newest team figures and details per team, competition and season."""
    figures = _newest(vault["sat_team_xg"], ["hub_team_hk", "league_id", "season_year"], "sat_team_xg_hashdiff")
    figures = figures.drop("sat_team_xg_hashdiff", "rsrc").withColumnRenamed("ldts", "xg_ldts")
    own = F.filter("__figures", lambda f: (f["league_id"] == F.col("league_id")) & (f["season_year"] == F.col("season_year")))
    metrics = [c for c in figures.columns if c not in ("hub_team_hk", "league_id", "season_year")]
    details = _newest(vault["sat_team_details"], ["hub_team_hk"], "sat_team_details_hashdiff").select(
        "hub_team_hk", "team_title", F.col("ldts").alias("details_ldts")
    )
    joined = (
        vault["lnk_team_competition_season"].select("hub_team_hk", "hub_competition_hk", "hub_season_hk")
        .join(vault["hub_competition"].select("hub_competition_hk", "league_id"), "hub_competition_hk")
        .join(vault["hub_season"].select("hub_season_hk", "season_year"), "hub_season_hk")
        .join(vault["hub_team"].select("hub_team_hk", "team_bk"), "hub_team_hk")
        .join(_seasons(figures, "hub_team_hk", "__figures"), "hub_team_hk", "left")
        .join(details, "hub_team_hk", "left")
        .withColumn("__own", F.get(own, F.lit(0)))
        .withColumns({c: F.col(f"__own.{c}") for c in metrics})
    )
    keys = ["hub_team_hk", "hub_competition_hk", "hub_season_hk"]
    return joined.select(
        link_key(*keys).alias("pit_team_season_hk"), *keys,
        "team_bk", "league_id", "season_year", "team_title",
        "xg_for", "npxg_for", "xg_against", "npxg_against", "npxg_diff", "ppda", "oppda",
        "deep_completions", "opp_deep_completions", "xpts", "matches", "wins", "draws",
        "losses", "points", "goals_for", "goals_against",
        F.greatest("xg_ldts", "details_ldts").alias("pit_ldts"),
    )


def pit_player_season(vault: Mapping[str, DataFrame]) -> DataFrame:
    """Newest player figures per player, competition and season."""
    newest = _newest(
        vault["sat_player_xg"], ["hub_player_hk", "league_id", "season_year"], "sat_player_xg_hashdiff"
    )
    joined = (
        newest
        .join(vault["hub_player"].select("hub_player_hk", "player_bk"), "hub_player_hk")
        .join(vault["hub_competition"].select("hub_competition_hk", "league_id"), "league_id")
        .join(vault["hub_season"].select("hub_season_hk", "season_year"), "season_year")
    )
    keys = ["hub_player_hk", "hub_competition_hk", "hub_season_hk"]
    return joined.select(
        link_key(*keys).alias("pit_player_season_hk"), *keys,
        "player_bk", "player_name", F.col("team_title").alias("team_title_raw"),
        "league_id", "season_year",
        "xg", "xa", "npxg", "npg", "xg_chain", "xg_buildup", "goals", "assists", "shots",
        "key_passes", "games", "minutes", "position", F.col("ldts").alias("pit_ldts"),
    )


def br_player_team_season(vault: Mapping[str, DataFrame], pit_players: DataFrame) -> DataFrame:
    """Player, team, league and season; the league must be one the player has figures for.

    The player's own league and season narrow the pairs first: a team may play in many
    leagues, and the pairs of player and foreign league never form. Teams get their names
    before the players meet them, by one short key; players bring theirs along.
    """
    details = _newest(vault["sat_team_details"], ["hub_team_hk"], "sat_team_details_hashdiff")
    season = ["hub_team_hk", "hub_competition_hk", "hub_season_hk"]
    at = F.unhex(link_key(*season)).alias("__at")
    teams = (
        vault["lnk_team_competition_season"].select(*season)
        .join(vault["hub_team"].select("hub_team_hk", "team_bk"), "hub_team_hk")
        .join(details.select("hub_team_hk", "team_title"), "hub_team_hk", "left")
        .select(at, *season, "team_bk", "team_title")
    )
    seasons = _seasons(
        pit_players.select("hub_player_hk", "hub_competition_hk", F.col("hub_season_hk").alias("__in"), "player_bk", "player_name"),
        "hub_player_hk", "__seasons")
    same = F.filter("__seasons", lambda s: s["__in"] == F.col("hub_season_hk"))
    players = vault["lnk_player_team"].select("hub_player_hk", "hub_team_hk", "hub_season_hk").join(seasons, "hub_player_hk").select(
        "hub_player_hk", "hub_team_hk", "hub_season_hk", F.inline(same))
    joined = (
        players.select(at, short_key(F.col("hub_player_hk")).alias("__player"), "player_bk", "player_name").join(teams, "__at")
        .withColumn("hub_player_hk", key_text(F.col("__player")))
        .join(vault["hub_competition"].select("hub_competition_hk", "league_id"), "hub_competition_hk")
        .join(vault["hub_season"].select("hub_season_hk", "season_year"), "hub_season_hk")
    )
    keys = ["hub_player_hk", "hub_team_hk", "hub_competition_hk", "hub_season_hk"]
    return joined.select(
        link_key(*keys).alias("br_hk"), *keys,
        "player_bk", "player_name", "team_bk", "team_title", "league_id", "season_year",
    )


def br_team_competition_season(pit_teams: DataFrame) -> DataFrame:
    """Team, competition and season with their names, from the point-in-time table."""
    return pit_teams.select(
        F.col("pit_team_season_hk").alias("br_hk"),
        "hub_team_hk", "hub_competition_hk", "hub_season_hk",
        "team_bk", "league_id", "season_year", "team_title",
    )


BUILDERS = {
    "pit_team_season": pit_team_season,
    "pit_player_season": pit_player_season,
    "br_player_team_season": lambda m: br_player_team_season(m, m["pit_player_season"]),
    "br_team_competition_season": lambda m: br_team_competition_season(m["pit_team_season"]),
}


def business_vault(vault: Mapping[str, DataFrame]) -> Models:
    """All four tables over the raw vault."""
    return Models(BUILDERS, vault)
