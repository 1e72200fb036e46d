"""Daily loads of the stage tables from raw snapshots.

The first source is upserted by natural key, season by season; the second is replaced as
a whole. ``raw_item`` is the text of the whole item; ``raw_payload`` a struct of the fields
that the models read, with numbers as they are written there.
"""

from __future__ import annotations

from collections.abc import Collection, Mapping
from datetime import date

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pitchvault.functions.payload import nan_to_null
from pitchvault.operators.load import distinct_sorted, is_true, upsert, with_placeholders
from pitchvault.operators.lookup import lookup, semi_filter
from pitchvault.operators.versions import latest
from pitchvault.plans.stage_models import LEAGUES, SOURCE_A
from pitchvault.sources.snapshots import read_snapshot
from pitchvault.sources.tables import upsert_partitions

# Source name in the lake, and the leagues of the first source.
LAKE_SOURCE_B = "statsbomb"
RAW = "raw_item"
SOURCE_A_LEAGUES = ("epl", "la_liga", "serie_a", "bundesliga", "ligue_1")


def _texts(names: str) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names.split()])


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(n, t) for n, t in fields.items()])


TEXT, LONG, INT, DOUBLE = T.StringType(), T.LongType(), T.IntegerType(), T.DoubleType()
_SIDE, _PAIR = _texts("id title"), _texts("h a")

# Fields the models read. Figures stay text until they are staged; scores of the second
# source may be NaN, which needs a floating type to be read.
PLAYER = _texts(
    "id player_name team_title xG xA npxG xGChain xGBuildup npg goals assists shots key_passes games time position")
TEAM = _texts("Team xG NPxG xGA NPxGA NPxGD PPDA OPPDA DC ODC xPTS M W D L PTS G GA")
MATCH = _struct(id=TEXT, isResult=T.BooleanType(), h=_SIDE, a=_SIDE, goals=_PAIR, xG=_PAIR, datetime=TEXT)
COMPETITION = _struct(competition_id=INT, season_id=INT, country_name=TEXT, competition_name=TEXT)
MATCH_B = _struct(
    match_id=LONG, match_date=TEXT, home_team=TEXT, away_team=TEXT, home_score=DOUBLE, away_score=DOUBLE,
    match_status=TEXT)

# Endpoint -> item schema, natural key of the stage table, stage column -> item field.
ENDPOINTS = {
    "players": (PLAYER, ("player_id", "league_id", "season"), {"player_id": "id", "player_name": "player_name"}),
    "teams": (TEAM, ("team_title", "league_id", "season"), {"team_title": "Team"}),
    "matches": (MATCH, ("match_id",), {"match_id": "id"}),
}


def _now() -> Column:
    return F.to_timestamp_ntz(F.date_format(F.current_timestamp(), "yyyy-MM-dd HH:mm:ss.SSSSSS"))


def read_source_a(
    spark: SparkSession, root: str, endpoint: str, dt: str | date, season: int | None = None,
    leagues: Collection[str] = SOURCE_A_LEAGUES,
) -> DataFrame:
    """One day's rows of an endpoint for its stage table, with their order; only finished matches count."""
    schema, _, columns = ENDPOINTS[endpoint]
    items = read_snapshot(spark, root, SOURCE_A, endpoint, schema, dt, season, RAW)
    items = items.filter(F.col("league_id").isin(list(leagues)))
    if endpoint == "matches":
        items = is_true(items, "isResult")
    return items.select(
        *[F.col(field).alias(name) for name, field in columns.items()], "league_id", "season", "dt",
        F.struct(*schema.fieldNames()).alias("raw_payload"), RAW, "source_file", "item_no",
    )


# The last item of a batch wins, in the order of files and of the items in a file.
LAST = ("source_file", "item_no")


def load_source_a(
    spark: SparkSession,
    root: str,
    endpoint: str,
    dt: str | date,
    season: int | None = None,
    target: DataFrame | None = None,
    leagues: Collection[str] = SOURCE_A_LEAGUES,
    loaded_at: Column | None = None,
) -> DataFrame:
    """Stage table of one endpoint after the load of one day's snapshot.

    ``season`` narrows the load to one season. Leagues without a snapshot are skipped: their rows stay as they are.
    """
    rows = read_source_a(spark, root, endpoint, dt, season, leagues)
    order = [F.col(c).desc() for c in LAST]
    return upsert(target, rows, ENDPOINTS[endpoint][1], order, loaded_at if loaded_at is not None else _now()).drop(*LAST)


def upsert_source_a(
    spark: SparkSession, root: str, endpoint: str, dt: str | date, path: str, season: int | None = None,
    leagues: Collection[str] = SOURCE_A_LEAGUES, loaded_at: Column | None = None,
) -> int:
    """The same into the stage table at ``path``, kept by league and season; returns the rows written."""
    rows = read_source_a(spark, root, endpoint, dt, season, leagues)
    keys = ENDPOINTS[endpoint][1]
    once = latest(rows, keys, [F.col(c).desc() for c in LAST]).drop(*LAST)
    return upsert_partitions(
        once, path, keys, ("league_id", "season"), [F.col(keys[0])], loaded_at if loaded_at is not None else _now())


def read_competitions(spark: SparkSession, root: str, dt: str | date) -> DataFrame:
    """All competitions of the second source as told on one day."""
    return read_snapshot(spark, root, LAKE_SOURCE_B, "competitions", COMPETITION, dt, item=RAW)


def _league_frame(spark: SparkSession, leagues: Mapping[tuple, str]) -> DataFrame:
    rows = [(country, competition, slug) for (country, competition), slug in leagues.items()]
    return spark.createDataFrame(rows, "country_name string, competition_name string, slug string")


def load_competitions(
    spark: SparkSession, root: str, dt: str | date, leagues: Mapping[tuple, str] = LEAGUES,
    loaded_at: Column | None = None,
) -> DataFrame:
    """Stage table of the served competitions; empty where the snapshot is missing."""
    items = read_competitions(spark, root, dt)
    wanted = semi_filter(items, _league_frame(spark, leagues), ["country_name", "competition_name"])
    return wanted.select(
        "competition_id", "season_id", "dt", "country_name", "competition_name", "source_file",
        (loaded_at if loaded_at is not None else _now()).alias("loaded_at"),
        F.struct(*COMPETITION.fieldNames()).alias("raw_payload"), RAW,
    )


def load_matches_b(
    spark: SparkSession, root: str, dt: str | date, leagues: Mapping[tuple, str] = LEAGUES,
    loaded_at: Column | None = None, unresolved: Observation | None = None,
) -> DataFrame:
    """Stage table of the second source's matches, all seasons with a snapshot of the day.

    The competition id comes from the competitions of the same day by country, name and
    season; where they do not list it, it is NULL and counted in ``unresolved``. Of several
    ids for one key the last listed counts.
    """
    items = nan_to_null(read_snapshot(spark, root, LAKE_SOURCE_B, "matches", MATCH_B, dt, item=RAW))
    served = items.join(_league_frame(spark, leagues), F.col("league_id") == F.col("slug"))
    named = served.withColumnRenamed("season", "season_id")
    resolved = lookup(
        named, read_competitions(spark, root, dt).select("country_name", "competition_name", "season_id", "competition_id", "source_file", "item_no"),
        ["country_name", "competition_name", "season_id"], "competition_id",
        [F.col("source_file").desc(), F.col("item_no").desc()], unresolved,
    )
    return with_placeholders(resolved, {"home_team_id": "bigint", "away_team_id": "bigint"}).select(
        "match_id", "dt", "league_id", "competition_id", "season_id",
        F.to_date("match_date").alias("match_date"), "home_team_id", "away_team_id", "source_file",
        (loaded_at if loaded_at is not None else _now()).alias("loaded_at"),
        F.struct(*MATCH_B.fieldNames()).alias("raw_payload"), RAW,
    )


def season_ids(competitions: DataFrame, country: str, competition: str) -> DataFrame:
    """Distinct season ids of one competition, ascending."""
    mine = competitions.filter((F.col("country_name") == country) & (F.col("competition_name") == competition))
    return distinct_sorted(mine.dropna(subset=["season_id"]), "season_id")
