"""Football-shaped stage tables derived from a star schema of orders.

One match per order, one player per customer. Home teams are groups of customers, away
teams suppliers, so that teams grow with the tables as well as matches and players.
"""

from __future__ import annotations

from collections.abc import Callable, Collection

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pitchvault.functions.hashing import hash_key, normalise_key
from pitchvault.operators.reshape import unpivot_sides
from pitchvault.operators.versions import latest
from pitchvault.plans.models import Models
from pitchvault.plans.stage_models import SOURCE_A

# Region and segment stand for country and competition; the last slug has no other source.
LEAGUES = {
    ("AFRICA", "BUILDING"): "africa",
    ("AMERICA", "BUILDING"): "america",
    ("ASIA", "BUILDING"): "asia",
    ("EUROPE", "BUILDING"): "europe",
    ("MIDDLE EAST", "BUILDING"): "middle east",
    ("EUROPE", "MACHINERY"): "cup",
}
FOCUS_TEAM = "NATION_18 3"
FOCUS_LEAGUE = "europe"


class Tables:
    """Parquet tables of one scale-factor folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self._dir = spark, sf_dir
        self._read: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        # Reading the footer takes a job: once per table will do.
        if name not in self._read:
            self._read[name] = self.spark.read.parquet(f"{self._dir}/{name}.parquet")
        return self._read[name]


def customer_places(t: Tables) -> DataFrame:
    """Customers with nation name and league (lower-case region)."""
    nations = t["nation"].join(t["region"], F.col("n_regionkey") == F.col("r_regionkey"))
    return t["customer"].join(nations, F.col("c_nationkey") == F.col("n_nationkey")).select(
        "c_custkey", "c_name", "c_mktsegment", "c_nationkey", F.expr("c_custkey DIV 15").alias("home_id"),
        F.col("n_name").alias("c_nation"), F.expr("concat(n_name, ' ', c_custkey DIV 15)").alias("home_team"), "r_name", F.lower("r_name").alias("league_id"),
    )


def with_suppliers(lines: DataFrame, t: Tables) -> DataFrame:
    """Lines with nation and team name of their supplier.

    The suppliers are joined as a table, not as a join with the nations whose size is not known beforehand:
    their few columns are then sent to the lines, not the lines to them, as long as they are small enough.
    """
    suppliers = t["supplier"].select("s_suppkey", "s_nationkey")
    nations = t["nation"].select(F.col("n_nationkey").alias("__nation"), F.col("n_name").alias("s_nation"))
    placed = lines.join(suppliers, F.col("l_suppkey") == F.col("s_suppkey")).join(nations, F.col("s_nationkey") == F.col("__nation"))
    return placed.withColumn("away_team", F.concat_ws(" ", "s_nation", "s_suppkey")).drop("s_nationkey", "__nation")


def hundredths(c: str) -> Column:
    return F.round(F.col(c) * 100).cast("int")


def fifths(c: Column) -> Column:
    """A count of fifths as an exact decimal."""
    return (c * F.lit("0.2").cast("decimal(2,1)")).cast("decimal(12,1)")


def dealt(df: DataFrame, buckets: int, key: Column, name: str) -> DataFrame:
    """The rows dealt out by ``key``, which is worked out where they arrive, as the column ``name``: a hash key does not travel."""
    return df.repartition(buckets, key).withColumn(name, key)


def match_frame(t: Tables, buckets: int | None = None) -> DataFrame:
    """One match per order, from its first lineitem; sides of one nation are left out.

    With ``buckets`` the matches bring the hub key of the first source, and are dealt out by it: first lines and
    orders meet there, when they have the names of their suppliers and customers.
    """
    order = [F.col(c).asc() for c in ("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")]
    lines = t["lineitem"].select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice",
        "l_quantity", "l_discount", "l_tax", "l_shipdate",
    )
    first = latest(lines, ["l_orderkey"], order)
    if buckets is None:
        joined = with_suppliers(
            first.join(t["orders"], F.col("l_orderkey") == F.col("o_orderkey"))
            .join(customer_places(t), F.col("o_custkey") == F.col("c_custkey")), t)
    else:
        # Keys of orders that are there stand for the orders.
        lines = with_suppliers(first.filter("l_orderkey IS NOT NULL"), t).withColumn("__price", F.floor("l_extendedprice")).drop(
            "l_linenumber", "l_partkey", "l_extendedprice").withColumnRenamed("__price", "l_extendedprice")
        orders = t["orders"].filter("o_orderkey IS NOT NULL").join(customer_places(t), F.col("o_custkey") == F.col("c_custkey"))
        joined = dealt(lines, buckets, hash_key("l_orderkey", source=SOURCE_A), "hub_match_hk").join(
            dealt(orders, buckets, hash_key("o_orderkey", source=SOURCE_A), "__order"), F.col("hub_match_hk") == F.col("__order"))
    return joined.filter(F.col("c_nation") != F.col("s_nation")).select(
        F.col("o_orderkey").alias("match_id"), "league_id",
        F.year("o_orderdate").alias("season_year"),
        F.col("o_orderdate").alias("match_datetime"),
        F.col("home_team").alias("home_team_title"), F.col("away_team").alias("away_team_title"),
        "home_id", F.col("s_suppkey").alias("away_id"),
        (F.col("l_quantity").cast("int") % 5).alias("home_goals"),
        (F.floor("l_extendedprice") % 4).cast("int").alias("away_goals"),
        fifths(hundredths("l_discount")).alias("home_xg"),
        fifths(hundredths("l_tax")).alias("away_xg"),
        "o_orderstatus", "o_orderpriority", F.col("l_shipdate").alias("loaded_at"), *[c for c in joined.columns if c == "hub_match_hk"],
    )


def understat_matches(t: Tables, frame: DataFrame | None = None) -> DataFrame:
    frame = match_frame(t) if frame is None else frame
    payload = F.to_json(F.struct(
        F.col("match_id").cast("string").alias("id"), F.lit(True).alias("isResult"),
        F.struct(F.col("home_id").cast("string").alias("id"), F.col("home_team_title").alias("title")).alias("h"),
        F.struct(F.col("away_id").cast("string").alias("id"), F.col("away_team_title").alias("title")).alias("a"),
        F.struct(F.col("home_goals").cast("string").alias("h"), F.col("away_goals").cast("string").alias("a")).alias("goals"),
        F.struct(F.col("home_xg").cast("string").alias("h"), F.col("away_xg").cast("string").alias("a")).alias("xG"),
        F.date_format("match_datetime", "yyyy-MM-dd HH:mm:ss").alias("datetime"),
    ))
    return frame.select(
        F.col("match_id").cast("string").alias("match_id"), "league_id",
        F.col("season_year").alias("season"), F.to_date("loaded_at").alias("dt"),
        "loaded_at", payload.alias("raw_payload"), *[c for c in frame.columns if c == "hub_match_hk"],
    )


def sb_matches(t: Tables, frame: DataFrame | None = None) -> DataFrame:
    """The same matches as a second source tells them: club prefixes, open scores."""
    frame = match_frame(t) if frame is None else frame
    prefix = (
        F.when(F.col("o_orderpriority") == "1-URGENT", "FC ")
        .when(F.col("o_orderpriority") == "2-HIGH", "AC FC ")
        .otherwise("")
    )
    status = (
        F.when(F.col("o_orderstatus") == "F", "available")
        .when(F.col("o_orderstatus") == "O", "scheduled").otherwise("processing")
    )
    score_known = F.col("o_orderstatus") != "O"
    payload = F.to_json(F.struct(
        F.concat(prefix, F.col("home_team_title")).alias("home_team"),
        F.upper("away_team_title").alias("away_team"),
        F.when(score_known, F.col("home_goals")).alias("home_score"),
        F.when(score_known, F.col("away_goals")).alias("away_score"),
        status.alias("match_status"),
        F.date_format("match_datetime", "yyyy-MM-dd").alias("match_date"),
    ))
    return frame.select(
        "match_id", F.to_date("loaded_at").alias("dt"), "league_id",
        F.to_date("match_datetime").alias("match_date"),
        F.date_add("loaded_at", 1).cast("timestamp_ntz").alias("loaded_at"), payload.alias("raw_payload"),
    )


def sb_competitions(t: Tables) -> DataFrame:
    return customer_places(t).select(
        F.col("c_nationkey").alias("competition_id"), F.col("c_custkey").alias("season_id"),
        F.col("r_name").alias("country_name"), F.col("c_mktsegment").alias("competition_name"),
        F.lit("1990-01-01 00:00:00").cast("timestamp_ntz").alias("loaded_at"),
    )


def understat_players(t: Tables, buckets: int | None = None) -> DataFrame:
    """Season figures per customer; the teams are the suppliers of the season.

    The lines of an order are summed before they meet it. With ``buckets``, orders and customers are dealt out by
    the hub key of the player, in short rows, and their seasons are summed where they lie.
    """
    per_order = with_suppliers(t["lineitem"], t).groupBy("l_orderkey").agg(
        F.count(F.lit(1)).alias("games"),
        F.sum(F.col("l_quantity").cast("int")).alias("quantity"),
        F.sum(F.col("l_quantity").cast("int") % 3).alias("goals"),
        F.sum(F.col("l_linenumber")).alias("shots"),
        F.sum(hundredths("l_discount")).alias("discount"),
        F.sum(hundredths("l_tax")).alias("tax"),
        F.max("l_shipdate").alias("loaded_at"),
        F.collect_set("away_team").alias("teams"),
    )
    orders = t["orders"].select("o_orderkey", "o_custkey", F.year("o_orderdate").alias("season"))
    placed = per_order.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    places, player = customer_places(t).withColumnRenamed("c_custkey", "__customer"), F.col("o_custkey") == F.col("__customer")
    keys = ["o_custkey", "season"]
    if buckets is not None:
        # Keys of customers that are there stand for the customers.
        placed = dealt(placed.filter("o_custkey IS NOT NULL").drop("l_orderkey", "o_orderkey"), buckets, hash_key("o_custkey", source=SOURCE_A), "__player")
        places = places.filter("__customer IS NOT NULL").withColumn("__player", hash_key("__customer", source=SOURCE_A)).repartition(
            buckets, "__player")
        keys, player = ["__player", *keys], "__player"
    per_season = placed.groupBy(*keys).agg(
        *[F.sum(c).alias(c) for c in ("games", "quantity", "goals", "shots", "discount", "tax")],
        F.max("loaded_at").alias("loaded_at"),
        F.array_join(F.array_sort(F.array_distinct(F.flatten(F.collect_list("teams")))), ",").alias("team_title"),
    )

    def tenths(c: str) -> Column:
        return (F.col(c) * F.lit("0.1").cast("decimal(2,1)")).cast("decimal(20,1)").cast("string")

    payload = F.to_json(F.struct(
        F.col("o_custkey").cast("string").alias("id"), F.col("c_name").alias("player_name"), "team_title",
        F.col("c_mktsegment").alias("position"),
        *[tenths(c).alias(n) for n, c in (
            ("xG", "discount"), ("xA", "tax"), ("npxG", "discount"), ("xGChain", "shots"), ("xGBuildup", "games"))],
        *[F.col(c).cast("string").alias(n) for n, c in (
            ("npg", "goals"), ("goals", "goals"), ("assists", "games"), ("shots", "shots"),
            ("key_passes", "quantity"), ("games", "games"))],
        (F.col("quantity") * 4).cast("string").alias("time"),
    ))
    return per_season.join(places, player).select(
        F.col("o_custkey").cast("string").alias("player_id"), F.col("c_name").alias("player_name"),
        "league_id", "season", F.to_date("loaded_at").alias("dt"), "loaded_at", payload.alias("raw_payload"),
    )


def understat_teams(t: Tables, frame: DataFrame | None = None, buckets: int | None = None, few: bool = False) -> DataFrame:
    """Season figures per team and league, summed over the match frame.

    With ``buckets`` they are dealt out by the hub key of the team before their payload is written out. ``few`` says that
    a team has few matches per league and season: these are dealt out themselves, and summed where they lie.
    """
    def side(me: str, other: str) -> dict:
        return {
            "team_title": f"{me}_team_title", "gf": f"{me}_goals", "ga": f"{other}_goals",
            "xf": f"{me}_xg", "xa": f"{other}_xg",
        }

    sides = unpivot_sides(
        match_frame(t) if frame is None else frame, {"home": side("home", "away"), "away": side("away", "home")},
        keep=["league_id", "season_year", "loaded_at"],
    )
    gf, ga = F.col("gf"), F.col("ga")
    team, keys = hash_key(normalise_key("team_title"), source=SOURCE_A), ["team_title", "league_id", F.col("season_year").alias("season")]
    at_once = few and buckets is not None
    if at_once:
        sides, keys = dealt(sides, buckets, team, "__team"), ["__team", *keys]
    figures = sides.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("m"), F.count_if(gf > ga).alias("w"),
        F.count_if(gf == ga).alias("d"), F.count_if(gf < ga).alias("l"),
        F.sum(gf).alias("g"), F.sum(ga).alias("ga"),
        F.sum("xf").cast("decimal(20,1)").alias("xf"), F.sum("xa").cast("decimal(20,1)").alias("xa"),
        F.max("loaded_at").alias("loaded_at"),
    )
    if buckets is not None and not at_once:
        figures = figures.withColumn("__team", team).repartition(buckets, "__team")
    half = F.lit("0.5").cast("decimal(2,1)")
    text = {
        "xG": F.col("xf"), "NPxG": F.col("xf"), "xGA": F.col("xa"), "NPxGA": F.col("xa"),
        "NPxGD": F.col("xf") - F.col("xa"),
        "PPDA": (F.col("m") * half).cast("decimal(20,1)"), "OPPDA": (F.col("g") * half).cast("decimal(20,1)"),
        "xPTS": (F.col("xf") * half).cast("decimal(20,2)"),
        "DC": F.col("g") + F.col("ga"), "ODC": F.abs(F.col("g") - F.col("ga")),
        "M": F.col("m"), "W": F.col("w"), "D": F.col("d"), "L": F.col("l"),
        "PTS": F.col("w") * 3 + F.col("d"), "G": F.col("g"), "GA": F.col("ga"),
    }
    payload = F.to_json(F.struct(
        F.col("team_title").alias("Team"), *[c.cast("string").alias(n) for n, c in text.items()]
    ))
    return figures.select(
        "team_title", "league_id", "season", F.to_date("loaded_at").alias("dt"),
        "loaded_at", payload.alias("raw_payload"),
    )


STAGE_TABLES = {
    "understat_matches": understat_matches, "understat_players": understat_players,
    "understat_teams": understat_teams, "sb_matches": sb_matches, "sb_competitions": sb_competitions,
}


OF_MATCHES = ("understat_matches", "sb_matches")


def stage_builders(t: Tables, dealt: Collection[str] = (), buckets: Callable[[], int] | None = None) -> dict:
    """Builders of the stage tables, and of the match frame that several of them are made from.

    The frame and the stage tables behind the models named in ``dealt`` are dealt out into ``buckets()`` by their hub key.
    """
    def into(name: str) -> int | None:
        return buckets() if name in dealt else None

    return {
        "match_frame": lambda _: match_frame(t, into("match_frame")),
        **{name: (lambda m, f=fn: f(t, m["match_frame"])) if name in OF_MATCHES else (lambda _, f=fn: f(t))
           for name, fn in STAGE_TABLES.items()},
        "understat_players": lambda _: understat_players(t, into("stg_understat_players")),
        "understat_teams": lambda m: understat_teams(t, m["match_frame"], into("stg_understat_teams"), few=True),
    }


def stage_tables(t: Tables) -> Models:
    return Models(stage_builders(t))
