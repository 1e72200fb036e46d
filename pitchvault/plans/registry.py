"""Named queries over the driver tables, each with the SQL that must give the same rows.

Football models run over the stage tables of ``bindings``; the other queries apply one
operator to whole driver tables.
"""

from __future__ import annotations

import functools
from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pitchvault.functions import hashing as H
from pitchvault.functions import payload as P
from pitchvault.operators import elo as E
from pitchvault.operators import load as L
from pitchvault.operators import quality as Q
from pitchvault.operators.elo_corrections import correct_history
from pitchvault.operators.elo_pieces import rate_in_pieces
from pitchvault.operators.lookup import lookup, map_slug, semi_filter
from pitchvault.operators.matching import same_as
from pitchvault.operators.reshape import explode_delimited, unpivot_sides
from pitchvault.operators.vault import PART, load_hub, load_link, load_sat, with_lineage
from pitchvault.operators.versions import coarse, latest, split_percent_rank, split_row_number
from pitchvault.plans import bindings as B
from pitchvault.plans import business_vault as BV
from pitchvault.plans import checks, contracts
from pitchvault.plans import dashboards as D
from pitchvault.plans import marts as M
from pitchvault.plans import raw_vault as RV
from pitchvault.plans import stage_loads as SL
from pitchvault.plans import stage_models as S
from pitchvault.plans.models import Models
from pitchvault.plans.oracle_sql import agree, md5_keys, md5_of, model_sql, with_models
from pitchvault.session import configure
from pitchvault.sources import snapshots, tables
from pitchvault.sources.together import together
from pitchvault.sources.tables import scratch
from pitchvault.streaming.vault_stream import read_new_files, stream_load

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def plain(df: DataFrame) -> DataFrame:
    """Decimals as doubles and zoned timestamps as plain ones, for comparing."""
    changed = {}
    for f in df.schema.fields:
        if isinstance(f.dataType, T.DecimalType):
            changed[f.name] = F.col(f.name).cast("double")
        elif isinstance(f.dataType, T.TimestampType):
            changed[f.name] = F.col(f.name).cast("timestamp_ntz")
    return df.withColumns(changed) if changed else df


def query(name: str, sql: str | None = None):
    """Register ``fn(tables)`` under ``name``, with its SQL counterpart if there is one."""
    def add(fn: Callable[[B.Tables], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return plain(fn(B.Tables(configure(spark), sf_dir)))

        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = with_models(sql)
        return fn

    return add


# ---------------------------------------------------------------- football models

PLAYER_DECIMALS = ("xg", "xa", "npxg", "xg_chain", "xg_buildup")
TEAM_DECIMALS = ("xg_for", "npxg_for", "xg_against", "npxg_against", "npxg_diff", "ppda", "oppda", "xpts")
MATCH_DECIMALS = ("home_xg", "away_xg")

MODEL_DECIMALS = {
    "stg_understat_matches": MATCH_DECIMALS, "sat_match_xg": MATCH_DECIMALS,
    "stg_understat_players": PLAYER_DECIMALS, "sat_player_xg": PLAYER_DECIMALS,
    "stg_understat_teams": TEAM_DECIMALS, "sat_team_xg": TEAM_DECIMALS,
    "pit_team_season": TEAM_DECIMALS, "pit_player_season": PLAYER_DECIMALS,
    "mart_league_table": ("xpts", "xg_for", "xg_against", "npxg_diff", "ppda", "oppda", "pts_overperf"),
    "mart_top_scorers": ("xg", "xa", "npxg", "goals_per_xg"),
    "mart_match_facts": (*MATCH_DECIMALS, "xg_diff", "total_xg"),
    "mart_player_overperformers": ("xg", "xa", "npxg", "goals_minus_xg", "assists_minus_xa"),
    "mart_team_xg_trend": ("avg_xg_for", "avg_xg_against", "max_xg_for", "max_xg_against", "gf_minus_xg", "ga_minus_xga"),
    "mart_sb_la_liga_history": ("avg_goals_scored", "avg_goals_conceded"),
}


# Read by several models above them.
# The hubs of leagues and seasons and the ranks of surpluses are small: as tables, not as plans of unknown size, they are sent to what they are joined with.
_ABOVE = ("hub_competition", "hub_season", "elo_history", "elo_best", "surplus_ranks")
# These lie in buckets of their hub key: hubs, links, satellites and point-in-time tables of players and teams are picked
# and joined from them without a shuffle. Point-in-time tables are therefore not written: they cost no shuffle, and what
# reads them finds them by their hub key.
DEALT = {"stg_understat_players": "hub_player_hk", "stg_understat_teams": "hub_team_hk"}
SHARED = (*DEALT, *_ABOVE)
# For models of one side: of the other only leagues and seasons are read, for which it need not be dealt out.
OF_PLAYERS = ("stg_understat_players", "understat_teams", *_ABOVE)
OF_TEAMS = ("understat_players", "stg_understat_teams", *_ABOVE)
OF_HUBS = ("match_frame", "understat_players", "understat_teams", *_ABOVE)
# What reads several models of the matches writes the match frame too.
WITH_MATCHES = ("match_frame", *SHARED)
# Links of the matches are picked where the matches lie.
WITH_MATCHES_DEALT = {**DEALT, "match_frame": "hub_match_hk"}
ONE_SIDE = {
    "pit_player_season": OF_PLAYERS, "mart_player_overperformers": OF_PLAYERS, "pit_team_season": OF_TEAMS,
    "br_team_competition_season": OF_TEAMS, "mart_league_table": OF_TEAMS,
}


def models(t: B.Tables, write: tuple[str, ...] = SHARED, dealt: dict[str, str] = DEALT) -> Models:
    """Every football model over the derived stage tables; shared ones are written once, some of them ``dealt`` out."""
    buckets = functools.cache(lambda: _buckets(t["lineitem"]))
    return Models(
        {**B.stage_builders(t, [n for n in dealt if n in write], buckets), **S.stage_builders(B.LEAGUES), **RV.builders(), **BV.BUILDERS,
         **M.builders(B.FOCUS_TEAM, B.FOCUS_LEAGUE),
         # Staged players that are not written do not lie by a key: they are dealt out while a player's teams are one text.
         "stg_understat_player_team": lambda m: S.player_teams(m["stg_understat_players"]) if "stg_understat_players" in write
         else S.stg_understat_player_team(m["understat_players"]),
         "surplus_ranks": lambda m: M.surplus_ranks(m["pit_player_season"]),
         "mart_player_overperformers": lambda m: M.mart_player_overperformers(
             m["pit_player_season"], ranks=m["surplus_ranks"] if "surplus_ranks" in write else None)},
        write=write, root=scratch(t.spark, "models"), dealt=dealt, buckets=buckets)


def rated(t: B.Tables) -> DataFrame:
    return models(t)["elo_history"]


def _register_models() -> None:
    def sql(name: str) -> str:
        return model_sql(name, MODEL_DECIMALS.get(name, ()))

    for name in (*S.stage_builders(), *RV.TABLES):
        query(name, sql(name))(lambda t, n=name: models(t, ())[n])
    for name in (*BV.BUILDERS, *M.builders()):
        if "elo" not in name:
            # The result itself need not be written.
            shared = tuple(s for s in ONE_SIDE.get(name, SHARED) if s != name)
            query(name, sql(name))(lambda t, n=name, w=shared: models(t, w)[n])


_register_models()

# On its own, without the models that its source shares with others: a player's teams of a season.
ORACLES["stg_understat_player_team"] = f"""
    SELECT hub_player_hk, hub_team_hk, hub_season_hk, team_title, season_year, ldts, 'understat' AS rsrc,
      {md5_keys('hub_player_hk', 'hub_team_hk', 'hub_season_hk')} AS lnk_player_team_hk
    FROM (
      SELECT {md5_of("'understat'", 'o_custkey')} AS hub_player_hk, {md5_of("'understat'", 'lower(team)')} AS hub_team_hk,
        {md5_of('season')} AS hub_season_hk, team AS team_title, season AS season_year,
        max(latest) OVER (PARTITION BY o_custkey, season) AS ldts
      FROM (
        SELECT o_custkey, CAST(year(o_orderdate) AS INTEGER) AS season, n_name || ' ' || s_suppkey AS team, max(l_shipdate) AS latest
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN supplier ON l_suppkey = s_suppkey
        JOIN nation ON s_nationkey = n_nationkey GROUP BY ALL))"""

ELO_ROUNDED = "round(rating_before, 6) AS rating_before, round(rating_after, 6) AS rating_after"


@query("mart_team_elo_history", f"""
    SELECT * REPLACE ({ELO_ROUNDED}, round(rating_delta, 6) AS rating_delta) FROM mart_team_elo_history""")
def _(t):
    return models(t)["mart_team_elo_history"].withColumns(
        {c: F.round(c, 6) for c in ("rating_before", "rating_after", "rating_delta")})


@query("mart_team_elo_current", """
    SELECT * REPLACE (round(current_rating, 6) AS current_rating, round(peak_rating, 6) AS peak_rating) FROM mart_team_elo_current""")
def _(t):
    return models(t)["mart_team_elo_current"].withColumns(
        {c: F.round(c, 6) for c in ("current_rating", "peak_rating")})


@query("elo_history_numbered", f"SELECT * REPLACE ({ELO_ROUNDED}) FROM elo_history")
def _(t):
    return rated(t).drop("rating_delta").withColumns(
        {c: F.round(c, 6) for c in ("rating_before", "rating_after")})


@query("elo_history_in_pieces", f"SELECT * EXCLUDE (match_seq) REPLACE ({ELO_ROUNDED}) FROM elo_history")
def _(t):
    root = scratch(t.spark, "pieces")
    facts = models(t, ("mart_match_facts",))["mart_match_facts"]
    return rate_in_pieces(facts, [date(1997, 1, 1)], root).drop("rating_delta", "match_seq").withColumns(
        {c: F.round(c, 6) for c in ("rating_before", "rating_after")})


@query("elo_daily_increment", f"SELECT * REPLACE ({ELO_ROUNDED}) FROM elo_history")
def _(t):
    """The history up to a day, then the matches from it on, rated from the stored ratings."""
    facts = models(t, ("mart_match_facts",))["mart_match_facts"]
    root, day = scratch(t.spark, "elo-before"), F.lit(date(1997, 1, 1))
    tables.export_mart(E.elo_history(facts.filter(F.col("match_date") < day)), root)
    before = t.spark.read.parquet(root)
    later = E.elo_history(facts.filter(F.col("match_date") >= day), ratings=E.ratings_after(before))
    return before.unionByName(later.select(*before.columns)).drop("rating_delta").withColumns(
        {c: F.round(c, 6) for c in ("rating_before", "rating_after")})


@query("elo_corrected_increment", f"SELECT * REPLACE ({ELO_ROUNDED}) FROM elo_history")
def _(t):
    """A history of other scores for one match in a hundred, without some and with some too many; corrected."""
    facts = models(t, ("mart_match_facts",))["mart_match_facts"]
    draw = F.pmod(F.xxhash64("match_hk"), F.lit(1000))
    late = F.col("match_date") >= F.lit(date(1997, 1, 1))
    told = facts.withColumn("home_goals", F.when(late & (draw < 10), F.col("home_goals") + 2).otherwise(F.col("home_goals")))
    extra = facts.filter(late & (draw == 12)).withColumn("away_team_title", F.concat("away_team_title", F.lit(" B")))
    wrong = told.filter(~late | (draw != 11)).unionByName(extra)
    path = scratch(t.spark, "elo-wrong")
    tables.export_mart(E.elo_history(wrong), path)
    out, _ = correct_history(t.spark.read.parquet(path), facts)
    return out.drop("rating_delta").withColumns({c: F.round(c, 6) for c in ("rating_before", "rating_after")})


@query("elo_top_teams", "SELECT * FROM elo_top")
def _(t):
    return E.top_teams(rated(t))


# ---------------------------------------------------------------- dashboards

query("dash_league_table_top", """
    SELECT team_title, position, pts, CAST(round(xpts, 2) AS DOUBLE) AS xpts, CAST(ppda AS DOUBLE) AS ppda
    FROM mart_league_table WHERE league_id = 'europe' AND season_year = 1997 ORDER BY position LIMIT 5""")(
    lambda t: D.league_table_top(models(t, OF_TEAMS)["mart_league_table"], "europe", 1997))

_SCORERS = """
    SELECT player_name, teams_concat, league_id, season_year, goals, CAST(round(xg, 1) AS DOUBLE) AS xg
    FROM mart_top_scorers {where} ORDER BY goals DESC NULLS LAST, player_bk, league_id, season_year LIMIT {n}"""

query("dash_top_scorers_season", _SCORERS.format(where="WHERE league_id = 'europe' AND season_year = 1997", n=5))(
    lambda t: D.top_scorers(models(t)["mart_top_scorers"], "europe", 1997, 5))
query("dash_top_scorers_all_leagues", _SCORERS.format(where="", n=15))(
    lambda t: D.top_scorers(models(t)["mart_top_scorers"], None, None, 15))

query("dash_weekly_total_xg", """
    SELECT CAST(date_trunc('week', match_datetime) AS DATE) AS week, count(*) AS matches,
      CAST((200 * CAST(sum(total_xg) * 10 AS BIGINT) + count(*)) // (2 * count(*)) AS BIGINT) / 1000.0::DOUBLE AS avg_total_xg
    FROM mart_match_facts WHERE league_id = 'asia' GROUP BY 1""")(
    lambda t: D.weekly_total_xg(models(t)["mart_match_facts"], "asia", None))

query("dash_top_overperformers", """
    SELECT player_name, team_title, goals, CAST(xg AS DOUBLE) AS xg, CAST(goals_minus_xg AS DOUBLE) AS goals_minus_xg, overperf_pct_rank
    FROM mart_player_overperformers ORDER BY goals - xg DESC NULLS LAST, player_bk, league_id, season_year LIMIT 5""")(
    lambda t: D.top_overperformers(models(t, OF_PLAYERS)["mart_player_overperformers"], None, None))

query("dash_top_teams_by_xg", """
    SELECT team_title, league_id, season_year, CAST(avg_xg_for AS DOUBLE) AS avg_xg_for, CAST(avg_xg_against AS DOUBLE) AS avg_xg_against
    FROM mart_team_xg_trend ORDER BY mart_team_xg_trend.avg_xg_for DESC NULLS LAST, team_title, league_id, season_year LIMIT 10""")(
    lambda t: D.top_teams_by_xg(models(t)["mart_team_xg_trend"], None, None))

query("dash_top_matches_by_xg", """
    SELECT match_hk, match_date, home_team_title, away_team_title, home_goals, away_goals, CAST(total_xg AS DOUBLE) AS total_xg
    FROM mart_match_facts ORDER BY mart_match_facts.total_xg DESC NULLS LAST, match_hk LIMIT 10""")(
    lambda t: D.top_matches_by_xg(models(t)["mart_match_facts"], None, None))

_ELO_TOP = """
    SELECT team_title, league_id, round(current_rating, 1) AS elo, round(peak_rating, 1) AS peak
    FROM mart_team_elo_current {where} ORDER BY current_rating DESC, team_title, league_id LIMIT {n}"""

query("dash_top_elo_league", _ELO_TOP.format(where="WHERE league_id = 'america'", n=10))(
    lambda t: D.top_teams_by_elo(E.elo_current(rated(t)), "america", 10))
query("dash_top_elo_all_leagues", _ELO_TOP.format(where="", n=20))(
    lambda t: D.top_teams_by_elo(E.elo_current(rated(t)), None, 20))

query("dash_elo_evolution", """
    SELECT league_id, team_title, match_date, round(rating_after, 6) AS rating_after
    FROM mart_team_elo_history WHERE is_top3_in_league = 1""")(
    lambda t: D.elo_evolution(models(t)["mart_team_elo_history"]).withColumn("rating_after", F.round("rating_after", 6)))

query("dash_focus_team_seasons", """
    SELECT * REPLACE (CAST(avg_goals_scored AS DOUBLE) AS avg_goals_scored, CAST(avg_goals_conceded AS DOUBLE) AS avg_goals_conceded)
    FROM mart_sb_la_liga_history""")(lambda t: models(t)["mart_sb_la_liga_history"])

query("dash_points_surplus", """
    SELECT team_title, league_id, season_year, pts, CAST(xpts AS DOUBLE) AS xpts, CAST(pts_overperf AS DOUBLE) AS pts_overperf
    FROM mart_league_table ORDER BY abs(mart_league_table.pts_overperf) DESC NULLS LAST, team_bk, league_id, season_year LIMIT 15""")(
    lambda t: D.points_surplus(models(t, OF_TEAMS)["mart_league_table"]))

query("dash_upsets", """
    SELECT match_hk, match_date, league_id, home_team_title, away_team_title, goal_diff, CAST(xg_diff AS DOUBLE) AS xg_diff
    FROM mart_match_facts WHERE goal_diff <> 0 AND sign(mart_match_facts.xg_diff) = -sign(goal_diff)
    ORDER BY abs(mart_match_facts.xg_diff) DESC, match_hk LIMIT 15""")(
    lambda t: D.upsets(models(t)["mart_match_facts"]))


# ---------------------------------------------------------------- keys and payloads

@query("hash_keys_lineitem", f"""
    SELECT l_orderkey, l_linenumber, {md5_of('l_orderkey', source='orders')} AS order_hk, {md5_of('l_partkey')} AS part_hk,
      {md5_of('lower(trim(l_returnflag))')} AS flag_hk, 'orders|' || l_orderkey AS order_bk,
      {md5_keys(md5_of('l_orderkey', source='orders'), md5_of('l_partkey'))} AS lnk_hk,
      {md5_keys(md5_of('l_orderkey', source='orders'), md5_of('l_partkey'), 'l_linestatus')} AS lnk_role_hk,
      {md5_of('l_linenumber', 'l_returnflag', "CASE WHEN l_linestatus = 'O' THEN l_linestatus END")} AS line_hashdiff
    FROM lineitem""")
def _(t):
    order, part = H.hash_key("l_orderkey", source="orders"), H.hash_key("l_partkey")
    return t["lineitem"].select(
        "l_orderkey", "l_linenumber", order.alias("order_hk"), part.alias("part_hk"),
        H.hash_key(H.normalise_key("l_returnflag")).alias("flag_hk"),
        H.business_key("orders", "l_orderkey").alias("order_bk"),
        H.link_key(order, part).alias("lnk_hk"),
        H.link_key(order, part, role="l_linestatus").alias("lnk_role_hk"),
        H.hashdiff("l_linenumber", "l_returnflag", F.when(F.col("l_linestatus") == "O", F.col("l_linestatus")))
        .alias("line_hashdiff"),
    )


@query("lineage_columns", "SELECT o_orderkey, o_orderdate AS ldts, 'orders' AS rsrc FROM orders")
def _(t):
    return with_lineage(t["orders"].select("o_orderkey", "o_orderdate"), F.col("o_orderdate"), "orders").drop("o_orderdate")


@query("json_fields_events", "SELECT event_id, event_type, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events")
def _(t):
    return P.extract(t["events"], "props", {"k": ("k", "int")}).select("event_id", "event_type", "k")


@query("json_fields_variant", """
    SELECT CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, count(*) AS n, round(sum(value), 2) AS total
    FROM events GROUP BY 1""")
def _(t):
    parsed = t["events"].withColumn("props", F.parse_json("props"))
    return P.extract(parsed, "props", {"k": ("k", T.LongType())}).groupBy("k").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum("value"), 2).alias("total"))


@query("nan_to_null_events", """
    SELECT event_id, CASE WHEN event_type <> 'error' THEN value END AS value,
      CASE WHEN event_type <> 'view' THEN value END AS inner_value FROM events""")
def _(t):
    spoiled = t["events"].select(
        "event_id",
        F.when(F.col("event_type") == "error", F.lit(float("nan"))).otherwise(F.col("value")).alias("value"),
        F.struct(F.array(
            F.when(F.col("event_type") == "view", F.lit(float("-inf"))).otherwise(F.col("value"))
        ).alias("a")).alias("nested"),
    )
    return P.nan_to_null(spoiled).select("event_id", "value", F.col("nested.a")[0].alias("inner_value"))


@query("header_rows_lineitem", """
    SELECT l_orderkey, l_linenumber, CAST(l_quantity AS INTEGER) AS qty, l_returnflag AS flag FROM lineitem""")
def _(t):
    table = F.array(
        F.array(F.lit("flag"), F.lit("unused"), F.lit("qty")),
        F.array(F.col("l_returnflag"), F.lit("x"), F.col("l_quantity").cast("int").cast("string")),
    )
    df = t["lineitem"].select("l_orderkey", "l_linenumber", table.alias("rows"))
    return P.rows_with_header(df, "rows", {"qty": "int", "flag": "string"})


@query("explode_part_names", """
    SELECT DISTINCT p_partkey, trim(w) AS word FROM (SELECT p_partkey, unnest(string_split(p_name, ' ')) AS w FROM part)
    WHERE trim(w) <> ''""")
def _(t):
    return explode_delimited(t["part"], "p_name", "word", ["p_partkey"], " ")


@query("unpivot_order_parties", """
    SELECT l_orderkey, l_linenumber, party, nation_key FROM (
      SELECT l_orderkey, l_linenumber, 'buyer' AS party, CASE WHEN c_acctbal >= 0 THEN c_nationkey END AS nation_key
      FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
      UNION ALL SELECT l_orderkey, l_linenumber, 'seller', s_nationkey FROM lineitem
      JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN supplier ON l_suppkey = s_suppkey)
    WHERE nation_key IS NOT NULL""")
def _(t):
    lines = (
        t["lineitem"].join(t["orders"], F.col("l_orderkey") == F.col("o_orderkey"))
        .join(t["customer"], F.col("o_custkey") == F.col("c_custkey"))
        .join(t["supplier"], F.col("l_suppkey") == F.col("s_suppkey"))
    )
    buyer = F.when(F.col("c_acctbal") >= 0, F.col("c_nationkey"))
    return unpivot_sides(
        lines, {"buyer": {"nation_key": buyer}, "seller": {"nation_key": "s_nationkey"}},
        keep=["l_orderkey", "l_linenumber"], role="party", required=["nation_key"],
    )


# ---------------------------------------------------------------- vault loads

def _orders_stage(t: B.Tables) -> DataFrame:
    return with_lineage(t["orders"], F.col("o_orderdate"), "orders").withColumns({
        "customer_hk": H.hash_key("o_custkey"), "order_hk": H.hash_key("o_orderkey"),
        "customer_bk": F.col("o_custkey").cast("string"),
    }).withColumn("lnk_hk", H.link_key("order_hk", "customer_hk"))


_HUB_CUSTOMER = f"""
    SELECT {md5_of('o_custkey')} AS customer_hk, CAST(o_custkey AS VARCHAR) AS customer_bk, min(o_orderdate) AS ldts, 'orders' AS rsrc
    FROM orders GROUP BY o_custkey"""


@query("hub_customer_first_load", _HUB_CUSTOMER)
def _(t):
    return load_hub([_orders_stage(t)], "customer_hk", ["customer_bk"])


@query("hub_customer_stream", _HUB_CUSTOMER)
def _(t):
    """The orders arrive as files; the hub is loaded by a query that stops when none is left."""
    root = scratch(t.spark, "stream")
    _orders_stage(t).select("customer_hk", "customer_bk", "ldts", "rsrc").write.parquet(f"{root}/arrived")
    arriving = read_new_files(t.spark, f"{root}/arrived", t.spark.read.parquet(f"{root}/arrived").schema)

    def load(batch: DataFrame, existing: DataFrame | None) -> DataFrame:
        return load_hub([batch], "customer_hk", ["customer_bk"], existing)

    stream_load(arriving, load, f"{root}/hub", f"{root}/progress").awaitTermination()
    return t.spark.read.parquet(f"{root}/hub")


@query("hub_customer_increment", f"SELECT * FROM ({_HUB_CUSTOMER}) WHERE ldts >= TIMESTAMP '1996-01-01'")
def _(t):
    orders = _orders_stage(t)
    before = load_hub([orders.filter("ldts < timestamp_ntz'1996-01-01'")], "customer_hk", ["customer_bk"])
    return load_hub([orders], "customer_hk", ["customer_bk"], existing=before)


@query("hub_party_two_sources", f"""
    SELECT party_hk, party_bk, min(ldts) AS ldts, arg_min(rsrc, (ldts, rsrc)) AS rsrc FROM (
      SELECT {md5_of('o_custkey')} AS party_hk, o_custkey AS party_bk, o_orderdate AS ldts, 'orders' AS rsrc FROM orders
      UNION ALL SELECT {md5_of('l_suppkey')}, l_suppkey, l_shipdate, 'lineitem' FROM lineitem)
    GROUP BY party_hk, party_bk""")
def _(t):
    def party(df, key, at, rsrc):
        return with_lineage(df, F.col(at), rsrc).select(
            H.hash_key(key).alias("party_hk"), F.col(key).alias("party_bk"), "ldts", "rsrc")

    return load_hub(
        [party(t["orders"], "o_custkey", "o_orderdate", "orders"),
         party(t["lineitem"], "l_suppkey", "l_shipdate", "lineitem")],
        "party_hk", ["party_bk"])


@query("link_order_customer", f"""
    SELECT {md5_keys(md5_of('o_orderkey'), md5_of('o_custkey'))} AS lnk_hk, {md5_of('o_orderkey')} AS order_hk,
      {md5_of('o_custkey')} AS customer_hk, o_orderdate AS ldts, 'orders' AS rsrc FROM orders""")
def _(t):
    return load_link(_orders_stage(t), "lnk_hk", ["order_hk", "customer_hk"])


def _supply_stage(t: B.Tables) -> DataFrame:
    return with_lineage(t["lineitem"], F.col("l_shipdate"), "lineitem").withColumns({
        "part_hk": H.hash_key("l_partkey"), "supplier_hk": H.hash_key("l_suppkey"),
    }).withColumn("lnk_hk", H.link_key("part_hk", "supplier_hk", role="l_returnflag"))


_SUPPLY = f"""
    SELECT {md5_keys(md5_of('l_partkey'), md5_of('l_suppkey'), 'l_returnflag')} AS lnk_hk, {md5_of('l_partkey')} AS part_hk,
      {md5_of('l_suppkey')} AS supplier_hk, l_returnflag, min(l_shipdate) AS ldts, 'lineitem' AS rsrc
    FROM lineitem GROUP BY l_partkey, l_suppkey, l_returnflag"""


@query("link_part_supplier_role", _SUPPLY)
def _(t):
    return load_link(_supply_stage(t), "lnk_hk", ["part_hk", "supplier_hk"], attrs=["l_returnflag"])


@query("link_part_supplier_increment", f"SELECT * FROM ({_SUPPLY}) WHERE ldts >= TIMESTAMP '1998-01-01'")
def _(t):
    lines = _supply_stage(t)
    args = ("lnk_hk", ["part_hk", "supplier_hk"])
    before = load_link(lines.filter("ldts < timestamp_ntz'1998-01-01'"), *args, attrs=["l_returnflag"])
    return load_link(lines, *args, existing=before, attrs=["l_returnflag"])


BUCKET_ROWS = 500_000


def _buckets(rows: DataFrame) -> int:
    """A task reads a bucket, so their number grows with the rows."""
    return max(8, -(-rows.count() // BUCKET_ROWS))


def _in_buckets(t: B.Tables, key: str, load: Callable[..., DataFrame], batches: list[DataFrame]) -> DataFrame:
    """A hub or link kept in buckets of its key after one load per batch; the last batch holds the others."""
    path, name = scratch(t.spark, "buckets"), None
    buckets = _buckets(batches[-1])
    for batch in batches:
        new = load(batch, t.spark.table(name) if name else None, buckets)
        name = name or tables.bucketed_table(t.spark, path, new.schema, [key], buckets)
        tables.append_bucketed(new, name)
    return t.spark.table(name)


@query("hub_customer_buckets", _HUB_CUSTOMER)
def _(t):
    """Three loads into a hub in buckets, the last of which repeats all orders."""
    orders = _orders_stage(t)
    batches = [orders.filter(c) for c in ("ldts < timestamp_ntz'1995-01-01'", "ldts < timestamp_ntz'1997-01-01'", "true")]
    return _in_buckets(
        t, "customer_hk", lambda b, known, n: load_hub([b], "customer_hk", ["customer_bk"], known, n), batches)


@query("link_part_supplier_buckets", _SUPPLY)
def _(t):
    """Two loads into a link in buckets."""
    lines = _supply_stage(t)
    return _in_buckets(
        t, "lnk_hk", lambda b, known, n: load_link(b, "lnk_hk", ["part_hk", "supplier_hk"], known, ["l_returnflag"], n),
        [lines.filter("ldts < timestamp_ntz'1997-01-01'"), lines])


def _event_stage(t: B.Tables) -> DataFrame:
    return with_lineage(t["events"], F.col("ts"), "events").withColumns({
        "user_hk": H.hash_key("user_id"), "type_hashdiff": H.hashdiff("event_type"),
    })


_EVENT_COLS = "user_hk, type_hashdiff, event_type, event_id, ldts, rsrc"
_EVENT_ROWS = f"""
    SELECT {md5_of('user_id')} AS user_hk, {md5_of('event_type')} AS type_hashdiff, event_type, event_id,
      ts AS ldts, 'events' AS rsrc FROM events"""
_EVENT_SAT = f"""
    SELECT {_EVENT_COLS} FROM ({_EVENT_ROWS})
    QUALIFY lag(type_hashdiff) OVER (PARTITION BY user_hk ORDER BY ldts, type_hashdiff, event_id) IS DISTINCT FROM type_hashdiff"""


@query("sat_event_first_load", _EVENT_SAT)
def _(t):
    return load_sat(_event_stage(t), "user_hk", "type_hashdiff", ["event_type", "event_id"])


@query("sat_event_increment", f"SELECT * FROM ({_EVENT_SAT}) WHERE ldts >= TIMESTAMP '2024-01-16'")
def _(t):
    events = _event_stage(t)
    args = ("user_hk", "type_hashdiff", ["event_type", "event_id"])
    before = load_sat(events.filter("ldts < timestamp_ntz'2024-01-16'"), *args)
    return load_sat(events, *args, existing=before)


_LATE_BATCH = f"""
    WITH event_rows AS (SELECT *, ldts >= TIMESTAMP '2024-01-16' AS early FROM ({_EVENT_ROWS})), versions AS (
      SELECT * FROM event_rows WHERE early
      QUALIFY lag(type_hashdiff) OVER (PARTITION BY user_hk ORDER BY ldts, type_hashdiff, event_id) IS DISTINCT FROM type_hashdiff
    ), again AS (
      SELECT * EXCLUDE (early), 0 AS added FROM versions
      UNION ALL SELECT * EXCLUDE (early), 1 FROM event_rows WHERE NOT early
      UNION ALL SELECT * EXCLUDE (early) REPLACE (type_hashdiff || 'x' AS type_hashdiff), 1 FROM event_rows WHERE early AND event_id % 7 = 0
    ) SELECT * EXCLUDE (prior, added) FROM (
      SELECT *, lag(type_hashdiff) OVER (PARTITION BY user_hk ORDER BY ldts, type_hashdiff, added, event_id) AS prior FROM again)
    WHERE added = 1 AND prior IS DISTINCT FROM type_hashdiff"""


def _late_batch(t: B.Tables) -> tuple[DataFrame, DataFrame]:
    """The newer half of the events; and the older half, with other versions of the newer's times."""
    events = _event_stage(t)
    newer = events.filter("ldts >= timestamp_ntz'2024-01-16'")
    other = newer.filter("event_id % 7 = 0").withColumn("type_hashdiff", F.concat("type_hashdiff", F.lit("x")))
    return newer, events.filter("ldts < timestamp_ntz'2024-01-16'").unionByName(other)


@query("sat_event_late_batch", _LATE_BATCH)
def _(t):
    newer, late = _late_batch(t)
    args = ("user_hk", "type_hashdiff", ["event_type", "event_id"])
    return load_sat(late, *args, existing=load_sat(newer, *args))


@query("sat_event_parts", _LATE_BATCH)
def _(t):
    """The same loads into a satellite in folders by key, of which the second reads what it touches."""
    newer, late = _late_batch(t)
    args, path = ("user_hk", "type_hashdiff", ["event_type", "event_id"]), scratch(t.spark, "parts")
    tables.append_parts(load_sat(newer, *args, parts=16), path, PART)
    return load_sat(late, *args, existing=t.spark.read.parquet(path), parts=16).drop(PART)


@query("sat_event_multi_active", f"""
    SELECT user_hk, k_hashdiff, event_type, k, ldts, rsrc FROM (SELECT {md5_of('user_id')} AS user_hk, event_type,
      CAST(json_extract_string(props, '$.k') AS INTEGER) // 50 AS k,
      {md5_of("CAST(json_extract_string(props, '$.k') AS INTEGER) // 50")} AS k_hashdiff, ts AS ldts, 'events' AS rsrc FROM events)
    QUALIFY lag(k_hashdiff) OVER (PARTITION BY user_hk, event_type ORDER BY ldts, k_hashdiff) IS DISTINCT FROM k_hashdiff""")
def _(t):
    read = P.extract(_event_stage(t), "props", {"k": ("k", "int")}).withColumn("k", F.expr("k div 50").cast("int"))
    return load_sat(
        read.withColumn("k_hashdiff", H.hashdiff("k")), "user_hk", "k_hashdiff", ["k"], context=["event_type"])


_LATEST_EVENT = """
    SELECT user_id, event_type, event_id, ts, value FROM events
    QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC NULLS FIRST, event_id) = 1"""


@query("latest_event_per_type", _LATEST_EVENT)
def _(t):
    events = t["events"].select("user_id", "event_type", "event_id", "ts", "value")
    return latest(events, ["user_id", "event_type"], [F.col("ts").desc_nulls_first(), F.col("event_id").asc()])


@query("pit_customer_orders", """
    SELECT o_custkey, c_name, n_name, o_orderstatus, o_orderkey, o_orderdate, o_totalprice, last_ship
    FROM (SELECT * FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey, o_orderstatus ORDER BY o_orderdate DESC, o_orderkey DESC) = 1)
    JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
    LEFT JOIN (SELECT l_orderkey, max(l_shipdate) AS last_ship FROM lineitem GROUP BY l_orderkey) ON l_orderkey = o_orderkey""")
def _(t):
    newest = latest(t["orders"], ["o_custkey", "o_orderstatus"], [F.col("o_orderdate").desc(), F.col("o_orderkey").desc()])
    shipped = t["lineitem"].groupBy("l_orderkey").agg(F.max("l_shipdate").alias("last_ship"))
    return (
        newest.join(t["customer"], F.col("o_custkey") == F.col("c_custkey"))
        .join(t["nation"], F.col("c_nationkey") == F.col("n_nationkey"))
        .join(shipped, F.col("o_orderkey") == F.col("l_orderkey"), "left")
        .select("o_custkey", "c_name", "n_name", "o_orderstatus", "o_orderkey", "o_orderdate", "o_totalprice", "last_ship")
    )


# ---------------------------------------------------------------- matching and lookups

_TITLES = """
    SELECT match_id, league_id, CAST(match_datetime AS DATE) AS match_date,
      CASE o_orderstatus WHEN 'F' THEN 'FC ' WHEN 'O' THEN 'As fc ' ELSE ' ' END || home_team_title AS h,
      CASE o_orderpriority WHEN '1-URGENT' THEN 'AFC ' ELSE '' END || away_team_title AS a FROM match_frame"""


@query("same_as_prefixed", f"""
    SELECT u.league_id, u.match_date, u.match_id AS left_id, s.match_id AS right_id
    FROM (SELECT league_id, match_date, match_id, lower(trim(h)) AS h, lower(trim(a)) AS a FROM ({_TITLES})) u
    JOIN (SELECT league_id, match_date, match_id, regexp_replace(lower(trim(home_team)), '^(afc |fc |cf |ac |as )', '') AS h,
      regexp_replace(lower(trim(away_team)), '^(afc |fc |cf |ac |as )', '') AS a FROM sb_frame) s
    ON u.league_id = s.league_id AND u.match_date = s.match_date
    AND {agree('u.h', 's.h')} AND {agree('u.a', 's.a')}""")
def _(t):
    frame = B.match_frame(t)
    status, priority = F.col("o_orderstatus"), F.col("o_orderpriority")
    left = frame.select(
        "league_id", F.to_date("match_datetime").alias("match_date"), F.col("match_id").alias("left_id"),
        F.concat(F.when(status == "F", "FC ").when(status == "O", "As fc ").otherwise(" "), "home_team_title").alias("home"),
        F.concat(F.when(priority == "1-URGENT", "AFC ").otherwise(""), "away_team_title").alias("away"))
    right = P.extract(B.sb_matches(t), "raw_payload", {"home": ("home_team", "string"), "away": ("away_team", "string")})
    return same_as(
        left, right.withColumnRenamed("match_id", "right_id"), ["league_id", "match_date"], ["home", "away"],
        S.CLUB_PREFIX, ["left_id"], ["right_id"])


@query("semi_filter_orders", """
    SELECT o_orderkey, o_custkey, o_orderstatus FROM orders
    WHERE (o_custkey, o_orderstatus) IN (SELECT o_custkey, o_orderstatus FROM orders WHERE o_totalprice > 400000)""")
def _(t):
    orders = t["orders"]
    wanted = orders.filter("o_totalprice > 400000").select("o_custkey", "o_orderstatus")
    return semi_filter(orders.select("o_orderkey", "o_custkey", "o_orderstatus"), wanted, ["o_custkey", "o_orderstatus"])


@query("lookup_supplier_of_part", """
    SELECT o.l_orderkey, o.l_linenumber, o.l_partkey, d.l_suppkey AS usual_supplier FROM lineitem o LEFT JOIN (
      SELECT l_partkey, l_returnflag, l_suppkey FROM lineitem WHERE l_returnflag = 'R'
      QUALIFY row_number() OVER (PARTITION BY l_partkey, l_returnflag ORDER BY l_shipdate DESC, l_suppkey DESC) = 1) d
    ON d.l_partkey = o.l_partkey AND d.l_returnflag = o.l_returnflag""")
def _(t):
    lines = t["lineitem"]
    returned = F.when(F.col("l_returnflag") == "R", F.col("l_returnflag"))
    dim = lines.select("l_partkey", returned.alias("l_returnflag"), F.col("l_suppkey").alias("usual_supplier"), "l_shipdate")
    return lookup(
        lines.select("l_orderkey", "l_linenumber", "l_partkey", "l_returnflag"), dim, ["l_partkey", "l_returnflag"],
        "usual_supplier", [F.col("l_shipdate").desc(), F.col("usual_supplier").desc()],
    ).drop("l_returnflag")


@query("map_slug_orders", """
    SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' AND o_orderpriority = '1-URGENT' THEN 'done-urgent'
      WHEN o_orderstatus = 'O' AND o_orderpriority = '5-LOW' THEN 'open-low' END AS slug FROM orders
    WHERE (o_orderstatus, o_orderpriority) IN (('F', '1-URGENT'), ('O', '5-LOW'))""")
def _(t):
    mapping = {("F", "1-URGENT"): "done-urgent", ("O", "5-LOW"): "open-low"}
    return map_slug(t["orders"], ["o_orderstatus", "o_orderpriority"], mapping, "slug").select("o_orderkey", "slug")


# ---------------------------------------------------------------- stage loads

_UPSERT = """
    SELECT o_custkey, o_orderkey, o_totalprice, TIMESTAMP '2000-01-01' AS loaded_at FROM orders WHERE o_orderdate >= TIMESTAMP '1997-01-01'
    QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1"""


@query("upsert_customer_order", f"""
    WITH batch AS ({_UPSERT}), target AS (
      SELECT o_custkey, o_orderkey, o_totalprice, o_orderdate AS loaded_at FROM orders WHERE o_orderdate < TIMESTAMP '1997-01-01'
      QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1)
    SELECT * FROM batch UNION ALL SELECT * FROM target WHERE o_custkey NOT IN (SELECT o_custkey FROM batch)""")
def _(t):
    orders = t["orders"].select("o_custkey", "o_orderkey", "o_totalprice", "o_orderdate", F.col("o_orderdate").alias("loaded_at"))
    newest = [F.col("o_orderdate").desc(), F.col("o_orderkey").desc()]
    target = latest(orders.filter("o_orderdate < timestamp_ntz'1997-01-01'"), ["o_custkey"], newest).drop("o_orderdate")
    incoming = orders.filter("o_orderdate >= timestamp_ntz'1997-01-01'")
    return L.upsert(target, incoming, ["o_custkey"], newest, F.lit("2000-01-01 00:00:00").cast("timestamp_ntz"))


@query("upsert_order_parts", """
    WITH batch AS (SELECT o_orderkey, o_orderpriority, o_totalprice + 1 AS o_totalprice,
        CASE WHEN o_orderkey % 7 = 0 THEN 'F' ELSE o_orderstatus END AS o_orderstatus, TIMESTAMP '2000-01-01' AS loaded_at
      FROM orders WHERE o_orderstatus = 'O' AND o_orderkey % 3 = 0 OR o_orderstatus = 'P')
    SELECT * FROM batch UNION ALL
    SELECT o_orderkey, o_orderpriority, o_totalprice, o_orderstatus, TIMESTAMP '1999-01-01' FROM orders
    WHERE o_orderkey NOT IN (SELECT o_orderkey FROM batch)""")
def _(t):
    """Orders kept by status: a batch with new prices, some of them under another status, then an empty one."""
    path = scratch(t.spark, "orders-by-status")
    orders = t["orders"].select("o_orderkey", "o_orderpriority", "o_totalprice", "o_orderstatus")

    def load(batch: DataFrame, at: str) -> None:
        stamp = F.lit(f"{at} 00:00:00").cast("timestamp_ntz")
        tables.upsert_partitions(batch, path, ["o_orderkey"], ["o_orderstatus"], [F.col("o_totalprice").desc()], stamp)

    load(orders, "1999-01-01")
    some = orders.filter("o_orderstatus = 'O' AND o_orderkey % 3 = 0 OR o_orderstatus = 'P'")
    load(some.withColumns({
        "o_totalprice": F.col("o_totalprice") + 1,
        "o_orderstatus": F.when(F.col("o_orderkey") % 7 == 0, "F").otherwise(F.col("o_orderstatus"))}), "2000-01-01")
    load(orders.limit(0), "2001-01-01")
    return t.spark.read.parquet(path)


@query("full_refresh_orders", "SELECT o_orderkey, o_totalprice FROM orders")
def _(t):
    orders = t["orders"].select("o_orderkey", "o_totalprice")
    return L.full_refresh(orders.limit(0), t["orders"])


@query("is_true_lineitem", "SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_returnflag = 'R'")
def _(t):
    flag = F.when(F.col("l_returnflag") == "R", True).when(F.col("l_returnflag") == "N", False)
    return L.is_true(t["lineitem"].select("l_orderkey", "l_linenumber", flag.alias("f")), "f").drop("f")


@query("distinct_sorted_customers", "SELECT DISTINCT o_custkey FROM orders ORDER BY o_custkey")
def _(t):
    return L.distinct_sorted(t["orders"], "o_custkey")


@query("placeholders_orders", "SELECT o_orderkey, CAST(NULL AS BIGINT) AS home_team_id, CAST(NULL AS BIGINT) AS away_team_id FROM orders")
def _(t):
    return L.with_placeholders(t["orders"].select("o_orderkey"), {"home_team_id": "bigint", "away_team_id": "bigint"})


# ---------------------------------------------------------------- ordered numbering

@query("row_number_split", """
    SELECT o_orderkey, o_orderpriority, row_number() OVER (PARTITION BY o_orderpriority
      ORDER BY o_totalprice DESC NULLS FIRST, o_orderkey) AS place FROM orders""")
def _(t):
    orders = t["orders"].select("o_orderkey", "o_orderpriority", "o_totalprice")
    return split_row_number(
        orders, ["o_orderpriority"], [F.col("o_totalprice").desc_nulls_first(), F.col("o_orderkey").asc()],
        [(coarse("o_totalprice", 64), "desc")], "place").drop("o_totalprice")


@query("percent_rank_split", """
    SELECT l_orderkey, l_linenumber, l_partkey, l_returnflag, round(percent_rank() OVER (PARTITION BY l_returnflag
      ORDER BY CASE WHEN l_quantity < 50 THEN l_quantity END NULLS LAST), 9) AS share FROM lineitem""")
def _(t):
    lines = t["lineitem"].select("l_orderkey", "l_linenumber", "l_partkey", "l_returnflag", "l_quantity")
    key = F.when(F.col("l_quantity") < 50, F.col("l_quantity"))
    return split_percent_rank(lines, ["l_returnflag"], key, "share").withColumn("share", F.round("share", 9)).drop("l_quantity")


# ---------------------------------------------------------------- quality

_DRIVER_CHECKS = {
    "lineitem": Q.TableChecks(
        not_null=("l_orderkey", "l_shipdate"), accepted={"l_returnflag": ("A", "N")},
        expressions=("l_quantity < 50",), combinations=(("l_orderkey", "l_linenumber"),),
        relationships={"l_orderkey": ("orders", "o_orderkey"), "l_suppkey": ("late_supplier", "s_suppkey")}),
    "orders": Q.TableChecks(unique=("o_orderkey", "o_custkey"), accepted={"o_orderstatus": ("F", "O", "P")}),
}


@query("driver_checks", """
    SELECT 'lineitem' AS table_name, 'not_null' AS check_name, 'l_orderkey' AS target, count(*) FILTER (l_orderkey IS NULL) AS failures FROM lineitem
    UNION ALL SELECT 'lineitem', 'not_null', 'l_shipdate', count(*) FILTER (l_shipdate IS NULL) FROM lineitem
    UNION ALL SELECT 'lineitem', 'accepted_values', 'l_returnflag', count(*) FILTER (l_returnflag NOT IN ('A', 'N')) FROM lineitem
    UNION ALL SELECT 'lineitem', 'expression_is_true', 'l_quantity < 50', count(*) FILTER (NOT l_quantity < 50) FROM lineitem
    UNION ALL SELECT 'lineitem', 'unique_combination', 'l_orderkey,l_linenumber', count(*) FROM (SELECT 1 FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1)
    UNION ALL SELECT 'lineitem', 'relationships', 'l_orderkey', count(*) FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders)
    UNION ALL SELECT 'lineitem', 'relationships', 'l_suppkey', count(*) FROM lineitem WHERE l_suppkey NOT IN (SELECT s_suppkey FROM supplier WHERE s_acctbal > 0)
    UNION ALL SELECT 'orders', 'accepted_values', 'o_orderstatus', count(*) FILTER (o_orderstatus NOT IN ('F', 'O', 'P')) FROM orders
    UNION ALL SELECT 'orders', 'unique', 'o_orderkey', count(*) FROM (SELECT 1 FROM orders GROUP BY o_orderkey HAVING count(*) > 1)
    UNION ALL SELECT 'orders', 'unique', 'o_custkey', count(*) FROM (SELECT 1 FROM orders GROUP BY o_custkey HAVING count(*) > 1)""")
def _(t):
    found = {n: t[n] for n in ("lineitem", "orders")}
    found["late_supplier"] = t["supplier"].filter("s_acctbal > 0")
    return Q.check_all(_DRIVER_CHECKS, found)


def _failing(name: str, sql: str, fn) -> None:
    query(name, sql)(fn)


_failing("check_not_null_rows", "SELECT o_orderkey FROM orders WHERE o_orderpriority = '5-LOW'",
         lambda t: Q.not_null(t["orders"].withColumn("p", F.expr("nullif(o_orderpriority, '5-LOW')")), "p").select("o_orderkey"))
_failing("check_unique_rows", "SELECT l_orderkey, count(*) AS n_rows FROM lineitem GROUP BY 1 HAVING count(*) > 1",
         lambda t: Q.unique(t["lineitem"], "l_orderkey"))
_failing("check_unique_combination_rows",
         "SELECT l_orderkey, l_linenumber, count(*) AS n_rows FROM lineitem GROUP BY ALL HAVING count(*) > 1",
         lambda t: Q.unique_combination(t["lineitem"], ["l_orderkey", "l_linenumber"]))
_failing("check_relationships_rows",
         "SELECT l_partkey, count(*) AS n_rows FROM lineitem WHERE l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_size < 25) GROUP BY 1",
         lambda t: Q.relationships(t["lineitem"], "l_partkey", t["part"].filter("p_size < 25"), "p_partkey"))
_failing("check_accepted_values_rows", "SELECT event_id, event_type FROM events WHERE event_type NOT IN ('click', 'view')",
         lambda t: Q.accepted_values(t["events"].select("event_id", "event_type"), "event_type", ["click", "view"]))
_failing("check_expression_rows", "SELECT l_orderkey, l_linenumber FROM lineitem WHERE NOT (l_discount >= l_tax)",
         lambda t: Q.expression_is_true(t["lineitem"], "l_discount >= l_tax").select("l_orderkey", "l_linenumber"))


def _check_sql(name: str, c: Q.TableChecks) -> list[str]:
    def row(kind: str, target: str, count: str) -> str:
        quoted = target.replace("'", "''")
        return f"SELECT '{name}' AS table_name, '{kind}' AS check_name, '{quoted}' AS target, CAST({count} AS BIGINT) AS failures"

    def listed(values) -> str:
        return ", ".join(f"'{v}'" for v in values)

    out = [row("not_null", x, f"count(*) FILTER ({x} IS NULL)") + f" FROM {name}" for x in c.not_null]
    out += [row("accepted_values", x, f"count(*) FILTER ({x} NOT IN ({listed(v)}))") + f" FROM {name}" for x, v in c.accepted.items()]
    out += [row("expression_is_true", e, f"count(*) FILTER (NOT ({e}))") + f" FROM {name}" for e in c.expressions]
    for cols in [(u,) for u in c.unique] + list(c.combinations):
        kind = "unique" if len(cols) == 1 else "unique_combination"
        out.append(row(kind, ",".join(cols), "count(*)") + (
            f" FROM (SELECT 1 FROM {name} WHERE {cols[0]} IS NOT NULL GROUP BY {', '.join(cols)} HAVING count(*) > 1)"))
    out += [row("relationships", x, "count(*)") + (
        f" FROM {name} WHERE {x} IS NOT NULL AND {x} NOT IN (SELECT {pk} FROM {parent})")
        for x, (parent, pk) in c.relationships.items()]
    return out


def _layer_checks(layer: dict[str, Q.TableChecks]) -> str:
    return " UNION ALL ".join(s for n, c in layer.items() for s in _check_sql(n, c))


HUB_CHECKS = {n: checks.RAW_VAULT[n] for n in RV.HUBS}
LINK_CHECKS = {n: checks.RAW_VAULT[n] for n in RV.LINKS}
SAT_CHECKS = {n: checks.RAW_VAULT[n] for n in RV.SATS}


def _written_checks(layer: dict, shared: tuple[str, ...] = WITH_MATCHES, dealt: dict[str, str] = DEALT):
    """Write the checked columns of the tables once, then check them: every check would otherwise rebuild them.

    What goes into other columns only is not worked out. Parents that are not checked themselves are read once.
    """
    def run(t: B.Tables) -> DataFrame:
        built, root = models(t, shared, dealt), scratch(t.spark, "checked")

        def checked(name: str) -> DataFrame:
            if name not in shared:
                tables.export_mart(built[name].select(*Q.checked_columns(built[name], layer[name])), f"{root}/{name}")
            return built[name] if name in shared else t.spark.read.parquet(f"{root}/{name}")

        parents = {p for c in layer.values() for p, _ in c.relationships.values()}
        return Q.check_all(layer, {**{p: built[p] for p in parents}, **{n: checked(n) for n in layer}})

    return run


query("checks_hubs", _layer_checks(HUB_CHECKS))(_written_checks(HUB_CHECKS, shared=OF_HUBS))
query("checks_links", _layer_checks(LINK_CHECKS))(_written_checks(LINK_CHECKS, dealt=WITH_MATCHES_DEALT))
query("checks_satellites", _layer_checks(SAT_CHECKS))(_written_checks(SAT_CHECKS))
query("checks_business_vault", _layer_checks(checks.BUSINESS_VAULT))(_written_checks(checks.BUSINESS_VAULT))
query("checks_marts", _layer_checks(checks.MARTS))(_written_checks(checks.MARTS, (*WITH_MATCHES, "mart_match_facts"), WITH_MATCHES_DEALT))


def _contract_sql(name: str) -> str:
    c = contracts.CONTRACTS[name]
    parts = []
    for col, spec in c.columns.items():
        low_high = Q.INTEGER_RANGES.get(spec.rstrip("?"))
        nulls = "count(NULL)" if spec.endswith("?") else f"count(*) FILTER ({col} IS NULL)"
        outside = "count(NULL)" if low_high is None else f"count(*) FILTER ({col} NOT BETWEEN {low_high[0]} AND {low_high[1]})"
        parts.append(f"SELECT '{name}' AS mart, '{col}' AS column_name, CAST({nulls} AS BIGINT) AS nulls, CAST({outside} AS BIGINT) AS out_of_range FROM {name}")
    return " UNION ALL ".join(parts)


def _all_marts(t: B.Tables) -> Models:
    """All marts, each worked out by what reads it once; match facts are written, as other marts read them."""
    return models(t, (*WITH_MATCHES, "mart_match_facts"), WITH_MATCHES_DEALT)


@query("contract_violations_marts", " UNION ALL ".join(map(_contract_sql, contracts.CONTRACTS)))
def _(t):
    built, out = _all_marts(t), None
    for name, contract in contracts.CONTRACTS.items():
        part = Q.contract_violations(built[name].select(*contract.columns), contract).withColumn("mart", F.lit(name))
        out = part if out is None else out.unionByName(part)
    return out


@query("store_failures_rows", " UNION ALL ".join(
    f"SELECT table_name || '.' || check_name || '.' || target AS stored, failures AS n FROM ({_layer_checks({n: c})})"
    for n, c in HUB_CHECKS.items()))
def _(t):
    """Failing rows of every hub check, written to its own folder and counted there."""
    root, spark = scratch(t.spark, "failures"), t.spark
    paths = Q.store_failures(HUB_CHECKS, models(t, (*OF_HUBS, *RV.HUBS)), root)
    out = None
    for name, path in paths.items():
        part = spark.read.parquet(path).agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("stored"), "n")
        out = part if out is None else out.unionByName(part)
    return out


# ---------------------------------------------------------------- sources and sinks

@query("snapshot_round_trip", """
    SELECT event_id, ts, user_id, event_type AS league_id, CAST(year(ts) AS INTEGER) AS season, DATE '2024-02-01' AS dt,
      CASE WHEN value > 50 THEN NULL ELSE value END AS value, true AS has_file FROM events""")
def _(t):
    spark = t.spark
    root = scratch(spark, "snapshots")
    rows = t["events"].select(
        "event_id", "ts", "user_id", F.when(F.col("value") > 50, F.lit(float("nan"))).otherwise(F.col("value")).alias("value"),
        F.lit("driver").alias("source"), F.lit("events").alias("endpoint"), F.col("event_type").alias("league_id"),
        F.year("ts").alias("season"), F.lit("2024-02-01").alias("dt"))
    snapshots.write_snapshot(rows, root, ["source", "endpoint", "league_id", "season", "dt"])
    schema = T.StructType([
        T.StructField("event_id", T.LongType()), T.StructField("ts", T.TimestampNTZType()),
        T.StructField("user_id", T.LongType()), T.StructField("value", T.DoubleType())])
    read = snapshots.read_snapshot(spark, root, "driver", "events", schema, "2024-02-01")
    return P.nan_to_null(read).withColumn("has_file", F.col("source_file").contains("dt=2024-02-01")).drop("source_file", "item_no")


_LEVELS_A = ["source", "endpoint", "league_id", "season", "dt"]
_DAY = "2024-02-01"


def _snapshot_items(t: B.Tables, name: str, schema: T.StructType, source: str, endpoint: str) -> DataFrame:
    """Items of a stage table as a source would deliver them, with the levels of their snapshot."""
    raw = B.STAGE_TABLES[name](t)
    return raw.select(
        F.from_json("raw_payload", schema).alias("item"), F.lit(source).alias("source"), F.lit(endpoint).alias("endpoint"),
        "*", F.lit(_DAY).alias("__dt")).drop("dt", "raw_payload").withColumnRenamed("__dt", "dt")


def _loaded_a(t: B.Tables, endpoint: str, name: str) -> DataFrame:
    """A day's items written as a snapshot and loaded into the stage table of the first source."""
    root, schema = scratch(t.spark, "lake"), SL.ENDPOINTS[endpoint][0]
    items = _snapshot_items(t, name, schema, S.SOURCE_A, endpoint)
    snapshots.write_snapshot(items.select("item.*", *_LEVELS_A), root, _LEVELS_A)
    return SL.load_source_a(
        t.spark, root, endpoint, _DAY, leagues=B.LEAGUES.values(),
        loaded_at=F.lit("2024-02-01 04:00:00").cast("timestamp_ntz"))


def _no_ldts(name: str) -> str:
    """SQL of a stage model without its load time; numbers as the model's own query has them."""
    decimals = MODEL_DECIMALS.get(name, ())
    cast = f" REPLACE ({', '.join(f'CAST({c} AS DOUBLE) AS {c}' for c in decimals)})" if decimals else ""
    return f"SELECT * EXCLUDE (ldts){cast} FROM {name}"


@query("snapshot_stage_load_matches", _no_ldts("stg_understat_matches"))
def _(t):
    return S.stg_understat_matches(_loaded_a(t, "matches", "understat_matches")).drop("ldts")


@query("snapshot_stage_load_players", _no_ldts("stg_understat_players"))
def _(t):
    return S.stg_understat_players(_loaded_a(t, "players", "understat_players")).drop("ldts")


@query("snapshot_stage_load_teams", _no_ldts("stg_understat_teams"))
def _(t):
    return S.stg_understat_teams(_loaded_a(t, "teams", "understat_teams")).drop("ldts")


def _second_source(t: B.Tables) -> str:
    """Lake with one day's competitions and matches of the second source."""
    root = scratch(t.spark, "lake")
    competitions = B.sb_competitions(t).select(
        *SL.COMPETITION.fieldNames(), F.lit(SL.LAKE_SOURCE_B).alias("source"), F.lit("competitions").alias("endpoint"), F.lit(_DAY).alias("dt"))
    snapshots.write_snapshot(competitions, root, ["source", "endpoint", "dt"])
    fields = [f for f in SL.MATCH_B.fieldNames() if f != "match_id"]
    matches = _snapshot_items(t, "sb_matches", SL.MATCH_B, SL.LAKE_SOURCE_B, "matches").withColumn("season", F.year("match_date"))
    snapshots.write_snapshot(matches.select("match_id", *[f"item.{f}" for f in fields], *_LEVELS_A), root, _LEVELS_A)
    return root


@query("snapshot_stage_load_competitions", _no_ldts("stg_sb_competitions"))
def _(t):
    loaded = SL.load_competitions(t.spark, _second_source(t), _DAY, B.LEAGUES, F.lit("2024-02-01 04:00:00").cast("timestamp_ntz"))
    return S.stg_sb_competitions(loaded, B.LEAGUES).drop("ldts")


@query("snapshot_stage_load_matches_b", _no_ldts("stg_sb_matches"))
def _(t):
    loaded = SL.load_matches_b(t.spark, _second_source(t), _DAY, B.LEAGUES, F.lit("2024-02-01 04:00:00").cast("timestamp_ntz"))
    return S.stg_sb_matches(loaded).drop("ldts")


@query("export_round_trip", " UNION ALL ".join(
    f"SELECT '{m}' AS mart, count(*) AS n, (SELECT {' + '.join(f'(SELECT count(*) FROM {x})' for x in contracts.CONTRACTS)}) AS exported FROM {m}"
    for m in contracts.CONTRACTS))
def _(t):
    spark, built = t.spark, _all_marts(t)
    root = scratch(spark, "export")
    exported = tables.export_marts({m: built[m] for m in contracts.CONTRACTS}, root)
    out = None
    for m in contracts.CONTRACTS:
        part = spark.read.parquet(f"{root}/{m}").agg(F.count(F.lit(1)).alias("n")).select(
            F.lit(m).alias("mart"), "n", F.lit(exported).cast("long").alias("exported"))
        out = part if out is None else out.unionByName(part)
    return out


@query("publish_round_trip", """
    SELECT league_id, season_year, count(*) AS matches, CAST(sum(total_goals) AS BIGINT) AS goals,
      (SELECT count(*) FROM mart_match_facts) AS published FROM mart_match_facts GROUP BY league_id, season_year""")
def _(t):
    """Match facts exported, published behind their contract twice, and read from the serving copy."""
    spark = t.spark
    root = scratch(spark, "publish")
    contract = contracts.CONTRACTS["mart_match_facts"]
    tables.export_mart(models(t)["mart_match_facts"].select(*contract.columns), f"{root}/marts")
    for _ in range(2):  # the second replaces the first
        n = tables.publish_mart(spark, f"{root}/marts", f"{root}/serving", contract)
    return spark.read.parquet(f"{root}/serving").groupBy("league_id", "season_year").agg(
        F.count(F.lit(1)).alias("matches"), F.sum("total_goals").alias("goals"), F.lit(n).cast("long").alias("published"))


@query("export_laid_out_lookup", """
    SELECT match_hk, match_date, home_team_title, away_team_title, total_goals FROM mart_match_facts
    WHERE home_team_title = (SELECT min(home_team_title) FROM mart_match_facts)""")
def _(t):
    """All home matches of one team, found in match facts that are laid out by league and date."""
    path = scratch(t.spark, "laid-out")
    contract = contracts.CONTRACTS["mart_match_facts"]
    tables.export_laid_out(models(t)["mart_match_facts"], path, contract.sort_by, contracts.FIND_BY)
    facts = t.spark.read.parquet(path)
    team = facts.agg(F.min("home_team_title")).first()[0]
    return facts.filter(F.col("home_team_title") == team).select(
        "match_hk", "match_date", "home_team_title", "away_team_title", "total_goals")


@query("publish_all_marts", " UNION ALL ".join(
    f"SELECT '{m}' AS mart, CASE WHEN (SELECT sum(nulls + out_of_range) FROM ({_contract_sql(m)})) = 0 THEN (SELECT count(*) FROM {m}) END AS published"
    for m in contracts.CONTRACTS))
def _(t):
    """Every mart exported and published behind its contract, several at a time; no number where the contract refuses it."""
    spark, built = t.spark, _all_marts(t)
    root = scratch(spark, "publish-all")
    # What the marts share is written as they are asked for: players beside matches, not one after the other.
    together(spark, {m: functools.partial(built.__getitem__, m) for m in contracts.CONTRACTS})
    tables.export_marts({m: built[m].select(*c.columns) for m, c in contracts.CONTRACTS.items()}, f"{root}/marts")

    def publish(mart: str) -> int | None:
        try:
            return tables.publish_mart(spark, f"{root}/marts/{mart}", f"{root}/serving/{mart}", contracts.CONTRACTS[mart], contracts.FIND_BY)
        except ValueError:
            return None

    published = together(spark, {m: functools.partial(publish, m) for m in contracts.CONTRACTS})
    out = None
    for m, n in published.items():
        # What is there is counted by its readers, and by the writer.
        served = tables.read_table(spark, f"{root}/serving/{m}")
        count = F.lit(None).cast("long") if n is None else F.when(F.count(F.lit(1)) == n, F.lit(n).cast("long"))
        part = (spark.range(1) if served is None else served).agg(count.alias("published")).select(F.lit(m).alias("mart"), "published")
        out = part if out is None else out.unionByName(part)
    return out
