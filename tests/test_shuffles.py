"""What is shuffled: big sides are brought together once, by the keys that later steps use."""

import re
from datetime import datetime
from pathlib import Path
from threading import get_ident

import pytest

from pitchvault.functions import hashing as H
from pitchvault.operators import elo as E
from pitchvault.operators import elo_corrections as EC
from pitchvault.operators import quality as Q
from pitchvault.operators.elo_pieces import connected_teams
from pitchvault.plans import bindings as B
from pitchvault.plans import business_vault as BV
from pitchvault.plans import contracts as C
from pitchvault.plans import raw_vault as RV
from pitchvault.plans import registry as R
from pitchvault.plans import stage_models as S
from pitchvault.plans.models import Models

SMALL = "/root/testdata/sf0.001"


def exchanges(df) -> list[str]:
    """Keys of every shuffle, without the ids of their attributes."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    return [re.sub(r"#\d+L?", "", k) for k in re.findall(r"Exchange hashpartitioning\((.*?), \d+\)", plan)]


@pytest.fixture
def no_broadcast(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


PLAYERS = "player_id string, player_name string, league_id string, season int, dt date, loaded_at timestamp_ntz, raw_payload string"


def test_player_team_link_is_shuffled_once_and_joined_where_it_is(spark, frame, no_broadcast):
    players = frame(PLAYERS, *[(p, p, "epl", 2024, None, None, '{"team_title": "%s"}' % teams) for p, teams in (
        ("1", "A,B, A"), ("1", "B,C"), ("2", "a"))])
    link = RV.load("lnk_player_team", {"stg_understat_player_team": S.stg_understat_player_team(players)})
    assert exchanges(link) == ["hub_player_hk, hub_season_hk"]
    assert link.count() == 4
    pit = link.select("hub_player_hk", "hub_season_hk").distinct().withColumnRenamed("hub_season_hk", "s")
    joined = link.join(pit.withColumnRenamed("s", "hub_season_hk"), ["hub_player_hk", "hub_season_hk"])
    assert set(exchanges(joined)) == {"hub_player_hk, hub_season_hk"} and joined.count() == 4


def test_teams_of_unwritten_players_are_dealt_out_as_one_text(spark, no_broadcast, rows):
    """Every player and team was shuffled twice with all its hash keys, to tell doubles and to pick the link."""
    t = B.Tables(spark, SMALL)
    link = R.models(t, ())["lnk_player_team"]
    keys = exchanges(link)
    assert keys.count("hub_player_hk, hub_season_hk") == 1 and not [k for k in keys if "team" in k]
    assert link.count() > 1000 and rows(link) == rows(R.models(t)["lnk_player_team"])


def test_bridge_pairs_travel_by_one_key(spark, no_broadcast):
    t = B.Tables(spark, SMALL)
    models = R.models(t)
    keys = exchanges(BV.br_player_team_season(models, models["pit_player_season"]))
    assert "__at" in keys and not [k for k in keys if k.startswith("hub_team_hk, hub_competition_hk")]


def test_lines_are_not_dealt_out_by_supplier(spark):
    """At the default threshold the suppliers are sent to the lines, as are the small hubs to the figures."""
    t = B.Tables(spark, SMALL)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "200000")
    try:
        for df in (B.understat_players(t), B.match_frame(t)):
            assert not [k for k in exchanges(df) if "l_suppkey" in k]
        assert not [k for k in exchanges(R.models(t)["pit_player_season"]) if k in ("league_id", "season_year")]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_buckets_grow_with_the_rows(spark, monkeypatch):
    monkeypatch.setattr(R, "BUCKET_ROWS", 500)
    out = R.QUERIES["link_part_supplier_buckets"](spark, SMALL)
    name = re.search(r"bucketed_[0-9a-f]+", out._jdf.queryExecution().analyzed().toString()).group()
    described = {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE FORMATTED {name}").collect()}
    assert int(described["Num Buckets"]) == -(-spark.read.parquet(f"{SMALL}/lineitem.parquet").count() // 500)


def test_rounds_of_a_correction_read_the_matches_as_they_lie(spark, frame, no_broadcast):
    """Only the teams that moved are shuffled; every round shuffled all matches before."""
    rows = frame("pool string, home string, away string, moment int", ("p", "a", "b", 1), ("p", "b", "c", 2))
    name = EC._met(rows)
    moved = frame("pool string, opponent string, since int", ("p", "b", 2))
    met = spark.table(name).join(moved, ["pool", "opponent"])
    assert exchanges(met) == ["pool, opponent"]
    assert sorted((r.team, r.moment) for r in met.collect()) == [("a", 1), ("c", 2)]
    spark.sql(f"DROP TABLE {name}")


def test_models_of_players_and_teams_are_picked_where_they_lie(spark, no_broadcast):
    """The staged rows are dealt out by hub key once; every hub, link and satellite shuffled them before."""
    models = R.models(B.Tables(spark, SMALL))
    for name in ("hub_team", "hub_player", "lnk_team_competition_season", "lnk_player_team", "sat_team_details", "sat_team_xg", "sat_player_xg"):
        assert exchanges(models[name]) == [], name


def test_details_of_a_team_take_one_shuffle(spark, frame, rows):
    team = "hub_team_hk string, team_title string, league_id string, sat_team_details_hashdiff string, ldts timestamp_ntz, rsrc string"
    at = [datetime(2024, 1, 1, h) for h in range(4)]
    stage = frame(team, *[("t", x, "epl", x, at[i], "r") for i, x in enumerate("aaba")], ("u", "c", "epl", "c", None, "r"))
    details = RV.load("sat_team_details", {"stg_understat_teams": stage})
    assert exchanges(details) == ["hub_team_hk"]
    assert rows(details, "hub_team_hk", "team_title", "ldts") == sorted(
        [("t", "a", at[0]), ("t", "b", at[2]), ("t", "a", at[3]), ("u", "c", None)], key=repr)


def test_seasons_of_a_team_meet_their_own_figures(frame, rows):
    """A league or season that is NULL or without figures meets none."""
    at = datetime(2024, 1, 1)
    figures = ("xg_for", "npxg_for", "xg_against", "npxg_against", "npxg_diff", "ppda", "oppda", "xpts", "deep_completions",
               "opp_deep_completions", "matches", "wins", "draws", "losses", "points", "goals_for", "goals_against")
    vault = {
        "lnk_team_competition_season": frame(
            "hub_team_hk string, hub_competition_hk string, hub_season_hk string", ("t", "l", "s1"), ("t", "l", "s2"), ("u", "l", "s1")),
        "hub_competition": frame("hub_competition_hk string, league_id string", ("l", "epl")),
        "hub_season": frame("hub_season_hk string, season_year int", ("s1", 2023), ("s2", 2024)),
        "hub_team": frame("hub_team_hk string, team_bk string", ("t", "bt"), ("u", "bu")),
        "sat_team_details": frame("hub_team_hk string, team_title string, ldts timestamp_ntz", ("t", "T", at)),
        "sat_team_xg": frame(
            f"hub_team_hk string, league_id string, season_year int, ldts timestamp_ntz, rsrc string, {', '.join(f'{c} int' for c in figures)}",
            ("t", "epl", 2024, at, "r", *[7] * 17), ("t", None, 2023, at, "r", *[8] * 17), ("t", "cup", 2023, at, "r", *[9] * 17)),
    }
    assert rows(BV.pit_team_season(vault), "team_bk", "season_year", "team_title", "points") == [
        ("bt", 2023, "T", None), ("bt", 2024, "T", 7), ("bu", 2023, None, None)]


def test_matches_are_made_once(spark, no_broadcast):
    models = R.models(B.Tables(spark, SMALL), (*R.WITH_MATCHES, "mart_match_facts"))
    assert exchanges(models["sb_matches"]) == [] and exchanges(models["understat_matches"]) == []
    assert exchanges(models["mart_team_xg_trend"]) == ["league_id, season_year, team_title"]


def test_history_is_not_shuffled_for_its_best_teams(spark):
    history = R.models(B.Tables(spark, SMALL))["mart_team_elo_history"]
    assert exchanges(history) == [] and history.filter("is_top3_in_league = 1").count() > 0


def test_marts_are_worked_out_by_the_export_only(spark, monkeypatch):
    made = []
    scratch = R.scratch
    monkeypatch.setattr(R, "scratch", lambda s, name: made.append(scratch(s, name)) or made[-1])
    R.QUERIES["export_round_trip"](spark, SMALL).collect()
    models = next(p for p in made if "/models-" in p).removeprefix("file:")
    assert {p.name for p in Path(models).iterdir() if p.name.startswith("mart_")} == {"mart_match_facts"}


def test_models_that_marts_share_are_written_side_by_side(spark, monkeypatch):
    """All of them were written one after the other before the first mart was exported."""
    by, build = {}, Models._build
    monkeypatch.setattr(Models, "_build", lambda self, name, builder: by.setdefault(name, get_ident()) and build(self, name, builder))
    published = R.QUERIES["publish_all_marts"](spark, SMALL)
    assert published.filter("published > 0").count() == len(C.CONTRACTS)
    assert by["match_frame"] != by["stg_understat_players"]


def test_rounds_of_connected_teams_are_counted_where_they_are_written(spark, frame, tmp_path):
    games = frame("p string, home_team_title string, away_team_title string", ("p", "a", "b"), ("p", "b", "c"), ("p", "x", "y"))
    got = {(r.team_title, r.grp) for r in connected_teams(games, "p", str(tmp_path)).collect()}
    assert got == {("a", "a"), ("b", "a"), ("c", "a"), ("x", "x"), ("y", "x")}
    assert "moved" in spark.read.parquet(f"{tmp_path}/labels-1").columns


def test_staged_rows_are_dealt_out_while_they_are_short(spark, no_broadcast, rows):
    """Orders of a player and figures of a team are dealt out, not the staged rows; lines meet their orders as sums."""
    t = B.Tables(spark, SMALL)
    players, teams = B.understat_players(t, 4), B.understat_teams(t, None, 4)
    keys = exchanges(S.stg_understat_players(players))
    assert "__player" in keys and not [k for k in keys if "hub_player_hk" in k or k == "o_custkey, season"]
    assert exchanges(S.stg_understat_teams(teams))[0] == "__team"
    assert rows(players) == rows(B.understat_players(t)) and rows(teams) == rows(B.understat_teams(t))


def test_peaks_of_ratings_are_picked_before_the_shuffle(spark, frame, rows, no_broadcast):
    day = [datetime(2024, 1, d).date() for d in (1, 2, 3, 4)]
    history = frame("team_title string, league_id string, rating_after double, match_date date, match_seq long",
                    *[("a", "l", r, day[i], i) for i, r in enumerate((1.0, 3.0, 3.0, 2.0))], ("b", "l", 5.0, day[3], 3))
    current = E.elo_current(history)
    assert set(exchanges(current)) == {"team_title, league_id"}
    assert rows(current, "team_title", "current_rating", "peak_rating", "peak_match_date", "matches_played") == [
        ("a", 2.0, 3.0, day[1], 4), ("b", 5.0, 5.0, day[3], 1)]


def test_pairs_of_players_and_teams_are_made_where_the_players_lie(spark):
    """A written point-in-time table had no layout, so that the pairs were shuffled to its players first."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "200000")
    try:
        keys = exchanges(R.models(B.Tables(spark, SMALL))["mart_top_scorers"])
        assert "__at" in keys and not [k for k in keys if "hub_player_hk" in k]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_checks_write_the_columns_they_look_at(spark, monkeypatch):
    """Teams of scorers are not checked: neither their bridge is made nor their names."""
    made = []
    scratch = R.scratch
    monkeypatch.setattr(R, "scratch", lambda s, name: made.append(scratch(s, name)) or made[-1])
    found = R.QUERIES["checks_marts"](spark, SMALL)
    root = next(p for p in made if "/checked-" in p)
    assert set(spark.read.parquet(f"{root}/mart_top_scorers").columns) == {"player_bk", "league_id", "season_year"}
    assert set(spark.read.parquet(f"{root}/mart_player_overperformers").columns) == {
        "player_hk", "league_id", "season_year", "minutes"}
    assert found.filter("failures > 0").count() == 0


def test_single_keys_are_not_counted_in_full(frame, rows):
    """Only keys whose hashes may repeat are counted as they are; hot, NULL and repeated ones are counted rightly."""
    keys = [["k"], ["k", "v"]]
    single = frame("k string, v int", *[(str(i), i % 7) for i in range(500)])
    assert single.filter(Q._may_repeat(single, keys)).count() == 0
    checks = Q.TableChecks(unique=("k",), combinations=(("k", "v"),))
    many = single.unionByName(frame("k string, v int", *[("7", 0)] * 50, ("8", 1), (None, 3), (None, 3), (None, None)))
    assert 0 < many.filter(Q._may_repeat(many, keys)).count() < 200
    assert rows(Q.check_table("t", checks, {"t": many}), "check_name", "failures") == [("unique", 2), ("unique_combination", 3)]


def test_values_and_parents_meet_where_they_are_counted(spark, frame, rows, no_broadcast):
    """Values were shuffled twice, as text; different texts are different as bytes too."""
    texts = ["", "a", "0" * 32, "0" * 31, "0" * 32 + "\n", "A" * 32, "\0" * 16, "\0" * 15, "\0" * 17, "é" * 8, "md5", "f" * 32]
    tables = {"t": frame("k string, l string", *[(x, None) for x in texts], ("a", "x"), (None, "md5")),
              "p": frame("id string", ("a",), ("f" * 32,), (None,)), "q": frame("id string", ("x",))}
    checks = {"t": Q.TableChecks(relationships={"k": ("p", "id"), "l": ("q", "id")})}
    lost = Q.orphans(checks, tables)
    assert set(exchanges(lost)) == {"parent, value"} and len(exchanges(lost)) == 2
    assert rows(lost) == sorted([(0, x, 1) for x in texts if x not in ("a", "f" * 32)] + [(1, "md5", 1)], key=repr)


def test_links_and_hub_of_matches_take_few_shuffles(spark, rows, no_broadcast):
    models = R.models(B.Tables(spark, SMALL), R.WITH_MATCHES, R.WITH_MATCHES_DEALT)
    for name in ("lnk_match_team", "lnk_match_competition_season"):
        assert exchanges(models[name]) == [], name
    assert exchanges(models["hub_match"]) == ["hub_match_hk"]
    plain = R.models(B.Tables(spark, SMALL), ())
    for name in ("lnk_match_team", "hub_match"):
        assert rows(models[name]) == rows(plain[name])


def test_hash_keys_of_matches_players_and_teams_do_not_travel(spark, no_broadcast, rows):
    """They are worked out where the rows arrive; they were shuffled with orders, figures and matches."""
    t = B.Tables(spark, SMALL)
    frame = B.match_frame(t, 4)
    assert rows(frame.drop("hub_match_hk")) == rows(B.match_frame(t))
    assert frame.filter(frame.hub_match_hk != H.hash_key("match_id", source=S.SOURCE_A)).count() == 0
    for df, key in ((frame, "hub_match_hk"), (B.understat_teams(t, B.match_frame(t), 4, few=True), "md5")):
        assert [k for k in exchanges(df) if k.startswith("md5(")] and key not in exchanges(df)
    lying = exchanges(frame.groupBy("hub_match_hk").count())
    assert len(lying) == len(exchanges(frame))
    assert rows(B.understat_teams(t, None, 4, few=True)) == rows(B.understat_teams(t))


def test_match_facts_of_all_marts_are_picked_where_the_matches_lie(spark, no_broadcast):
    """The matches were written as they came and shuffled by their key as staged rows."""
    models = R._all_marts(B.Tables(spark, SMALL))
    assert exchanges(models._builders["mart_match_facts"](models)) == []


def test_regular_players_are_not_shuffled_for_their_ranks(spark, rows):
    models, plain = R.models(B.Tables(spark, SMALL)), R.models(B.Tables(spark, SMALL), ())
    ranked = models["mart_player_overperformers"]
    assert not [k for k in exchanges(ranked) if "__key" in k]
    assert rows(ranked) == rows(plain["mart_player_overperformers"])


def test_bridge_keeps_keys_of_any_text(frame, rows):
    """Keys of players travel as bytes; those that are not 32 hexadecimal digits come back as they were."""
    keys = ["p", "", "0" * 32, "A" * 32, "f" * 31]
    vault = {
        "sat_team_details": frame("hub_team_hk string, team_title string, ldts timestamp_ntz", ("t", "T", None)),
        "lnk_team_competition_season": frame("hub_team_hk string, hub_competition_hk string, hub_season_hk string", ("t", "l", "s")),
        "hub_team": frame("hub_team_hk string, team_bk string", ("t", "bt")),
        "lnk_player_team": frame("hub_player_hk string, hub_team_hk string, hub_season_hk string", *[(k, "t", "s") for k in keys]),
        "hub_competition": frame("hub_competition_hk string, league_id string", ("l", "epl")),
        "hub_season": frame("hub_season_hk string, season_year int", ("s", 2024)),
    }
    pit = frame("hub_player_hk string, hub_competition_hk string, hub_season_hk string, player_bk string, player_name string",
                *[(k, "l", "s", "b" + k, "n") for k in keys])
    assert rows(BV.br_player_team_season(vault, pit), "hub_player_hk", "player_bk") == sorted([(k, "b" + k) for k in keys], key=repr)
