"""The football models end to end, on a few literal payloads."""

import json
from datetime import date, datetime

import pytest

from pitchvault.plans import checks, contracts
from pitchvault.plans import dashboards as D
from pitchvault.plans.warehouse import Warehouse

T1, T2 = datetime(2024, 1, 1), datetime(2024, 2, 1)
DAY = date(2024, 1, 1)

MATCHES = "match_id string, league_id string, season int, dt date, loaded_at timestamp_ntz, raw_payload string"
PLAYERS = "player_id string, player_name string, league_id string, season int, dt date, loaded_at timestamp_ntz, raw_payload string"
TEAMS = "team_title string, league_id string, season int, dt date, loaded_at timestamp_ntz, raw_payload string"
SB_MATCHES = "match_id long, dt date, league_id string, match_date date, loaded_at timestamp_ntz, raw_payload string"
SB_COMPETITIONS = "competition_id int, season_id int, country_name string, competition_name string, loaded_at timestamp_ntz"


def match(i, home, away, goals, xg, at, when=T1, league="la_liga"):
    payload = {"id": str(i), "isResult": True, "h": {"id": "1", "title": home}, "a": {"id": "2", "title": away},
               "goals": {"h": goals[0], "a": goals[1]}, "xG": {"h": xg[0], "a": xg[1]}, "datetime": at}
    return (str(i), league, 2023, DAY, when, json.dumps(payload))


def player(i, name, teams, goals, xg, minutes, league="la_liga", when=T1):
    payload = {"id": str(i), "player_name": name, "team_title": teams, "xG": xg, "xA": "1.5", "npxG": xg, "xGChain": "2",
               "xGBuildup": "1", "npg": str(goals), "goals": str(goals), "assists": "2", "shots": "9", "key_passes": "4",
               "games": "10", "time": str(minutes), "position": "F"}
    return (str(i), name, league, 2023, DAY, when, json.dumps(payload))


def team(title, pts, g, ga, xpts, league="la_liga", when=T1):
    payload = {"Team": title, "xG": 10.5, "NPxG": 9.5, "xGA": 8.0, "NPxGA": 7.5, "NPxGD": 2.0, "PPDA": 9.1, "OPPDA": 10.2,
               "DC": 50, "ODC": 40, "xPTS": xpts, "M": 4, "W": pts // 3, "D": pts % 3, "L": 1, "PTS": pts, "G": g, "GA": ga}
    return (title, league, 2023, DAY, when, json.dumps(payload))


def sb(i, home, away, score, day, status="available", league="la_liga"):
    payload = {"match_id": i, "home_team": home, "away_team": away, "home_score": score[0], "away_score": score[1],
               "match_status": status, "match_date": day}
    return (i, DAY, league, date.fromisoformat(day), T2, json.dumps(payload))


@pytest.fixture(scope="module")
def stage(frame):
    return {
        "understat_matches": frame(
            MATCHES,
            match(1, "Barcelona", "Getafe", ("3", "0"), ("1.5", "0.25"), "2023-08-20 19:00:00"),
            match(2, "Getafe", "Real Betis", ("1", "1"), ("0.4", "2.1"), "2023-08-21 19:00:00"),
            match(3, "Real Betis", "Barcelona", ("2", "1"), ("0.5", "2.0"), "2023-09-01 19:00:00"),
            match(4, "Getafe", "Barcelona", (None, None), ("0.1", "0.2"), "2023-09-09 19:00:00")),
        "understat_players": frame(
            PLAYERS,
            player(7, "Ana", "Getafe,Barcelona", 8, "4.0", 900), player(8, "Bo", "Real Betis", 2, "3.0", 450),
            player(9, "Cy", "Getafe, ,Getafe ", 1, "0", 449), player(7, "Ana", "Metz", 1, "0.5", 90, league="ligue_1"),
            player(10, "Di", None, 0, "0.0", 800)),
        "understat_teams": frame(
            TEAMS, team("Barcelona", 6, 9, 4, 5.25), team("Getafe", 6, 9, 4, 7.0), team("Real Betis", 7, 5, 4, 6.0),
            team("Metz", 1, 1, 4, 2.0, league="ligue_1")),
        "sb_matches": frame(
            SB_MATCHES, sb(501, "FC Barcelona", "Getafe CF", (3, 0), "2023-08-20"), sb(502, "FC Barcelona", "Getafe", (3, 0), "2023-08-20"),
            sb(503, "Barcelona", "Sevilla", (2, 2), "2015-06-30"), sb(504, "Sevilla", "Barcelona", (0, 4), "2015-07-01"),
            sb(505, "Barcelona", "Sevilla", (1, None), "2015-08-01"), sb(506, "Barcelona", "Elche", (5, 0), "2015-09-01", status="scheduled"),
            sb(507, "Elche", "Sevilla", (5, 0), "2015-09-01")),
        "sb_competitions": frame(
            SB_COMPETITIONS, (11, 1, "Spain", "La Liga", T1), (11, 2, "Spain", "La Liga", T1), (7, 1, "France", "Ligue 1", T1),
            (16, 1, "Europe", "Champions League", T1), (49, 1, "United States", "Women", T1)),
    }


@pytest.fixture(scope="module")
def wh(spark, stage, tmp_path_factory):
    w = Warehouse(spark, str(tmp_path_factory.mktemp("warehouse")))
    w.added = w.load_raw_vault(stage)
    w.build_business_vault()
    w.counts = w.build_marts(stage)
    return w


def test_first_load_counts(wh):
    assert wh.added == {
        "hub_team": 4, "hub_player": 4, "hub_match": 11, "hub_competition": 3, "hub_season": 1,
        "lnk_match_team": 8, "lnk_team_competition_season": 4, "lnk_player_team": 5,
        "lnk_match_competition_season": 4, "lnk_match_same_as": 1,
        "sat_match_score": 7, "sat_match_score_understat": 4, "sat_match_xg": 4, "sat_player_xg": 5,
        "sat_team_details": 4, "sat_team_xg": 4}


def test_league_table(wh, rows):
    table = wh.table("marts", "mart_league_table")
    assert rows(table.filter("league_id = 'la_liga'"), "position", "team_title", "pts", "gd", "pts_overperf") == [
        (1, "Real Betis", 7, 1, 1), (2, "Barcelona", 6, 5, pytest.approx(0.75)), (3, "Getafe", 6, 5, -1)]
    top = D.league_table_top(table, "la_liga", 2023, 1).collect()
    assert [(r.team_title, r.position) for r in top] == [("Real Betis", 1)]


def test_top_scorers(wh, rows):
    got = {(r.player_name, r.league_id): r for r in wh.table("marts", "mart_top_scorers").collect()}
    ana = got["Ana", "la_liga"]
    assert (ana.teams_concat, ana.teams_count, float(ana.goals_per_xg)) == ("Barcelona → Getafe", 2, 2.0)
    assert (got["Ana", "ligue_1"].teams_concat, got["Cy", "la_liga"].teams_concat) == ("Metz", "Getafe")
    di = got["Di", "la_liga"]
    assert (di.teams_concat, di.teams_count, di.goals_per_xg) == ("Di", 1, None)
    assert got["Cy", "la_liga"].goals_per_xg is None


def test_overperformers(wh, rows):
    got = rows(wh.table("marts", "mart_player_overperformers"), "player_name", "overperf_pct_rank", "goals_minus_xg")
    assert [(n, float(p), float(g)) for n, p, g in got] == [("Ana", 1.0, 4.0), ("Bo", 0.0, -1.0), ("Di", 0.5, 0.0)]


def test_match_facts_and_upsets(wh, rows):
    facts = wh.table("marts", "mart_match_facts")
    assert rows(facts, "home_team_title", "result", "goal_diff") == [
        ("Barcelona", "home", 3), ("Getafe", "draw", 0), ("Getafe", "draw", None), ("Real Betis", "home", 1)]
    assert [r.home_team_title for r in D.upsets(facts).collect()] == ["Real Betis"]
    weeks = [(str(r.week), float(r.avg_total_xg), r.matches) for r in D.weekly_total_xg(facts, "la_liga", 2023).collect()]
    assert weeks[:2] == [("2023-08-14", 1.75, 1), ("2023-08-21", 2.5, 1)]


def test_xg_trend(wh):
    got = {r.team_title: r for r in wh.table("marts", "mart_team_xg_trend").collect()}
    barca, betis = got["Barcelona"], got["Real Betis"]
    assert (barca.matches, float(barca.max_xg_for), barca.total_gf, float(barca.gf_minus_xg)) == (3, 2.0, 4, pytest.approx(0.3))
    assert float(barca.avg_xg_for) == pytest.approx(1.233) and float(betis.std_xg_for) == pytest.approx(1.131)


def test_focus_team_history(wh):
    got = [tuple(r) for r in wh.table("marts", "mart_sb_la_liga_history").orderBy("season_year").collect()]
    assert got == [(2014, 1, 0, 1, 0, 2, 2, 2.0, 2.0), (2015, 1, 1, 0, 0, 4, 0, 4.0, 0.0)]


def test_elo_marts(wh, rows):
    current = wh.table("marts", "mart_team_elo_current")
    assert rows(current, "team_title", "matches_played") == [("Barcelona", 2), ("Getafe", 2), ("Real Betis", 2)]
    history = wh.table("marts", "mart_team_elo_history")
    assert history.count() == 6 and history.filter("is_top3_in_league = 1").count() == 6
    assert wh.counts["elo_history"] == 6


def test_checks_find_nothing(wh):
    result = wh.check().collect()
    assert len(result) == sum(len(c) for c in checks.ALL.values()) == 166
    assert [(r.table_name, r.check_name, r.target) for r in result if r.failures] == []


def test_publish_holds_to_the_contract(wh, rows):
    """The match without a score breaks the contract of match facts."""
    with pytest.raises(ValueError, match="mart_match_facts"):
        wh.publish()
    path = wh.path("serving", "mart_league_table")
    assert wh.spark.read.parquet(path).columns == list(contracts.CONTRACTS["mart_league_table"].columns)


def test_second_load_adds_only_changes(spark, stage, frame, rows, tmp_path):
    w = Warehouse(spark, str(tmp_path))
    w.load_raw_vault(stage)
    assert set(w.load_raw_vault(stage).values()) == {0}
    later = dict(stage)
    later["understat_matches"] = frame(
        MATCHES, match(4, "Getafe", "Barcelona", ("0", "2"), ("0.1", "0.2"), "2023-09-09 19:00:00", when=T2),
        match(5, "Barcelona", "Metz", ("1", "0"), ("1.0", "0.0"), "2023-10-01 19:00:00", when=T2))
    added = w.load_raw_vault(later)
    assert {n: c for n, c in added.items() if c} == {
        "hub_match": 1, "lnk_match_team": 2, "lnk_match_competition_season": 1, "sat_match_xg": 2,
        "sat_match_score_understat": 2}
    from pitchvault.plans.marts import mart_match_facts

    facts = mart_match_facts(w.vault()["sat_match_xg"])
    assert facts.count() == 5
    assert rows(facts.filter("away_team_title = 'Barcelona' and home_team_title = 'Getafe'"), "result") == [("away",)]


def test_daily_ratings_equal_one_fold(spark, stage, rows, tmp_path):
    from datetime import date

    w = Warehouse(spark, str(tmp_path))
    w.load_raw_vault(stage)
    w.build_business_vault()
    w.build_marts(stage)
    cols = ("team_title", "league_id", "match_date", "rating_before", "rating_after")
    whole = rows(w.table("marts", "mart_team_elo_history"), *cols)
    w.build_marts(stage, rate_from=date(2023, 8, 20))
    assert rows(w.table("marts", "mart_team_elo_history"), *cols) == whole
    w.build_marts(stage, correct=True)
    assert rows(w.table("marts", "mart_team_elo_history"), *cols) == whole


def test_stage_load_writes_and_replaces(spark, tmp_path, rows):
    import json

    def day(dt, *items):
        folder = tmp_path / f"lake/source=understat/endpoint=teams/league_id=epl/season=2024/dt={dt}"
        folder.mkdir(parents=True)
        (folder / "teams.json").write_text(json.dumps([{"Team": n, "M": m} for n, m in items]))

    w = Warehouse(spark, str(tmp_path / "wh"))
    day("2024-01-01", ("A", "1"), ("B", "10"), ("B", "9"))
    counts = w.load_stage(str(tmp_path / "lake"), "2024-01-01")
    assert counts == {"understat_matches": 0, "understat_players": 0, "understat_teams": 2, "sb_competitions": 0, "sb_matches": 0}
    # The last item of a batch wins, also where it is smaller as text.
    assert rows(w.stage()["understat_teams"], "team_title", "raw_payload.M") == [("A", "1"), ("B", "9")]
    day("2024-01-02", ("B", "11"), ("C", "1"))
    w.load_stage(str(tmp_path / "lake"), "2024-01-02")
    assert rows(w.stage()["understat_teams"], "team_title", "raw_payload.M") == [("A", "1"), ("B", "11"), ("C", "1")]
