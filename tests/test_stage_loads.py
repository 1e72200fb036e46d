import json
from datetime import date, datetime

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from pitchvault.operators.load import full_refresh
from pitchvault.plans import stage_loads as SL
from pitchvault.plans import stage_models as SM



def now():
    return F.lit("2024-03-01 00:00:00").cast("timestamp_ntz")


DT = "2024-03-01"


def put(root, name, items, **levels):
    folder = root
    for k, v in levels.items():
        folder = folder / f"{k}={v}"
    folder.mkdir(parents=True, exist_ok=True)
    (folder / f"{name}.json").write_text(json.dumps(items))


def player(i, xg, league=None):
    return {"id": str(i), "player_name": f"P{i}", "team_title": "A,B", "xG": xg, "goals": "3", "time": "900", "extra": 1}


def test_players_upsert(spark, rows, tmp_path):
    a = {"source": "understat", "endpoint": "players"}
    put(tmp_path, "players", [player(1, "1.50"), player(2, "2.0")], **a, league_id="epl", season=2024, dt=DT)
    put(tmp_path, "players", [player(1, "9.0")], **a, league_id="mls", season=2024, dt=DT)
    put(tmp_path, "players", [player(1, "8.0")], **a, league_id="epl", season=2023, dt=DT)
    first = SL.load_source_a(spark, str(tmp_path), "players", DT, 2024, loaded_at=now())
    assert rows(first, "player_id", "league_id", "season", "raw_payload.xG") == [("1", "epl", 2024, "1.50"), ("2", "epl", 2024, "2.0")]
    put(tmp_path, "players", [player(2, "4.0")], **a, league_id="epl", season=2024, dt="2024-03-02")
    second = SL.load_source_a(spark, str(tmp_path), "players", "2024-03-02", 2024, first, loaded_at=now())
    assert rows(second, "player_id", "raw_payload.xG", "dt") == [
        ("1", "1.50", date(2024, 3, 1)), ("2", "4.0", date(2024, 3, 2))]
    staged = SM.stg_understat_players(second)
    assert [(r.player_bk, float(r.xg), r.goals, r.minutes) for r in staged.orderBy("player_bk").collect()] == [
        ("understat|1", 1.5, 3, 900), ("understat|2", 4.0, 3, 900)]
    missing = SL.load_source_a(spark, str(tmp_path), "players", "2024-03-09", 2024, second, loaded_at=now())
    assert missing.count() == 2


def test_matches_need_a_result(spark, rows, tmp_path):
    done = {"id": "5", "isResult": True, "h": {"id": "1", "title": "A"}, "a": {"id": "2", "title": "B"},
            "goals": {"h": "1", "a": "0"}, "xG": {"h": "1.2", "a": "0.3"}, "datetime": "2024-02-01 20:00:00"}
    put(tmp_path, "matches", [done, {**done, "id": "6", "isResult": False}, {**done, "id": "7", "isResult": None}],
        source="understat", endpoint="matches", league_id="epl", season=2024, dt=DT)
    table = SL.load_source_a(spark, str(tmp_path), "matches", DT, 2024, loaded_at=now())
    staged = SM.stg_understat_matches(table)
    assert rows(staged, "match_bk", "home_team_title", "home_goals", "match_datetime") == [
        ("understat|5", "A", 1, datetime(2024, 2, 1, 20))]


def competition(cid, sid, country, name):
    return {"competition_id": cid, "season_id": sid, "country_name": country, "competition_name": name, "gender": "x"}


def test_second_source(spark, rows, tmp_path):
    root, b = str(tmp_path), {"source": "statsbomb"}
    put(tmp_path, "competitions", [
        competition(11, 90, "Spain", "La Liga"), competition(11, 91, "Spain", "La Liga"), competition(12, 90, "Spain", "La Liga"),
        competition(49, 90, "Spain", "Women"), competition(13, None, "Spain", "La Liga")], **b, endpoint="competitions", dt=DT)
    item = {"match_id": 1, "match_date": "2015-08-23", "home_team": "X", "away_team": "Y", "home_score": 2, "away_score": 1,
            "match_status": "available", "referee": float("nan")}
    m = {**b, "endpoint": "matches"}
    put(tmp_path, "matches", [item, {**item, "match_id": 2, "home_score": float("nan")}], **m, league_id="la_liga", season=90, dt=DT)
    put(tmp_path, "matches", [{**item, "match_id": 3}], **m, league_id="la_liga", season=77, dt=DT)
    put(tmp_path, "matches", [{**item, "match_id": 4}], **m, league_id="wsl", season=90, dt=DT)
    put(tmp_path, "matches", [{**item, "match_id": 5}], **m, league_id="la_liga", season=90, dt="2024-02-01")

    comps = SL.load_competitions(spark, root, DT, loaded_at=now())
    assert rows(comps, "competition_id", "season_id") == [(11, 90), (11, 91), (12, 90), (13, None)]
    assert rows(SL.season_ids(SL.read_competitions(spark, root, DT), "Spain", "La Liga")) == [(90,), (91,)]
    seen = Observation()
    table = SL.load_matches_b(spark, root, DT, loaded_at=now(), unresolved=seen)
    assert rows(table, "match_id", "competition_id", "season_id", "home_team_id", "raw_payload.home_score") == [
        (1, 12, 90, None, 2.0), (2, 12, 90, None, None), (3, None, 77, None, 2.0)]
    assert seen.get["unresolved"] == 1
    staged = SM.stg_sb_matches(table)
    assert rows(staged, "match_bk", "home_goals", "match_status") == [
        ("sb|1", 2, "available"), ("sb|2", None, "available"), ("sb|3", 2, "available")]
    assert SM.stg_sb_competitions(comps).select("league_id").distinct().count() == 1

    empty = SL.load_competitions(spark, root, "2024-09-09", loaded_at=now())
    assert full_refresh(comps, empty).count() == 0


TRICKY = '{"id": "1", "player_name": "a\\"b: 1.10, NaN ]}{\\\\", "team_title": "A", "xG": 1.10, "xA": 2E0, "npxG": -0.50, "goals": 3, "time": 900, "new field": {"x": [1.00, NaN, "NaN", -Infinity, null, true]}, "é": -7.0}'


def test_whole_items_and_number_texts_are_kept(spark, rows, tmp_path):
    """Unknown fields and the digits of numbers, from an array and from lines, whatever the strings hold."""
    folder = tmp_path / f"source=understat/endpoint=players/league_id=epl/season=2024/dt={DT}"
    folder.mkdir(parents=True)
    plain = '{"id":"2","player_name":"P","team_title":"A","xG":"1.10","goals":3,"time":900}'
    (folder / "players.json").write_text(f"\n[ {TRICKY} ,\n{plain}]\n")
    (folder / "part-0.json").write_text(TRICKY.replace('"1"', '"3"', 1) + "\n\n" + plain.replace('"2"', '"4"', 1) + "\n")
    table = SL.load_source_a(spark, str(tmp_path), "players", DT, loaded_at=now())
    whole = {r["player_id"]: r["raw_item"] for r in table.collect()}
    finite = TRICKY.replace("[1.00, NaN, ", "[1.00, null, ").replace("-Infinity", "null")
    assert whole == {"1": finite, "2": plain, "3": finite.replace('"1"', '"3"', 1), "4": plain.replace('"2"', '"4"', 1)}
    assert json.loads(whole["1"])["new field"] == {"x": [1.0, None, "NaN", None, None, True]}
    told = rows(table, "player_id", "player_name", "raw_payload.xG", "raw_payload.xA", "raw_payload.npxG", "raw_payload.goals")
    name = 'a"b: 1.10, NaN ]}{\\'
    assert told == [("1", name, "1.10", "2E0", "-0.50", "3"), ("2", "P", "1.10", None, None, "3"),
                    ("3", name, "1.10", "2E0", "-0.50", "3"), ("4", "P", "1.10", None, None, "3")]
    # The change marker is made of the texts, so 1.10 and 1.1 differ.
    staged = SM.stg_understat_players(table)
    marks = rows(staged.filter("player_bk IN ('understat|2', 'understat|4')").select("sat_player_xg_hashdiff").distinct())
    marked = []
    for number in ("1.10", "1.1"):
        (folder / "players.json").write_text("[" + plain.replace('"1.10"', number) + "]")
        again = SL.load_source_a(spark, str(tmp_path), "players", DT, loaded_at=now()).filter("player_id = 2")
        marked.append(rows(SM.stg_understat_players(again).select("sat_player_xg_hashdiff")))
    assert marked[0] == marks != marked[1]


@pytest.mark.parametrize("text", ["[{}", "[{} {}]", "[{},]x", "{", "[1, {}]"])
def test_files_that_are_no_json_are_errors(spark, tmp_path, text):
    folder = tmp_path / f"source=understat/endpoint=teams/league_id=epl/season=2024/dt={DT}"
    folder.mkdir(parents=True)
    (folder / "teams.json").write_text(text)
    with pytest.raises(Exception, match="JSON|Expecting|MALFORMED|delimiter|not JSON"):
        SL.load_source_a(spark, str(tmp_path), "teams", DT, loaded_at=now()).collect()


def game(i, home="A", day="2024-02-01"):
    return {"id": str(i), "isResult": True, "h": {"id": "1", "title": home}, "a": {"id": "2", "title": "B"},
            "goals": {"h": "1", "a": "0"}, "xG": {"h": "1.2", "a": "0.3"}, "datetime": f"{day} 20:00:00"}


def test_untouched_partitions_are_neither_read_nor_written(spark, rows, tmp_path):
    lake, path = tmp_path / "lake", tmp_path / "matches"
    a = {"source": "understat", "endpoint": "matches"}

    def load(dt):
        return SL.upsert_source_a(spark, str(lake), "matches", dt, str(path), loaded_at=now())

    def files():
        return {f.relative_to(path): f.stat().st_mtime_ns for f in path.rglob("*.parquet")}

    assert load("2024-01-01") == 0 and spark.read.parquet(str(path)).count() == 0  # no snapshot yet
    for league, season, ids in (("epl", 2023, (1, 2)), ("epl", 2024, (3,)), ("la_liga", 2024, (4,)), ("serie_a", 2024, (5, 6))):
        put(lake, "m", [game(i) for i in ids], **a, league_id=league, season=season, dt="2024-01-02")
    assert load("2024-01-02") == 6
    before = files()
    put(lake, "m", [game(3, "C"), game(7), game(7, "D")], **a, league_id="epl", season=2024, dt="2024-01-03")
    # A match moves to another league; its old one is rewritten, or goes when nothing is left in it.
    put(lake, "m", [game(4, "E"), game(5, "F")], **a, league_id="ligue_1", season=2024, dt="2024-01-03")
    assert load("2024-01-03") == 2 + 2 + 1
    after = files()
    same = {f for f, t in before.items() if after.get(f) == t}
    assert {str(f.parent) for f in same} == {"league_id=epl/season=2023"}
    assert not (path / "league_id=la_liga").exists() or not list((path / "league_id=la_liga").rglob("*.parquet"))
    table = spark.read.parquet(str(path))
    assert rows(table, "match_id", "league_id", "season", "raw_payload.h.title") == [
        ("1", "epl", 2023, "A"), ("2", "epl", 2023, "A"), ("3", "epl", 2024, "C"), ("4", "ligue_1", 2024, "E"),
        ("5", "ligue_1", 2024, "F"), ("6", "serie_a", 2024, "A"), ("7", "epl", 2024, "D")]
    assert load("2024-01-09") == 0 and files() == after

    # Where the partition is part of the key, other partitions' files are not even opened.
    teams, t = tmp_path / "teams", {"source": "understat", "endpoint": "teams"}
    for season in (2023, 2024):
        put(lake, "t", [{"Team": "A", "M": "1"}, {"Team": "B", "M": "1"}], **t, league_id="epl", season=season, dt="2024-01-02")
    assert SL.upsert_source_a(spark, str(lake), "teams", "2024-01-02", str(teams), loaded_at=now()) == 4
    for f in (teams / "league_id=epl/season=2023").glob("*.parquet"):
        f.write_bytes(b"no parquet")
        crc = f.with_name(f".{f.name}.crc")
        crc.unlink(missing_ok=True)
    put(lake, "t", [{"Team": "B", "M": "2"}], **t, league_id="epl", season=2024, dt="2024-01-03")
    assert SL.upsert_source_a(spark, str(lake), "teams", "2024-01-03", str(teams), loaded_at=now()) == 2
    now_ = spark.read.parquet(str(teams / "league_id=epl/season=2024"))
    assert rows(now_, "team_title", "raw_payload.M") == [("A", "1"), ("B", "2")]
