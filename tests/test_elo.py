import math
import random
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from pitchvault.operators import elo as E

SCHEMA = ("match_hk string, league_id string, season_year int, match_date date, home_team_title string, "
          "away_team_title string, home_goals int, away_goals int")


def season(seed, n=300, pools=5):
    rnd = random.Random(seed)
    out = []
    for i in range(n):
        home, away = rnd.sample([f"T{j}" for j in range(8)], 2)
        goals = (rnd.choice([0, 1, 2, 5]), rnd.choice([0, 1, 3]))
        if rnd.random() < 0.05:
            goals = (None, goals[1])
        out.append((f"m{i:04}", f"L{rnd.randrange(pools)}", 2024, date(2024, 1, 1) + timedelta(days=rnd.randrange(60)), home, away, *goals))
    return out


def plain_fold(matches):
    """Independent fold over one ordered list, all pools together."""
    ratings, history = {}, []
    for hk, pool, year, day, home, away, gh, ga in sorted(matches, key=lambda m: (m[3], m[4], m[0])):
        if gh is None or ga is None:
            continue
        rh, ra = ratings.get((pool, home), 1500.0), ratings.get((pool, away), 1500.0)
        chance = 1 / (1 + 10 ** ((ra - rh - 100) / 400))
        score = (gh > ga) + 0.5 * (gh == ga)
        step = 20 * (math.log(abs(gh - ga) + 1) if abs(gh - ga) >= 2 else 1) * (score - chance)
        ratings[pool, home], ratings[pool, away] = rh + step, ra - step
        history += [(pool, home, day, rh, rh + step), (pool, away, day, ra, ra - step)]
    return ratings, history


@pytest.mark.parametrize("batch", [2, 10000])
def test_history_against_a_plain_fold(spark, frame, batch):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(batch))
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    try:
        matches = season(1)
        got = E.elo_history(frame(SCHEMA, *matches)).collect()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "10000")
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    _, history = plain_fold(matches)
    a = sorted((r.league_id, r.team_title, r.match_date, r.rating_before, r.rating_after) for r in got)
    b = sorted(history)
    assert len(a) == len(b)
    for x, y in zip(a, b):
        assert x[:3] == y[:3] and x[3:] == pytest.approx(y[3:], abs=1e-9)


def test_deltas_cancel(frame):
    history = E.elo_history(frame(SCHEMA, *season(2)))
    sums = history.groupBy("league_id", "match_seq").agg(F.sum("rating_delta").alias("s")).collect()
    assert max(abs(r.s) for r in sums) < 1e-9


def test_history_in_pieces(frame):
    """Carrying on from stored ratings gives the history rated in one go."""
    matches = season(3)
    cut = date(2024, 2, 1)
    whole = E.elo_history(frame(SCHEMA, *matches))
    first = E.elo_history(frame(SCHEMA, *[m for m in matches if m[3] < cut]))
    second = E.elo_history(frame(SCHEMA, *[m for m in matches if m[3] >= cut]), ratings=E.ratings_after(first))
    cols = ["league_id", "match_seq", "is_home", "team_title", "match_date", "rating_before", "rating_after"]
    order = lambda df: sorted(tuple(r) for r in df.select(*cols).collect())
    assert order(whole) == sorted(order(first) + order(second))


def test_current_peak_and_top(frame):
    matches = season(4)
    history = E.elo_history(frame(SCHEMA, *matches))
    ratings, lines = plain_fold(matches)
    for r in E.elo_current(history).collect():
        mine = [x for x in lines if x[:2] == (r.league_id, r.team_title)]
        peak = max(x[4] for x in mine)
        assert r.current_rating == pytest.approx(ratings[r.league_id, r.team_title])
        assert r.peak_rating == pytest.approx(peak) and r.matches_played == len(mine)
        assert r.peak_match_date == next(x[2] for x in mine if x[4] == pytest.approx(peak, abs=1e-12))
        assert r.last_match_date == mine[-1][2]
    for pool in {k[0] for k in ratings}:
        best = sorted((v, k[1]) for k, v in ratings.items() if k[0] == pool)[-3:]
        flagged = E.flag_top(history).filter((F.col("league_id") == pool) & (F.col("is_top3_in_league") == 1))
        assert {t for _, t in best} == {r.team_title for r in flagged.select("team_title").distinct().collect()}


def test_equal_peak_takes_the_first_date(frame, rows):
    schema = "team_title string, league_id string, rating_after double, match_seq long, match_date date, is_home int"
    d = [date(2024, 1, i) for i in range(1, 5)]
    history = frame(schema, ("T", "L", 1510.0, 1, d[0], 1), ("T", "L", 1505.0, 2, d[1], 1), ("T", "L", 1510.0, 3, d[2], 0))
    assert rows(E.elo_current(history), "peak_match_date", "current_rating") == [(d[0], 1510.0)]


def test_top_ties_go_to_the_team_seen_first(frame, rows):
    schema = "team_title string, league_id string, rating_after double, match_seq long, match_date date, is_home int"
    d = date(2024, 1, 1)
    history = frame(schema, ("B", "L", 1500.0, 1, d, 1), ("A", "L", 1500.0, 1, d, 0), ("C", "L", 1500.0, 2, d, 1))
    assert rows(E.top_teams(history, 2), "team_title") == [("A",), ("B",)]


def test_formula():
    assert E.expected_home(1500, 1600) == 0.5
    assert [E.margin_factor(n) for n in (0, 1, 2, 5)] == [1.0, 1.0, math.log(3), math.log(6)]


def test_rating_in_pieces_equals_the_whole(frame, tmp_path):
    from pitchvault.operators.elo_pieces import rate_in_pieces

    matches = season(6, n=200, pools=2)
    # A pool in which two pairs of teams never meet the others.
    matches += [(f"x{i}", "L9", 2024, date(2024, 1, 1 + i), *pair, i % 4, 1) for i in range(20) for pair in (("P", "Q"), ("R", "S"))]
    df = frame(SCHEMA, *matches)
    whole = E.elo_history(df)
    pieces = rate_in_pieces(df, [date(2024, 1, 15), date(2024, 2, 10)], str(tmp_path))
    cols = ["league_id", "team_title", "opponent_title", "match_date", "is_home", "goals_for", "rating_before", "rating_after"]
    order = lambda x: sorted(tuple(r) for r in x.select(*cols).collect())
    assert order(whole) == order(pieces)
    final = lambda h: sorted(tuple(r) for r in E.elo_current(h).select("league_id", "team_title", "current_rating", "peak_rating", "peak_match_date").collect())
    assert final(whole) == final(pieces)


def test_connected_teams(frame, tmp_path):
    from pitchvault.operators.elo_pieces import connected_teams

    df = frame("league_id string, home_team_title string, away_team_title string",
               ("L", "e", "d"), ("L", "d", "c"), ("L", "c", "b"), ("L", "b", "a"), ("L", "y", "z"), ("M", "a", "z"))
    got = {(r.league_id, r.team_title): r.grp for r in connected_teams(df, "league_id", str(tmp_path)).collect()}
    assert got == {**{("L", t): "a" for t in "abcde"}, ("L", "y"): "y", ("L", "z"): "y", ("M", "a"): "a", ("M", "z"): "a"}
