"""Corrected results: the history equals a new fold, and only reached matches are rated."""

import random
from datetime import date, timedelta

import pytest

from pitchvault.operators.elo import elo_history
from pitchvault.operators.elo_corrections import correct_history

SCHEMA = "match_hk string, league_id string, season_year int, match_date date, home_team_title string, away_team_title string, home_goals int, away_goals int"


def season(r, pool, teams, days, start=date(2024, 8, 1)):
    rows = []
    for d in range(days):
        playing = r.sample(teams, len(teams) // 2 * 2)
        for home, away in zip(playing[::2], playing[1::2], strict=True):
            goals = (None, None) if r.random() < 0.03 else (r.randint(0, 5), r.randint(0, 4))
            rows.append((f"{pool}{len(rows):05d}", pool, 2024, start + timedelta(days=d), home, away, *goals))
    return rows


def told(df):
    return sorted(tuple(r) for r in df.select(
        "league_id", "match_seq", "is_home", "team_title", "opponent_title", "match_date", "season_year", "goals_for", "goals_against",
        "rating_before", "rating_after").collect())


def check(spark, wrong, right):
    old = elo_history(spark.createDataFrame(wrong, SCHEMA))
    new = spark.createDataFrame(right, SCHEMA)
    out, rated = correct_history(old, new)
    got, want = told(out), told(elo_history(new))
    assert [x[:-2] for x in got] == [x[:-2] for x in want]
    assert all(a == pytest.approx(b, abs=1e-9) for x, y in zip(got, want, strict=True) for a, b in zip(x[-2:], y[-2:], strict=True))
    return rated


def test_a_correction_goes_no_further_than_its_teams_meet(spark):
    r = random.Random(1)
    west, east = season(r, "w", [f"w{i}" for i in range(6)], 30), season(r, "e", [f"e{i}" for i in range(6)], 30)
    # Two groups of teams in one league that never meet, and another league.
    right = [(a, "one", *x) for a, _, *x in west + east] + [("z" + a, "two", *x) for a, _, *x in west]
    played_ = [x for x in right if x[6] is not None]
    at = next(i for i, x in enumerate(right) if x[0] == west[60][0] and x[6] is not None)
    wrong = list(right)
    wrong[at] = (*wrong[at][:6], wrong[at][6] + 1, wrong[at][7])
    rated = check(spark, wrong, right)
    after = [x for x in played_ if x[1] == "one" and x[0][0] == "w" and x[3] >= right[at][3]]
    assert 0 < rated <= len(after) < len(played_) / 4
    assert check(spark, right, right) == 0
    # On the last day it reaches one match.
    last = max(i for i, x in enumerate(right) if x[1] == "two" and x[6] is not None)
    wrong = list(right)
    wrong[last] = (*wrong[last][:7], wrong[last][7] + 1)
    assert check(spark, wrong, right) == 1


def test_missing_extra_moved_and_repeated_matches(spark):
    r = random.Random(2)
    right = season(r, "one", [f"t{i}" for i in range(5)], 40) + season(r, "two", ["a", "b"], 10)
    right += [(f"again{i}", *right[20][1:6], i, 0) for i in range(3)]  # the same teams on the same day
    wrong = [x for i, x in enumerate(right) if i not in (3, 50)]  # not known before
    wrong += [("extra1", "one", 2024, date(2024, 8, 20), "t0", "new team", 3, 0), ("extra2", "two", 2024, date(2024, 8, 3), "a", "b", 1, 1)]
    wrong[30] = (*wrong[30][:3], date(2024, 9, 30), *wrong[30][4:])  # played on another day
    wrong[11] = (*wrong[11][:6], None, None)  # the score was not known
    check(spark, wrong, right)
    check(spark, [], right)
    check(spark, right, [])
