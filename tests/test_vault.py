import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from pitchvault.operators.versions import coarse, latest, prefix_sum, split_percent_rank, split_row_number, top_n
from pitchvault.operators.vault import load_hub, load_link, load_sat

DAY = datetime(2024, 1, 1)
SAT = "hk string, hd string, pay int, ldts timestamp_ntz, rsrc string"


def at(days, hours=0):
    return DAY + timedelta(days=days, hours=hours)


def test_hub_takes_the_earliest_of_all_sources(frame, rows):
    a = frame("hk string, bk string, ldts timestamp_ntz, rsrc string",
              ("k1", "x", at(2), "a"), ("k1", "x", at(1), "a"), ("k2", "y", at(3), "a"))
    b = frame("rsrc string, ldts timestamp_ntz, bk string, hk string", ("b", at(1), "x", "k1"), ("b", at(0), "z", "k3"))
    hub = load_hub([a, b], "hk", ["bk"])
    assert rows(hub) == [("k1", "x", at(1), "a"), ("k2", "y", at(3), "a"), ("k3", "z", at(0), "b")]
    assert load_hub([a, b], "hk", ["bk"], existing=hub).count() == 0


def test_hub_spellings_share_one_row(frame, rows):
    df = frame("hk string, bk string, ldts timestamp_ntz, rsrc string",
               ("k", " X", at(1), "a"), ("k", "x", at(1), "a"), ("k", "x", at(2), "a"))
    assert rows(load_hub([df], "hk", ["bk"])) == [("k", " X", at(1), "a")]


def test_link_keeps_one_row_per_key(frame, rows):
    df = frame("lk string, a string, b string, role string, ldts timestamp_ntz, rsrc string",
               ("l1", "a", "b", "home", at(5), "s"), ("l1", "a", "b", "home", at(4), "s"), ("l2", "a", "c", "away", at(1), "s"))
    link = load_link(df, "lk", ["a", "b"], attrs=["role"])
    assert rows(link) == [("l1", "a", "b", "home", at(4), "s"), ("l2", "a", "c", "away", at(1), "s")]
    assert load_link(df, "lk", ["a", "b"], existing=link, attrs=["role"]).count() == 0


def test_satellite_versions(frame, rows):
    """A, A, B, A across days gives three versions."""
    df = frame(SAT, ("k", "A", 1, at(0), "s"), ("k", "A", 2, at(1), "s"), ("k", "B", 3, at(2), "s"),
               ("k", "A", 4, at(3), "s"), ("j", "A", 5, at(3), "s"))
    sat = load_sat(df, "hk", "hd", ["pay"])
    assert rows(sat, "hk", "hd", "pay") == [("j", "A", 5), ("k", "A", 1), ("k", "A", 4), ("k", "B", 3)]
    assert load_sat(df, "hk", "hd", ["pay"], existing=sat).count() == 0


def test_satellite_compares_with_the_stored_version(frame, rows):
    stored = frame(SAT, ("k", "A", 1, at(0), "s"), ("k", "B", 2, at(1), "s"))
    df = frame(SAT, ("k", "A", 1, at(0), "s"), ("k", "B", 9, at(2), "s"), ("k", "C", 3, at(2, 1), "s"), ("n", "B", 4, at(0), "s"))
    assert rows(load_sat(df, "hk", "hd", ["pay"], existing=stored), "hk", "hd", "pay") == [("k", "C", 3), ("n", "B", 4)]


def test_satellite_context_keeps_active_rows_apart(frame, rows):
    df = frame(SAT + ", ctx string", ("k", "A", 1, at(0), "s", "x"), ("k", "B", 1, at(0), "s", "y"),
               ("k", "A", 1, at(1), "s", "x"), ("k", "B", 2, at(1), "s", None), ("k", "B", 3, at(2), "s", None))
    sat = load_sat(df, "hk", "hd", ["pay"], context=["ctx"])
    assert rows(sat, "hd", "ctx", "pay") == [("A", "x", 1), ("B", "y", 1), ("B", None, 2)]
    assert load_sat(df, "hk", "hd", ["pay"], existing=sat, context=["ctx"]).count() == 0


def expected_versions(data, stored=()):
    """Versions by a plain pass over each key's rows in order, stored ones in their places."""
    out, last = [], {}
    for new, row in sorted([(0, r) for r in stored] + [(1, r) for r in data], key=lambda x: (x[1][3], x[1][1], x[0], x[1][2])):
        hk, hd = row[:2]
        if last.get(hk) != hd and new:
            out.append(row)
        last[hk] = hd
    return sorted(out, key=repr)


@pytest.mark.parametrize("seed,keyed", [(1, False), (2, False), (3, True)])
def test_satellite_against_a_plain_pass(frame, rows, seed, keyed):
    rnd = random.Random(seed)
    data = []
    for _ in range(1500):
        hk = "hot" if rnd.random() < 0.4 else f"k{rnd.randrange(20)}"
        data.append((hk, rnd.choice("AB"), rnd.randrange(3), at(rnd.randrange(30), rnd.randrange(24)), "s"))
    cut = at(12)
    early, late = [r for r in data if r[3] < cut], data
    first = load_sat(frame(SAT, *early), "hk", "hd", ["pay"], keyed=keyed)
    assert rows(first) == sorted(
        [(hk, hd, p, t, s) for hk, hd, p, t, s in expected_versions(early)], key=repr)
    again = load_sat(frame(SAT, *late), "hk", "hd", ["pay"], existing=first, keyed=keyed)
    assert rows(again) == expected_versions([r for r in data], expected_versions(early))


@pytest.mark.parametrize("keyed", [False, True])
def test_satellite_takes_late_and_equal_time_rows(frame, rows, keyed):
    """The newer half first, the older half and other versions of stored times second."""
    def load(stored, *new):
        existing = frame(SAT, *stored) if stored else None
        return rows(load_sat(frame(SAT, *new), "hk", "hd", ["pay"], existing=existing, keyed=keyed))

    first = load([], ("k", "h1", 1, at(0), "s"), ("k", "h3", 1, at(2), "s"))
    late = [("k", "h2", 1, at(1), "s"), ("k", "hX", 1, at(2), "s"), ("k", "h1", 2, at(0, 5), "s")]
    added = load(first, *late)
    assert added == sorted(late[:2], key=repr)
    assert load(first + added, *late) == []


def test_satellite_splits_one_day_of_one_key(frame, rows):
    rnd = random.Random(4)
    data = [("hot" if i % 3 == 0 else f"k{i}", rnd.choice("AB"), i, at(1, i % 24), "s") for i in range(1200)]
    assert rows(load_sat(frame(SAT, *data), "hk", "hd", ["pay"])) == expected_versions(data)


def test_satellite_does_not_gather_a_key(frame):
    df = frame(SAT, ("k", "A", 1, at(0), "s"))
    plan = lambda **how: load_sat(df, "hk", "hd", ["pay"], **how)._jdf.queryExecution().executedPlan().toString()
    assert "__run" in plan() and plan().count("Exchange") == 2
    assert plan(keyed=True).count("Exchange") == 1


def test_latest_and_top_n(frame, rows):
    df = frame("k string, v int, t int", ("a", 1, 1), ("a", 2, None), ("a", 3, 3), ("b", 4, 0))
    order = [F.col("t").desc_nulls_first(), F.col("v").asc()]
    assert rows(latest(df, ["k"], order)) == [("a", 2, None), ("b", 4, 0)]
    assert rows(top_n(df, ["k"], order, 2), "v") == [(2,), (3,), (4,)]
    plan = latest(df, ["k"], order)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


NUMBERS = "g string, v double, k int"


def numbers(seed):
    rnd = random.Random(seed)
    pick = lambda: rnd.choice([None, 0.0, float("nan"), float("inf"), float("-inf"), -0.25, 0.25, rnd.uniform(-5, 5), rnd.uniform(-1e6, 1e6), float(rnd.randrange(4))])
    return [(rnd.choice(["hot", "hot", "x", None]), pick(), i) for i in range(800)]


@pytest.mark.parametrize("seed", [1, 2])
def test_split_row_number_against_window(frame, rows, seed):
    from pyspark.sql import Window as W

    df = frame(NUMBERS, *numbers(seed))
    order = [F.col("v").desc_nulls_first(), F.col("k").asc()]
    split = split_row_number(df, ["g"], order, [(coarse("v"), "desc")], "n")
    plain = df.withColumn("n", F.row_number().over(W.partitionBy("g").orderBy(*order)))
    assert repr(rows(split)) == repr(rows(plain))  # NaN is not equal to itself


@pytest.mark.parametrize("seed", [1, 2])
def test_split_percent_rank_against_window(frame, rows, seed):
    from pyspark.sql import Window as W

    df = frame(NUMBERS, *numbers(seed), ("alone", 1.0, -1))
    plain = df.withColumn("r", F.percent_rank().over(W.partitionBy("g").orderBy(F.col("v").asc_nulls_last())))
    assert repr(rows(split_percent_rank(df, ["g"], F.col("v"), "r"))) == repr(rows(plain))


def test_prefix_sum_with_total(frame, rows):
    df = frame("g int, v int, w int", (1, 10, 2), (1, 20, 3), (1, 30, 5), (2, 5, 7))
    out = prefix_sum(df, ["g"], [F.col("v").asc()], [(coarse("v"), "asc")], F.col("w"), "before", "total")
    assert rows(out, "v", "before", "total") == [(10, 0, 10), (20, 2, 10), (30, 5, 10), (5, 0, 7)]
