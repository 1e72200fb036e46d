import itertools
import random
import re
from datetime import date, datetime

from pyspark.sql import Observation
from pyspark.sql import functions as F

from pitchvault.operators import load as L
from pitchvault.operators import quality as Q
from pitchvault.operators.lookup import lookup, map_slug, semi_filter
from pitchvault.operators.matching import same_as
from pitchvault.operators.reshape import explode_delimited, unpivot_sides

PREFIX = "^(afc |fc |cf |ac |as )"
NOW = datetime(2024, 5, 1)


def test_unpivot_sides_drops_missing(frame, rows):
    df = frame("id int, h string, a string", (1, "x", "y"), (2, None, "z"))
    out = unpivot_sides(df, {"home": {"t": "h"}, "away": {"t": "a"}}, ["id"], "role", ["t"])
    assert rows(out) == [(1, "x", "home"), (1, "y", "away"), (2, "z", "away")]


def test_explode_delimited(frame, rows):
    df = frame("id int, t string", (1, "A,B"), (2, "A,,B , A"), (3, None), (4, " "), (1, "B"))
    assert rows(explode_delimited(df, "t", "x", ["id"])) == [(1, "A"), (1, "B"), (2, "A"), (2, "B")]


def strip(x):
    return re.sub(PREFIX, "", x)


def agree(left, right):
    left, right = left.strip().lower(), strip(right.strip().lower())
    return left == right or left == strip(right) or strip(left) == right


def test_same_as_against_all_pairs(frame, rows):
    names = ["FC Barcelona", "Barcelona ", "AC FC Barcelona", "as as Roma", "Roma", "fc as roma", "AFC fc cf X", "cf X", "x", "fc "]
    rnd = random.Random(5)
    days = [date(2024, 1, d) for d in (1, 2)]
    left = [(i, rnd.choice(days), rnd.choice(names), rnd.choice(names)) for i in range(150)] + [(900, days[0], None, "x")]
    right = [(i, rnd.choice(days), rnd.choice(names), rnd.choice(names)) for i in range(150)]
    schema = "d date, home string, away string"
    got = rows(same_as(
        frame("l int, " + schema, *left), frame("r int, " + schema, *right), ["d"], ["home", "away"], PREFIX, ["l"], ["r"]), "l", "r")
    want = [(a[0], b[0]) for a, b in itertools.product(left, right)
            if a[1] == b[1] and a[2] and agree(a[2], b[2]) and agree(a[3], b[3])]
    assert got == sorted(want, key=repr) and len(set(got)) == len(got) > 100


def test_same_as_joins_on_names(frame):
    df = frame("i int, d date, n string", (1, date(2024, 1, 1), "x"))
    out = same_as(df, df.withColumnRenamed("i", "j"), ["d"], ["n"], PREFIX, ["i"], ["j"])
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "__f_n" in plan and "Cross" not in plan


def test_semi_filter(frame, rows):
    df = frame("a string, b string, i int", ("x", "y", 1), ("x", "z", 2), (None, "y", 3))
    ref = frame("a string, b string", ("x", "y"), ("x", "y"), (None, "y"))
    assert rows(semi_filter(df, ref, ["a", "b"]), "i") == [(1,)]


def test_lookup_counts_misses(frame, rows):
    df = frame("a string, b int", ("x", 1), ("x", 2), (None, 1))
    dim = frame("a string, b int, v int, t int", ("x", 1, 10, 1), ("x", 1, 20, 2), (None, 1, 30, 1))
    seen = Observation()
    out = lookup(df, dim, ["a", "b"], "v", [F.col("t").desc()], seen)
    assert rows(out, "a", "b", "v") == [("x", 1, 20), ("x", 2, None), (None, 1, None)]
    assert seen.get["unresolved"] == 2


def test_map_slug(frame, rows):
    df = frame("c string, n string", ("England", "Premier League"), ("Spain", "Premier League"), (None, "x"))
    assert rows(map_slug(df, ["c", "n"], {("England", "Premier League"): "epl"}, "s"), "s") == [("epl",)]


def test_upsert(frame, rows):
    schema = "k int, v string, loaded_at timestamp_ntz"
    old = datetime(2020, 1, 1)
    target = frame(schema, (1, "old", old), (2, "kept", old))
    batch = frame("k int, v string, n int", (1, "first", 1), (1, "last", 2), (3, "new", 1))
    out = L.upsert(target, batch, ["k"], [F.col("n").desc()], F.lit(NOW).cast("timestamp_ntz"))
    assert rows(out) == [(1, "last", NOW), (2, "kept", old), (3, "new", NOW)]
    first = L.upsert(None, batch, ["k"], [F.col("n").desc()], F.lit(NOW).cast("timestamp_ntz"))
    assert rows(first, "k", "v") == [(1, "last"), (3, "new")]


def test_full_refresh_and_flags(frame, rows):
    target = frame("k int, v int", (1, 1))
    assert rows(L.full_refresh(target, frame("v int, k int", (5, 2)))) == [(2, 5)]
    assert L.full_refresh(target, None).count() == 0
    assert rows(L.is_true(frame("k int, f boolean", (1, True), (2, False), (3, None)), "f"), "k") == [(1,)]
    assert L.with_placeholders(target, {"x": "bigint"}).dtypes[-1] == ("x", "bigint")
    assert [r[0] for r in L.distinct_sorted(frame("s int", (3,), (1,), (3,)), "s").collect()] == [1, 3]


def test_checks_return_failing_rows(frame, rows):
    df = frame("k int, v string", (1, "a"), (1, "b"), (2, None), (None, "a"), (None, "c"))
    assert Q.not_null(df, "v").count() == 1
    assert rows(Q.unique(df, "k")) == [(1, 2)]
    assert rows(Q.unique_combination(df, ["k", "v"])) == []
    assert rows(Q.accepted_values(df, "v", ["a", "b"]), "v") == [("c",)]
    assert rows(Q.expression_is_true(df, "k < 2"), "k") == [(2,)]
    parent = frame("p int", (2,), (2,))
    assert rows(Q.relationships(df, "k", parent, "p")) == [(1, 2)]


def test_check_table_counts_and_stores(frame, rows, tmp_path, spark):
    tables = {
        "t": frame("k int, v string", (1, "a"), (1, "b"), (2, None), (None, "c")), "p": frame("p int", (2,))}
    checks = {"t": Q.TableChecks(
        not_null=("k",), unique=("k",), accepted={"v": ("a",)}, expressions=("k < 2",),
        combinations=(("k", "v"),), relationships={"k": ("p", "p")})}
    assert len(checks["t"]) == 6
    assert rows(Q.check_all(checks, tables), "check_name", "failures") == [
        ("accepted_values", 2), ("expression_is_true", 1), ("not_null", 1), ("relationships", 2),
        ("unique", 1), ("unique_combination", 0)]
    stored = Q.store_failures(checks, tables, str(tmp_path))
    assert spark.read.parquet(stored["t.unique.k"]).count() == 1
    assert spark.read.parquet(stored["t.accepted_values.v"]).count() == 2


def test_contract(frame, rows):
    import pytest

    c = Q.Contract({"a": "UInt8", "b": "String?", "d": "Int8?"}, ["a"])
    df = frame("a int, b string, d int", (255, None, -128), (256, "x", 128), (None, "y", None), (-1, "z", 0))
    assert rows(Q.contract_violations(df, c)) == [("a", 1, 2), ("b", 0, 0), ("d", 0, 1)]
    with pytest.raises(ValueError):
        Q.contract_violations(df.select("b", "a", "d"), c)


def test_checks_of_several_tables_share_their_passes(spark, frame, rows):
    """One join for all relationships, one expand per table for all its unique keys."""
    tables = {
        "a": frame("k int, v string, w string", (1, "x", "p"), (1, "x", None), (2, None, "q"), (None, None, "q"), (None, "y", "p")),
        "b": frame("k long, s string", (1, "x"), (9, "x"), (9, "z"), (None, None)),
        "n": frame("id long, name string", (1, "x"), (2, "y"), (2, "y")), "m": frame("name string", ("x",), (None,)),
    }
    checks = {
        "a": Q.TableChecks(unique=("k", "v"), combinations=(("v", "k"), ("w",), ("v", "w")),
                           relationships={"k": ("n", "id"), "v": ("n", "name"), "w": ("m", "name")}),
        "b": Q.TableChecks(unique=("s",), relationships={"k": ("n", "id"), "s": ("m", "name")}),
        "n": Q.TableChecks(combinations=(("id", "name"),)),
    }
    out = Q.check_all(checks, tables)
    assert rows(out) == [
        ("a", "relationships", "k", 0), ("a", "relationships", "v", 0), ("a", "relationships", "w", 4),
        ("a", "unique", "k", 1), ("a", "unique", "v", 1), ("a", "unique_combination", "v,k", 1),
        ("a", "unique_combination", "v,w", 1), ("a", "unique_combination", "w", 2),
        ("b", "relationships", "k", 2), ("b", "relationships", "s", 1), ("b", "unique", "s", 1),
        ("n", "unique_combination", "id,name", 1)]
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join ") == 1 and plan.count("Expand") == 3
    assert rows(Q.orphans(checks, tables)) == [(2, "p", 2), (2, "q", 2), (3, "9", 2), (4, "z", 1)]
    empty = {n: t.limit(0) for n, t in tables.items()}
    assert {r["failures"] for r in Q.check_all(checks, empty).collect()} == {0}
