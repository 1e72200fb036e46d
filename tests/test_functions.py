import hashlib
import math

from pyspark.sql import functions as F

from pitchvault.functions import hashing as H
from pitchvault.functions import payload as P


def md5(text):
    return hashlib.md5(text.encode()).hexdigest()


def test_hash_keys(frame, rows):
    df = frame("id int, name string", (7, " Ñandú "), (None, None))
    out = rows(df.select(
        H.hash_key("id", source="src"), H.hash_key(H.normalise_key("name")),
        H.business_key("src", "id"), H.hashdiff("id", "name")))
    assert (md5("src||7"), md5("ñandú"), "src|7", md5("7|| Ñandú ")) in out
    assert (md5("src||^^"), md5("^^"), None, md5("^^||^^")) in out


def test_link_key_carries_null_and_role(frame, rows):
    df = frame("a string, b string, r string", ("x", "y", "home"), ("x", None, "away"))
    assert rows(df.select(H.link_key("a", "b"), H.link_key("a", "b", role="r"))) == [
        (md5("x||y"), md5("x||y||home")), (None, None)]


def test_utc_text(frame, rows):
    df = frame("t string", ("2015-08-23 18:30:00",)).select(H.utc_text(F.col("t").cast("timestamp")))
    assert rows(df) == [("2015-08-23 18:30:00+00",)]


FIELDS = {"xg": ("xG.h", P.METRIC), "title": ("h.title", "string"), "goals": ("goals", "int")}


def test_extract_reads_text_struct_and_variant(frame, rows):
    text = frame("p string", ('{"xG": {"h": "1.25"}, "h": {"title": "Ä"}, "goals": "3"}',), ('{"goals": null}',))
    struct = text.select(F.from_json("p", "xG struct<h string>, h struct<title string>, goals string").alias("p"))
    variant = text.select(F.parse_json("p").alias("p"))
    expected = None
    for df in (text, struct, variant):
        out = rows(P.extract(df, "p", FIELDS).drop("p"))
        assert expected is None or out == expected
        expected = out
    assert [(None if x is None else float(x), t, g) for x, t, g in expected] == [(1.25, "Ä", 3), (None, None, None)]


def test_extract_rejects_bad_values(frame):
    import pytest

    for bad in ('{"goals": "many"}', "{not json"):
        with pytest.raises(Exception):
            P.extract(frame("p string", (bad,)), "p", {"goals": ("goals", "int")}).collect()


def test_extract_parses_text_once(frame):
    plan = P.extract(frame("p string", ("{}",)), "p", FIELDS)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 1


def test_header_rows(frame, rows):
    df = frame(
        "k int, t array<array<string>>",
        (1, [["b", "a"], ["2", "x"], ["3"]]), (2, [["a"]]), (3, []), (4, None))
    assert rows(P.rows_with_header(df, "t", {"a": "string", "b": "int"})) == [(1, "x", 2), (1, None, 3)]


def test_nan_to_null_at_every_depth(frame):
    df = frame(
        "a double, s struct<x: float, y: array<double>, z: string>, m map<string,double>, i int",
        (math.nan, (math.inf, [1.0, -math.inf, None], "k"), {"a": math.nan, "b": 2.0}, 1),
        (1.5, None, None, None))
    first, second = P.nan_to_null(df).collect()
    assert first.a is None and first.s.x is None and first.s.y == [1.0, None, None] and first.s.z == "k"
    assert first.m == {"a": None, "b": 2.0} and first.i == 1
    assert second.a == 1.5 and second.s is None and second.m is None


def test_split_literal(frame, rows):
    df = frame("t string", ("a.b|c",)).select(P.split_literal("t", "."), P.split_literal("t", "|"))
    assert rows(df) == [(["a", "b|c"], ["a.b", "c"])]
