"""Boundary sets against sorted lists, and fill-in-middle against a plain restatement."""

import bisect
import hashlib
import random
import re
import sys
from pathlib import Path

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

sys.path.insert(0, str(Path(__file__).resolve().parent))

import brute  # noqa: E402

from pitchvault.llm import fill_in_middle as fim  # noqa: E402
from pitchvault.llm.boundary_set import Array, Bitmap, BoundarySet, Runs  # noqa: E402


def held(values):
    values = sorted(set(values))
    s = BoundarySet(np.array(values, np.int64))
    assert len(s) == len(values) and s.values().tolist() == values
    for k in {0, len(values) // 3, len(values) // 2, len(values) - 1} & set(range(len(values))):
        assert s.select(k) == values[k] and s.rank(values[k]) == k
    for x in [0, 1, 65535, 65536, 70000, 10**6, *values[:3]]:
        assert s.rank(x) == bisect.bisect_left(values, x)
    return s


def test_every_form_of_container():
    r = random.Random(3)
    assert [type(c) for c in held(r.sample(range(65536), 1000)).containers] == [Array]
    assert [type(c) for c in held(r.sample(range(65536), 30000)).containers] == [Bitmap]
    assert [type(c) for c in held(range(100, 50000)).containers] == [Runs]
    mixed = [*r.sample(range(65536), 20000), *range(70000, 120000), 65536 * 5, 65536 * 5 + 7, 65536 * 40 + 65535]
    s = held(mixed)
    assert [type(c) for c in s.containers] == [Bitmap, Runs, Array, Array]
    assert s.nbytes < 2 * len(mixed)
    for k in range(0, len(s), 777):
        assert s.select(k) == sorted(set(mixed))[k]
    held([])
    with pytest.raises(IndexError):
        s.select(len(s))
    with pytest.raises(IndexError):
        s.select(-1)


@settings(max_examples=60, deadline=None)
@given(st.sets(st.integers(0, 200_000), max_size=60), st.lists(st.tuples(st.integers(0, 190_000), st.integers(1, 9000)), max_size=3))
def test_select_and_rank(single, runs):
    values = set(single)
    for a, n in runs:
        values.update(range(a, a + n))
    held(values)


def plain_form(doc_id, text):
    text = text or ""
    d = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(d[8 * i : 8 * i + 8], 16) for i in range(4)]
    t = re.findall(r"[A-Za-z]+|[^A-Za-z]", text)
    a, b = sorted((h[0] % (len(t) + 1), h[1] % (len(t) + 1)))
    p, m, s = "".join(t[:a]), "".join(t[a:b]), "".join(t[b:])
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return doc_id, len(t), "plain", None, None, text
    if h[3] % 100 < 20:
        return doc_id, len(t), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return doc_id, len(t), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


ODD = [
    None, "", " ", "x", "one two", "é", "💥" * 40, "a💥b\u0000c\r\n\n", "<P>", "<S", "<M>a", "< <P <S <M P> S>", "<" * 30, "S>x<P" * 9, "M>M>M>",
    "word " * 30_000, "漢字" * 50_000, "a" * 200_000, "\n" * 70_000 + "ab cd " * 20_000, "mixed é text, naïve Ünïcode <P< S>. ",
]


@pytest.mark.parametrize("slices", [1, 4])
def test_against_a_plain_restatement(spark, slices):
    rows = [(11 * j + i, t) for i, t in enumerate(ODD) for j in range(1, 40 if t is None or len(t) < 1000 else 5)]
    rows += [(None, "null id"), (None, "null id"), (-5, "less than none"), (7, ODD[-1]), (7, ODD[-1])]
    schema = "doc_id long, text string, n string, form int, output string, h1 string, prefix_chars string"
    df = spark.createDataFrame([(d, t, "x", 1, "o", "h", "p") for d, t in rows], schema).repartition(slices)
    expected = [plain_form(d, t) for d, t in rows]
    assert {x[2] for x in expected} == {"plain", "psm", "spm"}
    out = sorted((tuple(r) for r in fim.fill_in_middle(df).collect()), key=repr)
    assert out == sorted(expected, key=repr)
    told = sorted((tuple(r) for r in fim.report(df).collect()), key=repr)
    want = [(*x[:5], brute.sha(x[5]), brute.sha(t or "")) for x, (_, t) in zip(expected, rows, strict=True)]
    assert told == sorted(want, key=repr)


def test_no_rows_and_other_parameters(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert fim.report(none).collect() == []
    df = spark.createDataFrame([(i, "some text here") for i in range(300)], "doc_id long, text string")
    forms = {r["form"] for r in fim.fill_in_middle(df, plain_percent=0, spm_percent=100).collect()}
    assert forms == {"spm"}
    assert {r["form"] for r in fim.fill_in_middle(df, plain_percent=100).collect()} == {"plain"}
    marks = ("[pre]", "[suf]", "[mid]")
    back = fim.fill_in_middle(df, marks=marks).select(fim.restored(fim.F.col("output"), fim.F.col("form"), marks).alias("t"))
    assert {r["t"] for r in back.collect()} == {"some text here"}
    with pytest.raises(ValueError):
        fim.fill_in_middle(df, marks=("aa", "ab", "ac"))
