"""Collocations against a plain restatement, and the graph's parts on their own."""

import random
import re
import sys
from collections import Counter
from pathlib import Path

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

sys.path.insert(0, str(Path(__file__).resolve().parent))

import brute  # noqa: E402

from pitchvault.llm import phrases  # noqa: E402
from pitchvault.llm.blobs import pack, steps, unpack  # noqa: E402


@settings(max_examples=80, deadline=None)
@given(st.lists(st.lists(st.integers(0, 2**64 - 1), max_size=40), max_size=4))
def test_arrays_come_back(arrays):
    back = unpack(pack(*[np.array(a, np.uint64) for a in arrays]))
    assert [b.tolist() for b in back] == arrays
    for a in arrays:
        up = np.sort(np.array(a, np.uint64))
        assert np.cumsum(steps(up), dtype=np.uint64).tolist() == up.tolist()


def mined(rows, least=10, percent=50, top=2000):
    """Rows of (lang, rank, phrase, a, l, r, n, score)."""
    count, size = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", brute.ascii_lower(text or "")):
            w = re.findall(r"[^\x20\x09]+", piece)
            size[lang] += len(w)
            count.update((lang, *w[i : i + k]) for k in (1, 2, 3) for i in range(len(w) - k + 1))
    long = {g: f for g, f in count.items() if len(g) > 2 and f >= least}
    out = []
    for g, a in long.items():
        if any(len(t) > len(g) and (t[0] == g[0] and g[1:] in (t[1:3], t[2:4])) and 100 * f >= percent * a for t, f in long.items()):
            continue
        cuts = []
        for k in range(1, len(g) - 1):
            left, right = count[g[: k + 1]], count[(g[0], *g[k + 1 :])]
            cuts.append((1_000_000 * a * a // (left * right), k, left, right))
        s, _, left, right = min(cuts)
        out.append((g[0], -s, -a, " ".join(g[1:]).encode(), left, right))
    ranked, seen = [], Counter()
    for lang, s, a, phrase, left, right in sorted(out):
        seen[lang] += 1
        if seen[lang] <= top:
            ranked.append((lang, seen[lang], phrase.decode(), -a, left, right, size[lang], -s))
    return ranked


def corpus(seed=4, docs=120):
    r = random.Random(seed)
    plenty = ["the", "of", "a", "é", "in", "漢", "x1", "big", "Red", "dog", "'s", " "]
    fixed = ["once upon a time there was a very old king", "terms and conditions", "ha ha ha ha ha", "new york city", "new york", "The End"]
    rows = []
    for _ in range(docs):
        parts = []
        for _ in range(r.randint(1, 25)):
            parts.append(r.choice(fixed) if r.random() < 0.4 else " ".join(r.choices(plenty, range(12, 0, -1), k=r.randint(1, 9))))
            parts.append(r.choice([" ", ". ", "\n", ", ", "\t", " ; ", "!?", "\r\n", "\x0b", "  "]))
        rows.append((r.choice(["en", "en", "en", "de", None, "und", ""]), "".join(parts)))
    return rows + [("en", None), ("en", ""), (None, " .\n. "), ("fr", "alone"), ("zz", "")] + rows[:20]


def asked(df, **given):
    return sorted(tuple(r) for r in phrases.collocations(df, **given).collect())


@pytest.mark.parametrize(("sent", "met"), [(1_000_000, 1_000_000), (500, 400)])
def test_against_a_plain_restatement(spark, monkeypatch, sent, met):
    monkeypatch.setattr(phrases, "SENT", sent)
    monkeypatch.setattr(phrases, "MET", met)
    rows = corpus()
    df = spark.createDataFrame([(t, lang, 1, "h", 2) for lang, t in rows], "text string, lang string, f int, h1 string, rank int").repartition(5)
    expected = mined(rows)
    assert len(expected) > 100 and len({x[0] for x in expected}) > 3
    assert asked(df) == sorted(expected)
    if sent > 500:
        assert asked(df, top=7) == sorted(mined(rows, top=7))
        assert asked(df, least=3, covered_percent=80) == sorted(mined(rows, 3, 80))


def test_paths_are_compacted(spark):
    """A fixed sentence in other words is one path, whose inner pairs are no candidates."""
    line = " ".join(f"w{i}" for i in range(70))
    rows = [("en", f"a{i % 3} {line} z{i % 2}") for i in range(30)] + [("en", "w3 w4 w9") for _ in range(10)]
    df = spark.createDataFrame(rows, "lang string, text string")
    graph = phrases.phrase_graph(df)
    names = {r["h"]: r["word"] for r in graph.names.collect()}
    nodes = phrases.stored(phrases.with_heaviest_in(graph), "nodes")
    paths = {(" ".join(names[h] for h in r["path"]), r["f"]) for r in phrases.compact_paths(nodes, graph.edges).collect()}
    inner = {(p, f) for p, f in paths if "w20" in p.split()}
    assert inner == {(" ".join(f"w{i}" for i in range(3, 70)), 30)}  # w3 w4 goes on in two ways
    assert ("w3 w4 w9", 10) in paths and ("a0 w0 w1", 10) in paths and (" ".join(f"w{i}" for i in range(5)), 30) in paths
    assert asked(df) == sorted(mined(rows))


def test_long_pieces_and_counts_beyond_64_bits(spark):
    rows = [("en", "tick tock " * 40_000 + "end"), ("en", "x" * 100_000 + " y z ")] * 2
    df = spark.createDataFrame(rows, "lang string, text string")
    assert asked(df) == sorted(mined(rows))
    one = spark.range(1).selectExpr("900000000000L AS a", "1000000000000L AS l", "990000000000L AS r")
    assert one.select(phrases.score("a", "l", "r")).first()[0] == 1_000_000 * 9 * 10**11 * 9 * 10**11 // (10**12 * 99 * 10**10)


def test_no_rows_and_words_with_one_hash(spark, monkeypatch):
    none = spark.createDataFrame([], "lang string, text string")
    assert asked(none) == []
    plain = phrases._hashed
    monkeypatch.setattr(phrases, "_hashed", lambda *a: (*(x := plain(*a))[:2], x[2] % np.uint64(2) + np.uint64(1), x[3]))
    df = spark.createDataFrame([("en", "a b c d e f g h " * 30)], "lang string, text string")
    with pytest.raises(ValueError, match="share a hash"):
        asked(df)
