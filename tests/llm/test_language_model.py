"""Language-model scores against a plain restatement of counts, learning and scoring."""

import math
import random
import re
import sys
import zlib
from collections import Counter, defaultdict
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))

import brute  # noqa: E402

from pitchvault.llm import language_model as lm  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402


def tokens(text):
    return [*re.findall(r"[^\x20\x09-\x0D]+", brute.ascii_lower(text or "")), None]  # None: the end


class Counts:
    def __init__(self, texts):
        self.one, self.two, self.three = Counter(), Counter(), Counter()
        self.v, self.uv = Counter(), Counter()
        for t in texts:
            for u, v, w in grams(t):
                self.one[w] += 1
                self.two[v, w] += 1
                self.three[u, v, w] += 1
                self.v[v] += 1
                self.uv[u, v] += 1
        self.n, self.types = sum(self.one.values()), len(self.one)

    def at(self, u, v, w):
        c3, c2 = self.uv[u, v], self.v[v]
        return (c3.bit_length(), c2.bit_length(), self.three[u, v, w] / c3 if c3 else 0, self.two[v, w] / c2 if c2 else 0,
                self.one[w] / max(self.n, 1))


def grams(text):
    t = ["<s>", "<s>", *tokens(text)]
    return zip(t, t[1:], t[2:], strict=False)


def filled(seen):
    out = [0.0]
    for i in range(1, lm.OCTAVES):
        out.append(seen.get(i, out[-1] if i > 1 else 0.5))
    return out


def learned(counted, deleted):
    """Nested weights by expectation-maximisation over the words of the deleted texts."""
    events = Counter(counted.at(*g) for t in deleted for g in grams(t))
    a, b, d, before = filled({}), filled({}), 0.5, None
    for _ in range(lm.ROUNDS if events else 0):
        up3, up2, up1, ll = defaultdict(lambda: [1.0, 2.0]), defaultdict(lambda: [1.0, 2.0]), [1.0, 2.0], 0.0
        for (b3, b2, p3, p2, p1), n in events.items():
            x = [a[b3] * p3, (1 - a[b3]) * b[b2] * p2, (1 - a[b3]) * (1 - b[b2]) * d * p1,
                 (1 - a[b3]) * (1 - b[b2]) * (1 - d) / (counted.types + 1)]
            s = sum(x)
            ll += n * math.log(s)
            g = [n * y / s for y in x]
            up3[b3][0] += g[0]
            up3[b3][1] += sum(g)
            up2[b2][0] += g[1]
            up2[b2][1] += sum(g[1:])
            up1[0] += g[2]
            up1[1] += g[2] + g[3]
        a = filled({k: x / y for k, (x, y) in up3.items() if k})
        b = filled({k: x / y for k, (x, y) in up2.items() if k})
        d, ll = up1[0] / up1[1], ll / sum(events.values())
        if before is not None and ll - before < lm.STILL:
            break
        before = ll
    return a, b, d


def scored(rows, kind):
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base, score) per row."""
    counted = Counts(t for d, t in rows if kind(d) == lm.COUNTED)
    every = Counts(t for d, t in rows if kind(d) != lm.HELD_OUT)
    a, b, d = learned(counted, [t for i, t in rows if kind(i) == lm.DELETED])
    out = []
    for doc_id, text in rows:
        base = score = 0.0
        for g in grams(text):
            b3, b2, p3, p2, p1 = every.at(*g)
            base += math.log10((every.one[g[2]] + 1) / (every.n + every.types + 1))
            p = d * p1 + (1 - d) / (every.types + 1)
            score += math.log10(a[b3] * p3 + (1 - a[b3]) * (b[b2] * p2 + (1 - b[b2]) * p))
        t = tokens(text)
        out.append((doc_id, kind(doc_id) == lm.HELD_OUT, len(t), sum(every.one[w] > 0 for w in t), every.n, base, score))
    return out


def kinds(spark, ids, kept):
    """The fold of every id, as the operator deals them."""
    df = spark.createDataFrame([(i,) for i in set(ids)], "id long")
    draw = F.crc32(F.coalesce(F.col("id").cast("string"), F.lit("")).cast("binary"))
    deleted = {r["id"]: r["k"] for r in df.select("id", (F.xxhash64(draw) % kept == 0).alias("k")).collect()}
    out = {}
    for i in set(ids):
        c = zlib.crc32(("" if i is None else str(i)).encode()) % 7
        out[i] = lm.HELD_OUT if c == 2 else lm.DELETED if deleted[i] else lm.COUNTED
    return out.__getitem__


def prose(seed=8, n=220):
    r = random.Random(seed)
    vocabulary = ["The", "cat", "sat", "on", "a", "mat", "é", "漢字", "x", *[f"w{i}" for i in range(300)]]
    rows = []
    for i in range(n):
        w, out = r.choice(vocabulary), []
        for _ in range(r.randint(0, 120)):
            out.append(w)
            w = vocabulary[(vocabulary.index(w) * 7 + r.randint(0, 3)) % len(vocabulary)] if r.random() < 0.7 else r.choice(vocabulary[: 1 + int(r.expovariate(0.05)) % 300])
        rows.append((i, r.choice([" ", "\n", " \t "]).join(out)))
    odd = [(1001, None), (1002, ""), (1003, " \n"), (None, "null id text"), (None, "null id text"), (5, rows[5][1]), (1004, "never-seen-" * 3), (1005, "x" * 90_000 + " end"),
           (1006, "the cat sat " * 20_000)]
    return rows + odd


def check(out, expected):
    got = sorted((tuple(r) for r in out.collect()), key=repr)
    expected = sorted(expected, key=repr)
    assert len(got) == len(expected)
    by = lambda x: (repr(x[0]), x[2:4], round(x[6], 4))
    for g, e in zip(sorted(got, key=by), sorted(expected, key=by), strict=True):
        assert g[:5] == e[:5]
        assert g[5] == pytest.approx(e[5], rel=1e-9, abs=1e-9) and g[6] == pytest.approx(e[6], rel=1e-6, abs=1e-9)


@pytest.mark.parametrize(("chunk", "met", "slices"), [(8 << 20, 2_000_000, 2), (3000, 700, 5)])
def test_against_a_plain_restatement(spark, monkeypatch, chunk, met, slices):
    monkeypatch.setattr(lm, "CHUNK", chunk)
    monkeypatch.setattr(lm, "MET", met)
    rows = prose() if chunk > 3000 else prose(9, 120)[:-1]
    df = spark.createDataFrame([(d, t, "k", 1, "c") for d, t in rows], "doc_id long, text string, kind string, slot int, chunk string").repartition(slices)
    out = lm.report(df)
    assert out.columns == ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
    check(out, scored(rows, kinds(spark, [d for d, _ in rows], lm.KEPT)))
    assert spark.sql("SHOW TABLES").filter("tableName LIKE 'bucketed%'").isEmpty()


def test_held_out_words_become_likelier_and_rounds_never_lose(spark):
    told = []
    plain, lm.learn_weights = lm.learn_weights, lambda *a: told.append(plain(*a)) or told[-1]
    try:
        rows = prose(10, 400)
        out = lm.report(spark.createDataFrame(rows, "doc_id long, text string")).filter("held_out").agg(
            F.sum("score").alias("s"), F.sum("base_score").alias("b")).first()
    finally:
        lm.learn_weights = plain
    assert out["s"] > 0.8 * out["b"]
    likely = told[0][1]
    assert len(likely) > 2 and all(y > x - 1e-4 for x, y in zip(likely, likely[1:], strict=False))
    assert all(0 < x < 1 for x in (*told[0][0].trigram[1:], *told[0][0].bigram[1:], told[0][0].word))


def test_without_rows_or_without_training_texts(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert lm.report(none).collect() == []
    rows = [(1, "a b"), (2, None), (2, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    check(lm.score_texts(df, F.lit(True)), scored(rows, lambda _: lm.HELD_OUT))
    check(lm.score_texts(df, F.lit(False), kept=1), scored(rows, lambda _: lm.DELETED))
