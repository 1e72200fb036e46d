"""Toxicity by a classifier chain.

Categories are predicted one after another. Each link is a linear model of the words a
document holds, with the log-odds that all earlier links gave it as further features. In
training a link sees out-of-fold predictions: an earlier link is fitted once per fold on
the other folds, so that what it says about a training row is as uncertain as what it will
say about a new one. The threshold of the last link is chosen on out-of-fold predictions.

The categories are columns of the labels: those of ``EARLIER`` that the table has, in that
order, then ``toxic``. No category is made up from words: splitting the toxic documents by
the words that tell most for toxic made the last link worse out of fold.

The chain is fitted in one task on at most ``SAMPLE`` labelled documents and ``BYTES`` of
their text, in the order of a hash of their ids; both bounds are parameters, and a text that
does not fit leaves its place to the next. If documents are labelled toxic and none of them
is in the sample, that is an error. Everything else covers all rows: every document is judged by its whole text.

Words are runs of letters, in lower case; a word also counts by its beginnings of 3 to 8
letters, so that forms of a word never seen in training are told by their stem. Null, empty and wordless texts are not toxic.
Copies in the sample count once, toxic if at least half of them are labelled so; a doc_id
that repeats in the labels is toxic if one of its labels is, and so for the other labels;
rows where such a label is null take no part in its link, and a column that is neither
numeric nor boolean is no label. A category without both outcomes is a constant; without
toxic labels no document is toxic. Repeated rows are
judged alike. Other columns pass through ``judge`` untouched, whatever their names, but for the
two that it is told to write.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pitchvault.llm.common import map_batches, stored

SAMPLE = 15_000
BYTES = 32 << 20
FOLDS = 3
WORDS = 500  # features that a link may use
PENALTY = 0.12  # of a weight, by the root of the number of rows
STEPS = 200
MIN_DOCS = 3
STEMS = range(3, 9)
#: Label columns that links before the overall one predict, where the table has them.
EARLIER = ("quality",)
OVERALL = "toxic"

_LETTERS = re.compile(r"[^\W\d_]+")


def words_of(text: str) -> set[str]:
    return set(_LETTERS.findall(text.lower()))


class WordSets(Sequence):
    """Word sets of texts, each made when it is asked for: all of them take several times the texts' memory."""

    def __init__(self, texts: Sequence[str]):
        self.texts = texts

    def __len__(self) -> int:
        return len(self.texts)

    def __getitem__(self, i: int) -> set[str]:
        return words_of(self.texts[i])


def features(words: set[str], lengths: Sequence[int] = STEMS) -> set[str]:
    """The words, and their beginnings of the given lengths with a hyphen."""
    return words.union(*({w[:k] + "-" for w in words if len(w) >= k} for k in lengths))


class Known:
    """Finds the features that a model has weights for."""

    def __init__(self, weighed: set[str]):
        self.words = {f for f in weighed if f[-1] != "-"}
        self.stems = {k: found for k in STEMS if (found := {f[:-1] for f in weighed if f[-1] == "-" and len(f) == k + 1})}

    def held(self, words: set[str]) -> set[str]:
        out = self.words & words
        for k, stems in self.stems.items():
            out.update(f + "-" for f in stems & {w[:k] for w in words})
        return out


@dataclass(frozen=True)
class Link:
    """Log-odds of a category: ``bias``, a weight per word and one per earlier link."""

    name: str
    bias: float
    words: Mapping[str, float]
    earlier: tuple[float, ...] = ()

    def odds(self, words: set[str], told: Sequence[float]) -> float:
        held = self.words.keys() & words
        return self.bias + sum(self.words[w] for w in sorted(held)) + sum(a * b for a, b in zip(self.earlier, told, strict=True))


@dataclass(frozen=True)
class Chain:
    links: tuple[Link, ...]
    threshold: float  # log-odds of the last link from which a document is toxic

    def known(self) -> Known:
        return Known({w for link in self.links for w in link.words})

    def odds(self, text: str | None, known: Known | None = None) -> list[float]:
        held = (known or self.known()).held(words_of(text or ""))
        told: list[float] = []
        for link in self.links:
            told.append(float(np.clip(link.odds(held, told), -_SURE, _SURE)))
        return told


_SURE = 12.0  # log-odds beyond which links do not tell documents apart


def _logistic(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -35, 35)))


class Table:
    """Sample rows by the features that enough toxic documents hold, in sparse form."""

    def __init__(self, words: Sequence[set[str]], toxic: np.ndarray):
        counts = Counter(f for w, y in zip(words, toxic, strict=True) if y for f in features(w))
        self.words = sorted(f for f, n in counts.items() if n >= MIN_DOCS)
        number, known = {w: i for i, w in enumerate(self.words)}, Known(set(self.words))
        each = [np.array(sorted(number[f] for f in known.held(w)), np.int32) for w in words]
        self.rows = np.repeat(np.arange(len(words), dtype=np.int32), [len(e) for e in each])
        self.cols = np.concatenate([np.empty(0, np.int32), *each])
        self.n = len(words)

    def fit(self, name: str, y: np.ndarray, dense: np.ndarray, use: np.ndarray) -> tuple[Link, np.ndarray]:
        """Sparse logistic regression on the rows ``use``; the link and its log-odds for all rows.

        Both outcomes weigh the same. Words are screened by their gradient at the constant
        model, then fitted by accelerated proximal gradient steps.
        """
        positive = y[use].sum()
        if not len(use) or positive in (0, len(use)):
            bias = _SURE if positive else -_SURE
            return Link(name, bias, {}, (0.0,) * dense.shape[1]), np.full(self.n, bias)
        weight = np.zeros(self.n)
        weight[use] = np.where(y[use] > 0, 0.5 / positive, 0.5 / (len(use) - positive))
        penalty = PENALTY / np.sqrt(len(use))
        pull = np.bincount(self.cols, (weight * (0.5 - y))[self.rows], len(self.words))
        kept = np.argsort(-np.abs(pull), kind="stable")[:WORDS]
        kept = kept[np.abs(pull[kept]) > penalty]
        place = np.full(len(self.words) + 1, -1, np.int32)
        place[kept] = np.arange(len(kept), dtype=np.int32)
        mine = place[self.cols] >= 0
        k = len(kept)
        x = np.zeros((self.n, k + 1 + dense.shape[1]), np.float32)
        x[self.rows[mine], place[self.cols[mine]]] = 1
        x[:, k] = 1
        x[:, k + 1 :] = dense / _SURE
        mine, aim, pays = x[use], y[use], weight[use]

        v = np.ones(x.shape[1], np.float32)
        for _ in range(20):
            v = (pays * (mine @ (v / np.linalg.norm(v)))).astype(np.float32) @ mine
        step = 1 / (0.3 * np.linalg.norm(v) + 1e-12)
        beta = ahead = np.zeros(x.shape[1])
        shrink = np.concatenate([np.full(k, penalty), [0], np.full(dense.shape[1], penalty / 10)])
        t = 1.0
        for _ in range(STEPS):
            gradient = (pays * (_logistic(mine @ ahead.astype(np.float32)) - aim)).astype(np.float32) @ mine
            moved = ahead - step * gradient
            new = np.sign(moved) * np.maximum(np.abs(moved) - step * shrink, 0)
            t_new = (1 + np.sqrt(1 + 4 * t * t)) / 2
            ahead = new + (t - 1) / t_new * (new - beta)
            done = np.abs(new - beta).max() < 1e-3
            beta, t = new, t_new
            if done:
                break
        words = {self.words[j]: float(b) for j, b in zip(kept, beta[:k], strict=True) if b}
        return Link(name, float(beta[k]), words, tuple(float(b) / _SURE for b in beta[k + 1 :])), x @ beta.astype(np.float32)


def fit_chain(table: Table, labels: Mapping[str, np.ndarray], folds: np.ndarray) -> Chain:
    """The chain over the categories in the order of ``labels``, NaN where unknown; the last one is the overall."""
    dense = np.empty((table.n, 0))
    links, told = [], np.zeros(table.n)
    for name, y in labels.items():
        known = ~np.isnan(y)
        link, _ = table.fit(name, y, dense, np.flatnonzero(known))
        links.append(link)
        told = np.zeros(table.n)
        for fold in range(FOLDS):
            _, odds = table.fit(name, y, dense, np.flatnonzero((folds != fold) & known))
            told[folds == fold] = odds[folds == fold]
        told = np.clip(told, -_SURE, _SURE)
        dense = np.hstack([dense, told[:, None]])
    return Chain(tuple(links), best_cut(told, y))


def best_cut(odds: np.ndarray, y: np.ndarray) -> float:
    """Log-odds with the best F-measure; in the middle of the best gap between rows."""
    if not len(y) or not y.any():
        return _SURE + 1
    order = np.argsort(-odds, kind="stable")
    hits = np.cumsum(y[order])
    score = 2 * hits / (np.arange(1, len(y) + 1) + y.sum())
    values = odds[order]
    score[:-1][values[:-1] == values[1:]] = -1  # rows alike are judged alike
    best = int(np.argmax(score))
    return float((values[best] + values[best + 1]) / 2) if best + 1 < len(y) else float(values[best]) - 1


def earlier_of(labels: DataFrame) -> list[str]:
    """The label columns before ``toxic`` that the table has."""
    numbers = (T.NumericType, T.BooleanType)
    return [f.name for name in EARLIER for f in labels.schema if f.name == name and isinstance(f.dataType, numbers)]


def labelled_sample(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, size: int = BYTES) -> DataFrame:
    """text, label (``y``) and further labels (``others``) of at most ``sample`` labelled documents and ``size`` characters, by hash order.

    Texts of over a 16th of ``size`` come after all others. One that does not fit is passed over,
    and the next looked at, until ``sample`` documents or nearly ``size`` characters are found.
    Of rows with one doc_id the shortest counts.
    """
    others = F.array(*[(F.max(F.col(c).cast("double")) > 0).cast("double") for c in earlier_of(labels)]).cast("array<double>")
    of_doc = (
        labels.filter("doc_id IS NOT NULL AND toxic IS NOT NULL")
        .groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg((F.max("toxic") > 0).cast("int").alias("y"), others.alias("others"))
    )
    texts = docs.select(F.col("doc_id").cast("long"), "text", F.coalesce(F.length("text"), F.lit(0)).cast("long").alias("n"), F.xxhash64("text").alias("hash"))
    one = texts.filter("doc_id IS NOT NULL").groupBy("doc_id").agg(F.min(F.struct("n", "hash")).alias("one")).select("doc_id", "one.*")
    late = (16 * F.col("n") > size).cast("int")
    there = stored(one.join(of_doc, "doc_id").withColumns({"at": F.xxhash64("doc_id"), "late": late}), "labelled")
    picked, room, rest = [], size, there
    order = F.struct("late", "at", "doc_id")
    # A round looks at no more rows than are still wanted. Another one follows only if late texts
    # were passed over.
    while len(picked) < sample and 16 * room > size:
        found = rest.filter(F.col("n") <= room).orderBy(order).limit(sample - len(picked)).collect()
        for r in found:
            if r["n"] <= room:
                picked.append(r)
                room -= r["n"]
            elif 16 * room <= size:
                break
        if not found:
            break
        last = [F.lit(found[-1][c]).cast(there.schema[c].dataType).alias(c) for c in ("late", "at", "doc_id")]
        rest = there.filter(order > F.struct(*last))
    if not any(r["y"] for r in picked) and not there.filter("y > 0").isEmpty():
        raise ValueError("there are documents labelled toxic, but none is in the sample to learn from")
    wanted = docs.sparkSession.createDataFrame([tuple(r) for r in picked], there.schema)
    # At most `sample` rows of numbers.
    rows = texts.join(F.broadcast(wanted.drop("late")), ["doc_id", "n", "hash"])
    return stored(rows.groupBy("doc_id", "at", "y", "others").agg(F.any_value("text").alias("text")).select("at", "y", "others", "text"), "toxicity-sample")


def learn(texts: Sequence[str | None], toxic: Sequence[int], others: Mapping[str, Sequence[float]]) -> Chain:
    """The chain of labelled texts. Copies count once; texts fall into folds by their place in text order."""
    frame = pd.DataFrame({"text": [t or "" for t in texts], OVERALL: np.asarray(toxic, float), **{f"of {k}": np.asarray(v, float) for k, v in others.items()}})
    shares = frame.groupby("text", sort=True).mean()  # of the labels that are known
    labels = {k: np.where(shares[k].isna(), np.nan, shares[k] >= 0.5).astype(float) for k in shares}
    y = labels.pop(OVERALL)
    table = Table(WordSets(list(shares.index)), y)
    given = {k.removeprefix("of "): v for k, v in labels.items()}
    return fit_chain(table, {**given, OVERALL: y}, np.arange(len(y)) % FOLDS)


def train_chain(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, size: int = BYTES) -> Chain:
    others = earlier_of(labels)

    def fit(rows: pd.DataFrame) -> pd.DataFrame:
        chain = learn(rows["text"], rows["y"], {c: [o[i] for o in rows["others"]] for i, c in enumerate(others)})
        out = [(i, k, w) for i, link in enumerate(chain.links) for k, w in [("bias", link.bias), *((f"w{x}", b) for x, b in link.words.items()), *((f"e{j}", b) for j, b in enumerate(link.earlier))]]
        return pd.DataFrame([*out, (-1, "threshold", chain.threshold)], columns=["link", "what", "value"])

    rows = labelled_sample(docs, labels, sample, size).withColumn("all", F.lit(0)).groupBy("all").applyInPandas(fit, "link int, what string, value double").collect()
    names = [*others, OVERALL]
    if not rows:
        return Chain(tuple(Link(n, -_SURE, {}, (0.0,) * i) for i, n in enumerate(names)), _SURE + 1)
    links = []
    for i, name in enumerate(names):
        of = {r["what"]: r["value"] for r in rows if r["link"] == i}
        links.append(Link(name, of["bias"], {k[1:]: b for k, b in of.items() if k[0] == "w"}, tuple(of[f"e{j}"] for j in range(i))))
    return Chain(tuple(links), next(r["value"] for r in rows if r["link"] == -1))


def judge(docs: DataFrame, chain: Chain, scores: str = "toxicity_odds", verdict: str = "is_toxic") -> DataFrame:
    """``docs`` with the log-odds of every category and the verdict; older columns of these names go."""
    kept = docs.drop(scores, verdict)
    names = kept.columns
    schema = T.StructType([*kept.schema.fields, T.StructField(scores, T.ArrayType(T.DoubleType())), T.StructField(verdict, T.BooleanType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = chain.known()
        for batch in batches:
            odds = [chain.odds(t.as_py(), known) for t in batch.column("text")]
            toxic = [o[-1] >= chain.threshold for o in odds]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(odds, pa.list_(pa.float64())), pa.array(toxic, pa.bool_())], names=[*names, scores, verdict])

    return map_batches(kept, run, schema)


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Per document: the probability of every category and ``toxic``."""
    chain = train_chain(docs, labels)
    scored = judge(docs.select("doc_id", "text"), chain)
    told = [F.expr(f"round(1 / (1 + exp(-toxicity_odds[{i}])), 6) AS p_{x.name}") for i, x in enumerate(chain.links)]
    return scored.select("doc_id", *told, F.col("is_toxic").alias("toxic"))
