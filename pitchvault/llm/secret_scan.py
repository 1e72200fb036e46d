"""Secret scans: a trigram index picks the texts that each rule has to be run on.

A rule's regular expression yields a Boolean query over trigrams that every match must
hold. Documents are indexed block by block (some megabytes of an Arrow batch): the
postings of the trigrams that any query asks for are bitmaps over the block's documents,
queries intersect and unite them, and the expression runs on what is left. A rule without
mandatory trigrams runs on every text. Blocks are independent, so nothing is shuffled.

Null and empty texts have no spans; repeated rows are scanned each for itself; other
columns pass through untouched, whatever their names, but for the one that ``scan`` is told to write.
"""

from __future__ import annotations

import re
import re._parser as sre
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pitchvault.llm.common import LOWER, chunks, free_name, map_batches


@dataclass(frozen=True)
class Rule:
    """``pattern`` with matches kept if ``group`` has at least ``least`` characters."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 1


# From BEGIN to END, with no other BEGIN or END between. Without END, to the end of the key's
# lines: named headers, an empty line, lines of base64 and nothing else, or long runs of it in
# a line. Lines also end in a written-out \n, and may be indented, quoted or commented out.
_KEY = r"[A-Z0-9\x20]*PRIVATE\x20KEY(?:\x20BLOCK)?-----"
_LINE = r"""["',;+]*+[^\S\n]*+(?:\n|(?:\\r)?\\n)(?:[^\S\n]|[>#*|"'])*+"""
_PRIVATE_KEY = (
    rf"-----BEGIN\x20{_KEY}(?:"
    rf"[^-]*+(?:-(?!----(?:BEGIN|END)\x20)[^-]*+)*+-----END\x20{_KEY}"
    rf"|(?:{_LINE}(?:Proc-Type|DEK-Info|Version|Comment|Charset|Hash|MessageID):[^\n\\]*+)*+"
    rf"(?:{_LINE}(?=\n|(?:\\r)?\\n))*+"
    rf"""(?:{_LINE}[A-Za-z0-9+/=]++(?=["',;+]*+[^\S\n]*+(?:\n|\\|\Z))|[^\S\n]*+[A-Za-z0-9+/=]{{32,}}+)*+)"""
)
BASE = (
    Rule("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 20),
    Rule("hex", r"[0-9a-f]{24,}", 0, 24),  # maximal runs; those under 24 would drop out
)
ADDED = (
    Rule("private_key", _PRIVATE_KEY),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("stripe", r"[rs]k_(?:live|test)_[A-Za-z0-9]{16,}"),
    Rule("google", r"AIza[A-Za-z0-9_-]{35}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    Rule("url_login", r"[a-z][a-z0-9+.-]{1,15}://[^\s/:@]*+:[^\s/:@]{3,}+@"),
)
RULES = BASE + ADDED

_MOST = 64  # alternatives of one stretch of an expression; beyond, the stretch is cut


def _stretches(tree: Iterable) -> tuple[list[set[str]], set[str] | None]:
    """(clauses, exact) of a parsed expression, letters folded.

    Every match holds one string of each clause. ``exact`` are all strings that match, if
    they are few.
    """
    clauses: list[set[str]] = []
    run, cut = {""}, False
    for op, arg in tree:
        inner: list[set[str]] = []
        exact: set[str] | None = None
        if op is sre.LITERAL:
            exact = {chr(arg).lower()}
        elif op is sre.AT:
            exact = {""}
        elif op is sre.IN and all(k in (sre.LITERAL, sre.RANGE) for k, _ in arg):
            each = [range(v, v + 1) if k is sre.LITERAL else range(v[0], v[1] + 1) for k, v in arg]
            if sum(map(len, each)) <= 8:
                exact = {chr(c).lower() for r in each for c in r}
        elif op is sre.SUBPATTERN:
            inner, exact = _stretches(arg[3])
        elif op is sre.BRANCH:
            parts = [_stretches(x) for x in arg[1]]
            if all(e is not None for _, e in parts):
                exact = set().union(*(e for _, e in parts))
            elif all(c or e for c, e in parts):
                inner = [set().union(*(e or c[0] for c, e in parts))]
        elif op in (sre.MAX_REPEAT, sre.MIN_REPEAT):
            low, high, body = arg
            if low:
                inner, once = _stretches(body)
                if low == high == 1:
                    exact = once
            elif high == 1 and (once := _stretches(body)[1]) is not None:
                exact = {"", *once}
        if exact is not None and len(run) * len(exact) <= _MOST:
            run = {a + b for a in run for b in exact}
        else:
            clauses.append(run)
            clauses += inner if exact is None else []
            run, cut = (exact or {""}) if exact is not None and len(exact) <= _MOST else {""}, True
    if not cut:
        return [], run
    return [c for c in [*clauses, run] if all(len(s) >= 3 for s in c)], None


def trigram_query(pattern: str) -> list[list[frozenset[bytes]]]:
    """Conjunction of disjunctions of trigram sets (folded to lower case); empty: scan fully."""
    clauses, exact = _stretches(sre.parse(pattern))
    if exact is not None:
        clauses = [exact] if all(len(s) >= 3 for s in exact) else []

    def cut(s: str) -> frozenset[bytes]:
        raw = s.encode()
        return frozenset(raw[i : i + 3] for i in range(len(raw) - 2))

    return [sorted((cut(s) for s in c), key=sorted) for c in clauses]


class Index:
    """Trigram postings of one block and the rules' queries over them."""

    def __init__(self, rules: Sequence[Rule]):
        self.rules = [(r, re.compile(r.pattern, re.ASCII)) for r in rules]
        self.queries = [trigram_query(r.pattern) for r in rules]
        grams = sorted({g for q in self.queries for c in q for alt in c for g in alt})
        self.number = {g: i for i, g in enumerate(grams)}
        self.lookup = np.zeros(1 << 24, np.uint16)  # trigram to 1 + its number
        for g, i in self.number.items():
            self.lookup[g[0] << 16 | g[1] << 8 | g[2]] = i + 1

    def postings(self, text: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Bitmap of the block's rows for each trigram that a query asks for."""
        rows = len(offsets) - 1
        out = np.zeros((len(self.number), rows), bool)
        if len(text) >= 3 and len(self.number):
            low = LOWER[text].astype(np.uint32)
            codes = self.lookup[low[:-2] << 16 | low[1:-1] << 8 | low[2:]]
            at = np.flatnonzero(codes)
            row = np.searchsorted(offsets, at, "right") - 1
            within = at + 3 <= offsets[row + 1]
            out[codes[at[within]] - 1, row[within]] = True
        return out

    def candidates(self, query: list, postings: np.ndarray) -> np.ndarray:
        found = np.ones(postings.shape[1], bool)
        for clause in query:
            any_of = np.zeros_like(found)
            for grams in clause:
                any_of |= postings[[self.number[g] for g in grams]].all(axis=0)
            found &= any_of
        return found

    def spans(self, text: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[str, list[tuple[str, int, int]]]]:
        """Text and (kind, start, end) of each row, in code points, by start and then by rule."""
        postings = self.postings(text, offsets)
        wanted = [self.candidates(q, postings) for q in self.queries]
        raw = text.tobytes()
        for i in range(len(offsets) - 1):
            value = raw[offsets[i] : offsets[i + 1]].decode("utf-8", "replace")
            found = []
            for k, (rule, compiled) in enumerate(self.rules):
                if wanted[k][i]:
                    for m in compiled.finditer(value):
                        if m.end(rule.group) - m.start(rule.group) >= rule.least:
                            found.append((m.start(), k, m.end()))
            yield value, [(self.rules[k][0].kind, s, e) for s, k, e in sorted(found)]


def blot(text: str, spans: Sequence[tuple[str, int, int]], mark: str) -> str:
    """``text`` with every span, overlapping ones as one, replaced by ``mark``."""
    out, done = [], 0
    for _, start, end in spans:
        if start >= done:
            out += [text[done:start], mark]
        done = max(done, end)
    return "".join([*out, text[done:]])


SPAN = T.ArrayType(T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))


def scan(docs: DataFrame, rules: Sequence[Rule] = RULES, text: str = "text", out: str = "spans", mark: str | None = None) -> DataFrame:
    """``docs`` with the array ``out`` of (kind, start, end); an older column of that name goes.

    With ``mark``, secrets in ``text`` are replaced by it.
    """
    kept = docs.drop(out)
    bytes_ = free_name(docs, "raw")
    ask = kept.withColumn(bytes_, F.expr(f"CAST(coalesce(`{text}`, '') AS BINARY)"))
    schema = T.StructType([*kept.schema.fields, T.StructField(out, SPAN)])
    arrow_span = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
    names = kept.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = Index(rules)
        for batch in batches:
            for first, raw, offsets in chunks(batch, bytes_):
                part = batch.slice(first, len(offsets) - 1)
                each = list(index.spans(raw, offsets))
                cols = [part.column(n) for n in names]
                if mark is not None:
                    old = part.column(text)
                    new = [blot(v, s, mark) if s else o for (v, s), o in zip(each, old.to_pylist(), strict=True)]
                    cols[names.index(text)] = pa.array(new, old.type)
                spans = pa.array([[{"kind": k, "start": a, "end": b} for k, a, b in s] for _, s in each], arrow_span)
                yield pa.RecordBatch.from_arrays([*cols, spans], names=[*names, out])

    return map_batches(ask, run, schema)


def report(docs: DataFrame, rules: Sequence[Rule] = RULES, base: Sequence[Rule] = BASE) -> DataFrame:
    """Per document: base counts, a digest of the base spans, and all spans as text."""
    kinds = [r.kind for r in base]

    def listed(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    found = scan(docs.select("doc_id", "text"), rules).drop("text")
    of_base = F.filter("spans", lambda s: s["kind"].isin(kinds))
    counts = [F.expr(f"CAST(size(filter(spans, s -> s.kind = '{k}')) AS BIGINT) AS n_{k}") for k in kinds]
    return found.select("doc_id", *counts, F.sha2(listed(of_base), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans"))
