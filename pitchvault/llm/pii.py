r"""Personal data: patterns propose spans, checksums confirm them, words nearby move the score.

All in Spark SQL. The matches of a pattern and the lengths of the gaps between them (the
text split at the pattern) give every match's place in code points; running sums go over
blocks of 64 lengths, so that a text of many matches stays cheap. Patterns only propose
what could pass; they start where a run of their characters starts, which gives the
leftmost matches without trying each place of a long run.

Kinds with a checksum (Luhn for cards, mod-97 for account numbers, whose length goes by the
country) must pass it. Each span
has a score: the kind's own, plus a bonus if one of its words is near, in the ``NEAR``
characters before it. Kinds beyond the base ones need a score of ``LEAST``; base spans stay.

Null and empty texts have no spans. Repeated rows are searched each for itself. Other
columns do not matter.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

NEAR = 40
LEAST = 0.5
BONUS = 0.3
_BLOCK = 64


@dataclass(frozen=True)
class Kind:
    """A pattern, a condition on a match ``m``, a score, and words that raise it."""

    name: str
    pattern: str
    passes: str = "true"
    score: float = 0.5
    words: str = ""
    needs: str = ""  # a character without which nothing can match
    group: int = 0  # the span, from where the match starts; beyond the match if it is looked ahead at


def _digits(m: str) -> str:
    return f"regexp_replace({m}, '[^0-9]', '')"


def luhn(m: str) -> str:
    """Whether the digits of ``m`` pass Luhn's check."""
    double = "(2 * CAST(d AS INT)) DIV 10 + (2 * CAST(d AS INT)) % 10"
    each = f"transform(split(reverse({_digits(m)}), ''), (d, i) -> CASE WHEN d = '' THEN 0 WHEN i % 2 = 1 THEN {double} ELSE CAST(d AS INT) END)"
    return f"aggregate({each}, 0L, (a, d) -> a + d) % 10 = 0"


def mod97(m: str) -> str:
    """Whether an account number passes the mod-97 check: letters count from 10, first four last."""
    bare = f"replace({m}, ' ', '')"
    moved = f"concat(substr({bare}, 5), substr({bare}, 1, 4))"
    step = "CASE WHEN d = '' THEN a WHEN d < 'A' THEN (a * 10 + CAST(d AS INT)) % 97 ELSE (a * 100 + ascii(d) - 55) % 97 END"
    return f"aggregate(split({moved}, ''), 0, (a, d) -> {step}) = 1"


_PART = "regexp_replace(p, '^0+(?=.)', '')"
BASE = (
    Kind("email", r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", score=0.9, words="mail|contact|write", needs="@"),
    Kind("ip", r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}", f"forall(split(m, '[.]'), p -> length({_PART}) <= 3 AND CAST(left({_PART}, 3) AS INT) <= 255)", 0.6, "ip|host|server|address", "."),
    # Digits with at most one space or hyphen between: the whole chain, of 13 to 19 digits.
    Kind("card", r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){12,18}(?![\x20-]?[0-9])", luhn("m"), 0.8, "card|visa|credit|payment"),
    Kind("phone", r"\+[0-9][\x20().0-9-]+[0-9]", f"length({_digits('m')}) BETWEEN 9 AND 15", 0.5, "phone|call|tel|mobile|fax", "+"),
)
#: Characters of an account number by its country, without spaces.
IBAN = {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH CR HR LI LV",
    22: "BG BH DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ DZ ES MD PK RO SA SE SK TN VG", 25: "AO CV GW LY PT ST",
    26: "IR IS TR", 27: "BI CF CG CM DJ FR GA GR IT KM MC MG MR SM TD", 28: "AL AZ BF BJ BY CI CY DO GQ GT HN HU LB MA ML NE NI PL SN SV TG",
    29: "BR EG PS QA UA", 30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU",
}
_IBAN = "|".join(rf"(?:{c.replace(' ', '|')})[0-9]{{2}}(?:\x20?[A-Z0-9]){{{n - 4}}}" for n, c in IBAN.items())
ADDED = (
    # Only the first four characters are consumed: what fails the check hides no number that starts within it.
    Kind("iban", rf"(?=[A-Z]{{2}}[0-9]{{2}})(?<![A-Za-z0-9])(?=((?:{_IBAN})(?![A-Za-z0-9])))[A-Z]{{2}}[0-9]{{2}}", mod97("m"), 0.7, "iban|account|bank", group=1),
    Kind("ssn", r"(?<![0-9-])(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}(?![0-9-])", "true", 0.3, "ssn|social|security", "-"),
)


def _literal(s: str) -> str:
    return "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _let(name: str, value: str, body: str) -> str:
    """``body`` with ``name`` bound to ``value``, worked out once."""
    return f"element_at(transform(array({value}), {name} -> {body}), 1)"


def _sum(values: str) -> str:
    return f"aggregate({values}, 0L, (a, v) -> a + v)"


def spans_sql(kind: Kind, number: int, text: str = "text", strict: bool = False) -> str:
    """SQL for the array of (kind number, kind, start, end, score) of a text column."""
    pattern = _literal(kind.pattern)
    found = (
        f"named_struct('m', regexp_extract_all({text}, {pattern}, 0),"
        f" 'g', transform(split({text}, {pattern}, -1), s -> CAST(length(s) AS BIGINT)))"
    )
    spans = "x.m"
    if kind.group:
        found = f"{found[:-1]}, 'w', regexp_extract_all({text}, {pattern}, {kind.group}))"
        spans = "x.w"
    lengths = "transform(x.m, (m, i) -> x.g[i] + length(m))"
    blocks = f"transform(sequence(0, size(l) DIV {_BLOCK}), b -> {_sum(f'slice(l, b * {_BLOCK} + 1, {_BLOCK})')})"
    before = f"{_sum(f'slice(s, 1, i DIV {_BLOCK})')} + {_sum(f'slice(l, i DIV {_BLOCK} * {_BLOCK} + 1, i % {_BLOCK})')}"
    place = f"transform({spans}, (m, i) -> named_struct('m', m, 'at', {before} + x.g[i]))"
    kept = f"filter({_let('l', lengths, _let('s', blocks, place))}, e -> {_let('m', 'e.m', kind.passes)})"
    near = f"lower(substr({text}, CAST(greatest(e.at - {NEAR}, 0) AS INT) + 1, CAST(least(e.at, {NEAR}) AS INT)))"
    score = f"{kind.score}D + IF({near} RLIKE {_literal(kind.words)}, {BONUS}D, 0D)" if kind.words else f"{kind.score}D"
    out = f"transform({kept}, e -> named_struct('number', {number}, 'kind', '{kind.name}', 'start', e.at, 'end', e.at + length(e.m), 'score', {score}))"
    whole = _let("x", found, f"IF(size(x.m) = 0, CAST(array() AS {_TYPE}), {out})")
    if strict:
        whole = f"filter({whole}, e -> e.score >= {LEAST}D)"
    return f"IF(contains({text}, '{kind.needs}'), {whole}, CAST(array() AS {_TYPE}))" if kind.needs else whole


_TYPE = "ARRAY<STRUCT<number: INT, kind: STRING, start: BIGINT, end: BIGINT, score: DOUBLE>>"


def find(docs: DataFrame, base: tuple[Kind, ...] = BASE, added: tuple[Kind, ...] = ADDED) -> DataFrame:
    """doc_id and ``spans``: (number, kind, start, end, score) by kind and start."""
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    each = [spans_sql(k, i, strict=k in added) for i, k in enumerate([*base, *added])]
    return texts.select("doc_id", F.expr(f"concat({', '.join(each)})").alias("spans"))


def report(docs: DataFrame) -> DataFrame:
    """Per document: base counts, a digest of the base spans, all spans and their scores as text."""
    found = find(docs)

    def listed(spans: str) -> str:
        return f"array_join(transform({spans}, s -> concat_ws(':', s.kind, s.start, s.end)), ',')"

    counts = [F.expr(f"CAST(size(filter(spans, s -> s.kind = '{k.name}')) AS BIGINT) AS n_{k.name}") for k in BASE]
    return found.select(
        "doc_id", *counts,
        F.expr(f"sha2({listed(f'filter(spans, s -> s.number < {len(BASE)})')}, 256) AS base_sha256"),
        F.expr(f"{listed('spans')} AS spans"),
        F.expr("array_join(transform(spans, s -> CAST(CAST(s.score AS DECIMAL(3,1)) AS STRING)), ',') AS scores"),
    )
