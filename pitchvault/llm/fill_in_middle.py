"""Fill-in-the-middle rearrangement of whole texts, cut between tokens.

A text's tokens are runs of ASCII letters and single other characters. The offsets
between tokens form a ``BoundarySet`` over code points; two selects give both cuts. Where
to cut, and in which form to write, follows from the document's id alone.

Null and empty texts stay plain. Texts that hold one of the marks stay plain, so that the
text can always be rebuilt. A null id draws like an empty one. Repeated rows are cut
alike. Only ``doc_id`` and ``text`` are read; other columns do not matter. One row is
worked on at a time, and rows do not meet: no shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pitchvault.llm.boundary_set import BoundarySet
from pitchvault.llm.common import TEXT, chunks, record, table_of

MARKS = ("<P>", "<S>", "<M>")
LETTER = table_of([*range(65, 91), *range(97, 123)]).astype(bool)

FORM = ["plain", "psm", "spm"]
SCHEMA = pa.schema([
    ("doc_id", pa.int64()), ("n", pa.int64()), ("form", pa.string()), ("prefix_chars", pa.int64()), ("middle_chars", pa.int64()),
    ("output", pa.string()),
])


def token_starts(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per byte: whether a code point begins there, and whether a token does."""
    point = (raw & 0xC0) != 0x80
    letter = LETTER[raw]
    inside = letter.copy()
    inside[1:] &= letter[:-1]
    rows = offsets[:-1]
    inside[rows[rows < len(raw)]] = False
    return point, point & ~inside


def draws(seed: str, doc_id: Column) -> list[Column]:
    """Four 32-bit numbers from the SHA-256 of ``seed:doc_id``."""
    digest = F.sha2(F.concat(F.lit(seed + ":"), F.coalesce(doc_id.cast("string"), F.lit(""))).cast("binary"), 256)
    return [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long") for i in range(4)]


def fill_in_middle(
    docs: DataFrame, seed: str = "1", spm_percent: int = 20, plain_percent: int = 10, marks: Sequence[str] = MARKS,
) -> DataFrame:
    """Per document: n tokens, form (plain, psm or spm), both lengths in code points, and the output.

    ``marks`` go before prefix, suffix and middle. They must start with a character that
    none of them holds again, so that no cut can make one up.
    """
    if any(m[:1] in other[1:] for m in marks for other in marks) or len({m[:1] for m in marks}) != 1 or len(set(marks)) != 3:
        raise ValueError(f"marks that a cut could make up: {marks}")
    pre, suf, mid = (m.encode() for m in marks)
    h = draws(seed, F.col("doc_id"))
    text = F.coalesce(F.col("text"), F.lit(""))
    marked = [F.contains(text, F.lit(m)) for m in marks]
    plain = (text == "") | marked[0] | marked[1] | marked[2] | (h[2] % 100 >= 100 - plain_percent)
    form = F.when(plain, 0).otherwise(F.when(h[3] % 100 < spm_percent, 2).otherwise(1))
    rows = docs.select(
        F.col("doc_id").cast("long"), F.expr(TEXT), h[0].alias("h1"), h[1].alias("h2"), form.cast("int").alias("form"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            one, two, forms = (batch.column(c).to_numpy() for c in ("h1", "h2", "form"))
            for first, raw, offsets in chunks(batch):
                point, token = token_starts(raw, offsets)
                whole = raw.tobytes()
                ns, before, between, outputs = [], [], [], []
                for i in range(len(offsets) - 1):
                    a, b = int(offsets[i]), int(offsets[i + 1])
                    row = first + i
                    points = np.flatnonzero(point[a:b])  # byte offset of every code point
                    cuts = BoundarySet(np.append(np.flatnonzero(token[a:b][points]), len(points)))
                    n = len(cuts) - 1
                    ns.append(n)
                    if not forms[row]:
                        before.append(None)
                        between.append(None)
                        outputs.append(whole[a:b])
                        continue
                    k, m = sorted((int(one[row]) % (n + 1), int(two[row]) % (n + 1)))
                    p, q = cuts.select(k), cuts.select(m)
                    ends = [a + int(points[x]) if x < len(points) else b for x in (p, q)]
                    prefix, middle, suffix = whole[a : ends[0]], whole[ends[0] : ends[1]], whole[ends[1] : b]
                    before.append(p)
                    between.append(q - p)
                    outputs.append(b"".join(
                        (pre, prefix, suf, suffix, mid, middle) if forms[row] == 1 else (suf, suffix, pre, prefix, mid, middle)))
                ids = batch.column("doc_id").slice(first, len(ns))
                names = [FORM[forms[first + i]] for i in range(len(ns))]
                yield record(SCHEMA, ids, ns, names, before, between, outputs)

    return rows.mapInArrow(run, "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string")


def restored(output: Column, form: Column, marks: Sequence[str] = MARKS) -> Column:
    """The text that an output of some form was made from."""
    pre, suf, mid = marks

    def parts(first: str, second: str) -> tuple[Column, Column, Column]:
        body = F.substr(output, F.lit(len(first) + 1))
        one = F.substring_index(body, second, 1)
        rest = F.substr(body, F.length(one) + len(second) + 1)
        two = F.substring_index(rest, mid, 1)
        return one, two, F.substr(rest, F.length(two) + len(mid) + 1)

    prefix, suffix, middle = parts(pre, suf)
    suffix2, prefix2, middle2 = parts(suf, pre)
    return (
        F.when(form == "psm", F.concat(prefix, middle, suffix))
        .when(form == "spm", F.concat(prefix2, middle2, suffix2))
        .otherwise(output)
    )


def report(docs: DataFrame) -> DataFrame:
    """Lengths and digests of every output, and of the text rebuilt from it."""
    return fill_in_middle(docs).select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars",
        F.sha2(F.col("output").cast("binary"), 256).alias("output_sha256"),
        F.sha2(restored(F.col("output"), F.col("form")).cast("binary"), 256).alias("restored_sha256"),
    )
