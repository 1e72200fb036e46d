"""Wide-to-long reshaping in a single scan."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pitchvault.functions.payload import split_literal


def unpivot_sides(
    df: DataFrame,
    sides: Mapping[str, Mapping[str, Column | str]],
    keep: Sequence[str] = (),
    role: str | None = None,
    required: Sequence[str] = (),
) -> DataFrame:
    """One output row per input row and side.

    ``sides`` maps a role name to ``{output column: source}``; every side gives the same
    columns. ``required`` names output columns whose NULLs drop the row. The rows are
    built from an inlined array, so the input is read once rather than once per side.
    """
    def entry(name: str, cols: Mapping[str, Column | str]) -> Column:
        parts = [(F.col(c) if isinstance(c, str) else c).alias(o) for o, c in cols.items()]
        if role is not None:
            parts.append(F.lit(name).alias(role))
        return F.struct(*parts)

    rows = F.array(*[entry(name, cols) for name, cols in sides.items()])
    out = df.select(*keep, F.inline(rows))
    return out.dropna(subset=list(required)) if required else out


def explode_delimited(
    df: DataFrame, c: str, out: str, keep: Sequence[str], separator: str = ","
) -> DataFrame:
    """Split a delimited text into distinct trimmed parts; NULL text and blank parts vanish."""
    parts = df.select(*keep, F.explode(split_literal(c, separator)).alias(out))
    return parts.withColumn(out, F.trim(out)).filter(F.col(out) != "").distinct()
