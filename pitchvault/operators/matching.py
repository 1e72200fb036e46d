"""Matching the same entity across two sources by normalised names."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pitchvault.functions.hashing import normalise_key


def strip_prefix(c: Column, prefix_re: str) -> Column:
    return F.regexp_replace(c, prefix_re, "")


def same_as(
    left: DataFrame,
    right: DataFrame,
    block_on: Sequence[str],
    names: Sequence[str],
    prefix_re: str,
    keep_left: Sequence[str],
    keep_right: Sequence[str],
) -> DataFrame:
    """Pairs that agree on ``block_on`` and, for every name column, on one of its forms.

    ``prefix_re`` is anchored at the start. The right name loses its prefix once; then a
    name pair agrees if the names are equal, or if they are equal after one more prefix
    comes off the right name, or after one comes off the left name.

    Written as an OR this would compare all pairs of a block. Instead every row is laid
    out once per name form and the forms join as plain equalities next to the block
    columns. A bare form is laid out only where a prefix came off, which makes it shorter
    than the plain one, so a name pair agrees in one way at most and no pair repeats.
    """
    def forms(df: DataFrame, side: str, keep: Sequence[str]) -> DataFrame:
        out = df
        for n in names:
            plain = normalise_key(n)
            if side == "r":
                plain = strip_prefix(plain, prefix_re)
            out = out.withColumn(f"__{side}_{n}", plain)
        cols = [*block_on, *[F.col(c).alias(f"__{side}k_{c}") for c in keep]]
        out = out.select(*cols, *[f"__{side}_{n}" for n in names])
        for n in names:
            plain = F.col(f"__{side}_{n}")
            bare = strip_prefix(plain, prefix_re)
            both = F.array(F.lit(False), F.lit(True))
            out = (
                out.withColumn(f"__{side}s_{n}", F.explode(F.when(bare != plain, both).otherwise(F.array(F.lit(False)))))
                .withColumn(f"__f_{n}", F.when(F.col(f"__{side}s_{n}"), bare).otherwise(plain))
            )
        return out

    lf, rf = forms(left, "l", keep_left), forms(right, "r", keep_right)

    joined = lf.join(rf, [*block_on, *[f"__f_{n}" for n in names]])
    one_side_bare = [~(F.col(f"__ls_{n}") & F.col(f"__rs_{n}")) for n in names]
    agreed = joined.filter(reduce(lambda a, b: a & b, one_side_bare))
    return agreed.select(
        *block_on,
        *[F.col(f"__lk_{c}").alias(c) for c in keep_left],
        *[F.col(f"__rk_{c}").alias(c) for c in keep_right],
    )
