"""Lookups against reference lists. Join strategy is left to the planner's size check."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from pitchvault.operators.versions import latest


def semi_filter(df: DataFrame, ref: DataFrame, on: Sequence[str]) -> DataFrame:
    """Rows whose ``on`` tuple is listed in ``ref``."""
    return df.join(ref.select(*on), list(on), "left_semi")


def lookup(
    df: DataFrame,
    dim: DataFrame,
    on: Sequence[str],
    value: str,
    order_by: Sequence[Column],
    unresolved: Observation | None = None,
) -> DataFrame:
    """Add ``value`` from ``dim``; NULL where the key is not listed.

    Dimension rows with a NULL key part are left out; of several rows for one key the
    first in ``order_by`` order counts. ``unresolved`` takes the number of misses as the
    metric ``unresolved`` of whatever action runs the result.

    The join runs on one struct of the keys. Joined on the keys themselves, ``df`` would
    be laid out like the dimension's own grouping and a key on many rows could not be
    split; this way AQE may split it.
    """
    listed = dim.dropna(subset=list(on))
    once = latest(listed, on, order_by).select(F.struct(*on).alias("__key"), value)
    out = df.withColumn("__key", F.struct(*on)).join(once, "__key", "left").drop("__key")
    if unresolved is not None:
        out = out.observe(unresolved, F.count_if(F.col(value).isNull()).alias("unresolved"))
    return out


def map_slug(
    df: DataFrame, on: Sequence[str], mapping: Mapping[tuple, str], out: str
) -> DataFrame:
    """Map value tuples to a slug; rows outside the mapping are dropped."""
    slug = None
    for values, name in mapping.items():
        hit = F.lit(True)
        for c, v in zip(on, values, strict=True):
            hit = hit & (F.col(c) == v)
        slug = F.when(hit, name) if slug is None else slug.when(hit, name)
    return df.withColumn(out, slug).filter(F.col(out).isNotNull())
