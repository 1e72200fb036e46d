"""Stage loads: upsert by natural key, full refresh, truth filter, placeholders."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pitchvault.operators.versions import latest


def upsert(
    target: DataFrame | None,
    incoming: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[Column],
    loaded_at: Column | None = None,
) -> DataFrame:
    """Target after the batch: incoming rows replace those of equal key, others stay.

    Within the batch the first row in ``order_by`` order wins. ``loaded_at`` (default:
    the current time) is set on every incoming row, changed or not.
    """
    stamp = F.current_timestamp() if loaded_at is None else loaded_at
    batch = latest(incoming, keys, order_by).withColumn("loaded_at", stamp)
    if target is None:
        return batch
    kept = target.join(batch.select(*keys), list(keys), "left_anti")
    return kept.unionByName(batch.select(*target.columns))


def full_refresh(target: DataFrame, incoming: DataFrame | None) -> DataFrame:
    """Table after truncate-and-load; a missing source leaves it empty."""
    if incoming is None:
        return target.limit(0)
    return incoming.select(*target.columns)


def is_true(df: DataFrame, flag: str) -> DataFrame:
    """Rows whose flag is true; NULL counts as false."""
    return df.filter(F.coalesce(F.col(flag), F.lit(False)))


def with_placeholders(df: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    """Add NULL columns of the given types."""
    return df.withColumns({c: F.lit(None).cast(t) for c, t in columns.items()})


def distinct_sorted(df: DataFrame, c: str) -> DataFrame:
    """Distinct values of one column, ascending."""
    return df.select(c).distinct().orderBy(c)
