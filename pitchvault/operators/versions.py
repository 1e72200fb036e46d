"""Latest row per key, and ordered numbering that splits large groups."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def latest(df: DataFrame, keys: Sequence[str], order_by: Sequence[Column]) -> DataFrame:
    """First row per key in ``order_by`` order.

    ``row_number() = 1`` is planned as a group limit on both sides of the shuffle:
    each task sends one row per key, so a key with many versions does not pile up.
    """
    w = W.partitionBy(*keys).orderBy(*order_by)
    return df.withColumn("__rn", F.row_number().over(w)).filter("__rn = 1").drop("__rn")


def top_n(df: DataFrame, keys: Sequence[str], order_by: Sequence[Column], n: int) -> DataFrame:
    """First ``n`` rows per key; pruned before the shuffle like ``latest``."""
    w = W.partitionBy(*keys).orderBy(*order_by)
    return df.withColumn("__rn", F.row_number().over(w)).filter(F.col("__rn") <= n).drop("__rn")


def coarse(c: Column | str, steps: int = 16) -> Column:
    """Order-keeping image of a number with few distinct values (log scale, ``steps`` per octave).

    Any set of numbers maps to at most some thousand values, so it can split a group for
    ``prefix_sum``. Infinite values and NaN, which sorts above all others, have steps of
    their own.
    """
    v = (F.col(c) if isinstance(c, str) else c).cast("double")
    step = F.signum(v) * F.floor(F.log2(F.abs(v) + 1) * steps)
    top = steps << 12
    return (
        F.when(F.isnan(v), 2 * top).when(F.abs(v) == float("inf"), F.signum(v) * top).otherwise(step).cast("long")
    )


def prefix_sum(
    df: DataFrame,
    group: Sequence[str],
    order_by: Sequence[Column],
    split: Sequence[tuple[Column, str]],
    value: Column | None = None,
    out: str = "prefix",
    total: str | None = None,
) -> DataFrame:
    """Sum of ``value`` (default: row count) over the rows before this one in its group.

    A plain running window would sort a whole group in one task. Here ``split`` cuts each
    group into consecutive runs: ``(expression, "asc"|"desc")`` pairs whose order agrees
    with ``order_by``. Runs are windowed apart from each other; the run totals come from a
    partial aggregate and give each run its offset. ``total`` adds the group's sum.

    NULLs of a split expression go last for "asc" and first for "desc".
    """
    value = F.lit(1).cast("long") if value is None else value
    # One struct holds group and run: equal structs join even where a field is NULL.
    run = F.struct(
        F.struct(*group).alias("g"), *[e.alias(f"s{i}") for i, (e, _) in enumerate(split)]
    )
    tagged = df.withColumn("__run", run).withColumn("__v", value)

    run_order = [
        F.col(f"__run.s{i}").desc_nulls_first() if d == "desc" else F.col(f"__run.s{i}").asc_nulls_last()
        for i, (_, d) in enumerate(split)
    ]
    in_group = W.partitionBy("__run.g")
    before = in_group.orderBy(*run_order).rowsBetween(W.unboundedPreceding, -1)
    offset_cols = {"__offset": F.coalesce(F.sum("__n").over(before), F.lit(0))}
    if total is not None:
        offset_cols[total] = F.sum("__n").over(in_group)
    offsets = tagged.groupBy("__run").agg(F.sum("__v").alias("__n")).withColumns(offset_cols).drop("__n")

    in_run = W.partitionBy("__run").orderBy(*order_by).rowsBetween(W.unboundedPreceding, -1)
    local = tagged.withColumn("__local", F.coalesce(F.sum("__v").over(in_run), F.lit(0)))
    return local.join(offsets, "__run").withColumn(out, F.col("__offset") + F.col("__local")).select(
        *df.columns, out, *([total] if total is not None else [])
    )


def split_row_number(
    df: DataFrame,
    group: Sequence[str],
    order_by: Sequence[Column],
    split: Sequence[tuple[Column, str]],
    out: str,
) -> DataFrame:
    """``row_number`` within ``group`` that cuts a large group into runs (see ``prefix_sum``)."""
    return prefix_sum(df, group, order_by, split, out="__before").withColumn(
        out, F.col("__before") + 1
    ).drop("__before")


def percent_ranks(df: DataFrame, group: Sequence[str], key: Column) -> DataFrame:
    """``percent_rank`` of every distinct ``key`` of a group, as ``__key`` and ``__share``; NULL keys are last.

    Equal keys collapse before any shuffle, however many rows hold them.
    """
    keyed = df.select(_rank_key(group, key))
    counts = keyed.groupBy("__key").agg(F.count(F.lit(1)).alias("__n")).select("__key", "__key.g", "__n")
    k = F.col("__key.k")
    ranks = prefix_sum(
        counts, ["g"], [k.asc_nulls_last()], [(coarse(k), "asc")],
        value=F.col("__n"), out="__less", total="__total",
    )
    share = F.when(F.col("__total") == 1, F.lit(0.0)).otherwise(
        F.col("__less") / (F.col("__total") - 1)
    )
    return ranks.select("__key", share.alias("__share"))


def _rank_key(group: Sequence[str], key: Column) -> Column:
    return F.struct(F.struct(*group).alias("g"), key.alias("k")).alias("__key")


def split_percent_rank(df: DataFrame, group: Sequence[str], key: Column, out: str, ranks: DataFrame | None = None) -> DataFrame:
    """``percent_rank`` within ``group``, ascending by ``key``, NULL keys last.

    Ties share a rank, so the rank is worked out on the distinct keys and joined back. ``ranks`` gives the
    ``percent_ranks`` as a table: where its size is known to be small, it is sent to the rows, which are then not shuffled.
    """
    ranks = percent_ranks(df, group, key) if ranks is None else ranks
    return df.withColumn("__key", _rank_key(group, key)).join(ranks, "__key").withColumn(out, F.col("__share")).select(*df.columns, out)
