"""Raw-vault loads: hubs, links and satellites.

Each function returns the rows to append. ``existing`` is the table as it stands, or
``None`` on the first load; running the same load twice adds nothing.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from pitchvault.operators.versions import latest


def with_lineage(df: DataFrame, ldts: Column, rsrc: str) -> DataFrame:
    """Load time and record source columns."""
    return df.withColumns({"ldts": ldts, "rsrc": F.lit(rsrc)})


def _unknown(once: DataFrame, key: str, existing: DataFrame | None, buckets: int | None) -> DataFrame:
    if buckets is None:
        # The rows arrive partitioned by the key, which the anti join uses as it is.
        return once if existing is None else once.join(existing.select(key), key, "left_anti")
    dealt = once.repartition(buckets, key)
    if existing is None:
        return dealt
    # Dealt out like the stored table's buckets, which are then read in place. An anti join
    # would be pushed below the dealing out.
    known = existing.select(key, F.lit(True).alias("__known"))
    return dealt.join(known, key, "left").filter("__known IS NULL").drop("__known")


def load_hub(
    sources: Sequence[DataFrame],
    key: str,
    business_keys: Sequence[str],
    existing: DataFrame | None = None,
    buckets: int | None = None,
    single: bool = False,
) -> DataFrame:
    """One row per hash key over all sources, earliest load first; known keys are left out.

    If ``existing`` is a table in so many ``buckets`` of the key, it is not shuffled, and the
    rows to append come one task per bucket.

    A hub key repeats on most source rows. They collapse in a hash aggregate before the
    shuffle (its only state is a timestamp); what is left per key is one row per spelling
    and record source. ``single`` says that a key is on few rows of a load: these gain nothing by that, and are
    brought together by the key at once, in one shuffle instead of two.
    """
    cols = [key, *business_keys, "ldts", "rsrc"]
    rows = sources[0].select(*cols)
    for s in sources[1:]:
        rows = rows.unionByName(s.select(*cols))
    if single:
        rows = rows.repartition(key)
    spelled = rows.groupBy(key, *business_keys, "rsrc").agg(F.min("ldts").alias("ldts")).select(*cols)
    ties = [F.col(c).asc() for c in business_keys]
    once = latest(spelled, [key], [F.col("ldts").asc(), F.col("rsrc").asc(), *ties])
    return _unknown(once, key, existing, buckets)


def load_link(
    source: DataFrame,
    key: str,
    hub_keys: Sequence[str],
    existing: DataFrame | None = None,
    attrs: Sequence[str] = (),
    buckets: int | None = None,
    together: Sequence[str] = (),
) -> DataFrame:
    """One row per link key with its hub keys and role attributes; known keys are left out.

    Links repeat little, so the earliest row per key is picked in one shuffle. ``buckets``:
    as for hubs. ``together`` names hub keys that are never NULL and by which the source is dealt out;
    rows of one link key agree in them and are then picked where they are.
    """
    rows = source.select(key, *hub_keys, *attrs, "ldts", "rsrc")
    once = latest(rows, [*together, key], [F.col("ldts").asc(), F.col("rsrc").asc()])
    return _unknown(once, key, existing, buckets)


PART = "key_part"


def key_part(key: str, parts: int) -> Column:
    """Which of so many parts of a satellite table a key's versions are in."""
    return F.pmod(F.hash(key), F.lit(parts)).cast("int")


def load_sat(
    source: DataFrame,
    key: str,
    hashdiff: str,
    payload: Sequence[str],
    existing: DataFrame | None = None,
    context: Sequence[str] = (),
    split: Column | None = None,
    keyed: bool = False,
    parts: int | None = None,
) -> DataFrame:
    """Append a version where the hashdiff differs from the version before it.

    ``context`` names further key columns of a satellite with several active rows per
    parent. Versions of a key are ordered by ``ldts``, those of one time by hashdiff; the
    stored versions of the batch's keys take their places in that order. So a row that
    arrives late is held against the version that was valid before it, rows of one time
    and several hashdiffs are all versions, and what is stored already adds nothing.

    Versions are compared in runs of one key and one ``split`` value (default: the hour of
    ``ldts``; any expression that grows with ``ldts`` will do). The first survivor of each
    run is then held against the end of the run before, so no task ever sorts the whole
    history of a key. Two shuffles in all.

    ``keyed`` says that the source has a primary key that leaves few rows per satellite
    key, like a stage table with one row per key and load. Then one window per key will
    do, in one shuffle.

    With ``parts``, the rows get the column ``key_part`` and the table is kept in folders by it
    (``append_parts``). Which parts the batch touches is found first, at most ``parts``
    numbers, and only the files of those are read.
    """
    if parts is not None:
        source = source.withColumn(PART, key_part(key, parts))
        if existing is not None:
            touched = [r[0] for r in source.select(PART).distinct().collect()]  # at most `parts`
            existing = existing.filter(F.col(PART).isin(touched))
    ident = [key, *context]
    cols = list(dict.fromkeys([key, hashdiff, *context, *payload, "ldts", "rsrc", *([PART] if parts is not None else [])]))
    rows = _with_stored(source.select(*cols), ident, hashdiff, existing)
    others = [F.col(c).asc() for c in cols if c not in (*ident, "ldts", hashdiff)]
    # A stored version comes before its copies in the batch, which are then no change.
    in_order = [F.col("ldts"), F.col(hashdiff), F.col("__new"), *others]

    def differs(before: Column) -> Column:
        return before.isNull() | (before != F.col(hashdiff))

    if keyed:
        per_key = W.partitionBy(*ident).orderBy(*in_order)
        changed = rows.withColumn("__before", F.lag(hashdiff).over(per_key)).filter(differs(F.col("__before")))
        return changed.filter("__new").select(*cols)

    rows = rows.withColumn("__run", F.date_trunc("hour", "ldts") if split is None else split)
    run = W.partitionBy(*ident, "__run").orderBy(*in_order)
    whole_run = run.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    changes = (
        rows.withColumns({
            "__prev": F.lag(hashdiff).over(run),
            "__first": F.row_number().over(run) == 1,
            "__end": F.last(hashdiff).over(whole_run),
        })
        .filter(F.col("__first") | (F.col("__prev") != F.col(hashdiff)))
    )

    # Run heads of a key meet in one group; every other row sits in its own run's group.
    head = F.when(~F.col("__first"), F.col("__run"))
    across = W.partitionBy(*ident, head).orderBy(F.col("__run"), F.col("ldts"))
    return (
        changes.withColumn("__before", F.lag("__end").over(across))
        .filter(~F.col("__first") | differs(F.col("__before")))
        .filter("__new").select(*cols)
    )


def _with_stored(rows: DataFrame, ident: Sequence[str], hashdiff: str, existing: DataFrame | None) -> DataFrame:
    """The batch (``__new``) and the stored versions of its keys."""
    batch = rows.withColumn("__new", F.lit(True))
    if existing is None:
        return batch
    # One struct: keys with a NULL context match too, and AQE may split a hot key's versions,
    # which it could not if the join used the layout of the grouping.
    touched = rows.select(*ident).distinct().select(F.struct(*ident).alias("__key"))
    stored = existing.select(*ident, hashdiff, "ldts", F.struct(*ident).alias("__key")).join(touched, "__key", "left_semi")
    return batch.unionByName(stored.drop("__key").withColumn("__new", F.lit(False)), allowMissingColumns=True)
