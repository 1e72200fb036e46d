"""Declarative data checks. Each check returns the failing rows."""

from __future__ import annotations

import functools
import logging
import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pitchvault.functions.hashing import key_text, short_key

log = logging.getLogger(__name__)


def not_null(df: DataFrame, c: str) -> DataFrame:
    return df.filter(F.col(c).isNull())


def unique(df: DataFrame, c: str) -> DataFrame:
    """Repeated values with their count; NULLs do not count."""
    return unique_combination(df.filter(F.col(c).isNotNull()), [c])


def unique_combination(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Repeated column tuples with their count."""
    return df.groupBy(*cols).agg(F.count(F.lit(1)).alias("n_rows")).filter("n_rows > 1")


def relationships(df: DataFrame, c: str, parent: DataFrame, parent_col: str) -> DataFrame:
    """Non-NULL values of ``c`` without a parent row, with the number of rows that hold them.

    The child is counted per value first, so a value on many rows shuffles once.
    """
    values = df.filter(F.col(c).isNotNull()).groupBy(c).agg(F.count(F.lit(1)).alias("n_rows"))
    keys = parent.select(F.col(parent_col).alias("__pk"))
    return values.join(keys, F.col(c) == F.col("__pk"), "left_anti")


def accepted_values(df: DataFrame, c: str, values: Sequence) -> DataFrame:
    """Rows with a value outside the list; NULL passes."""
    return df.filter(~F.col(c).isin(list(values)))


def expression_is_true(df: DataFrame, expression: str) -> DataFrame:
    """Rows where the expression is false; NULL passes."""
    return df.filter(~F.expr(expression))


@dataclass(frozen=True)
class TableChecks:
    """Checks of one table."""

    not_null: Sequence[str] = ()
    unique: Sequence[str] = ()
    accepted: Mapping[str, Sequence] = field(default_factory=dict)
    expressions: Sequence[str] = ()
    combinations: Sequence[Sequence[str]] = ()
    # column -> (parent table, parent column)
    relationships: Mapping[str, tuple[str, str]] = field(default_factory=dict)

    def __len__(self) -> int:
        return sum(map(len, (
            self.not_null, self.unique, self.accepted, self.expressions,
            self.combinations, self.relationships,
        )))


def checked_columns(df: DataFrame, checks: TableChecks) -> list[str]:
    """The columns of ``df`` that its checks look at."""
    named = {*checks.not_null, *checks.unique, *checks.accepted, *checks.relationships, *(c for k in checks.combinations for c in k)}
    named |= {word for e in checks.expressions for word in re.findall(r"\w+", e)}
    return [c for c in df.columns if c in named]


def _row_checks(checks: TableChecks) -> dict[tuple[str, str], Column]:
    """Failure predicate of every check that looks at one row at a time."""
    out: dict[tuple[str, str], Column] = {}
    for c in checks.not_null:
        out["not_null", c] = F.col(c).isNull()
    for c, values in checks.accepted.items():
        out["accepted_values", c] = ~F.col(c).isin(list(values))
    for e in checks.expressions:
        out["expression_is_true", e] = ~F.expr(e)
    return out


def _group_checks(
    name: str, checks: TableChecks, tables: Mapping[str, DataFrame]
) -> dict[tuple[str, str], DataFrame]:
    df = tables[name]
    out: dict[tuple[str, str], DataFrame] = {}
    for c in checks.unique:
        out["unique", c] = unique(df, c)
    for cols in checks.combinations:
        out["unique_combination", ",".join(cols)] = unique_combination(df, cols)
    for c, (parent, parent_col) in checks.relationships.items():
        out["relationships", c] = relationships(df, c, tables[parent], parent_col)
    return out


def _inlined(counted: DataFrame, table_names: Sequence[str], labels: Sequence[tuple[str, str]]) -> DataFrame:
    """One row of counts ``c0, c1, ...`` as a row per check."""
    entries = [
        F.struct(F.lit(table).alias("table_name"), F.lit(kind).alias("check_name"), F.lit(target).alias("target"),
                 F.coalesce(F.col(f"c{i}"), F.lit(0)).cast("long").alias("failures"))
        for i, (table, (kind, target)) in enumerate(zip(table_names, labels, strict=True))
    ]
    return counted.select(F.inline(F.array(*entries)))


def repeated(df: DataFrame, keys: Sequence[Sequence[str]]) -> DataFrame:
    """Repeated tuples of several column lists: ``which`` list, its columns, ``n_rows``.

    The lists are grouping sets of one aggregation: the table is read once, every row goes
    once per list into the combine before one shuffle. Columns of other lists are NULL.
    """
    sets = [list(k) for k in keys]
    cols = list(dict.fromkeys(c for k in sets for c in k))
    ids = [sum(1 << (len(cols) - 1 - i) for i, c in enumerate(cols) if c not in k) for k in sets]
    which = F.array_position(F.array(*[F.lit(i).cast("long") for i in ids]), F.grouping_id().cast("long")) - 1
    counted = df.groupingSets([[F.col(c) for c in k] for k in sets], *cols).agg(
        which.cast("int").alias("which"), F.count(F.lit(1)).alias("n_rows"))
    return counted.filter("n_rows > 1")


# Groups over which the hashes of a uniqueness check are dealt.
HASH_GROUPS = 1024


def _hash_group(i: int, keys: Sequence[str]) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(HASH_GROUPS)).cast("int") + i * HASH_GROUPS


def _may_repeat(df: DataFrame, sets: Sequence[Sequence[str]]) -> Column:
    """False for rows whose keys are all single for sure, told from 8 bytes per key.

    The hashes of the keys go to groups as sets; where a group has fewer hashes than keys, one of its keys
    may repeat. All copies of a repeated key are in one group, so that it is counted in full among the rows left.
    """
    sent = df.select(F.inline(F.array(*[
        F.struct(_hash_group(i, k).alias("grp"), F.xxhash64(*k).alias("hash")) for i, k in enumerate(sets)])))
    groups = sent.groupBy("grp").agg(F.count(F.lit(1)).alias("n"), F.collect_set("hash").alias("hashes"))
    found = groups.filter(F.col("n") > F.size("hashes")).agg(F.collect_set("grp").alias("found"))
    return F.arrays_overlap(found.scalar(), F.array(*[_hash_group(i, k) for i, k in enumerate(sets)]))


def _unique_failures(name: str, checks: TableChecks, df: DataFrame) -> DataFrame | None:
    """Repeated values of every uniqueness check, from one pass over the table; NULLs of a unique column do not count."""
    labels = [("unique", c) for c in checks.unique] + [("unique_combination", ",".join(k)) for k in checks.combinations]
    if not labels:
        return None
    wanted = [(c,) for c in checks.unique] + [tuple(k) for k in checks.combinations]
    sets = list(dict.fromkeys(tuple(sorted(k)) for k in wanted))
    failed = []
    for i, k in enumerate(wanted):
        fails = F.col("which") == sets.index(tuple(sorted(k)))
        if labels[i][0] == "unique":
            fails = fails & F.col(k[0]).isNotNull()
        failed.append(F.count_if(fails).alias(f"c{i}"))
    return _inlined(repeated(df.filter(_may_repeat(df, sets)), sets).agg(*failed), [name] * len(labels), labels)


def orphans(checks: Mapping[str, TableChecks], tables: Mapping[str, DataFrame]) -> DataFrame | None:
    """Values without a parent row of all relationships: number of the ``relation``, ``value`` as text, ``n_rows``.

    Foreign values of all tables are tagged and counted, then held against the values of all
    parents in one join, where they were counted. A value on many rows is one row there.
    """
    relations = [(t, c, *parent) for t, found in checks.items() for c, parent in found.relationships.items()]
    if not relations:
        return None
    parents = list(dict.fromkeys(r[2:] for r in relations))
    known = None
    for i, (parent, column) in enumerate(parents):
        part = tables[parent].select(F.lit(i).alias("parent"), short_key(F.col(column).cast("string")).alias("value"))
        known = part if known is None else known.unionByName(part)
    # Relations of one parent are numbered, so that their counts are columns.
    numbers = [[r[2:] for r in relations[:i]].count(r[2:]) for i, r in enumerate(relations)]
    held = None
    for t in dict.fromkeys(r[0] for r in relations):
        tagged = []
        for i, (table, c, *parent) in enumerate(relations):
            if table == t:
                kind = tables[parent[0]].schema[parent[1]].dataType
                value = F.col(c).cast(kind).cast("string")  # as the parent writes it
                tagged.append(F.struct(
                    F.lit(numbers[i]).alias("number"), F.lit(parents.index(tuple(parent))).alias("parent"), short_key(value).alias("value")))
        part = tables[t].select(F.inline(F.array(*tagged))).filter("value IS NOT NULL")
        held = part if held is None else held.unionByName(part)
    counted = held.groupBy("parent", "value").agg(
        *[F.count_if(F.col("number") == n).alias(f"n{n}") for n in range(max(numbers) + 1)])
    # An anti join would be pushed below the union, into one join per table.
    there = known.distinct().withColumn("there", F.lit(True))
    lost = counted.join(there, ["parent", "value"], "left").filter("there IS NULL")
    counts = [
        F.struct(F.lit(i).alias("relation"), F.when(F.col("parent") == parents.index(r[2:]), F.col(f"n{n}")).alias("n_rows"))
        for i, (r, n) in enumerate(zip(relations, numbers, strict=True))]
    return lost.select(key_text(F.col("value")).alias("value"), F.inline(F.array(*counts))).filter("n_rows > 0").select(
        "relation", "value", "n_rows")


def _relationship_failures(checks: Mapping[str, TableChecks], tables: Mapping[str, DataFrame]) -> DataFrame | None:
    found = orphans(checks, tables)
    if found is None:
        return None
    labels = [(t, c) for t, of in checks.items() for c in of.relationships]
    counted = found.agg(*[F.sum(F.when(F.col("relation") == i, F.col("n_rows"))).alias(f"c{i}") for i in range(len(labels))])
    return _inlined(counted, [t for t, _ in labels], [("relationships", c) for _, c in labels])


def _row_failures(name: str, checks: TableChecks, df: DataFrame) -> DataFrame | None:
    rows = _row_checks(checks)
    if not rows:
        return None
    counted = df.agg(*[F.count_if(p).alias(f"c{i}") for i, p in enumerate(rows.values())])
    return _inlined(counted, [name] * len(rows), list(rows))


def check_table(name: str, checks: TableChecks, tables: Mapping[str, DataFrame]) -> DataFrame:
    """Failure count per check of one table, see ``check_all``."""
    return check_all({name: checks}, tables)


def check_all(checks: Mapping[str, TableChecks], tables: Mapping[str, DataFrame]) -> DataFrame:
    """Failure count per check: ``(table_name, check_name, target, failures)``.

    A table's row checks share one scan, its uniqueness checks another; the relationships of
    all tables share one join. Failures of ``relationships`` are child rows, those of the
    uniqueness checks repeated values.
    """
    parts = [_relationship_failures(checks, tables)]
    for name, c in checks.items():
        parts += [_row_failures(name, c, tables[name]), _unique_failures(name, c, tables[name])]
    return functools.reduce(DataFrame.unionByName, [p for p in parts if p is not None])


def store_failures(
    checks: Mapping[str, TableChecks], tables: Mapping[str, DataFrame], root: str
) -> dict[str, str]:
    """Write the failing rows of every check below ``root``; returns check -> path."""
    written = {}
    for name, c in checks.items():
        failing = {k: tables[name].filter(p) for k, p in _row_checks(c).items()}
        failing |= _group_checks(name, c, tables)
        for i, ((kind, target), rows) in enumerate(failing.items()):
            path = f"{root}/{name}/{i:02d}_{kind}"
            rows.write.mode("overwrite").parquet(path)
            written[f"{name}.{kind}.{target}"] = path
    return written


# Value ranges of the serving integer types (fixed values).
INTEGER_RANGES = {
    "UInt8": (0, 2**8 - 1), "UInt16": (0, 2**16 - 1), "UInt32": (0, 2**32 - 1),
    "Int8": (-2**7, 2**7 - 1), "Int16": (-2**15, 2**15 - 1), "Int32": (-2**31, 2**31 - 1),
}


@dataclass(frozen=True)
class Contract:
    """Serving schema of a mart: column -> type name, ``?`` at the end for nullable."""

    columns: Mapping[str, str]
    sort_by: Sequence[str]


def contract_violations(df: DataFrame, contract: Contract) -> DataFrame:
    """``(column_name, nulls, out_of_range)`` per contract column, from one aggregate.

    The columns of ``df`` must be those of the contract, in its order: serving loads go
    by position.
    """
    require_columns(df, contract)
    aggs, entries = [], []
    for c, spec in contract.columns.items():
        kind, nullable = spec.rstrip("?"), spec.endswith("?")
        nulls = F.lit(0).cast("long") if nullable else F.count_if(F.col(c).isNull())
        low_high = INTEGER_RANGES.get(kind)
        outside = F.lit(0).cast("long") if low_high is None else F.count_if(~F.col(c).between(*low_high))
        aggs += [nulls.alias(f"n_{c}"), outside.alias(f"r_{c}")]
        entries.append(F.struct(
            F.lit(c).alias("column_name"), F.col(f"n_{c}").alias("nulls"), F.col(f"r_{c}").alias("out_of_range")))
    return df.agg(*aggs).select(F.inline(F.array(*entries)))


def require_columns(df: DataFrame, contract: Contract) -> None:
    if list(df.columns) != list(contract.columns):
        raise ValueError(f"columns {df.columns} do not follow the contract {list(contract.columns)}")
