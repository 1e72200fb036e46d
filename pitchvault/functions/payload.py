"""Reading semi-structured payloads: projection, header rows, non-finite numbers."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Wide enough for integers up to ten digits next to 18 decimals.
METRIC = T.DecimalType(28, 18)


def _text_schema(paths: list[str]) -> T.StructType:
    """Struct schema of strings that holds every dotted path."""
    tree: dict = {}
    for path in paths:
        node = tree
        *parents, leaf = path.split(".")
        for p in parents:
            node = node.setdefault(p, {})
        node.setdefault(leaf, None)

    def build(node: dict) -> T.StructType:
        return T.StructType([
            T.StructField(name, build(child) if child else T.StringType())
            for name, child in node.items()
        ])

    return build(tree)


def extract(df: DataFrame, payload: str, fields: dict[str, tuple[str, object]]) -> DataFrame:
    """Add ``{name: (dotted path, type)}`` read from ``payload``.

    A string payload is parsed once per row, into text fields only, and cast after
    that; malformed text and bad casts raise. A struct payload is read field by field,
    so a parquet scan prunes to the used leaves; a variant payload by path.
    """
    kind = df.schema[payload].dataType
    if isinstance(kind, T.StringType):
        tmp = f"__{payload}"
        schema = _text_schema([path for path, _ in fields.values()])
        parsed = df.withColumn(tmp, F.from_json(payload, schema, {"mode": "FAILFAST"}))
        return parsed.withColumns(
            {name: F.col(f"{tmp}.{path}").cast(t) for name, (path, t) in fields.items()}
        ).drop(tmp)
    if isinstance(kind, T.VariantType):
        def ddl(t) -> str:
            return t if isinstance(t, str) else t.simpleString()

        return df.withColumns({
            name: F.variant_get(payload, "$." + path, ddl(t)) for name, (path, t) in fields.items()
        })
    return df.withColumns(
        {name: F.col(f"{payload}.{path}").cast(t) for name, (path, t) in fields.items()}
    )


def rows_with_header(df: DataFrame, table: str, fields: dict[str, object]) -> DataFrame:
    """Explode an array of rows whose first row holds the column names.

    ``fields`` maps the wanted header names to types; the other columns of ``df`` stay.
    Short rows give NULL for the missing tail.
    """
    header = F.element_at(table, 1)
    body = F.slice(table, 2, F.greatest(F.size(table) - 1, F.lit(0)))
    rest = [c for c in df.columns if c != table]
    cells = (
        df.filter(F.size(table) > 1)
        .select(*rest, header.alias("__header"), F.explode(body).alias("__row"))
    )
    return cells.select(
        *rest,
        *[
            F.get(F.col("__row"), (F.array_position("__header", F.lit(name)) - 1).cast("int"))
            .cast(t).alias(name)
            for name, t in fields.items()
        ],
    )


def _finite(c: Column, t: T.DataType) -> Column:
    if isinstance(t, (T.FloatType, T.DoubleType)):
        bad = F.isnan(c) | c.isin(float("inf"), float("-inf"))
        return F.when(~bad, c)
    if isinstance(t, T.ArrayType) and _has_float(t):
        return F.transform(c, lambda x: _finite(x, t.elementType))
    if isinstance(t, T.MapType) and _has_float(t.valueType):
        return F.transform_values(c, lambda _, v: _finite(v, t.valueType))
    if isinstance(t, T.StructType) and _has_float(t):
        rebuilt = F.struct(*[_finite(c[f.name], f.dataType).alias(f.name) for f in t.fields])
        return F.when(c.isNotNull(), rebuilt)
    return c


def _has_float(t: T.DataType) -> bool:
    if isinstance(t, (T.FloatType, T.DoubleType)):
        return True
    if isinstance(t, T.ArrayType):
        return _has_float(t.elementType)
    if isinstance(t, T.MapType):
        return _has_float(t.valueType)
    if isinstance(t, T.StructType):
        return any(_has_float(f.dataType) for f in t.fields)
    return False


def nan_to_null(df: DataFrame) -> DataFrame:
    """NaN and the infinities become NULL at every depth; untouched columns pass through."""
    changed = {f.name: _finite(F.col(f"`{f.name}`"), f.dataType) for f in df.schema if _has_float(f.dataType)}
    return df.withColumns(changed) if changed else df


def split_literal(c: Column | str, separator: str) -> Column:
    """``split`` on a literal separator, not on a pattern."""
    return F.split(c, re.escape(separator))
