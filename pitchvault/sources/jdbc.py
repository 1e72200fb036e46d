"""JDBC tables and subqueries as sources and sinks."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class Slices:
    """Ranges of a numeric, date or timestamp column, one read task each."""

    column: str
    lower: object
    upper: object
    count: int


def read_options(
    url: str, table_or_query: str, props: Mapping[str, str] | None = None, slices: Slices | None = None
) -> dict[str, str]:
    """Reader options; a text that starts with SELECT is sent as a subquery."""
    text = table_or_query.strip()
    if text.lower().startswith("select"):
        text = f"({text}) src"
    options = {"url": url, "dbtable": text, **(props or {})}
    if slices is not None:
        options |= {
            "partitionColumn": slices.column, "lowerBound": str(slices.lower),
            "upperBound": str(slices.upper), "numPartitions": str(slices.count),
        }
    return options


def read_jdbc(
    spark: SparkSession,
    url: str,
    table_or_query: str,
    props: Mapping[str, str] | None = None,
    slices: Slices | None = None,
) -> DataFrame:
    """Lazy scan; filters and columns are pushed to the database.

    Without ``slices`` one task reads the whole table over one connection: give them for
    anything large.
    """
    return spark.read.format("jdbc").options(**read_options(url, table_or_query, props, slices)).load()


def write_options(
    url: str, table: str, column_types: Mapping[str, str] | None = None,
    props: Mapping[str, str] | None = None, connections: int | None = None,
) -> dict[str, str]:
    options = {"url": url, "dbtable": table, **(props or {})}
    if column_types:
        options["createTableColumnTypes"] = ", ".join(f"{c} {t}" for c, t in column_types.items())
    if connections is not None:
        options["numPartitions"] = str(connections)
    return options


def write_jdbc(
    df: DataFrame, url: str, table: str, column_types: Mapping[str, str] | None = None,
    props: Mapping[str, str] | None = None, connections: int | None = None,
) -> None:
    """Replace a database table; ``connections`` bounds the parallel writers."""
    options = write_options(url, table, column_types, props, connections)
    df.write.format("jdbc").mode("overwrite").options(**options).save()
