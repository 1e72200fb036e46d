"""Raw snapshots: JSON array files in Hive-style directories.

``source=/endpoint=[/league_id=][/season=]/dt=/file.json``; a rerun for the same keys
replaces the snapshot.
"""

from __future__ import annotations

import json
import logging
import re
from collections.abc import Iterator, Sequence
from datetime import date

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

log = logging.getLogger(__name__)

# Spark's default text form of timestamps stops at milliseconds.
MICROSECONDS = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


def snapshot_path(
    source: str,
    endpoint: str,
    dt: str | date | None = None,
    league: str | None = None,
    season: int | str | None = None,
    filename: str | None = None,
) -> str:
    """Relative key of a snapshot; the levels left out do not appear."""
    levels = {
        "source": source, "endpoint": endpoint, "league_id": league,
        "season": season, "dt": None if dt is None else str(dt),
    }
    parts = [f"{k}={v}" for k, v in levels.items() if v is not None]
    return "/".join(parts if filename is None else [*parts, filename])


def write_snapshot(df: DataFrame, root: str, keys: Sequence[str]) -> None:
    """Write JSON partitioned by ``keys``; only the partitions in ``df`` are replaced.

    One JSON object per line: files split across tasks, which one array per file cannot.
    Rows are gathered by partition first, large partitions over several tasks, so that
    not every task writes a file into every partition.
    """
    (
        df.hint("rebalance", *[F.col(k) for k in keys]).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .options(timestampNTZFormat=MICROSECONDS, timestampFormat=MICROSECONDS + "XXX")
        .option("ignoreNullFields", "false").partitionBy(*keys).json(root)
    )


# Files that Spark's JSON writer makes hold one object per line; others hold one array.
LINES = "part-*"
ARRAYS = "{[^p]*,p,p[^a]*,pa,pa[^r]*,par,par[^t]*,part,part[^-]*}"


# JSON as it is scanned from its start: strings as wholes, so that what follows them is no part of one.
_STRING = r'"(?:[^"\\\\]++|\\\\.)*+"'
_NON_FINITE = r'\\G((?:[^"NI-]++|%s|-(?!Infinity))*+)(?:NaN|-?Infinity)' % _STRING
_NUMBER = r'\\G((?:[^"0-9-]++|%s)*+)(-?[0-9][0-9.eE+-]*+)' % _STRING


def finite_json(item: str) -> Column:
    """JSON text with null for NaN and the infinities, else character by character as it is."""
    return F.expr(f"CASE WHEN {item} RLIKE 'NaN|Infinity' THEN regexp_replace({item}, '{_NON_FINITE}', '$1null') ELSE {item} END")


def as_text(t: T.DataType) -> T.DataType:
    """The type with text for every value."""
    if isinstance(t, T.StructType):
        return T.StructType([T.StructField(f.name, as_text(f.dataType)) for f in t.fields])
    return T.ArrayType(as_text(t.elementType)) if isinstance(t, T.ArrayType) else T.StringType()


def parsed(item: str, schema: T.StructType) -> Column:
    """Fields of finite JSON text; numbers that are wanted as text come as they are written there."""
    quoted = F.expr(f"""regexp_replace({item}, '{_NUMBER}', '$1"$2"')""")
    return F.from_json(quoted, as_text(schema), {"mode": "FAILFAST"}).cast(schema)


def _items_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Whole files, each an array of items or one item, cut into the texts of their items."""
    decode = json.JSONDecoder().raw_decode
    skip = re.compile(r"\s*").match

    def cut(text: str) -> Iterator[str]:
        at = skip(text).end()
        many = text[at : at + 1] == "["
        if many:
            at = skip(text, at + 1).end()
        while not (many and text[at : at + 1] == "]"):
            end = decode(text, at)[1]
            yield text[at:end]
            at = skip(text, end).end()
            if not many or text[at : at + 1] == "]":
                break
            if text[at : at + 1] != ",":
                raise ValueError(f"not JSON at {at}")
            at = skip(text, at + 1).end()
            if text[at : at + 1] == "]":
                raise ValueError(f"not JSON at {at}")
        if text[at + many :].strip():
            raise ValueError(f"not JSON at {at}")

    for batch in batches:
        for row in batch.to_pylist():
            if not row["value"].strip():
                continue
            items = list(cut(row.pop("value")))
            columns = [pa.array(items, pa.string()), pa.array(range(len(items)), pa.int64())]
            columns += [pa.array([v] * len(items), batch.schema.field(c).type) for c, v in row.items()]
            yield pa.RecordBatch.from_arrays(columns, ["item", "row", *row])


def read_snapshot(
    spark: SparkSession,
    root: str,
    source: str,
    endpoint: str,
    schema: T.StructType,
    dt: str | date,
    season: int | None = None,
    item: str | None = None,
) -> DataFrame:
    """Rows of one endpoint's snapshot for one day.

    Adds ``league_id`` (NULL where the level is absent), ``season``, ``dt``,
    ``source_file`` and ``item_no``, which orders the items of a file. Season directories
    whose value is no integer are left out. A missing snapshot gives no rows and a
    warning. A file's name tells its layout, so a folder may hold both.

    With ``item``, a column of that name holds the text of the whole item, fields that the
    schema does not know included, with null for numbers that are not finite. Fields that the
    schema has as text then hold numbers as they are written there.

    The paths go down to the day: folders of other days are not listed.
    """
    base = f"{root}/{snapshot_path(source, endpoint)}"
    day = f"dt={dt}"
    year = f"season={'*' if season is None else season}"
    days = f"{base}/{{{day},{year}/{day},league_id=*/{day},league_id=*/{year}/{day}}}"
    levels = {"league_id": "string", "season": "int", "dt": "date"}

    def files(pattern: str, multiline: bool) -> DataFrame:
        reader = spark.read.option("basePath", base).option("pathGlobFilter", pattern)
        if item is None:
            raw = reader.option("multiLine", multiline).option("mode", "FAILFAST").schema(schema).json(days)
        else:
            raw = reader.text(days, wholetext=multiline)
        place = F.struct(F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("row"))
        rows = with_source_file(raw).withColumn("item_no", place)
        if item is not None:
            if multiline:
                kept = rows.drop("item_no")
                types = [T.StructField("item", T.StringType()), T.StructField("row", T.LongType())]
                cut = kept.select("value", *[c for c in kept.columns if c != "value"])
                rows = cut.mapInArrow(_items_of, T.StructType([*types, *[f for f in cut.schema.fields if f.name != "value"]]))
                rows = rows.withColumn("item_no", F.struct(F.lit(0).cast("long").alias("block"), "row")).drop("row")
            else:
                rows = rows.filter("trim(value) != ''").withColumnRenamed("value", "item")
            rows = rows.withColumn("item", finite_json("item"))
            # Parsed under one name, as an item may have fields named like the levels.
            rows = rows.withColumn("__fields", parsed("item", schema)).withColumnRenamed("item", "__item")
        if "season" in rows.columns:
            rows = rows.withColumn("season", F.expr("try_cast(season AS int)"))
            rows = rows.filter(F.col("season").isNotNull())
            if season is not None:
                rows = rows.filter(F.col("season") == season)
        for name, t in levels.items():
            if name not in rows.columns:
                given = str(dt) if name == "dt" else None
                rows = rows.withColumn(name, F.lit(given).cast(t))
        rows = rows.withColumn("dt", F.col("dt").cast("date"))
        if item is not None:
            fields = [F.col(f"__fields.{n}").alias(n) for n in schema.fieldNames()]
            return rows.select(*fields, *levels, "source_file", "item_no", F.col("__item").alias(item))
        return rows.select(*schema.fieldNames(), *levels, "source_file", "item_no")

    try:
        return files(ARRAYS, True).unionByName(files(LINES, False))
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        log.warning("no snapshot of %s below %s", dt, base)
        added = {**levels, "source_file": "string", "item_no": "struct<block: bigint, row: bigint>"} | ({item: "string"} if item else {})
        return spark.createDataFrame([], schema).withColumns({c: F.lit(None).cast(t) for c, t in added.items()})


def with_source_file(df: DataFrame) -> DataFrame:
    """Path of the file each row came from."""
    return df.withColumn("source_file", F.col("_metadata.file_path"))
