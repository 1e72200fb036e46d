"""Parquet tables below a root folder: appends, rebuilds, mart export and publishing."""

from __future__ import annotations

import atexit
import contextlib
import functools
import hashlib
import uuid
from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pitchvault.operators.load import upsert
from pitchvault.operators.quality import Contract, contract_violations, require_columns
from pitchvault.sources.together import together


def read_table(spark: SparkSession, path: str) -> DataFrame | None:
    """The table, or ``None`` if nothing has been written there."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as e:
        if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def append_table(df: DataFrame, path: str) -> int:
    """Append and return the number of rows, counted while writing."""
    return _counted_write(df, path, "append")


def _counted_write(df: DataFrame, path: str, mode: str, partition_by: Sequence[str] = (), options: Mapping[str, str] | None = None) -> int:
    seen = Observation()
    # Hash keys are hexadecimal text: zstd writes them in half the space.
    writer = df.observe(seen, F.count(F.lit(1)).alias("n")).write.mode(mode).options(**{"compression": "zstd"} | dict(options or {}))
    if partition_by:
        writer = writer.partitionBy(*partition_by).option("partitionOverwriteMode", "dynamic")
    writer.parquet(path)
    return seen.get["n"]


def replace_partitions(df: DataFrame, path: str, partition_by: Sequence[str]) -> int:
    """Replace the partitions present in ``df``, also when ``df`` was read from ``path``.

    Rows are gathered by partition, large partitions over several tasks.
    """
    gathered = df.hint("rebalance", *[F.col(c) for c in partition_by])
    return _counted_write(gathered, path, "overwrite", partition_by)


def upsert_partitions(
    incoming: DataFrame,
    path: str,
    keys: Sequence[str],
    partition_by: Sequence[str],
    order_by: Sequence[Column],
    loaded_at: Column | None = None,
) -> int:
    """``upsert`` into the table at ``path``, kept in folders by ``partition_by``; returns the rows written.

    Only partitions that the batch names are read and written; the files of the others stay as
    they are. Where the partition is no part of the key, a row may move: then the keys of the
    whole table are read, and the partitions that rows move away from are rewritten too. The
    driver gets the names of partitions only.
    """
    spark = incoming.sparkSession
    batch = _written(upsert(None, incoming, keys, order_by, loaded_at), "batch")
    target = _partitioned(spark, path, batch.schema)
    if target is None:
        old = read_table(spark, path)
        if batch.isEmpty():
            return 0 if old is not None else export_mart(batch, path)
        whole = batch if old is None else _replacing(old, batch, keys)
        return replace_table(whole, path, partition_by)

    named = [tuple(r) for r in batch.select(*partition_by).distinct().collect()]
    left = []
    if not set(partition_by) <= set(keys):
        where = target.select(*keys, *partition_by).join(batch.select(*keys), list(keys), "left_semi")
        left = [p for r in where.select(*partition_by).distinct().collect() if (p := tuple(r)) not in named]
    if not named:
        return 0
    touched = F.lit(False)
    for p in (*named, *left):
        same = [F.col(c).eqNullSafe(F.lit(v)) for c, v in zip(partition_by, p, strict=True)]
        touched = touched | functools.reduce(lambda a, b: a & b, same)
    result = _written(_replacing(target.filter(touched), batch, keys), "upserted")
    n = replace_partitions(result, path, partition_by)
    full = {tuple(r) for r in result.select(*partition_by).distinct().collect()} if left else ()
    for p in left:
        if p not in full:  # all its rows have moved
            _delete_partition(spark, path, partition_by, p)
    return n


def _replacing(target: DataFrame, batch: DataFrame, keys: Sequence[str]) -> DataFrame:
    kept = target.join(batch.select(*keys), list(keys), "left_anti")
    return kept.unionByName(batch, allowMissingColumns=True).select(*batch.columns)


def _written(df: DataFrame, name: str) -> DataFrame:
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _partitioned(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame | None:
    """The table at ``path`` if it is kept in folders by partition; no file is opened for that."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path
    fs = hadoop(path).getFileSystem(spark._jsc.hadoopConfiguration())
    found = fs.globStatus(hadoop(f"{path}/*=*"))
    return spark.read.schema(schema).parquet(path) if found else None


def _delete_partition(spark: SparkSession, path: str, columns: Sequence[str], values: tuple) -> None:
    """Remove the files of one partition, whose folder is told by its rows' file paths."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path
    rows = spark.read.parquet(path)
    for c, v in zip(columns, values, strict=True):
        rows = rows.filter(F.col(c).eqNullSafe(F.lit(v)))
    folders = {r[0] for r in rows.select(F.regexp_replace(F.col("_metadata.file_path"), "/[^/]*$", "")).distinct().collect()}
    for folder in folders:
        target = hadoop(folder)
        target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def export_mart(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> int:
    """Rebuild a parquet folder and return its row count; the source is read once."""
    return _counted_write(df, path, "overwrite", partition_by)


def export_laid_out(df: DataFrame, path: str, sort_by: Sequence[str], find_by: Sequence[str] = ()) -> int:
    """``export_mart`` in ranges of ``sort_by``, with Bloom filters for look-ups by the columns ``find_by``.

    Rows are sorted inside each file, so the least and greatest values of files, row groups and
    pages let readers skip most of them in a filter on the first sort columns. Where a column is
    in another order than the rows, these tell nothing; a Bloom filter per row group, sized by its
    distinct values, then lets readers skip those that do not hold the value.
    """
    return _counted_write(_laid_out(df, sort_by), path, "overwrite", options=_bloom_filters(df, find_by))


def _laid_out(df: DataFrame, sort_by: Sequence[str]) -> DataFrame:
    return df.repartitionByRange(*sort_by).sortWithinPartitions(*sort_by)


def _bloom_filters(df: DataFrame, columns: Sequence[str]) -> dict[str, str]:
    there = [c for c in columns if c in df.columns]
    on = {f"parquet.bloom.filter.enabled#{c}": "true" for c in there}
    return on | {"parquet.bloom.filter.adaptive.enabled": "true"} if on else {}


def export_marts(marts: Mapping[str, DataFrame], root: str) -> int:
    """Export every mart to its own folder below ``root``, several at a time; returns the total row count."""
    if not marts:
        return 0
    spark = next(iter(marts.values())).sparkSession
    return sum(together(spark, {name: functools.partial(export_mart, df, f"{root}/{name}") for name, df in marts.items()}).values())


def publish_mart(spark: SparkSession, exported: str, path: str, contract: Contract, find_by: Sequence[str] = ()) -> int:
    """Replace a serving copy with an exported mart.

    A missing or empty export, other columns than the contract's, NULLs in required
    columns or values outside their integer type are errors, raised before the old copy
    is touched. Rows are laid out in ranges of the sort key and sorted inside each file, so
    that readers can skip files and row groups; ``find_by`` as in ``export_laid_out``. The new
    copy is written beside the old one and takes its place when it is complete.
    """
    df = read_table(spark, exported)
    if df is None:
        raise FileNotFoundError(f"no parquet files in {exported}")
    require_columns(df, contract)
    broken = contract_violations(df, contract).filter("nulls > 0 OR out_of_range > 0")
    # At most one row per contract column.
    names = [r["column_name"] for r in broken.select("column_name").collect()]
    if names:
        raise ValueError(f"{exported}: contract violated by {names}")
    return replace_table(_laid_out(df, contract.sort_by), path, options=_bloom_filters(df, find_by))


def replace_table(df: DataFrame, path: str, partition_by: Sequence[str] = (), options: Mapping[str, str] | None = None) -> int:
    """Write ``df``, which may read the table at ``path``, beside it and then in its place."""
    beside = f"{path.rstrip('/')}-{uuid.uuid4().hex}"
    gathered = df.hint("rebalance", *[F.col(c) for c in partition_by]) if partition_by else df
    n = _counted_write(gathered, beside, "overwrite", partition_by, options)
    _switch(df.sparkSession, beside, path)
    return n


def _switch(spark: SparkSession, new: str, path: str) -> None:
    """Put the folder ``new`` in the place of ``path``."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path
    old, current, target = f"{new}-old", hadoop(path), hadoop(new)
    fs = target.getFileSystem(spark._jsc.hadoopConfiguration())
    fs.mkdirs(current.getParent())
    if fs.exists(current) and not fs.rename(current, hadoop(old)):
        raise OSError(f"cannot move {path}")
    if not fs.rename(target, current):
        fs.rename(hadoop(old), current)
        raise OSError(f"cannot move {new} to {path}")
    fs.delete(hadoop(old), True)


def bucketed_table(spark: SparkSession, path: str, schema: T.StructType, key: Sequence[str], buckets: int) -> str:
    """Name, in the session's catalog, of the Parquet table at ``path`` laid out in buckets of ``key``.

    Rows of one key hash to one bucket, so that a join or grouping by the key reads them in
    place. The layout is noted in the folder; a new session registers it again, and another
    key or number of buckets than noted is an error.
    """
    name = "bucketed_" + hashlib.md5(path.encode()).hexdigest()
    layout = f"{','.join(key)}:{buckets}"
    hadoop = spark._jvm.org.apache.hadoop.fs.Path
    note = hadoop(f"{path}/_buckets")
    fs = note.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(note):
        with_layout = fs.create(note)
        with_layout.writeUTF(layout)
        with_layout.close()
    else:
        held = fs.open(note)
        found = held.readUTF()
        held.close()
        if found != layout:
            raise ValueError(f"{path} is laid out by {found}, not by {layout}")
    if not spark.catalog.tableExists(name):
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
        keys = ", ".join(f"`{k}`" for k in key)
        spark.sql(
            f"CREATE TABLE {name} ({columns}) USING parquet OPTIONS (compression 'zstd') "
            f"CLUSTERED BY ({keys}) SORTED BY ({keys}) INTO {buckets} BUCKETS LOCATION '{path}'")
    return name


def append_bucketed(df: DataFrame, name: str) -> int:
    """Append rows to a bucketed table, each task writing into the buckets of its rows; returns their number."""
    spark, seen = df.sparkSession, Observation()
    counted = df.select(*spark.table(name).columns).observe(seen, F.count(F.lit(1)).alias("n"))
    counted.write.insertInto(name)
    spark.catalog.refreshTable(name)
    return seen.get["n"]


def export_bucketed(df: DataFrame, path: str, key: str, buckets: int) -> DataFrame:
    """Write a new table in buckets of ``key`` and return it.

    ``df`` has been dealt out into so many parts by the key, when its rows were still short: each task writes one bucket.
    """
    name = bucketed_table(df.sparkSession, path, df.schema, [key], buckets)
    append_bucketed(df, name)
    return df.sparkSession.table(name)


def append_parts(df: DataFrame, path: str, part: str) -> int:
    """Append to a table in folders by the column ``part``; rows are gathered by folder first."""
    return _counted_write(df.hint("rebalance", F.col(part)), path, "append", [part])


def scratch_root(spark: SparkSession) -> str:
    """Shared folder for intermediate tables: that of ``spark.checkpoint.dir``.

    A session that names none keeps them in its warehouse, which its executors share too,
    until the process ends.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    own = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_scratch"
    _remove_at_exit(spark, f"{own}/{spark.sparkContext.applicationId}")
    return own


_leaving: set[str] = set()


def _remove_at_exit(spark: SparkSession, folder: str) -> None:
    if folder in _leaving:
        return
    _leaving.add(folder)
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())

    def remove() -> None:
        with contextlib.suppress(Exception):  # the JVM may be gone before
            fs.delete(path, True)

    atexit.register(remove)


def scratch(spark: SparkSession, name: str) -> str:
    """A folder of this session that nothing else uses: ``<root>/<application>/<name>-<id>``."""
    return f"{scratch_root(spark)}/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"
