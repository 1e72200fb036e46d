"""Written intermediate tables, and vectorised word hashing over Arrow batches."""

from __future__ import annotations

import gc
from collections.abc import Callable, Iterator, Mapping
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pitchvault.sources.tables import scratch

TEXT = "CAST(coalesce(text, '') AS BINARY) AS text"  # UTF-8 bytes; null is empty
CHUNK_BYTES = 1 << 19  # text worked on at once inside a task


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back: cuts lineage, survives lost executors."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def free_shuffles(spark: SparkSession) -> None:
    """Let Spark remove the shuffle files of finished queries, which stay until the driver collects its garbage."""
    gc.collect()
    spark._jvm.System.gc()


def free_name(df: DataFrame, wanted: str) -> str:
    """``wanted``, lengthened until no column of ``df`` is named so, whatever the case of its letters."""
    taken = {c.lower() for c in df.columns}
    while wanted.lower() in taken:
        wanted += "_"
    return wanted


def columns_of(df: DataFrame) -> list[Column]:
    """The columns of ``df``, whatever characters are in their names."""
    return [F.col("`" + c.replace("`", "``") + "`") for c in df.columns]


def map_batches(df: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: T.StructType) -> DataFrame:
    """``mapInArrow`` for column names of any characters."""
    names = df.columns
    plain = df.toDF(*[f"c{i}" for i in range(len(names))])
    return plain.mapInArrow(lambda batches: run(b.rename_columns(names) for b in batches), schema)


@contextmanager
def settings(spark: SparkSession, conf: Mapping[str, str]) -> Iterator[None]:
    """SQL settings for the actions inside, put back afterwards."""
    before = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


#: Merge joins for which Spark sends a Bloom filter (of at most its usual size) of the
#: filtered side ahead to the other scan, so that only rows which may match are shuffled,
#: however large that side is.
BLOOM = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "0",
    "spark.sql.optimizer.runtime.bloomFilter.creationSideThreshold": "1t",
}


def fixed(raw: bytes, dtype: str) -> np.ndarray:
    return np.frombuffer(raw, dtype)


def chunks(batch: pa.RecordBatch, column: str = "text") -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Consecutive rows of a binary column: (first row, bytes, offsets), some of the rows at a time.

    Row ``first + i`` is ``bytes[offsets[i]:offsets[i + 1]]``. One longer text is one chunk.
    """
    col = pc.fill_null(batch.column(column), b"")
    if not len(col):
        return
    wide = pa.types.is_large_binary(col.type)
    _, offs, data = col.buffers()
    at = np.frombuffer(offs, np.int64 if wide else np.int32)[col.offset : col.offset + len(col) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    first = 0
    while first < len(col):
        last = max(first + 1, int(np.searchsorted(at, at[first] + CHUNK_BYTES, "right")) - 1)
        yield first, raw[at[first] : at[last]], at[first : last + 1] - at[first]
        first = last


def table_of(code_points: range | list[int], value: int = 1) -> np.ndarray:
    out = np.zeros(256, np.uint8)
    out[list(code_points)] = value
    return out


LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32  # A-Z only; other letters stay as they are

_rng = np.random.default_rng(20240229)
_BYTE = _rng.integers(1, 2**63, 256, dtype=np.uint64) | np.uint64(1)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_powers = np.ones(1, np.uint64)


def powers(n: int) -> np.ndarray:
    """``BASE ** 0 .. BASE ** (n - 1)`` modulo 2**64."""
    global _powers
    if len(_powers) < n:
        grown = np.full(max(n, 2 * len(_powers), 1024), _BASE, np.uint64)
        grown[0] = 1
        _powers = np.multiply.accumulate(grown)
    return _powers[:n]


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def words(text: np.ndarray, offsets: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, ...]:
    """Words of a chunk: (starts, lengths, 64-bit hashes, first word of each row, as offsets).

    ``inside`` marks the bytes that words are made of. Words end where a row ends.
    """
    is_in = inside[text].astype(bool)
    begins = is_in.copy()
    begins[1:] &= ~is_in[:-1]
    row_starts = offsets[:-1][offsets[:-1] < len(text)]
    begins[row_starts] = is_in[row_starts]
    at = np.flatnonzero(is_in)
    if not len(at):
        none = np.empty(0, np.int64)
        return none, none, none.astype(np.uint64), np.zeros(len(offsets), np.int64)
    first = np.flatnonzero(begins[at])
    lengths = np.diff(np.append(first, len(at)))
    starts = at[first]
    places = at - np.repeat(starts, lengths)
    hashes = mix(np.add.reduceat(_BYTE[text[at]] * powers(int(lengths.max()))[places], first))
    return starts, lengths, hashes, np.searchsorted(starts, offsets)


_STEP = _rng.integers(1, 2**63, 64, dtype=np.uint64) | np.uint64(1)


def grams(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hash of every ``size`` consecutive words; the caller leaves out those over a row's end."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    out = np.full(n, size, np.uint64)
    for j in range(size):
        out += hashes[j : j + n] * _STEP[j]
    return mix(out)


def record(schema: pa.Schema, *columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema
    )
