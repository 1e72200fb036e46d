"""Raw-vault loads over newly arrived stage files, run as they come or once per trigger."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from pitchvault.sources.tables import append_table, read_table


def read_new_files(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet", **options) -> DataFrame:
    """Stream of the files below ``path`` not seen before."""
    return spark.readStream.format(fmt).schema(schema).options(**options).load(path)


def stream_load(
    arriving: DataFrame,
    load: Callable[[DataFrame, DataFrame | None], DataFrame],
    path: str,
    checkpoint: str,
) -> StreamingQuery:
    """Load each micro-batch into the table at ``path`` and stop when no file is left.

    ``load(batch, existing)`` gives the rows to append, e.g. a hub or satellite load. Those
    loads leave out what the table holds, so a batch repeated after a failure adds nothing.
    """
    def run(batch: DataFrame, _: int) -> None:
        append_table(load(batch, read_table(batch.sparkSession, path)), path)

    return (
        arriving.writeStream.foreachBatch(run)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )
