"""From raw documents to packed sequences: the stages of a training-data pipeline.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet
and read back as the next stage's documents.

Null and empty texts pass all stages. Rows are judged each for itself, whatever their
doc_id: repeated rows are copies, of which one stays; rows without a text or without words
are no copies of each other. All columns but the blotted text and its ``n_chars`` come out
as they went in, in type and value, whatever their names. Empty tables give empty tables.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pitchvault.llm import decontamination, jaccard_join, packing, secret_scan, toxicity
from pitchvault.llm.common import columns_of, free_name, read, stored
from pitchvault.llm.registry import tokenizer

MARK = "[secret]"
BITS = 32768  # of one of Spark's bitmaps


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity chain does not reject; it is trained on these documents' labels."""
    chain = toxicity.train_chain(docs, read(spark, sf_dir, "labels"))
    odds, verdict = free_name(docs, "odds"), free_name(docs, "verdict")
    judged = toxicity.judge(docs, chain, odds, verdict)
    return judged.filter(~F.col(verdict)).select(*columns_of(docs))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of every near-duplicate class: that with the least doc_id, rows without one last.

    Rows are told apart by a written number, so that repeated and missing ids do no harm. Which
    of them go is sent to the texts as bitmaps, one bit a row at most: the texts are not shuffled.
    """
    row = free_name(docs, "row")
    numbered = stored(docs.withColumn(row, F.monotonically_increasing_id()), "numbered")
    found = stored(jaccard_join.near_duplicates(numbered.select(F.col(row).alias("doc_id"), "text")), "near-copies")
    linked = found.filter("doc_id != component_id").select(F.col("doc_id").alias("row"), F.col("component_id").alias("class"))
    members = linked.union(linked.select(F.col("class").alias("row"), "class").distinct())
    ids = numbered.select(F.col(row).alias("row"), F.col("doc_id").cast("long").alias("id"))
    order = F.struct(F.col("id").isNull(), "id", "row")
    first = members.join(ids, "row").groupBy("class").agg(F.min(order).alias("first"))
    others = members.join(first.select(F.col("first.row").alias("row")), "row", "left_anti")
    part, bits = free_name(docs, "part"), free_name(docs, "bits")
    gone = others.groupBy(F.expr(f"row DIV {BITS}").alias(part)).agg(F.expr(f"bitmap_construct_agg(row % {BITS})").alias(bits))
    marked = numbered.join(F.broadcast(gone), F.expr(f"{row} DIV {BITS}") == F.col(part), "left")
    byte = F.expr(f"CAST(conv(hex(substring({bits}, {row} % {BITS} DIV 8 + 1, 1)), 16, 10) AS INT)")
    stays = F.col(bits).isNull() | (byte.bitwiseAND(F.expr(f"shiftleft(1, CAST({row} % 8 AS INT))")) == 0)
    return marked.filter(stays).select(*columns_of(docs))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which less than a twentieth is benchmark passages."""
    return decontamination.clean(docs, read(spark, sf_dir, "benchmark"))


def blot_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with every secret replaced by a mark, and ``n_chars`` of those texts counted anew."""
    spans = free_name(docs, "spans")
    blotted = secret_scan.scan(docs, out=spans, mark=MARK)
    if "n_chars" in docs.columns:
        counted = F.length("text").cast(docs.schema["n_chars"].dataType)
        blotted = blotted.withColumn("n_chars", F.when(F.size(spans) > 0, counted).otherwise(F.col("n_chars")))
    return blotted.select(*columns_of(docs))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of all documents, each with its sequence and offset."""
    return packing.pack_documents(docs, tokenizer())


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("secrets", blot_secrets),
    ("packing", pack_sequences),
]

#: Tokens, trained models and tree classes are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read back."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
