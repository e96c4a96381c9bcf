"""Parquet tables by folder, and the labelled-text views the queries use."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """The rows dealt over twice as many partitions as there are cores.

    Text work is heavy per byte and a Parquet file of one row group is one split, so the
    registered queries deal their rows out anew. Operators never do.
    """
    return df.repartition(2 * df.sparkSession.sparkContext.defaultParallelism)


def text_table(spark: SparkSession, folder: str, name: str, *columns: str) -> DataFrame:
    df = table(spark, folder, name)
    return spread(df.select(*columns) if columns else df)


def labelled_documents(spark: SparkSession, folder: str, label: str = "quality") -> DataFrame:
    """``doc_id, text, label`` of the documents that carry a label."""
    labels = table(spark, folder, "labels").select("doc_id", F.col(label).alias("label"))
    docs = text_table(spark, folder, "documents", "doc_id", "text")
    return docs.join(labels, "doc_id")


def documents_with_labels(spark: SparkSession, folder: str) -> DataFrame:
    """All documents; ``label`` is null where none was given."""
    labels = table(spark, folder, "labels").select("doc_id", F.col("quality").alias("label"))
    docs = text_table(spark, folder, "documents", "doc_id", "text")
    return docs.join(labels, "doc_id", "left")


def turns(spark: SparkSession, folder: str) -> DataFrame:
    """Conversation turns with one string key: ``key, text, label``."""
    return text_table(spark, folder, "conversations").select(
        F.concat_ws("-", "conv_id", "turn").alias("key"), "text", F.col("role").alias("label")
    )
