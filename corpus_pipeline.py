"""From raw documents to packed training sequences, stage by stage.

Every stage works on all that its predecessor kept. All but the last keep the columns of
``documents``; the last gives one row per piece of a document with its place in a sequence.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from textforge.llm.decontaminate import remove_contaminated
from textforge.llm.exact_dedup import drop_copies
from textforge.llm.frames import table
from textforge.llm.near_dedup import keep_one_of_each
from textforge.llm.packing import pack_documents
from textforge.llm.quality import drop_low_quality
from textforge.session import materialize


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops what the classifier rejects."""
    return drop_low_quality(docs, table(spark, sf_dir, "labels"))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the largest id stays."""
    return drop_copies(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class stays."""
    return keep_one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a passage of the benchmark."""
    return remove_contaminated(docs, table(spark, sf_dir, "benchmark"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Places the token pieces of all documents in sequences."""
    return pack_documents(docs)


STAGES = [
    ("quality classifier", quality_classifier),
    ("exact dedup", exact_dedup),
    ("near-duplicates", near_dedup),
    ("decontamination", decontamination),
    ("packing", packing),
]

#: SQL can't state the trained classifier and the packing; the tests check each stage by brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written as Parquet and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return docs
