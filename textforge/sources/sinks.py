"""Sinks: processed table, train/test features, reports, run metrics."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def write_processed(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    writer = df.write.mode("overwrite")
    if fmt == "csv":
        # The writer trims cells unless told otherwise.
        writer.options(
            header="true",
            quote='"',
            escape='"',
            ignoreLeadingWhiteSpace="false",
            ignoreTrailingWhiteSpace="false",
        ).csv(path)
    elif fmt == "parquet":
        writer.parquet(path)
    else:
        raise ValueError(f"unsupported format: {fmt}")


def write_features(df: DataFrame, path: str) -> None:
    """Train and test features as one table, one folder per split."""
    df.write.mode("overwrite").partitionBy("split").parquet(path)


def write_report(report: DataFrame, path: str) -> None:
    """Classification reports, one folder per model; a rerun replaces only its models."""
    (
        report.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("model")
        .parquet(path)
    )


def report_metrics(report: DataFrame, *keys: str) -> DataFrame:
    """Report rows unpivoted to ``metric, value`` with names such as ``0_precision``.

    The accuracy row holds one number, so it gives one metric ``accuracy``.
    """
    names = {
        "precision": "precision",
        "recall": "recall",
        "f1-score": "f1_score",
        "support": "support",
    }

    def metric(name: str, column: str) -> Column:
        return F.struct(F.lit(name).alias("name"), F.col(column).cast("double").alias("value"))

    every = F.array(*(metric(name, column) for name, column in names.items()))
    single = F.array(metric("accuracy", "precision"))
    is_accuracy = F.col("label") == "accuracy"
    return report.select(
        *keys, "label", F.inline(F.when(is_accuracy, single).otherwise(every))
    ).select(
        *keys,
        F.when(F.col("name") == "accuracy", F.col("name"))
        .otherwise(F.concat("label", F.lit("_"), "name"))
        .alias("metric"),
        "value",
    )


def append_run_metrics(metrics: DataFrame, path: str, run: str, params: dict | None = None) -> None:
    """Add one run's ``metric, value`` rows to the run table.

    A run with its parameters has a folder of its own, and only that is replaced when the same job is
    tried again, so a repeated run is stored once.
    """
    names = sorted(params or {})
    pairs = [c for k in names for c in (F.lit(k), F.lit(str(params[k])))]
    stored = F.create_map(*pairs) if pairs else F.create_map().cast("map<string,string>")
    said = json.dumps([run, [[k, str(params[k])] for k in names]])
    folder = F.concat(F.lit("run-"), F.sha2(F.lit(said), 256))
    (
        metrics.select(F.lit(run).alias("run"), stored.alias("params"), "metric", "value", folder.alias("folder"))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("folder")
        .parquet(path)
    )


def read_run_metrics(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).drop("folder")
