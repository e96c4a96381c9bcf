"""Session set-up and the shared folder that intermediate tables go to."""

from __future__ import annotations

import contextlib
import uuid

from pyspark.sql import DataFrame, SparkSession


def get_spark(app: str = "textforge", master: str | None = None, **conf) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        **{key.replace("__", "."): value for key, value in conf.items()},
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach: ``spark.checkpoint.dir``."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    return folder.rstrip("/")


_scopes: list[list[str]] = []


@contextlib.contextmanager
def scratch_scope(spark: SparkSession):
    """Delete the intermediate tables written inside, once the block ends.

    Only for flows that have written what they return elsewhere by then.
    """
    _scopes.append([])
    try:
        yield
    finally:
        for path in _scopes.pop():
            there = spark._jvm.org.apache.hadoop.fs.Path(path)
            there.getFileSystem(spark._jsc.hadoopConfiguration()).delete(there, True)


def scratch_path(spark: SparkSession, name: str) -> str:
    path = f"{shared_dir(spark)}/textforge/{name}-{uuid.uuid4().hex}"
    if _scopes:
        _scopes[-1].append(path)
    return path


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    The plan restarts from files, so a lost executor re-reads instead of
    recomputing, and the optimizer sees the true size: a join against the result
    is broadcast exactly when the table is below ``autoBroadcastJoinThreshold``.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
