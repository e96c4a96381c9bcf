"""Small helpers on frames that several operators share."""

from __future__ import annotations

import ctypes
import functools

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def fresh(df: DataFrame, name: str) -> str:
    """``name``, with underscores in front as long as ``df`` has a column of that name."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def table(spark, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: A side is broadcast up to this many bytes; a larger one takes part in a shuffled join.
BROADCAST_BYTES = 32 << 20


def checked_broadcast(keys: DataFrame, row_bytes: int = 16) -> DataFrame:
    """A written table of keys, with a broadcast hint if a count shows that it is small."""
    return F.broadcast(keys) if keys.count() * row_bytes <= BROADCAST_BYTES else keys


def give_back() -> None:
    """Returns freed memory to the system, for a worker lives on after its task."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def tidy(function):
    """A function over batches that leaves no freed memory behind in its worker."""

    @functools.wraps(function)
    def run(batches):
        try:
            yield from function(batches)
        finally:
            give_back()

    return run
