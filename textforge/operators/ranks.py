"""Exact ranks in hash order without sorting a class in one task.

Splits, folds and under-sampling all ask one question: which rows of a class come
before rank r in a repeatable random order? A ``row_number`` window answers it by
sorting each class in one task. Here the class is counted per hash prefix, the
prefix holding rank r is found in that small histogram, and only the rows of that
prefix are ranked. The answer is one (hash, key) cut per class and rank, and the
rows are compared with it in place: they are never shuffled.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textforge.session import materialize

PREFIX = 4  # hex digits: 65,536 buckets per class


def hash_order(key: str, seed: int = 42) -> Column:
    """Repeatable random order of the keys."""
    return F.md5(F.concat_ws("|", F.col(key).cast("string"), F.lit(str(seed))))


def class_totals(df: DataFrame, by: str) -> DataFrame:
    return df.groupBy(F.col(by).alias("_by")).agg(F.count(F.lit(1)).alias("_n"))


def hash_cuts(
    df: DataFrame,
    key: str,
    by: str,
    ranks: Callable[[DataFrame], DataFrame],
    seed: int = 42,
) -> DataFrame:
    """``_by, _cuts``: per class the (hash, key) at each wanted rank, ascending.

    ``ranks`` maps the totals ``_by, _n`` to ``_by, _ranks array<bigint>``. A rank
    of 0 gives a cut below every row.
    """
    rows = df.select(F.col(by).alias("_by"), F.col(key).alias("_key"), hash_order(key, seed).alias("_h"))
    rows = rows.withColumn("_b", F.substring("_h", 1, PREFIX))
    buckets = materialize(
        rows.groupBy("_by", "_b").agg(F.count(F.lit(1)).alias("_c")), "hash-buckets"
    )
    totals = buckets.groupBy("_by").agg(F.sum("_c").alias("_n"))
    wanted = ranks(totals).select("_by", F.posexplode("_ranks").alias("_no", "_rank"))

    running = Window.partitionBy("_by").orderBy("_b")
    spans = buckets.select("_by", "_b", "_c", F.sum("_c").over(running).alias("_hi")).withColumn(
        "_lo", F.col("_hi") - F.col("_c")
    )
    same = F.col("w._by").eqNullSafe(F.col("s._by"))
    places = materialize(
        wanted.alias("w")
        .join(
            spans.alias("s"),
            same & (F.col("_rank") > F.col("_lo")) & (F.col("_rank") <= F.col("_hi")),
            "left",
        )
        .select("w._by", "_no", "_rank", "_b", (F.col("_rank") - F.col("_lo")).alias("_within")),
        "cut-places",
    )
    # Only the rows of the buckets that hold a cut are ranked.
    order = Window.partitionBy("_by", "_no").orderBy("_h", "_key")
    edge = (
        rows.alias("r")
        .join(
            places.filter(F.col("_b").isNotNull()).alias("p"),
            F.col("r._by").eqNullSafe(F.col("p._by")) & (F.col("r._b") == F.col("p._b")),
        )
        .select("r._by", "p._no", "p._within", "_h", "_key")
        .withColumn("_at", F.row_number().over(order))
        .filter(F.col("_at") == F.col("_within"))
        .select("_by", "_no", "_h", "_key")
    )
    none = places.filter(F.col("_b").isNull()).select(
        "_by", "_no", F.lit("").alias("_h"), F.lit(None).cast(rows.schema["_key"].dataType).alias("_key")
    )
    cut = F.struct("_no", "_h", "_key")
    return materialize(
        edge.unionByName(none).groupBy("_by").agg(F.sort_array(F.collect_list(cut)).alias("_cuts")),
        "hash-cuts",
    )


def cuts_before(
    df: DataFrame,
    key: str,
    by: str,
    ranks: Callable[[DataFrame], DataFrame],
    out: str,
    seed: int = 42,
) -> DataFrame:
    """Add ``out``: how many of the class's cuts lie strictly before the row.

    A row whose rank is at most the first wanted rank gets 0, and so on. The cuts
    table has one row per class, so the join is a broadcast by its file size.
    """
    cuts = hash_cuts(df, key, by, ranks, seed)
    mine = F.struct(F.col("_h").alias("h"), F.col("_key").alias("k"))
    passed = F.size(
        F.filter(
            F.col("_cuts"), lambda c: F.struct(c["_h"].alias("h"), c["_key"].alias("k")) < mine
        )
    )
    return (
        df.withColumn("_h", hash_order(key, seed))
        .withColumn("_key", F.col(key))
        .join(cuts, F.col(by).eqNullSafe(cuts["_by"]))
        .withColumn(out, passed)
        .drop("_h", "_key", "_by", "_cuts")
    )


def with_place(df: DataFrame, order: str, out: str) -> DataFrame:
    """Add the row's place (from 0) in the order of a column of distinct values.

    Rows are cut into ranges; a place is the range's start plus the place inside it, so no task
    sees all rows.
    """
    inside = F.row_number().over(Window.partitionBy("_part").orderBy(order)) - 1
    ranged = df.repartitionByRange(order).withColumn("_part", F.spark_partition_id())
    ranged = materialize(ranged.withColumn("_in", inside), "places")
    sizes = ranged.groupBy("_part").agg(F.count(F.lit(1)).alias("_c"))
    running = Window.partitionBy(F.lit(1)).orderBy("_part")  # one row per range
    starts = sizes.select("_part", (F.sum("_c").over(running) - F.col("_c")).alias("_start"))
    placed = ranged.join(F.broadcast(starts), "_part")
    return placed.withColumn(out, F.col("_start") + F.col("_in")).drop("_part", "_in", "_start")
