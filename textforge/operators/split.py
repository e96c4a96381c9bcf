"""Train/test splits, folds, under-sampling and class weights."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from textforge.operators.ranks import cuts_before, hash_order
from textforge.session import materialize


def _train_test(passed: str) -> F.Column:
    return F.when(F.col(passed) == 0, "test").otherwise("train")


def random_split(
    df: DataFrame, key: str, test_size: float = 0.2, seed: int = 42, exact: bool = True
) -> DataFrame:
    """Add ``split``. Exact: ``ceil(test_size * n)`` test rows.

    ``exact=False`` compares one hash per row with the share: no pass over the
    counts, and a row keeps its side when other rows come or go.
    """
    if not exact:
        bucket = F.conv(F.substring(hash_order(key, seed), 1, 8), 16, 10).cast("bigint")
        below = bucket < F.lit(int(round(test_size * 2**32)))
        return df.withColumn("split", F.when(below, "test").otherwise("train"))

    def ranks(totals: DataFrame) -> DataFrame:
        test = F.ceil(F.round(F.col("_n") * F.lit(test_size), 6))
        return totals.select("_by", F.array(test.cast("bigint")).alias("_ranks"))

    whole = df.withColumn("_all", F.lit(1))
    out = cuts_before(whole, key, "_all", ranks, "_passed", seed)
    return out.withColumn("split", _train_test("_passed")).drop("_all", "_passed")


def stratified_split(
    df: DataFrame, key: str, label: str, test_size: float = 0.2, seed: int = 42
) -> DataFrame:
    """Add ``split`` with every class in proportion.

    ``ceil(test_size * n)`` test rows in all. The train rows are shared out by class
    size, the left-over ones to the largest remainders (ties: smaller label first).
    """

    def ranks(totals: DataFrame) -> DataFrame:
        everyone = Window.partitionBy(F.lit(1))  # one row per class
        n = F.sum("_n").over(everyone)
        shares = (
            totals.select("_by", "_n", n.alias("_all"))
            .withColumn("_train", F.col("_all") - F.ceil(F.round(F.col("_all") * test_size, 6)))
            # Products of two row counts need more than 64 bits.
            .withColumn("_p", F.expr("CAST(_n AS DECIMAL(18,0)) * CAST(_train AS DECIMAL(18,0))"))
            .withColumn("_floor", F.expr("_p div CAST(_all AS DECIMAL(18,0))"))
            .withColumn("_rest", F.expr("_p % CAST(_all AS DECIMAL(18,0))"))
        )
        spare = F.col("_train") - F.sum("_floor").over(everyone)
        place = F.row_number().over(everyone.orderBy(F.desc("_rest"), "_by"))
        train = F.col("_floor") + F.when(place <= spare, 1).otherwise(0)
        return shares.select(
            "_by", F.array((F.col("_n") - train).cast("bigint")).alias("_ranks")
        )

    out = cuts_before(df, key, label, ranks, "_passed", seed)
    return out.withColumn("split", _train_test("_passed")).drop("_passed")


def kfold(df: DataFrame, key: str, label: str, folds: int = 5, seed: int = 42) -> DataFrame:
    """Add ``fold`` in ``0..folds-1``: every class cut into equal parts of its hash order."""

    def ranks(totals: DataFrame) -> DataFrame:
        ends = [F.expr(f"_n * {i} div {folds}") for i in range(1, folds)]
        return totals.select("_by", F.array(*ends).alias("_ranks"))

    return cuts_before(df, key, label, ranks, "fold", seed)


def undersample(df: DataFrame, key: str, label: str, seed: int = 42) -> DataFrame:
    """Every class cut to the size of the smallest."""

    def ranks(totals: DataFrame) -> DataFrame:
        least = F.min("_n").over(Window.partitionBy(F.lit(1)))  # one row per class
        return totals.select("_by", F.array(least).alias("_ranks"))

    out = cuts_before(df, key, label, ranks, "_passed", seed)
    return out.filter(F.col("_passed") == 0).drop("_passed")


def class_weights(df: DataFrame, label: str) -> DataFrame:
    """``label, n, weight`` with the balanced weight ``n / (K * n_c)``."""
    counts = (
        df.filter(F.col(label).isNotNull())
        .groupBy(F.col(label).alias("label"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    everyone = Window.partitionBy(F.lit(1))  # one row per class
    k, total = F.count(F.lit(1)).over(everyone), F.sum("n").over(everyone)
    return counts.withColumn("weight", total / (k * F.col("n")))


def with_class_weight(df: DataFrame, label: str, out: str = "weight") -> DataFrame:
    """Balanced weight on every row; the class table is broadcast by its file size."""
    weights = materialize(
        class_weights(df, label).select(F.col("label").alias("_label"), F.col("weight").alias(out)),
        "class-weights",
    )
    return df.join(weights, df[label] == weights["_label"]).drop("_label")
