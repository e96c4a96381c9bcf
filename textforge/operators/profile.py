"""Dataset profile: counts, missing values, class shares, duplicates, lengths."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textforge.functions import patterns as P
from textforge.session import materialize


def data_stats(df: DataFrame, text: str, label: str) -> DataFrame:
    """Rows, columns, missing text and label, distinct labels and each label's share; one pass."""
    counts = df.groupBy(F.col(label).cast("string").alias("label")).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col(text).isNull()).alias("no_text")
    )
    known = F.col("label").isNotNull()
    shares = F.filter(F.col("each"), lambda e: e["label"].isNotNull())
    named = F.transform(
        F.array_sort(shares),
        lambda e: F.concat(e["label"], F.lit(":"), F.round(e["n"] / F.col("known_rows"), 4)),
    )
    return counts.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total_rows"),
        F.lit(len(df.columns)).cast("int").alias("total_columns"),
        F.coalesce(F.sum("no_text"), F.lit(0)).alias("missing_text"),
        F.coalesce(F.sum(F.when(~known, F.col("n"))), F.lit(0)).alias("missing_label"),
        F.count_if(known).alias("unique_labels"),
        F.sum(F.when(known, F.col("n"))).alias("known_rows"),
        F.collect_list(F.struct("label", "n")).alias("each"),
    ).select(
        "total_rows",
        "total_columns",
        "missing_text",
        "missing_label",
        "unique_labels",
        F.array_join(named, ",").alias("label_shares"),
    )


def missing_by_column(df: DataFrame) -> DataFrame:
    """``column, missing, pct`` from one pass over the table."""
    counts = df.agg(
        F.count(F.lit(1)).alias("total"),
        *(F.count_if(F.col(c).isNull()).alias(f"m{i}") for i, c in enumerate(df.columns)),
    )
    cells = F.array(
        *(
            F.struct(F.lit(c).alias("column"), F.col(f"m{i}").alias("missing"))
            for i, c in enumerate(df.columns)
        )
    )
    pct = F.when(F.col("total") > 0, F.round(F.col("missing") * 100 / F.col("total"), 6))
    return counts.select("total", F.inline(cells)).select("column", "missing", pct.alias("pct"))


def column_profile(df: DataFrame) -> DataFrame:
    """``column, dtype, non_null`` in column order."""
    counts = df.agg(*(F.count(F.col(c)).alias(f"c{i}") for i, c in enumerate(df.columns)))
    cells = F.array(
        *(
            F.struct(
                F.lit(i).alias("position"),
                F.lit(name).alias("column"),
                F.lit(dtype).alias("dtype"),
                F.col(f"c{i}").alias("non_null"),
            )
            for i, (name, dtype) in enumerate(df.dtypes)
        )
    )
    return counts.select(F.inline(cells))


def null_rows(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column).isNull())


def drop_null_rows(df: DataFrame) -> DataFrame:
    return df.na.drop("any")


def is_blank(text: Column) -> Column:
    return F.btrim(text, F.lit(P.SPACE_CHARS)) == ""


def blank_rows(df: DataFrame, text: str) -> DataFrame:
    return df.filter(is_blank(F.col(text)))


def non_blank_rows(df: DataFrame, text: str) -> DataFrame:
    return df.filter(~is_blank(F.col(text)))


def has_edge_space(text: Column) -> Column:
    return text.startswith(" ") | text.endswith(" ")


def has_url(text: Column) -> Column:
    return text.rlike(P.URL_PROFILE)


def has_newline(text: Column) -> Column:
    return F.contains(text, F.lit("\n"))


def distinct_labels(df: DataFrame, label: str) -> DataFrame:
    """Distinct labels; a null counts as one."""
    return df.select(F.col(label).alias("label")).distinct()


def n_classes(df: DataFrame, label: str) -> DataFrame:
    return df.agg(F.count_distinct(F.col(label)).alias("n_classes"))


def label_counts(df: DataFrame, label: str) -> DataFrame:
    return df.groupBy(F.col(label).alias("label")).agg(F.count(F.lit(1)).alias("n"))


def label_shares(df: DataFrame, label: str, *within: str) -> DataFrame:
    """Class counts and shares, nulls left out, optionally inside each ``within`` group.

    The total is a window over the counted table: one row per class.
    """
    counts = (
        df.filter(F.col(label).isNotNull())
        .groupBy(*within, F.col(label).alias("label"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    total = F.sum("n").over(Window.partitionBy(*(within or (F.lit(1),))))
    return counts.withColumn("share", F.col("n") / total)


def content_key(*columns: str) -> Column:
    """Digest of a row's content: long texts are grouped by 32 bytes instead of themselves."""
    cells = [
        F.coalesce(
            F.concat(F.length(F.col(c).cast("string")), F.lit(":"), F.col(c).cast("string")),
            F.lit("-"),
        )
        for c in columns
    ]
    return F.unhex(F.sha2(F.concat_ws("|", *cells), 256))


def duplicate_count(df: DataFrame, *columns: str) -> DataFrame:
    """Rows beyond the first of each content."""
    groups = df.groupBy(content_key(*columns).alias("k")).agg(F.count(F.lit(1)).alias("n"))
    return groups.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("duplicates"))


def _repeated_keys(df: DataFrame, key: str, columns) -> DataFrame:
    """Keys of the rows that repeat the content of a row with a smaller key.

    Keys and digests are written once, so the text is read once. The first key of a
    content comes from a partial aggregation; the join back holds one row per
    repeated content on one side, and adaptive execution splits a hot one on the other.
    """
    rows = materialize(df.select(key, content_key(*columns).alias("k")), "content-keys")
    firsts = (
        rows.groupBy("k")
        .agg(F.min(key).alias("first"), F.count(F.lit(1)).alias("n"))
        .filter("n > 1")
    )
    repeated = rows.join(firsts, "k").filter(F.col(key) != F.col("first"))
    return materialize(repeated.select(key), "repeated-keys")


def drop_duplicate_rows(df: DataFrame, key: str, *columns: str) -> DataFrame:
    """Keep the row with the smallest key of each content.

    The rows meet only the keys to drop: broadcast when those are few, by their file
    size, so the texts are not shuffled.
    """
    return df.join(_repeated_keys(df, key, columns), key, "left_anti")


def duplicate_rows(df: DataFrame, key: str, *columns: str) -> DataFrame:
    """The rows :func:`drop_duplicate_rows` removes."""
    return df.join(_repeated_keys(df, key, columns), key, "left_semi")


def numeric_summary(df: DataFrame, column: str) -> DataFrame:
    """Count, mean, sample deviation, min, quartiles (interpolated) and max, all exact.

    Values are counted, then cut into ranges; a value's rank is its range's start plus
    a running count inside the range, so no task sees all distinct values. Mean and deviation
    come from the column itself, whose aggregates merge without cancellation.
    """
    counted = (
        df.filter(F.col(column).isNotNull())
        .groupBy(F.col(column).alias("x"))
        .agg(F.count(F.lit(1)).alias("n"))
        .repartitionByRange("x")
        .withColumn("part", F.spark_partition_id())
    )
    counted = materialize(counted, "value-counts")
    ranges = counted.groupBy("part").agg(F.sum("n").alias("c"))
    everyone = Window.partitionBy(F.lit(1))  # one row per range
    starts = ranges.select(
        "part",
        (F.sum("c").over(everyone.orderBy("part")) - F.col("c")).alias("start"),
        F.sum("c").over(everyone).alias("total"),
    )
    running = F.sum("n").over(Window.partitionBy("part").orderBy("x"))
    ranked = counted.join(F.broadcast(starts), "part").withColumn("hi", F.col("start") + running)

    def at(place: Column) -> Column:
        """The value at a 0-based place of the sorted column."""
        here = (place >= F.col("hi") - F.col("n")) & (place < F.col("hi"))
        return F.max(F.when(here, F.col("x").cast("double")))

    def quantile(q: float) -> Column:
        place = (F.col("total") - 1) * q
        share = F.max(place - F.floor(place))
        low, high = at(F.floor(place)), at(F.ceil(place))
        return F.round(low + (high - low) * share, 6)

    here = F.struct(
        F.count(column).alias("n"),
        F.avg(F.col(column).cast("double")).alias("mean"),
        F.stddev_samp(F.col(column).cast("double")).alias("std"),
    )
    return ranked.agg(
        F.min("x").cast("double").alias("min"),
        quantile(0.25).alias("p25"),
        quantile(0.5).alias("p50"),
        quantile(0.75).alias("p75"),
        F.max("x").cast("double").alias("max"),
    ).select(
        df.agg(here.alias("m")).scalar().alias("m"), "min", "p25", "p50", "p75", "max"
    ).select(
        F.col("m.n").alias("count"),
        F.round("m.mean", 6).alias("mean"),
        F.when(F.col("m.n") > 1, F.round("m.std", 6)).alias("std"),
        "min",
        "p25",
        "p50",
        "p75",
        "max",
    )


def histogram(df: DataFrame, column: str, width: int, *by: str) -> DataFrame:
    """Counts per group and bin; ``bin`` is the bin's lower bound."""
    return df.groupBy(*by, (F.floor(F.col(column) / width) * width).alias("bin")).agg(
        F.count(F.lit(1)).alias("n")
    )


def density(df: DataFrame, column: str, *by: str, points: int = 200, cut: float = 3.0) -> DataFrame:
    """Gaussian kernel estimate of a column per group: ``point`` (from 0), ``x`` and ``density``.

    The bandwidth follows Scott's rule, and the curve reaches ``cut`` bandwidths beyond the values.
    Values are counted first, so the work grows with distinct values and points, and sums are
    combined before the shuffle. Null values are left out; a group whose values do not differ has
    no curve.
    """
    values = df.where(F.col(column).isNotNull()).select(*by, F.col(column).cast("double").alias("v"))
    shape = values.groupBy(*(F.col(c).alias(f"of_{c}") for c in by)).agg(
        F.count(F.lit(1)).alias("rows"),
        (F.stddev_samp("v") * F.pow(F.count(F.lit(1)).cast("double"), F.lit(-0.2))).alias("width"),
        F.min("v").alias("low"),
        F.max("v").alias("high"),
    )
    shape = shape.where("width > 0")
    counted = values.groupBy(*by, "v").agg(F.count(F.lit(1)).alias("n"))
    same = F.lit(True)
    for c in by:
        same = same & F.col(c).eqNullSafe(F.col(f"of_{c}"))
    placed = counted.join(shape, same).withColumn("point", F.explode(F.sequence(F.lit(0), F.lit(points - 1))))
    step = (F.col("high") - F.col("low") + 2 * cut * F.col("width")) / (points - 1)
    placed = placed.withColumn("x", F.col("low") - cut * F.col("width") + F.col("point") * step)
    away = (F.col("x") - F.col("v")) / F.col("width")
    share = F.col("n") * F.exp(-away * away / 2) / (F.col("rows") * F.col("width") * math.sqrt(2 * math.pi))
    return placed.groupBy(*by, "point").agg(F.first("x").alias("x"), F.sum(share).alias("density"))


def head_rows(df: DataFrame, key: str, n: int) -> DataFrame:
    return df.orderBy(key).limit(n)


def sample_rows(df: DataFrame, key: str, n: int, seed: int = 42) -> DataFrame:
    """A repeatable random sample of exactly ``n`` rows: the smallest key hashes."""
    from textforge.operators.ranks import hash_order

    return df.orderBy(hash_order(key, seed), key).limit(n)
