"""Label encoding: classes sorted as strings, codes 0..K-1."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textforge.operators.ranks import with_place
from textforge.session import materialize


def class_table(df: DataFrame, label: str, null_label: str | None = None) -> DataFrame:
    """``label, code``. Null labels are left out, or become the class ``null_label``."""
    text = F.col(label).cast("string")
    if null_label is not None:
        text = F.coalesce(text, F.lit(null_label))
    classes = df.select(text.alias("label")).filter("label IS NOT NULL").distinct()
    return with_place(classes, "label", "code").withColumn("code", F.col("code").cast("int"))


def encode_labels(
    df: DataFrame, label: str, out: str = "code", null_label: str | None = None
) -> tuple[DataFrame, DataFrame]:
    """Rows with their class code, and the class table.

    The class table is written once; joins against it are broadcast by its file size.
    """
    classes = materialize(class_table(df, label, null_label), "classes")
    return apply_classes(df, classes, label, out, null_label), classes


def apply_classes(
    df: DataFrame, classes: DataFrame, label: str, out: str = "code", null_label: str | None = None
) -> DataFrame:
    text = F.col(label).cast("string")
    if null_label is not None:
        text = F.coalesce(text, F.lit(null_label))
    coded = classes.select(F.col("label").alias("_class"), F.col("code").alias(out))
    return df.withColumn("_label", text).join(
        coded, F.col("_label") == F.col("_class")
    ).drop("_label", "_class")


def decode_labels(df: DataFrame, code: str, classes: DataFrame, out: str = "label") -> DataFrame:
    names = classes.select(F.col("code").alias("_code"), F.col("label").alias(out))
    return df.join(names, F.col(code).cast("int") == F.col("_code")).drop("_code")


def class_names(classes: DataFrame) -> list[str]:
    """The class list on the driver, for model stages, which hold a number per class and row anyway."""
    return [row["label"] for row in classes.orderBy("code").collect()]
