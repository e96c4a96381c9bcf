"""CSV, folder and line sources with the dataset checks."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textforge.functions import patterns as P

# Cell texts read as null.
NA_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)

CSV_OPTIONS = {"header": "true", "quote": '"', "escape": '"'}


class DatasetError(ValueError):
    """The input is missing, empty, of an unknown format or lacks a column."""


def na_to_null(df: DataFrame) -> DataFrame:
    """Null-token cells of every string column become null."""
    return df.select(
        *(
            F.when(~F.col(f.name).isin(*NA_TOKENS), F.col(f.name)).alias(f.name)
            if isinstance(f.dataType, T.StringType)
            else F.col(f.name)
            for f in df.schema.fields
        )
    )


def check_columns(df: DataFrame, *required: str) -> DataFrame:
    missing = [name for name in required if name not in df.columns]
    if missing:
        raise DatasetError(f"missing required columns: {', '.join(missing)}")
    return df


def read_csv(
    spark: SparkSession,
    path,
    *,
    encoding: str = "utf-8",
    schema=None,
    infer: bool = False,
    multi_line: bool = True,
    **options,
) -> DataFrame:
    """CSV with header, quoted fields and null tokens.

    Fields may hold line breaks unless ``multi_line`` is off; a file is then read in several splits,
    otherwise by one task. ``options`` go to the reader.

    Columns are strings unless ``schema`` or ``infer`` says otherwise; inference
    reads the data once more, after the null tokens are out.
    """
    reader = spark.read.options(**CSV_OPTIONS).option("encoding", encoding)
    reader = reader.option("multiLine", multi_line).options(**options)
    if schema is None:
        df = na_to_null(reader.csv(path))
        return _narrow_types(df) if infer else df
    strings = T.StructType(
        [T.StructField(f.name, T.StringType()) for f in _as_struct(schema).fields]
    )
    df = na_to_null(reader.option("enforceSchema", "false").schema(strings).csv(path))
    return df.select(*(F.col(f.name).cast(f.dataType) for f in _as_struct(schema).fields))


def _as_struct(schema) -> T.StructType:
    return schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)


def _narrow_types(df: DataFrame) -> DataFrame:
    """Cast string columns whose non-null cells all parse as a number."""
    strings = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    if not strings:
        return df
    checks = []
    for i, name in enumerate(strings):
        # A cast to double also takes "inf" or "1d", so ask for plain digits.
        whole = F.col(name).rlike(r"^\s*[+-]?\d{1,18}\s*$")
        number = F.col(name).rlike(r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$")
        checks += [
            F.count_if(~whole).alias(f"w{i}"),
            F.count_if(~number).alias(f"n{i}"),
            F.count(F.col(name)).alias(f"c{i}"),
        ]
    found = df.agg(*checks).first()
    types = {}
    for i, name in enumerate(strings):
        if found[f"c{i}"] and not found[f"w{i}"]:
            types[name] = "bigint"
        elif found[f"c{i}"] and not found[f"n{i}"]:
            types[name] = "double"
    return df.select(
        *(F.trim(F.col(c)).cast(types[c]).alias(c) if c in types else F.col(c) for c in df.columns)
    )


def load_labelled(
    spark: SparkSession,
    path: str,
    text_column: str,
    label_column: str,
    *,
    encoding: str = "utf-8",
    schema=None,
    infer: bool = False,
    multi_line: bool = True,
    **options,
) -> DataFrame:
    """A labelled CSV, checked: path, suffix, required columns, at least one row.

    The other arguments are those of :func:`read_csv`.
    """
    if not path.rstrip("/").endswith(".csv"):
        raise DatasetError(f"unsupported file format: {path}")
    try:
        df = read_csv(
            spark, path, encoding=encoding, schema=schema, infer=infer, multi_line=multi_line, **options
        )
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            raise DatasetError(f"data file not found: {path}") from error
        raise DatasetError(f"cannot read {path}: {error}") from error
    if not df.columns:
        raise DatasetError(f"data file is empty: {path}")
    check_columns(df, text_column, label_column)
    if df.isEmpty():
        raise DatasetError(f"data file has no rows: {path}")
    return df


def read_csv_folder(spark: SparkSession, folder: str, **options) -> DataFrame:
    """All CSV files of a folder as one table."""
    try:
        return read_csv(spark, folder, pathGlobFilter="*.csv", **options)
    except AnalysisException as error:
        raise DatasetError(f"no CSV file found in {folder}") from error


def clean_lines(lines: DataFrame) -> DataFrame:
    """Stripped, non-blank lines of a one-column ``value`` table (batch or stream)."""
    text = F.btrim("value", F.lit(P.SPACE_CHARS)).alias("text")
    return lines.select(text).filter(F.col("text") != "")


def read_lines(spark: SparkSession, path) -> DataFrame:
    """One text per line, stripped, blank lines skipped."""
    return clean_lines(spark.read.text(path))
