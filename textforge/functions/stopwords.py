"""Stop-word lists. Every operator also takes a list or a table of its own."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# The built-in short list.
STOP_WORDS = tuple(
    """
    i me my myself we our ours ourselves you your yours he him his himself she her hers
    herself it its itself they them their theirs themselves a an and if or because as until
    while of at by for with without after upon but not to is are was were be been being have
    has had having do does did doing will would shall should may might must the then than so
    too very just
    """.split()
)

# Negations the notebook cleaner keeps.
KEPT_NEGATIONS = ("not", "no", "however", "but", "yet")


def english_stop_words() -> tuple[str, ...]:
    """Spark ML's own English list (needs a running session)."""
    from pyspark.ml.feature import StopWordsRemover

    return tuple(StopWordsRemover.loadDefaultStopWords("english"))


def word_table(spark: SparkSession, words) -> DataFrame:
    """A fixed word list as a one-column table ``word``."""
    rows = ", ".join("('" + w.replace("\\", "\\\\").replace("'", "\\'") + "')" for w in words)
    return spark.sql(f"SELECT DISTINCT word FROM VALUES {rows} AS t(word)")


def without_negations(stop_words: DataFrame) -> DataFrame:
    """Stop-word set minus the kept negations."""
    return stop_words.subtract(word_table(stop_words.sparkSession, KEPT_NEGATIONS))
