"""Token lists, n-grams, per-row term counts and length features."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textforge.functions import patterns as P


def _all_matches(text: Column, pattern: str) -> Column:
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(0))


def word_tokens(text: Column) -> Column:
    """Maximal runs of word characters."""
    return _all_matches(text, P.WORD_RUN)


def ws_tokens(text: Column) -> Column:
    """Split on whitespace, no empty strings."""
    return F.filter(F.split(text, P.SPACE_RUN), lambda w: w != "")


def term_tokens(text: Column, stop_words=()) -> Column:
    """Vectorizer tokens: lowercase runs of two or more word characters, stop words out."""
    tokens = _all_matches(F.lower(text), P.TERM_RUN)
    return F.filter(tokens, lambda w: ~w.isin(*stop_words)) if stop_words else tokens


def ngrams(tokens: Column, low: int = 1, high: int = 1) -> Column:
    """All n-grams with ``low <= n <= high``, words joined by one space.

    ``tokens`` is used several times: pass a column, not a long expression.
    """
    if not 1 <= low <= high:
        raise ValueError(f"bad n-gram range ({low}, {high})")
    grams, parts = tokens, [tokens] if low == 1 else []
    for n in range(2, high + 1):
        size = F.greatest(F.size(tokens) - F.lit(n - 1), F.lit(0))
        grams = F.zip_with(
            F.slice(grams, F.lit(1), size),
            F.slice(tokens, F.lit(n), size),
            lambda a, b: F.concat(a, F.lit(" "), b),
        )
        if n >= low:
            parts.append(grams)
    return F.concat(*parts) if len(parts) > 1 else parts[0]


def with_term_counts(df: DataFrame, terms: str, out: str = "counts") -> DataFrame:
    """Replace the term array by ``out: array<struct<term, tf>>``, counted inside the row.

    In the sorted array a run starts where a term differs from its left neighbour;
    its length is the distance to the next start. No shuffle by document is needed.
    """
    starts = F.filter(
        F.transform(
            F.col("_sorted"),
            lambda t, i: F.when(~t.eqNullSafe(F.get(F.col("_sorted"), i - 1)), i),
        ),
        lambda p: p.isNotNull(),
    )
    ends = F.slice(
        F.concat(F.col("_starts"), F.array(F.size("_sorted"))), F.lit(2), F.size("_starts")
    )
    counts = F.zip_with(
        F.col("_starts"),
        ends,
        lambda p, e: F.struct(F.get(F.col("_sorted"), p).alias("term"), (e - p).alias("tf")),
    )
    return (
        df.withColumn("_sorted", F.sort_array(F.col(terms)))
        .drop(terms)
        .withColumn("_starts", starts)
        .withColumn(out, counts)
        .drop("_sorted", "_starts")
    )


def explode_terms(df: DataFrame, terms, *keep, name: str = "word", position: bool = False) -> DataFrame:
    """One row per array element.

    Outer generators, with the nulls filtered afterwards: for an inner one the
    optimizer adds ``size(array) > 0`` below the projections that build the array and
    so computes the array twice.
    """
    if position:
        out = df.select(*keep, F.posexplode_outer(terms).alias("pos", name))
    else:
        out = df.select(*keep, F.explode_outer(terms).alias(name))
    return out.filter(F.col(name).isNotNull())


def count_chars(text: Column, chars: str) -> Column:
    return F.char_length(text) - F.char_length(F.translate(text, chars, ""))


def text_features(text: Column, stop_words) -> dict[str, Column]:
    tokens = ws_tokens(text)
    return {
        "word_count": F.size(tokens),
        "num_stop_words": F.size(F.filter(tokens, lambda w: w.isin(*stop_words))),
        "num_chars": F.char_length(text),
        "num_punc_chars": count_chars(text, P.PUNCTUATION_CHARS),
    }
