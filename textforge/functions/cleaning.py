"""Text cleaners.

Each step is one native column expression; ``with_clean`` chains only the enabled
ones, always in the order tags, entities, URLs, lowercase, punctuation, digits,
emoji, stop words, whitespace.
"""

from __future__ import annotations

import html
from collections.abc import Callable
from dataclasses import dataclass, replace

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textforge.functions import patterns as P
from textforge.functions.stopwords import STOP_WORDS
from textforge.functions.tokens import word_tokens, ws_tokens


@dataclass(frozen=True)
class CleanOptions:
    lowercase: bool = True
    remove_punctuation: bool = True
    remove_numbers: bool = True
    remove_stopwords: bool = False
    remove_urls: bool = False
    remove_emojis: bool = False
    remove_html_tags: bool = False
    remove_extra_whitespace: bool = True
    unescape: bool = True
    null_text: str = "empty"  # "empty" -> '', "nan" -> the word nan
    wide_emoji: bool = True
    stop_words: tuple[str, ...] = STOP_WORDS

    def __post_init__(self):
        if self.null_text not in ("empty", "nan"):
            raise ValueError(f"null_text must be 'empty' or 'nan', not {self.null_text!r}")


DEFAULT = CleanOptions()
FULL = CleanOptions(
    remove_stopwords=True, remove_urls=True, remove_emojis=True, remove_html_tags=True
)
LIGHT = CleanOptions(unescape=False)
PROFILES = {"default": DEFAULT, "full": FULL, "light": LIGHT}


def options(profile: str | CleanOptions = "full", **changes) -> CleanOptions:
    base = PROFILES[profile] if isinstance(profile, str) else profile
    return replace(base, **changes)


def fill_null_text(text: Column, null_text: str = "empty") -> Column:
    return F.coalesce(text.cast("string"), F.lit("nan" if null_text == "nan" else ""))


def _has(text: Column, *marks: str) -> Column:
    found = F.contains(text, F.lit(marks[0]))
    for mark in marks[1:]:
        found = found | F.contains(text, F.lit(mark))
    return found


def _where(found: Column, changed: Column, text: Column) -> Column:
    """Run a pattern only on texts that hold its fixed part: a byte search is far cheaper."""
    return F.when(found, changed).otherwise(text)


def strip_tags(text: Column) -> Column:
    return _where(_has(text, "<"), F.regexp_replace(text, P.TAG, ""), text)


@F.pandas_udf(T.StringType())
def _unescape(texts: pd.Series) -> pd.Series:
    return texts.map(html.unescape, na_action="ignore")


def unescape(text: Column) -> Column:
    """All named and numeric HTML entities.

    The full entity table has no native twin, so this step alone goes through
    Arrow; rows without ``&`` cross as nulls and keep their text.
    """
    return F.coalesce(_unescape(F.when(_has(text, "&"), text)), text)


def strip_urls(text: Column) -> Column:
    return _where(_has(text, "://", "www."), F.regexp_replace(text, P.URL, ""), text)


def strip_punctuation(text: Column) -> Column:
    return F.regexp_replace(text, P.drop_chars(P.NOT_WORD_OR_SPACE), "")


def strip_digits(text: Column) -> Column:
    return F.regexp_replace(text, P.drop_chars(P.DIGIT), "")


def strip_emoji(text: Column, wide: bool = True) -> Column:
    return F.regexp_replace(text, P.drop_chars(P.emoji_class(wide)), "")


def drop_stop_words(text: Column, stop_words=STOP_WORDS) -> Column:
    kept = F.filter(word_tokens(text), lambda w: ~w.isin(*stop_words))
    return F.array_join(kept, " ")


def strip_ends(text: Column) -> Column:
    return F.btrim(text, F.lit(P.SPACE_CHARS))


def squeeze_space(text: Column) -> Column:
    return F.trim(F.regexp_replace(text, P.SPACE_RUN, " "))


def clean_steps(opts: CleanOptions = FULL) -> list[Callable[[Column], Column]]:
    """The enabled steps in order.

    Punctuation, digits and emoji all delete single characters and follow each other,
    so they are one pass. Stop-word removal leaves single spaces, so no squeeze then.
    """
    steps: list[Callable[[Column], Column]] = [lambda t: fill_null_text(t, opts.null_text)]
    if opts.remove_html_tags:
        steps.append(strip_tags)
    if opts.unescape:
        steps.append(unescape)
    if opts.remove_urls:
        steps.append(strip_urls)
    if opts.lowercase:
        steps.append(F.lower)
    dropped = []
    if opts.remove_punctuation:
        dropped.append(P.NOT_WORD_OR_SPACE)
    if opts.remove_numbers:
        dropped.append(P.DIGIT)
    if opts.remove_emojis:
        dropped.append(P.emoji_class(opts.wide_emoji))
    if dropped:
        steps.append(lambda t: F.regexp_replace(t, P.drop_chars(*dropped), ""))
    if opts.remove_stopwords:
        steps.append(lambda t: drop_stop_words(t, opts.stop_words))
    elif opts.remove_extra_whitespace:
        steps.append(squeeze_space)
    return steps


def with_clean(
    df: DataFrame, text: str, out: str = "cleaned", opts: CleanOptions = FULL
) -> DataFrame:
    """Add the cleaned text. One projection per step, so no step is computed twice."""
    df = df.withColumn(out, F.col(text))
    for step in clean_steps(opts):
        df = df.withColumn(out, step(F.col(out)))
    return df


def notebook_text(text: Column, newline: str = "") -> Column:
    """Lowercase, strip, drop newlines, keep only basic characters."""
    out = strip_ends(F.lower(text))
    out = F.replace(out, F.lit("\n"), F.lit(newline))
    return F.regexp_replace(out, P.drop_chars(P.NOT_BASIC), "")


def notebook_tokens(text: Column, stop_words, newline: str = "") -> Column:
    tokens = ws_tokens(notebook_text(text, newline))
    return F.filter(tokens, lambda w: ~w.isin(*stop_words))
