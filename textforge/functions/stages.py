"""Cleaner and tokenizer as Spark ML stages, saved and loaded with a pipeline."""

from __future__ import annotations

from dataclasses import asdict

from pyspark import keyword_only
from pyspark.ml import Transformer
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCol, HasOutputCol
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textforge.functions.cleaning import FULL, CleanOptions, with_clean
from textforge.functions.tokens import ngrams, term_tokens


class TextCleaner(
    Transformer, HasInputCol, HasOutputCol, DefaultParamsReadable, DefaultParamsWritable
):
    """Column of cleaned text."""

    steps = Param(
        Params._dummy(), "steps", "cleaner options that are on", TypeConverters.toListString
    )
    stopWords = Param(
        Params._dummy(), "stopWords", "words to drop", TypeConverters.toListString
    )
    nullText = Param(Params._dummy(), "nullText", "null policy", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, inputCol=None, outputCol=None, steps=None, stopWords=None, nullText=None):
        super().__init__()
        self._set(**self._input_kwargs)

    @classmethod
    def of(cls, opts: CleanOptions = FULL, inputCol: str = "text", outputCol: str = "cleaned"):
        steps = [name for name, on in asdict(opts).items() if on is True]
        return cls(
            inputCol=inputCol,
            outputCol=outputCol,
            steps=steps,
            stopWords=list(opts.stop_words),
            nullText=opts.null_text,
        )

    def options(self) -> CleanOptions:
        on = set(self.getOrDefault(self.steps))
        flags = {name: name in on for name, v in asdict(FULL).items() if isinstance(v, bool)}
        return CleanOptions(
            **flags,
            null_text=self.getOrDefault(self.nullText),
            stop_words=tuple(self.getOrDefault(self.stopWords)),
        )

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return with_clean(dataset, self.getInputCol(), self.getOutputCol(), self.options())


class TermTokenizer(
    Transformer, HasInputCol, HasOutputCol, DefaultParamsReadable, DefaultParamsWritable
):
    """Column of vectorizer terms: tokens without stop words, then n-grams."""

    low = Param(Params._dummy(), "low", "shortest n-gram", TypeConverters.toInt)
    high = Param(Params._dummy(), "high", "longest n-gram", TypeConverters.toInt)
    stopWords = Param(
        Params._dummy(), "stopWords", "words to drop", TypeConverters.toListString
    )

    @keyword_only
    def __init__(self, *, inputCol=None, outputCol=None, low=1, high=1, stopWords=()):
        super().__init__()
        self._set(**self._input_kwargs)
        self._setDefault(low=1, high=1, stopWords=[])

    def _transform(self, dataset: DataFrame) -> DataFrame:
        text = F.coalesce(F.col(self.getInputCol()), F.lit(""))
        words = term_tokens(text, self.getOrDefault(self.stopWords))
        terms = ngrams(
            F.col("_words"), self.getOrDefault(self.low), self.getOrDefault(self.high)
        )
        return (
            dataset.withColumn("_words", words)
            .withColumn(self.getOutputCol(), terms)
            .drop("_words")
        )
