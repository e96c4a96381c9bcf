"""N-gram vocabulary, count vectors and TF-IDF.

A fitted vectorizer is a Spark ML pipeline (tokenizer, vocabulary look-up, IDF
weights, unit length): transforming a row touches nothing but that row. The
vocabulary is the only state, at most ``max_features`` terms. Without a cap the
vocabulary may grow with the corpus, so that path stays relational
(:func:`tfidf_table`).
"""

from __future__ import annotations

import math
from dataclasses import dataclass, replace

from pyspark.ml import PipelineModel
from pyspark.ml.feature import CountVectorizerModel, ElementwiseProduct, Normalizer
from pyspark.ml.linalg import Vectors
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from textforge.functions.stages import TermTokenizer
from textforge.functions.stopwords import english_stop_words
from textforge.functions.tokens import explode_terms, ngrams, term_tokens, with_term_counts
from textforge.operators.ranks import with_place
from textforge.operators.terms import KNOWN_BYTES, count_grams, known_grams
from textforge.session import materialize

#: A fitted vectorizer holds its terms on the driver and in every task: so many bytes at most.
MAX_VOCABULARY_BYTES = 256 << 20


@dataclass(frozen=True)
class VectorizerOptions:
    method: str = "tfidf"
    max_features: int | None = 5000
    ngram_range: tuple[int, int] = (1, 1)
    stop_words: tuple[str, ...] | str | None = ()  # words, or "english" for Spark's list

    def __post_init__(self):
        if isinstance(self.stop_words, str) and self.stop_words != "english":
            raise ValueError(f"unknown stop-word list {self.stop_words!r}: use 'english' or words")
        if self.method not in ("tfidf", "count"):
            raise ValueError(f"unsupported method {self.method!r}: use 'tfidf' or 'count'")
        object.__setattr__(self, "ngram_range", tuple(self.ngram_range))

    @property
    def stop_list(self) -> tuple[str, ...]:
        if self.stop_words == "english":
            return english_stop_words()
        return tuple(self.stop_words or ())


def terms_of(df: DataFrame, text: str, opts: VectorizerOptions, out: str = "terms") -> DataFrame:
    """Add the row's term array (tokens, stop words out, n-grams)."""
    words = term_tokens(F.col(text), opts.stop_list)
    return (
        df.withColumn("_words", words)
        .withColumn(out, ngrams(F.col("_words"), *opts.ngram_range))
        .drop("_words")
    )


def document_terms(df: DataFrame, key: str, text: str, opts: VectorizerOptions) -> DataFrame:
    """Long form ``key, term, tf``; counted inside each row, nothing is shuffled."""
    rows = terms_of(df.select(key, F.col(text).alias("_text")), "_text", opts).drop("_text")
    counted = with_term_counts(rows, "terms")
    return explode_terms(counted, "counts", key, name="c").select(key, "c.term", "c.tf")


def term_stats(doc_terms: DataFrame) -> DataFrame:
    """``term, cf, df``: one shuffle, partially aggregated; no distinct."""
    return doc_terms.groupBy("term").agg(
        F.sum("tf").alias("cf"), F.count(F.lit(1)).alias("df")
    )


def vocabulary(stats: DataFrame, max_features: int | None = None) -> DataFrame:
    """``term, idx, cf, df``: the most frequent terms (ties: smaller term), indexed by term.

    With a cap the index window sorts at most ``max_features`` rows. Without one it
    is built from range-partitioned counts, so no task sees all terms.
    """
    if max_features is not None:
        top = stats.orderBy(F.desc("cf"), "term").limit(max_features)
        place = F.row_number().over(Window.partitionBy(F.lit(1)).orderBy("term")) - 1
        return top.select("term", place.alias("idx"), "cf", "df")
    return with_place(stats.select("term", "cf", "df"), "term", "idx").select("term", "idx", "cf", "df")


def idf(n_docs, df):
    """``ln((1 + n) / (1 + df)) + 1``"""
    return F.ln((F.lit(1) + n_docs) / (F.lit(1) + df)) + F.lit(1)


@dataclass
class Vectorizer:
    """A fitted vectorizer: ``pipeline`` for rows, ``vocab`` as a table."""

    pipeline: PipelineModel
    vocab: DataFrame
    n_docs: int
    options: VectorizerOptions

    @property
    def size(self) -> int:
        return len(self.pipeline.stages[1].vocabulary)

    def transform(self, df: DataFrame) -> DataFrame:
        return self.pipeline.transform(df).drop("_terms", "_counts", "_weighted")


def vector_stages(vocab_rows, n_docs: int, opts: VectorizerOptions, text: str, features: str):
    """The pipeline stages for a vocabulary in index order."""
    tokenizer = _tokenizer(opts, text)
    counted = features if opts.method == "count" else "_counts"
    counter = CountVectorizerModel.from_vocabulary(
        [row["term"] for row in vocab_rows], inputCol="_terms", outputCol=counted
    )
    if opts.method == "count":
        return [tokenizer, counter]
    weights = Vectors.dense([math.log((1 + n_docs) / (1 + row["df"])) + 1 for row in vocab_rows])
    return [
        tokenizer,
        counter,
        ElementwiseProduct(scalingVec=weights, inputCol="_counts", outputCol="_weighted"),
        Normalizer(p=2.0, inputCol="_weighted", outputCol=features),
    ]


def fit_vectorizer(
    df: DataFrame, text: str, opts: VectorizerOptions, features: str = "features"
) -> Vectorizer:
    """Count terms, keep the vocabulary and wrap it as pipeline stages.

    The model stages need the vocabulary on the driver; its size is checked first, and
    :func:`tfidf_table` takes any size. Rows are counted in the pass that tokenizes them.
    """
    return fit_transform(df, text, opts, features)[0]


def fit_transform(
    df: DataFrame, text: str, opts: VectorizerOptions, features: str = "features"
) -> tuple[Vectorizer, DataFrame]:
    """A fitted vectorizer and the rows it was fitted on, transformed; the text is tokenized once.

    Only the words are written; a vocabulary of up to ``KNOWN_BYTES`` then picks the rows' terms.
    """
    tokenizer = _tokenizer(replace(opts, ngram_range=(1, 1)), text)
    words = tokenizer.transform(df).withColumn("_words", F.array_join("_terms", " ")).drop("_terms")
    rows = materialize(words, "words")
    stats = frequent_stats(rows, "_words", opts)
    fitted = vectorizer_from_stats(stats, rows.count(), opts, text, features)
    vocab = fitted.pipeline.stages[1].vocabulary
    if sum(len(term.encode()) + 4 for term in vocab) <= KNOWN_BYTES:
        terms = known_grams(df.sparkSession, F.col("_words"), vocab, opts.ngram_range[1])
        rows = rows.withColumn("_terms", terms)
    else:
        rows = _joined_terms(rows, "_words", opts)
    weighing = PipelineModel(fitted.pipeline.stages[1:])
    return fitted, weighing.transform(rows).drop("_words", "_terms", "_counts", "_weighted")


def frequent_stats(df: DataFrame, words: str, opts: VectorizerOptions) -> DataFrame:
    """``term, cf, df`` of joined words: with a cap the most frequent terms at least, else all.

    An n-gram occurs no more often than any of its words. So with ``max_features`` single words
    known, the least frequent of these bounds the words whose n-grams need counting, and the result.
    """
    low, high = opts.ngram_range
    if opts.max_features is not None and high == 1:
        return count_grams(df, words, 1, 1)
    if opts.max_features is not None and low == 1:
        singles = materialize(count_grams(df, words, 1, 1), "word-stats")
        top = singles.orderBy(F.desc("cf")).limit(opts.max_features)
        n, least = top.agg(F.count(F.lit(1)), F.min("cf")).first()
        least = least if n == opts.max_features else 1
        often = singles.filter(F.col("cf") >= least).select(F.col("term").alias("word"))
        size = often.agg(F.sum(F.octet_length("word") + 4)).first()[0] or 0
        if size <= KNOWN_BYTES:
            found = singles.unionByName(count_grams(df, words, 2, high, often))
            return found.filter(F.col("cf") >= least)
    counted = with_term_counts(_joined_terms(df, words, opts).select("_terms"), "_terms")
    return term_stats(explode_terms(counted, "counts", name="c").select("c.term", "c.tf"))


def _joined_terms(df: DataFrame, words: str, opts: VectorizerOptions) -> DataFrame:
    """Add all ``_terms`` of a column of joined words."""
    tokens = F.filter(F.split(words, " "), lambda w: w != "")
    terms = ngrams(F.col("_tokens"), *opts.ngram_range)
    return df.withColumn("_tokens", tokens).withColumn("_terms", terms).drop("_tokens")


def _tokenizer(opts: VectorizerOptions, text: str) -> TermTokenizer:
    return TermTokenizer(
        inputCol=text,
        outputCol="_terms",
        low=opts.ngram_range[0],
        high=opts.ngram_range[1],
        stopWords=list(opts.stop_list),
    )


def vectorizer_from_stats(
    stats: DataFrame, n_docs: int, opts: VectorizerOptions, text: str, features: str = "features"
) -> Vectorizer:
    """The same from a ready ``term, cf, df`` table."""
    vocab = materialize(vocabulary(stats, opts.max_features), "vocabulary")
    size = vocab.agg(F.sum(F.octet_length("term") + 16)).first()[0] or 0
    if size > MAX_VOCABULARY_BYTES:
        raise ValueError(f"{size} bytes of terms: lower max_features or use tfidf_table")
    kept = vocab.orderBy("idx").collect()
    if not kept:
        raise ValueError("empty vocabulary: no text has a term")
    stages = vector_stages(kept, n_docs, opts, text, features)
    return Vectorizer(PipelineModel(stages), vocab, n_docs, opts)


def vector_entries(df: DataFrame, *keys: str, features: str = "features") -> DataFrame:
    """Non-zero entries of a sparse vector column as ``keys, idx, value``."""
    parts = F.unwrap_udt(F.col(features))
    entries = F.arrays_zip(parts["indices"].alias("idx"), parts["values"].alias("value"))
    return df.select(*keys, F.inline(entries)).filter("value <> 0")


def tfidf_table(df: DataFrame, key: str, text: str, opts: VectorizerOptions) -> DataFrame:
    """Long form ``key, term, idx, tf, weight`` by joins only, for any vocabulary size.

    A document's weights are normalised over its own rows, so the second shuffle is
    by document.
    """
    doc_terms = materialize(document_terms(df, key, text, opts), "document-terms")
    vocab = materialize(vocabulary(term_stats(doc_terms), opts.max_features), "vocabulary")
    n_docs = df.agg(F.count(F.lit(1))).scalar()
    raw = doc_terms.join(vocab, "term").withColumn(
        "_raw", F.col("tf") * (idf(n_docs, F.col("df")) if opts.method == "tfidf" else F.lit(1.0))
    )
    if opts.method == "count":
        return raw.select(key, "term", "idx", "tf", F.col("_raw").alias("weight"))
    norm = F.sqrt(F.sum(F.col("_raw") * F.col("_raw")).over(Window.partitionBy(key)))
    return raw.select(key, "term", "idx", "tf", (F.col("_raw") / norm).alias("weight"))


def vocabulary_coverage(stats: DataFrame, caps) -> DataFrame:
    """For each cap: terms kept and the share of all term occurrences they cover.

    Only the ``max(caps)`` most frequent terms are ranked.
    """
    top = stats.orderBy(F.desc("cf"), "term").limit(max(caps))
    place = F.row_number().over(Window.partitionBy(F.lit(1)).orderBy(F.desc("cf"), "term"))
    total = stats.agg(F.sum("cf")).scalar()
    ranked = top.select("cf", place.alias("place"))
    rows = ranked.select(
        "cf", "place", F.explode(F.array(*(F.lit(int(c)) for c in caps))).alias("max_features")
    ).filter(F.col("place") <= F.col("max_features"))
    return rows.groupBy("max_features").agg(
        F.count(F.lit(1)).alias("terms"),
        F.sum("cf").alias("occurrences"),
        (F.sum("cf") / F.max(total)).alias("coverage"),
    )
