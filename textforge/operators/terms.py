"""N-gram counts over Arrow batches of texts made of words with single spaces between.

Such a text crosses to Python as one string, much faster than a list. Words become numbers per batch, an n-gram the pair of its first part's number and its last word.
Strings are built for the different n-grams of a batch only.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: A batch is worked on in runs of rows with about so many bytes; a longer row is a run of its own.
RUN_BYTES = 4 << 20

#: Words that go to every task: so many bytes at most.
KNOWN_BYTES = 32 << 20


def row_runs(texts: pa.Array):
    """The rows of a string array in consecutive slices of about ``RUN_BYTES``."""
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(sizes, dtype="int64")
    begin = 0
    while begin < len(texts):
        before = ends[begin - 1] if begin else 0
        end = max(begin + 1, int(np.searchsorted(ends, before + RUN_BYTES, "right")))
        yield texts.slice(begin, end - begin)
        begin = end


def _coded(texts: pa.Array, known: pa.Array | None):
    """Row and word number of every token (-1: not in ``known``), and the numbered words."""
    lists = pc.split_pattern(pc.fill_null(texts, ""), " ")
    words = lists.flatten()
    rows = pc.list_parent_indices(lists).to_numpy()
    if known is None:
        coded = words.dictionary_encode()
        known, numbers = coded.dictionary, coded.indices.to_numpy().astype("int64")
        empty = pc.index(known, pa.scalar("", known.type)).as_py()  # the one token of an empty text
        if empty >= 0:
            numbers[numbers == empty] = -1
        return rows, numbers, known
    known = known.cast(words.type)
    numbers = pc.fill_null(pc.index_in(words, value_set=known), -1)
    return rows, numbers.to_numpy().astype("int64"), known


def _grams(rows: np.ndarray, words: np.ndarray, known: pa.Array, high: int):
    """For n = 1 to ``high``: rows, numbers and texts of all n-grams of known words."""
    ids, names = words, known
    for n in range(1, high + 1):
        if n > 1:
            first, last = ids[: max(len(words) - n + 1, 0)], words[n - 1 :]
            there = (first >= 0) & (last >= 0) & (rows[: len(first)] == rows[n - 1 :])
            pairs = first[there] * len(known) + last[there]
            coded = pa.array(pairs, pa.int64()).dictionary_encode()
            ids = np.full(len(first), -1, "int64")
            ids[there] = coded.indices.to_numpy(zero_copy_only=False)
            pairs = coded.dictionary.to_numpy(zero_copy_only=False)
            names = pc.binary_join_element_wise(
                names.take(pa.array(pairs // len(known))), known.take(pa.array(pairs % len(known))), " "
            )
        there = ids >= 0
        yield n, rows[: len(ids)][there], ids[there], names


def count_grams(
    df: DataFrame, words: str, low: int, high: int, known: DataFrame | None = None
) -> DataFrame:
    """``term, cf, df`` of the n-grams of a column of joined words, ``low <= n <= high``.

    With ``known`` (one column ``word``) only n-grams all of whose words are among them.
    """
    kept = None
    if known is not None:
        column = known.toArrow().column(0).combine_chunks()
        kept = df.sparkSession.sparkContext.broadcast(column)

    def count(batches):
        for batch in batches:
            for texts in row_runs(batch.column(0)):
                coded = _coded(texts, None if kept is None else kept.value)
                for n, rows, ids, names in _grams(*coded, high):
                    if n < low:
                        continue
                    cf = np.bincount(ids, minlength=len(names))
                    seen = pc.unique(pa.array(rows * len(names) + ids)).to_numpy()
                    in_rows = np.bincount(seen % max(len(names), 1), minlength=len(names))
                    found = np.flatnonzero(cf)
                    yield pa.RecordBatch.from_arrays(
                        [names.take(pa.array(found)).cast(pa.string()), pa.array(cf[found], pa.int64()),
                         pa.array(in_rows[found], pa.int64())],
                        names=["term", "cf", "df"],
                    )

    counted = df.select(words).mapInArrow(count, "term string, cf bigint, df bigint")
    return counted.groupBy("term").agg(F.sum("cf").alias("cf"), F.sum("df").alias("df"))


def known_grams(spark: SparkSession, words: Column, vocabulary: list[str], high: int) -> Column:
    """The n-grams of a column of joined words that are in ``vocabulary``, in no particular order."""
    sent = spark.sparkContext.broadcast(pa.array(vocabulary, pa.string()))

    @F.arrow_udf(T.ArrayType(T.StringType()))
    def look_up(texts: pa.Array) -> pa.Array:
        terms = sent.value
        parts = pc.unique(pc.split_pattern(terms, " ").flatten())
        return pa.concat_arrays([_known(run, terms, parts, high) for run in row_runs(texts)])

    return look_up(words)


def _known(texts: pa.Array, terms: pa.Array, parts: pa.Array, high: int) -> pa.Array:
    found_rows, found = [], []
    for _, rows, ids, names in _grams(*_coded(texts, parts), high):
        at = pc.fill_null(pc.index_in(names, value_set=terms.cast(names.type)), -1)
        at = at.to_numpy(zero_copy_only=False)[ids] if len(ids) else ids
        found_rows.append(rows[at >= 0])
        found.append(at[at >= 0])
    rows, at = np.concatenate(found_rows), np.concatenate(found)
    at = at[np.argsort(rows, kind="stable")]
    ends = np.concatenate(([0], np.cumsum(np.bincount(rows, minlength=len(texts)))))
    return pa.ListArray.from_arrays(
        pa.array(ends, pa.int32()), terms.take(pa.array(at, pa.int64())).cast(pa.string())
    )
