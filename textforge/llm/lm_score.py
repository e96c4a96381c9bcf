"""Stupid-backoff language-model scores of all documents from counts over all documents.

The score of a word after its history is ``count(history + word) / count(history)`` if the n-gram is in
the count tables, else ``alpha`` times the score after the history without its first word; the last
resort is ``count(word) / N``. A document's score is the sum of the logarithms over its words.
N-grams of two or more words are in the tables from ``min_count`` occurrences on. ``op9_lm_scoring`` is what its
SQL says, bigrams from two occurrences on; ``op9_lm_scoring_full`` scores trigrams and keeps every count.

Relational form. Documents are cut into chunks of some megabytes, written once as numbers of words.
Each chunk explodes into its n-grams and counts them before anything shuffles; the counts go to tables
that are partitioned by ranges of the n-gram's 64-bit hash. Arrays of numbers travel as planes of their
bytes, sorted hashes as differences: high bytes are then mostly zero and Spark's own compression removes them. A partition sums the counts of a hash, which is
its count table, joins them to the n-grams that came in, and answers each chunk with the totals of
its n-grams; the answers are joined to the chunks, which score their documents.
An n-gram that makes up a third of the corpus is one entry per chunk, so no partition is hot; the
number of partitions follows the number of words, so their size stays the same. Counts are 64-bit.

Defined cases: a null, empty or wordless text has score 0 with 0 words; repeated rows are counted and
scored each; rows with a null id are scored; an empty table gives an empty result; extra columns are
ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textforge.llm.frames import table
from textforge.llm.words import mix, row_slices, word_hashes
from textforge.session import materialize

ORDER = 2
ALPHA = 0.4
MIN_COUNT = 2
FULL_ORDER, FULL_MIN_COUNT = 3, 1
CHUNK_BYTES = 4 << 20
PARTITION_NGRAMS = 1 << 21
_ODD = mix(np.arange(1, 17, dtype=np.uint64)) | np.uint64(1)


def _packed(numbers: np.ndarray, kind: str = "<u8") -> bytes:
    """The numbers as planes: all lowest bytes first, all highest bytes last."""
    wide = np.ascontiguousarray(numbers.astype(kind, copy=False))
    return wide.view(np.uint8).reshape(len(wide), wide.itemsize).T.tobytes()


def _unpacked(value: pa.BinaryScalar, kind: str = "<u8") -> np.ndarray:
    size, data = np.dtype(kind).itemsize, value.as_py()
    planes = np.frombuffer(data, np.uint8).reshape(size, len(data) // size)
    return np.frombuffer(planes.T.tobytes(), kind)


def _packed_sorted(numbers: np.ndarray) -> bytes:
    return _packed(np.diff(numbers, prepend=np.uint64(0)))


def _unpacked_sorted(value: pa.BinaryScalar) -> np.ndarray:
    return np.cumsum(_unpacked(value), dtype=np.uint64)


def _chunks(batches):
    task, number = TaskContext.get().partitionId(), 0
    for batch in batches:
        for begin, end in row_slices(batch.column(1), CHUNK_BYTES):
            part = batch.slice(begin, end - begin)
            words, places = word_hashes(part.column(1))
            known, index, often = np.unique(words, return_inverse=True, return_counts=True)
            order = np.argsort(-often, kind="stable")  # frequent words get small numbers
            rank = np.empty(len(known), np.uint32)
            rank[order] = np.arange(len(known), dtype=np.uint32)
            ids = pa.ListArray.from_arrays(pa.array([0, part.num_rows], pa.int32()), part.column(0))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([(task << 32) | number], pa.int64()),
                    ids,
                    pa.array([_packed(np.diff(places))], pa.binary()),
                    pa.array([_packed(known[order])], pa.binary()),
                    pa.array([_packed(rank[index], "<u4")], pa.binary()),
                    pa.array([len(words)], pa.int64()),
                ],
                names=["chunk", "ids", "sizes", "known", "words", "n_words"],
            )
            number += 1


_CHUNK = "chunk long, ids array<long>, sizes binary, known binary, words binary, n_words long"


def _ngrams(chunk, row: int, order: int) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """The n-gram hashes that end at each word, per order; each word's place in its document."""
    sizes = _unpacked(chunk.column("sizes")[row]).astype(np.int64)
    words = _unpacked(chunk.column("known")[row])[_unpacked(chunk.column("words")[row], "<u4")]
    place = np.arange(len(words)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    hashes, value = [], np.zeros(len(words), np.uint64)
    for n in range(order):
        earlier = np.concatenate((np.zeros(min(n, len(words)), np.uint64), words[: max(0, len(words) - n)]))
        value = value + earlier * _ODD[n]
        hashes.append(mix(value + np.uint64(n)))
    return sizes, place, hashes


def _all_keys(place: np.ndarray, hashes: list[np.ndarray]) -> np.ndarray:
    return np.concatenate([h[place >= n] for n, h in enumerate(hashes)])


def _counted(order: int, bits: int):
    """Per chunk and partition the distinct n-grams in order of their hash, and their counts."""
    cuts = np.arange(1, 1 << bits, dtype=np.uint64) << np.uint64(64 - bits) if bits else np.empty(0, np.uint64)

    def counted(batches):
        for batch in batches:
            for row in range(batch.num_rows):
                _, place, hashes = _ngrams(batch, row, order)
                keys, counts = np.unique(_all_keys(place, hashes), return_counts=True)
                ends = np.concatenate(([0], np.searchsorted(keys, cuts), [len(keys)])).tolist()
                parts = list(zip(ends, ends[1:], strict=False))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.arange(len(parts), dtype=np.int32)),
                        pa.array(np.full(len(parts), batch.column(0)[row].as_py(), np.int64)),
                        pa.array([_packed_sorted(keys[lo:hi]) for lo, hi in parts], pa.binary()),
                        pa.array([_packed(counts[lo:hi]) for lo, hi in parts], pa.binary()),
                    ],
                    names=["part", "chunk", "keys", "counts"],
                )

    return counted


def _totals(group: pa.Table) -> pa.Table:
    """The count table of a partition, joined to the n-grams of each chunk."""
    keys = [_unpacked_sorted(x) for x in group.column("keys")]
    counts = np.concatenate([_unpacked(x) for x in group.column("counts")])
    known, index = np.unique(np.concatenate(keys), return_inverse=True)
    total = np.zeros(len(known), np.uint64)
    np.add.at(total, index, counts)
    ends = np.cumsum([0, *map(len, keys)]).tolist()
    totals = [_packed(total[index[lo:hi]]) for lo, hi in zip(ends, ends[1:], strict=False)]
    columns = [group.column("part"), group.column("chunk"), pa.array(totals, pa.binary())]
    return pa.Table.from_arrays(columns, names=["part", "chunk", "totals"])


def _scored(order: int, alpha: float, min_count: int, n_words: int):
    def scored(chunk: pa.Table, answers: pa.Table) -> pa.Table:
        totals = np.concatenate([_unpacked(x) for x in answers.sort_by("part").column("totals")])
        sizes, place, hashes = _ngrams(chunk, 0, order)
        keys, index = np.unique(_all_keys(place, hashes), return_inverse=True)
        found = totals[index].astype(float)
        count, at = [], 0
        for n in range(order):  # the count of the n-gram that ends at each word, 0 where there is none
            there = np.flatnonzero(place >= n)
            own = np.zeros(len(place))
            own[there] = found[at : at + len(there)]
            if n:
                own[own < min_count] = 0
            count.append(own)
            at += len(there)
        logs = np.log(count[0] / max(1, n_words))
        backed = np.zeros(len(place), np.int64)
        settled = np.zeros(len(place), bool)
        for n in range(order - 1, 0, -1):
            history = np.concatenate(([0.0], count[n - 1][:-1]))
            known = ~settled & (count[n] > 0) & (history > 0)
            logs[known] = np.log(count[n][known] / history[known]) + backed[known] * np.log(alpha)
            settled |= known
            backed[~settled & (place >= n)] += 1
        logs[~settled] += backed[~settled] * np.log(alpha)
        document = np.repeat(np.arange(len(sizes)), sizes)
        return pa.table(
            {
                "id": chunk.column("ids")[0].values,
                "n_words": pa.array(sizes),
                "n_backoff": pa.array(np.bincount(document, backed > 0, len(sizes)).astype(np.int64)),
                "score": pa.array(np.bincount(document, logs, len(sizes)).astype(float)),  # whole numbers without words
            }
        )

    return scored


def count_tables(chunks: DataFrame, order: int = ORDER, n_words: int | None = None) -> DataFrame:
    """``part, chunk, keys, counts``: the n-grams of each chunk, by range of their hash."""
    if n_words is None:
        n_words = chunks.agg(F.sum("n_words")).first()[0] or 0
    bits = max(0, (order * n_words // PARTITION_NGRAMS).bit_length())
    return chunks.mapInArrow(_counted(order, bits), "part int, chunk long, keys binary, counts binary")


def score_documents(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    order: int = ORDER,
    alpha: float = ALPHA,
    min_count: int = MIN_COUNT,
) -> DataFrame:
    """``id, n_words, n_backoff, score`` of every row."""
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    chunks = materialize(rows.mapInArrow(_chunks, _CHUNK), "chunks")
    n_words = chunks.agg(F.sum("n_words")).first()[0] or 0
    tables = count_tables(chunks, order, n_words)
    answers = tables.groupBy("part").applyInArrow(_totals, "part int, chunk long, totals binary")
    both = chunks.groupBy("chunk").cogroup(answers.groupBy("chunk"))
    return both.applyInArrow(
        _scored(order, alpha, min_count, n_words), "id long, n_words long, n_backoff long, score double"
    )


def _result(scored: DataFrame) -> DataFrame:
    return scored.select(
        F.col("id").alias("doc_id"),
        "n_words",
        "n_backoff",
        F.round("score", 4).alias("score"),
    )


def op9_lm_scoring(spark, sf_dir: str) -> DataFrame:
    return _result(score_documents(table(spark, sf_dir, "documents")))


def op9_lm_scoring_full(spark, sf_dir: str) -> DataFrame:
    """Trigrams, no n-gram's count left out."""
    docs = table(spark, sf_dir, "documents")
    return _result(score_documents(docs, order=FULL_ORDER, min_count=FULL_MIN_COUNT))
