"""Quality classifier learned from trusted positives and unlabelled text.

Method: positive-unlabelled learning. With class prior p and logistic loss l, the model minimises the
non-negative unbiased risk ``p E+[l(g)] + max(0, Eu[l(-g)] - p E+[l(-g)])``: the unlabelled rows stand
for negatives after the positives among them are taken off, and where that difference falls below
zero, which no true risk can, its gradient is reversed. The prior is estimated from the scores of a
first model that separates positives from unlabelled rows: the least ratio of the two tail
frequencies, with a margin for the sample size. Logistic loss is proper, so the sigmoid of the output
is the probability of the positive class.

Inputs of a score are measures of the whole text alone: shares of single ASCII symbols and of
character kinds, repeated neighbouring words, distinct words and lines, lengths.

The model is fitted on at most ``max_rows`` trusted positives and as many unlabelled rows, those with
the least hash of the id; that is the one bounded sample. Features of the sample are computed on the
executors. Scoring is a narrow pass over all rows.

Defined cases: a null text is an empty text, which has the features of an empty text and is scored
like any other; rows with a null id are scored; repeated rows get equal scores; without trusted
positives or without unlabelled rows nothing can be learned, and every score is 1; extra columns pass
through ``drop_low_quality``.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textforge.llm.frames import checked_broadcast, fresh, table, tidy
from textforge.llm.words import buffers, row_slices, word_hashes
from textforge.session import materialize

MAX_ROWS = 20_000
CUT = 0.7
FOLDS, HELD_OUT = 4, 2

_SYMBOLS = [c for c in range(33, 127) if not chr(c).isalnum()]


def features(texts: pa.Array) -> np.ndarray:
    """One row of measures per text."""
    data, places = buffers(texts)
    size = np.maximum(np.diff(places), 1)
    byte = np.arange(256)
    kinds = [
        (byte >= 65) & (byte <= 90),
        (byte >= 97) & (byte <= 122),
        (byte >= 48) & (byte <= 57),
        byte == 32,
        byte == 10,
        byte >= 128,
        byte < 32,
    ]
    n = len(size)
    histogram = np.bincount(
        np.repeat(np.arange(n) << 8, np.diff(places)) + data, minlength=n << 8
    ).reshape(n, 256)
    shares = [histogram[:, k].sum(1) / size for k in kinds] + [histogram[:, c] / size for c in _SYMBOLS]
    words, begins = word_hashes(texts)
    counts = np.diff(begins)
    some = np.maximum(counts, 1)
    row = np.repeat(np.arange(n), counts)
    again = np.zeros(len(words), bool)
    again[1:] = (words[1:] == words[:-1]) & (row[1:] == row[:-1])
    repeated = np.bincount(row[again], minlength=n) / some
    keys = np.unique((row.astype(np.uint64) << np.uint64(44)) | (words >> np.uint64(20)))
    distinct = np.bincount((keys >> np.uint64(44)).astype(np.int64), minlength=n) / np.sqrt(some)
    letters = size - histogram[:, :48].sum(1)
    lengths = [np.log1p(counts) / 10, letters / some / 10, distinct / 10]
    return np.column_stack([*(np.sqrt(x) for x in shares), np.sqrt(repeated), *lengths])


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _descend(gradient, size: int, steps: int = 600, rate: float = 0.05) -> np.ndarray:
    """Adam over whole-sample gradients."""
    w, m, v = np.zeros(size), np.zeros(size), np.zeros(size)
    for t in range(1, steps + 1):
        g = gradient(w)
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w -= rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    return w


def estimate_prior(positive: np.ndarray, unlabelled: np.ndarray) -> float:
    """Share of positives among the unlabelled, from scores that are higher for positives."""
    cuts = np.quantile(positive, np.linspace(0, 0.95, 200))
    above_p = np.array([(positive >= c).mean() for c in cuts])
    above_u = np.array([(unlabelled >= c).mean() for c in cuts])
    margin = np.sqrt(np.log(200) / 2) * (len(positive) ** -0.5 + len(unlabelled) ** -0.5)
    best = np.argmin((above_u + margin) / above_p)
    return float(np.clip(above_u[best] / above_p[best], 0.01, 0.99))


def fit(positive: np.ndarray, unlabelled: np.ndarray, prior: float | None = None) -> dict:
    """Weights, scaling and prior of a linear model with the non-negative risk."""
    both = np.concatenate((positive, unlabelled))
    mean, scale = both.mean(0), both.std(0)
    scale = np.where(scale > 1e-9, scale, 1.0)
    ready = [np.column_stack([(x - mean) / scale, np.ones(len(x))]) for x in (positive, unlabelled)]
    p, u = ready
    ridge = np.full(p.shape[1], 1e-4)
    ridge[-1] = 0

    def separating(w):
        return -(1 - _sigmoid(p @ w)) @ p / len(p) + _sigmoid(u @ w) @ u / len(u) + ridge * w

    if prior is None:
        first = _descend(separating, p.shape[1])
        prior = estimate_prior(p @ first, u @ first)

    def non_negative(w):
        at_p, at_u = p @ w, u @ w
        negative = np.logaddexp(0, at_u).mean() - prior * np.logaddexp(0, at_p).mean()
        slope = _sigmoid(at_u) @ u / len(u) - prior * _sigmoid(at_p) @ p / len(p)
        if negative < 0:
            return -slope
        return -prior * (1 - _sigmoid(at_p)) @ p / len(p) + slope + ridge * w

    return {"weights": _descend(non_negative, p.shape[1]), "mean": mean, "scale": scale, "prior": prior}


def score_texts(model: dict | None, texts: pa.Array) -> np.ndarray:
    if model is None:
        return np.ones(len(texts))
    x = (features(texts) - model["mean"]) / model["scale"]
    return _sigmoid(x @ model["weights"][:-1] + model["weights"][-1])


def in_fold(id_col: str):
    """Whether a row's label may not be learned from."""
    return F.crc32(F.col(f"`{id_col}`").cast("string")) % FOLDS == HELD_OUT


def _sample(ids: DataFrame, max_rows: int) -> DataFrame:
    return ids.orderBy(F.xxhash64("id"), "id").limit(max_rows)


def train(docs: DataFrame, labels: DataFrame, id_col="doc_id", text_col="text", label_col="quality", max_rows=MAX_ROWS):
    """The fitted model, or None without trusted positives or unlabelled rows."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    known = labels.where(F.col(label_col).eqNullSafe(1) & F.coalesce(~in_fold(id_col), F.lit(False)))
    known = materialize(known.select(F.col(id_col).alias("id")).distinct(), "positives")
    usable = rows.where(F.coalesce(~in_fold("id"), F.lit(False))).select("id")
    trusted = _sample(usable.join(known, "id", "left_semi").distinct(), max_rows)
    unknown = _sample(usable.join(known, "id", "left_anti").distinct(), max_rows)
    sample = trusted.withColumn("trusted", F.lit(True)).union(unknown.withColumn("trusted", F.lit(False)))
    chosen = rows.join(checked_broadcast(materialize(sample, "sample")), "id").select("trusted", "text")

    @tidy
    def measure(batches):
        for batch in batches:
            for begin, end in row_slices(batch.column(1)):
                part = batch.slice(begin, end - begin)
                x = features(part.column(1)).astype(np.float32)
                lists = pa.FixedSizeListArray.from_arrays(pa.array(x.reshape(-1)), x.shape[1]).cast(pa.list_(pa.float32()))
                yield pa.RecordBatch.from_arrays([part.column(0), lists], names=["trusted", "x"])

    measured = chosen.mapInArrow(measure, "trusted boolean, x array<float>").toArrow()  # bounded by max_rows
    if measured.num_rows == 0:
        return None
    x = np.array(measured.column("x").to_pylist(), float)
    mask = np.array(measured.column("trusted").to_pylist(), bool)
    order = np.lexsort(x.T)  # the same sums in whatever order the rows came
    x, mask = x[order], mask[order]
    return fit(x[mask], x[~mask]) if mask.any() and not mask.all() else None


def add_score(docs: DataFrame, model: dict | None, score: str, text_col: str = "text") -> DataFrame:
    place = docs.columns.index(text_col)

    @tidy
    def scored(batches):
        for batch in batches:
            for begin, end in row_slices(batch.column(place)):
                part = batch.slice(begin, end - begin)
                value = pa.array(score_texts(model, part.column(place)), pa.float64())
                yield pa.RecordBatch.from_arrays([*part.columns, value], names=[*part.schema.names, score])

    return docs.mapInArrow(scored, T.StructType([*docs.schema.fields, T.StructField(score, T.DoubleType())]))


def drop_low_quality(docs: DataFrame, labels: DataFrame, cut: float = CUT, **options) -> DataFrame:
    """The documents that the classifier accepts, with their own columns only."""
    score = fresh(docs, "score")
    scored = add_score(docs, train(docs, labels, **options), score)
    return scored.where(F.col(score) >= cut).drop(score)


def op5_quality_classifier(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = add_score(docs, train(docs, table(spark, sf_dir, "labels")), "score")
    return scored.select(
        "doc_id",
        F.coalesce(in_fold("doc_id"), F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= CUT).cast("int").alias("predicted"),
    )
