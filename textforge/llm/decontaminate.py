"""Benchmark decontamination with suffix arrays over the training words.

Method: the words of the documents form shards; every shard gets a suffix array (its positions in
the order of the word sequences that begin there). Every suffix of every test item is looked up in
every shard by binary search, one word deeper at a time: the interval of suffixes that agree with it
on a whole window gives all places of that window. Places where the word before agrees as well lie
inside a longer match; all others are followed on in the text, as far as it goes, which gives the
longest verbatim match of any length. Documents with a hit are removed by ``remove_contaminated``.

A window is ``window`` consecutive words of an item; an item with fewer words, but not none, is one
window. Words are compared through 64-bit hashes.

Distribution: a narrow pass, nothing is shuffled. A shard is at most ``SHARD_WORDS`` positions
inside a task, and it reads beyond its end as far as a window, so neither a long document, a long
item nor a hot source makes a large shard. The test items are read in blocks of at most ``block_bytes``
bytes of text; each block is one broadcast of that size and one more narrow pass, so the size of the
benchmark is not limited.

Defined cases: a null or empty text has no words, thus no hit; an item without words has no window;
an item with a null id counts as the id ``null``; item ids that repeat count once per document;
repeated documents each get their own equal result; an empty table on either side gives
``n_hit`` 0 for every document; extra columns pass through, and the name of the result column
is changed by the caller if it clashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textforge.llm.frames import fresh, table, tidy
from textforge.llm.words import row_slices, word_hashes

WINDOW = 10
SHARD_WORDS = 1 << 20
BLOCK_BYTES = 16 << 20
BATCH_BYTES = 2 << 20  # of text whose words make up shards together
_PAIRS = 1 << 17  # places of windows that are looked at together
_RANK_BITS = np.int64(21)  # three ranks fill one sort key

RESULT = T.StructType(
    [
        T.StructField("n_words", T.LongType()),
        T.StructField("spans", T.ArrayType(T.ArrayType(T.LongType()))),
        T.StructField("items", T.ArrayType(T.StringType())),
        T.StructField(
            "longest",
            T.StructType(
                [
                    T.StructField("item_id", T.StringType()),
                    T.StructField("item_word", T.LongType()),
                    T.StructField("doc_word", T.LongType()),
                    T.StructField("n_words", T.LongType()),
                ]
            ),
        ),
    ]
)
_ARROW = pa.struct(
    [
        ("n_words", pa.int64()),
        ("spans", pa.list_(pa.list_(pa.int64()))),
        ("items", pa.list_(pa.string())),
        (
            "longest",
            pa.struct(
                [
                    ("item_id", pa.string()),
                    ("item_word", pa.int64()),
                    ("doc_word", pa.int64()),
                    ("n_words", pa.int64()),
                ]
            ),
        ),
    ]
)


class TestBlock:
    """The words of some test items, and the windows whose places are wanted."""

    def __init__(self, ids: list[str], texts: list[str | None], window: int):
        words, places = word_hashes(pa.array(texts, pa.string()))
        sizes = np.diff(places)
        self.ids, self.words = ids, words
        self.item = np.repeat(np.arange(len(ids)), sizes)
        self.place = np.arange(len(words)) - places[:-1][self.item]
        left = places[1:][self.item] - np.arange(len(words))  # words up to the item's end
        need = np.minimum(window, sizes)[self.item]
        self.need = np.where(left >= need, need, 0)  # 0: no window begins here
        self.left = left
        self.deepest = int(self.need.max(initial=0))


def _triples(ranks: np.ndarray, step: int) -> np.ndarray:
    """One key for the ranks at i, i + step and i + 2 step; nothing (rank 0) follows the end."""
    far = np.concatenate((ranks, np.zeros(2 * step, np.int64)))
    n = len(ranks)
    second, third = far[step : step + n], far[2 * step : 2 * step + n]
    return (((ranks << _RANK_BITS) | second) << _RANK_BITS) | third


def _ranked(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order of the keys, the sorted keys, and each key's dense rank from 1."""
    order = np.argsort(keys)
    ordered = keys[order]
    steps = np.concatenate(([1], (ordered[1:] != ordered[:-1]).astype(np.int64))).cumsum()
    ranks = np.empty(len(keys), np.int64)
    ranks[order] = steps
    return order, ordered, ranks


def _find(values: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Rank from 1 of each wanted value among the sorted distinct values; -1 where it is none."""
    at = np.searchsorted(values, wanted)
    at[at == len(values)] = 0
    return np.where(values[at] == wanted, at + 1, -1)


class SuffixArray:
    """Positions of ``words`` ordered by what follows, as far as ``depth`` words."""

    def __init__(self, words: np.ndarray, depth: int):
        self.vocabulary, inverse = np.unique(words, return_inverse=True)
        self.ranks = inverse.astype(np.int64) + 1
        order, keys, ranks = _ranked(_triples(self.ranks, 1))
        self.triples = keys[np.concatenate(([True], keys[1:] != keys[:-1]))]
        reach = 3
        while reach < depth and ranks.max() < len(ranks):
            keys = _triples(ranks, reach)
            _, counts = np.unique(ranks, return_counts=True)
            tied = np.flatnonzero(counts[ranks[order] - 1] > 1)  # the others have their place
            order[tied] = order[tied][np.argsort(keys[order[tied]])]
            ordered = keys[order]
            steps = np.concatenate(([1], (ordered[1:] != ordered[:-1]).astype(np.int64))).cumsum()
            ranks = np.empty(len(keys), np.int64)
            ranks[order] = steps
            reach *= 3
        self.order = order

    def _deeper(self, lo, hi, at, ranks) -> tuple[np.ndarray, np.ndarray]:
        """Of the intervals, the parts whose next word, ``at`` words on, has the given rank."""
        out = []
        for side in (0, 1):
            low, high = lo.copy(), hi.copy()
            while (open_ := low < high).any():
                mid = (low + high) >> 1
                there = self.order[np.minimum(mid, len(self.order) - 1)] + at
                value = np.where(there < len(self.ranks), self.ranks[np.minimum(there, len(self.ranks) - 1)], 0)
                right = (value < ranks + side) & open_
                low, high = np.where(right, mid + 1, low), np.where(open_ & ~right, mid, high)
            out.append(low)
        return out[0], out[1]

    def look_up(self, block: TestBlock) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
        """Yield depth, the suffixes that some position agrees with so far, and their intervals."""
        ranks = _find(self.vocabulary, block.words)
        suffix = np.flatnonzero(ranks > 0)
        lo, hi = np.zeros(len(suffix), np.int64), np.full(len(suffix), len(self.order))
        # Suffixes whose first three words never stand together here are out at once.
        three = block.left[suffix] >= 3
        first = suffix[three]
        key = (((ranks[first] << _RANK_BITS) | ranks[first + 1]) << _RANK_BITS) | ranks[first + 2]
        known = (ranks[first + 1] > 0) & (ranks[first + 2] > 0)
        known &= _find(self.triples, np.where(known, key, -1)) > 0
        keep = np.ones(len(suffix), bool)
        keep[three] = known | (block.need[first] < 3) & (block.need[first] > 0)
        suffix, lo, hi = suffix[keep], lo[keep], hi[keep]
        depth = 0
        while len(suffix):
            lo, hi = self._deeper(lo, hi, depth, ranks[suffix + depth])
            depth += 1
            keep = hi > lo
            suffix, lo, hi = suffix[keep], lo[keep], hi[keep]
            yield depth, suffix, lo, hi
            more = (block.left[suffix] > depth) & (depth < block.deepest)
            suffix, lo, hi = suffix[more], lo[more], hi[more]


def _spread(lo: np.ndarray, hi: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All numbers of the intervals, and the interval each comes from, so many at a time."""
    ends = np.cumsum(hi - lo)
    for begin in range(0, int(ends[-1]) if len(ends) else 0, _PAIRS):
        number = np.arange(begin, min(begin + _PAIRS, int(ends[-1])))
        which = np.searchsorted(ends, number, "right")
        yield number - (ends[which] - hi[which]), which


def _lengths(flat: np.ndarray, at: np.ndarray, block: TestBlock, suffix: np.ndarray, depth: int) -> np.ndarray:
    """How many words agree from each place and suffix on, of which the first ``depth`` are known to."""
    length = np.full(len(at), depth, np.int64)
    going, step = np.arange(len(at)), 16
    while len(going):
        ahead = length[going][:, None] + np.arange(step)
        here, there = at[going][:, None] + ahead, suffix[going][:, None] + ahead
        same = (ahead < block.left[suffix[going]][:, None]) & (here < len(flat))
        same &= flat[np.minimum(here, len(flat) - 1)] == block.words[np.minimum(there, len(block.words) - 1)]
        agree = np.where(same.all(1), step, same.argmin(1))
        length[going] += agree
        going = going[agree == step]
        step = int(np.clip(_PAIRS // max(1, len(going)), 16, 1 << 14))
        step = min(step, int(length.max()))
    return length


def _batch_hits(texts: pa.Array, block: TestBlock) -> list[dict]:
    """The result of each text for one block of test items."""
    words, places = word_hashes(texts)
    n_docs = len(places) - 1
    sizes = np.diff(places)
    # A zero after each document keeps matches inside it.
    starts = places[:-1] + np.arange(n_docs)
    flat = np.zeros(len(words) + n_docs, np.uint64)
    owner = np.repeat(np.arange(n_docs), sizes)
    flat[np.arange(len(words)) + owner] = words
    change = np.zeros(len(flat) + 1, np.int64)
    pairs, deepest = [], {}
    if block.deepest:
        for begin in range(0, len(flat), SHARD_WORDS):
            array = SuffixArray(flat[begin : begin + SHARD_WORDS + block.deepest], block.deepest)
            for depth, suffix, lo, hi in array.look_up(block):
                window = block.need[suffix] == depth
                if not window.any():
                    continue
                suffix, lo, hi = suffix[window], lo[window], hi[window]
                # Equal windows of an item have the same places, which count once.
                _, once = np.unique(np.stack((block.item[suffix], lo)), axis=1, return_index=True)
                for at, which in _spread(lo[once], hi[once]):
                    at = array.order[at]
                    own = at < SHARD_WORDS  # the next shard has the others
                    at, item = at[own] + begin, block.item[suffix[once][which[own]]]
                    np.add.at(change, at, 1)
                    np.add.at(change, at + depth, -1)
                    doc = np.searchsorted(starts, at, "right") - 1
                    pairs.append(np.unique(doc * len(block.ids) + item))
                for at, which in _spread(lo, hi):
                    at = array.order[at]
                    own = at < SHARD_WORDS
                    at, start = at[own] + begin, suffix[which[own]]
                    # A match that could begin a word earlier is found there.
                    first = (block.place[start] == 0) | (at == 0) | (flat[at - 1] != block.words[start - 1])
                    at, start = at[first], start[first]
                    length = _lengths(flat, at, block, start, depth)
                    doc = np.searchsorted(starts, at, "right") - 1
                    order = np.lexsort((start, at, -length, doc))
                    for k in order[np.unique(doc[order], return_index=True)[1]]:
                        match = (int(length[k]), -int(at[k] - starts[doc[k]]), -int(start[k]))
                        deepest[doc[k]] = max(deepest.get(doc[k], match), match)
    hit = change.cumsum()[:-1] > 0
    edges = np.diff(np.concatenate(([0], hit.astype(np.int8), [0])))
    first, last = np.flatnonzero(edges > 0), np.flatnonzero(edges < 0)
    pairs = np.unique(np.concatenate(pairs)) if pairs else np.empty(0, np.int64)
    doc_of_pair, doc_of_span = pairs // max(1, len(block.ids)), np.searchsorted(starts, first, "right") - 1
    out = []
    for d in range(n_docs):
        spans = slice(*np.searchsorted(doc_of_span, [d, d + 1]))
        items = pairs[slice(*np.searchsorted(doc_of_pair, [d, d + 1]))] % max(1, len(block.ids))
        depth, at, suffix = deepest.get(d, (0, 0, 0))
        out.append(
            {
                "n_words": int(sizes[d]),
                "spans": (np.stack((first[spans], last[spans]), 1) - starts[d]).tolist(),
                "items": sorted({block.ids[i] for i in items}),
                "longest": {
                    "item_id": block.ids[block.item[-suffix]],
                    "item_word": int(block.place[-suffix]),
                    "doc_word": -at,
                    "n_words": depth,
                }
                if depth
                else None,
            }
        )
    return out


def _joined(old: dict, new: dict) -> dict:
    """One result from those of two blocks of test items."""
    spans = []
    for a, b in sorted([*map(list, old["spans"]), *map(list, new["spans"])]):
        if spans and a <= spans[-1][1]:
            spans[-1][1] = max(spans[-1][1], b)
        else:
            spans.append([a, b])
    best = max(old["longest"], new["longest"], key=lambda x: (x["n_words"], -x["doc_word"]) if x else (0, 0))
    items = sorted({*old["items"], *new["items"]})
    return {"n_words": new["n_words"], "spans": spans, "items": items, "longest": best}


def find_contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    result: str,
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """``docs`` with a struct column ``result``: ``n_words``, ``spans`` (from word, to word), ``items``, ``longest``.

    ``longest`` is the longest verbatim match of at least a window; of equal ones that earliest in the document.
    """
    spark = docs.sparkSession
    tests = benchmark.select(
        F.coalesce(F.col(item_id).cast("string"), F.lit("null")).alias("id"), F.col(item_text).alias("text")
    ).where("text is not null")
    size = tests.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n_blocks = max(1, -(-size // block_bytes))
    schema = T.StructType([*docs.schema.fields, T.StructField(result, RESULT)])
    place, old_place = docs.columns.index(text), len(docs.columns)
    out = docs.withColumn(result, F.lit(None).cast(RESULT))
    for number in range(n_blocks):
        rows = tests.where(F.pmod(F.xxhash64("id", "text"), F.lit(n_blocks)) == number).collect()
        block = spark.sparkContext.broadcast(
            TestBlock([r.id for r in rows], [r.text for r in rows], window)
        )

        def search(batches, block=block, again=number > 0):
            for batch in batches:
                for begin, end in row_slices(batch.column(place), BATCH_BYTES):
                    part = batch.slice(begin, end - begin)
                    found = _batch_hits(part.column(place), block.value)
                    if again:
                        old = part.column(old_place).to_pylist()
                        found = [_joined(a, b) for a, b in zip(old, found, strict=True)]
                    columns = [*part.columns[:old_place], pa.array(found, _ARROW)]
                    yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names)

        out = out.mapInArrow(tidy(search), schema)
    return out


def n_hit(result: str):
    """Number of words inside any window, from the result column."""
    spans = F.col(f"`{result}`.spans")
    return F.aggregate(spans, F.lit(0).cast("long"), lambda n, s: n + s[1] - s[0])


def remove_contaminated(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The documents in which no window of any test item occurs, with their own columns only."""
    result = fresh(docs, "contamination")
    found = find_contamination(docs, benchmark, result, **options)
    return found.where(n_hit(result) == 0).select(*[F.col(f"`{c}`") for c in docs.columns])


def op10_decontamination(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = find_contamination(docs, table(spark, sf_dir, "benchmark"), "found")
    return found.select(
        "doc_id",
        F.col("found.n_words").alias("n_words"),
        n_hit("found").alias("n_hit"),
        F.size("found.items").cast("long").alias("n_items"),
        F.sha2(F.array_join("found.items", ","), 256).alias("items_sha256"),
        (n_hit("found") > 0).alias("contaminated"),
    )
