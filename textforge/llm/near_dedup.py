"""Near-duplicate classes by BagMinHash signatures, banding and verified multiset overlap.

A document is the multiset of its shingles of five words (a text of one to four words is one
shingle). Two documents are linked if the weighted Jaccard similarity of their multisets (sum of
smaller counts over sum of larger counts) is at least ``threshold``; a class is a connected
component of the links.

Signatures. The weight axis of every shingle is cut at 1, 2, 4, 8, ...; each piece is a Poisson
process seeded by shingle and piece, with its length as the rate. A point has a time, a register and
a height; the piece that a count ends in keeps the points below the count. A register holds the
earliest time of all points, so two registers agree with exactly the weighted Jaccard probability.
As in BagMinHash, points are made in order of time and only as long as one may still be the earliest
in some register: a limit on the time is set per document, and doubled for those few documents that
have an empty register left.

Links. Documents with equal multisets are one node, whatever their ids: a node is named by 64 bits of
its multiset's digest and verified on the text of one of its rows, which is found by id and text hash.
Nodes that agree on a band are candidates.
1. Every node is verified against one node of each of its buckets, that with most neighbours in all.
2. Buckets whose nodes then still lie in different components are settled exactly: their nodes go
   through a prefix filter (shingles in order of rarity; a pair over the threshold shares one of the
   rarest), which compares nodes of different components only. So no pairs within a group of copies
   are ever listed, and no candidate is dropped, whatever the size of a bucket.
24 bands of 5 registers miss a pair at similarity 0.8 with a chance of 7e-5, at 0.9 of 3e-10.

Defined cases: a null, empty or wordless text is a class of its own; rows that repeat id and text are
one document; each text of an id with several texts has its own class, and is kept or dropped by itself;
a row with a null id gets a null class and stays; an empty table gives an empty result; extra columns
are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from textforge.llm.frames import checked_broadcast, fresh, table, tidy
from textforge.llm.graph import components
from textforge.llm.words import mix, row_slices, word_hashes
from textforge.session import materialize

SHINGLE = 5
THRESHOLD = 0.8
BANDS, ROWS = 24, 5
SALTS = 16

_SLICE_ROWS = 1 << 12  # a row number and 52 bits of a shingle's hash share one sort key
_HASH_BITS = np.uint64(52)
_ODD = mix(np.arange(1, 65, dtype=np.uint64)) | np.uint64(1)
_STEP = np.uint64(0x9E3779B97F4A7C15)
_LEVELS = np.arange(64, dtype=np.uint64) * _STEP


def multisets(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, 52-bit shingle hash and count of each distinct shingle of each text, in this order."""
    words, places = word_hashes(texts)
    sizes = np.diff(places)
    row = np.repeat(np.arange(len(sizes)), sizes)
    place = np.arange(len(words)) - places[:-1][row]
    left = sizes[row] - place
    value = np.zeros(len(words), np.uint64)
    for k in range(SHINGLE):
        later = np.concatenate((words[k:], np.zeros(min(k, len(words)), np.uint64)))
        value += np.where(left > k, later, np.uint64(0)) * _ODD[k]
    begins = (left >= SHINGLE) | (place == 0)
    keys = (row[begins].astype(np.uint64) << _HASH_BITS) | (mix(value[begins]) >> np.uint64(12))
    keys.sort()
    first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1]))) if len(keys) else np.empty(0, np.int64)
    counts = np.diff(np.concatenate((first, [len(keys)])))
    keys = keys[first]
    return (keys >> _HASH_BITS).astype(np.int64), keys & np.uint64((1 << 52) - 1), counts


def _pieces(row, shingle, count):
    """Each shingle's pieces of the weight axis: row, seed, length and the share below the count."""
    out, low, high, level = [], 0, 1, 0
    while len(row):
        share = np.minimum((count - low) / (high - low), 1.0)
        out.append((row, mix(shingle + _LEVELS[level]), np.full(len(row), high - low, float), share))
        over = count > high
        row, shingle, count = row[over], shingle[over], count[over]
        low, high, level = high, 2 * high, level + 1
    return [np.concatenate(x) for x in zip(*out, strict=True)]


def signatures(row, shingle, count, n_rows: int, registers: int) -> np.ndarray:
    """The earliest time in each register, by row; infinite in all registers of a row without shingles."""
    times = np.full(n_rows * registers, np.inf)
    if not len(row):
        return times.reshape(n_rows, registers)
    weight = np.bincount(row, count, n_rows)
    limit = (np.log(registers) + 4) / np.maximum(weight, 1)
    row, seed, length, share = _pieces(row, shingle, count)
    todo = np.arange(len(row))
    while len(todo):
        active, now, j = todo, np.zeros(len(todo)), 0
        while len(active):
            many = int(np.clip(250_000 // len(active), 1, 64))
            draw = mix(seed[active][:, None] + np.arange(j + 1, j + many + 1, dtype=np.uint64) * _STEP)
            chance = ((draw >> np.uint64(11)).astype(float) + 0.5) * 2.0**-53
            gaps = -np.log(chance) / (registers * length[active])[:, None]
            # One addition after another, so that a point's time is the same however points are grouped.
            at = np.cumsum(np.concatenate((now[:, None], gaps), 1), 1)[:, 1:]
            other = mix(draw ^ _ODD[0])
            ok = at <= limit[row[active]][:, None]
            kept = ok & ((other & np.uint64(0xFFFFFFFF)).astype(float) * 2.0**-32 < share[active][:, None])
            register = ((other >> np.uint64(32)) % np.uint64(registers)).astype(np.int64)
            np.minimum.at(times, (row[active][:, None] * registers + register)[kept], at[kept])
            active, now, j = active[ok[:, -1]], at[ok[:, -1], -1], j + many
        empty = np.isinf(times.reshape(n_rows, registers)).any(1)
        limit[empty] *= 2
        todo = np.flatnonzero(empty[row])
    return times.reshape(n_rows, registers)


def _sketch(bands: int, rows: int):
    @tidy
    def sketch(batches):
        for batch in batches:
            for begin, end in row_slices(batch.column(1)):
                for lo in range(begin, end, _SLICE_ROWS):
                    part = batch.slice(lo, min(end - lo, _SLICE_ROWS))
                    n = part.num_rows
                    row, shingle, count = multisets(part.column(1))
                    times = signatures(row, shingle, count, n, bands * rows)
                    bits = times.view(np.uint64).reshape(n, bands, rows)
                    keys = mix((bits * _ODD[:rows]).sum(2) + np.arange(bands, dtype=np.uint64) * _STEP)
                    both = mix(shingle * _ODD[1] + count.astype(np.uint64)), mix(shingle * _ODD[2] ^ count.astype(np.uint64))
                    # A digest of the multiset: sums do not depend on an order.
                    sums = [np.zeros(n, np.uint64) for _ in both]
                    for total, value in zip(sums, both, strict=True):
                        np.add.at(total, row, value)
                    size = np.bincount(row, count, n).astype(np.int64)
                    offsets = pa.array(np.arange(n + 1, dtype=np.int32) * bands)
                    yield pa.RecordBatch.from_arrays(
                        [
                            part.column(0),
                            part.column(2),
                            pa.array(size),
                            pa.array(sums[0].view(np.int64)),
                            pa.array(sums[1].view(np.int64)),
                            pa.ListArray.from_arrays(offsets, pa.array(keys.reshape(-1).view(np.int64))),
                        ],
                        names=["id", "content", "size", "d1", "d2", "bands"],
                    )

    return sketch


@tidy
def _overlaps(batches):
    for batch in batches:
        for begin, end in row_slices(batch.column(2)):
            for lo in range(begin, end, _SLICE_ROWS):
                part = batch.slice(lo, min(end - lo, _SLICE_ROWS))
                n = part.num_rows
                row, shingle, count = multisets(part.column(2))
                other_row, other, other_count = multisets(part.column(3))
                keys = (row.astype(np.uint64) << _HASH_BITS) | shingle
                others = (other_row.astype(np.uint64) << _HASH_BITS) | other
                at = np.minimum(np.searchsorted(others, keys), max(0, len(others) - 1))
                same = np.flatnonzero(others[at] == keys) if len(others) else np.empty(0, np.int64)
                shared = np.bincount(row[same], np.minimum(count[same], other_count[at[same]]), n)
                total = np.bincount(row, count, n) + np.bincount(other_row, other_count, n) - shared
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(shared / np.maximum(total, 1))],
                    names=["a", "b", "similarity"],
                )


@tidy
def _exploded(batches):
    """One row per shingle occurrence: the k-th occurrence of a shingle is an element of its own."""
    for batch in batches:
        for begin, end in row_slices(batch.column(2), 1 << 20):
            for lo in range(begin, end, _SLICE_ROWS):
                part = batch.slice(lo, min(end - lo, _SLICE_ROWS))
                row, shingle, count = multisets(part.column(2))
                size = np.bincount(row, count, part.num_rows).astype(np.int64)
                again = np.repeat(np.arange(len(row)), count)
                nth = np.arange(len(again)) - np.repeat(np.cumsum(count) - count, count)
                element = mix(shingle[again] + nth.astype(np.uint64) * _STEP).view(np.int64)
                own = pa.array(row[again])
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(own), part.column(1).take(own), pa.array(size[row[again]]), pa.array(element)],
                    names=["node", "component", "size", "element"],
                )


def _texts_of(docs: DataFrame, nodes: DataFrame) -> DataFrame:
    """``node, text`` of the given ``node, id, content``, which are broadcast only after a check of their number."""
    nodes = checked_broadcast(materialize(nodes, "nodes-of-texts"), 24)
    return docs.join(nodes, ["id", "content"]).groupBy("node").agg(F.min("text").alias("text"))


def _verified(docs: DataFrame, nodes: DataFrame, pairs: DataFrame, threshold: float) -> DataFrame:
    """The pairs ``a, b`` of nodes whose multisets overlap enough."""
    pairs = materialize(pairs, "pairs")
    ends = pairs.select(F.col("a").alias("node")).union(pairs.select(F.col("b").alias("node"))).distinct()
    texts = materialize(_texts_of(docs, nodes.join(ends, "node", "left_semi")), "texts")
    both = pairs.join(texts.select(F.col("node").alias("a"), F.col("text").alias("text_a")), "a")
    both = both.join(texts.select(F.col("node").alias("b"), F.col("text").alias("text_b")), "b")
    checked = both.select("a", "b", "text_a", "text_b").mapInArrow(_overlaps, "a long, b long, similarity double")
    return materialize(checked.where(F.col("similarity") >= threshold - 1e-12).select("a", "b"), "links")


def _rare_pairs(docs: DataFrame, nodes: DataFrame, placed: DataFrame, threshold: float) -> DataFrame:
    """Pairs of the nodes in ``placed`` (``node, component``) in different components that share one of their
    rarest elements."""
    texts = _texts_of(docs, nodes.join(placed, "node", "left_semi"))
    texts = texts.join(placed, "node").select("node", "component", "text")
    elements = materialize(
        texts.mapInArrow(_exploded, "node long, component long, size long, element long"), "elements"
    )
    often = elements.groupBy("element").agg(F.count("*").alias("often"))
    own = Window.partitionBy("node")
    # Two multisets share their rarest elements if they overlap enough: for a larger partner a shorter
    # prefix of the smaller one is enough. What a node shares with any other also bounds an overlap.
    wide = F.col("size") - F.ceil(F.col("size") * threshold - 1e-9) + 1
    narrow = F.col("size") - F.ceil(F.col("size") * (2 * threshold / (1 + threshold)) - 1e-9) + 1
    rare = (
        elements.join(often, "element")
        .withColumn("place", F.row_number().over(own.orderBy("often", "element")))
        .withColumn("common", F.count_if(F.col("often") > 1).over(own))
        .where((F.col("place") <= wide) & (F.col("often") > 1))
        .select("element", "node", "component", "size", "common", (F.col("place") <= narrow).alias("first"))
    )
    rare = materialize(rare, "rare")
    by_component = rare.groupBy("element", "component").agg(F.count("*").alias("n"))
    main = by_component.groupBy("element").agg(
        F.max_by("component", F.struct("n", "component")).alias("main"), F.count("*").alias("components")
    )
    light = rare.join(main.where("components > 1").select("element", "main"), "element").where("component <> main")
    x, y = light.alias("x"), rare.alias("y")
    least = (F.col("x.size") + F.col("y.size")) * (threshold / (1 + threshold)) - 1e-9
    smaller_first = F.when(F.col("x.size") < F.col("y.size"), F.col("x.first"))
    smaller_first = smaller_first.when(F.col("x.size") > F.col("y.size"), F.col("y.first"))
    pairs = x.join(y, F.col("x.element") == F.col("y.element")).where(
        (F.col("x.component") != F.col("y.component"))
        & (F.least("x.size", "y.size") >= F.greatest("x.size", "y.size") * threshold - 1e-9)
        & (F.least("x.common", "y.common") >= least)
        & smaller_first.otherwise(F.col("x.first") & F.col("y.first"))
    )
    return pairs.select(
        F.least("x.node", "y.node").alias("a"), F.greatest("x.node", "y.node").alias("b")
    ).distinct()


def content_of(text: Column) -> Column:
    """A hash that tells the texts of one id apart; null and empty texts are alike."""
    return F.xxhash64(F.coalesce(text, F.lit("")))


def near_duplicate_classes(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    threshold: float = THRESHOLD,
    bands: int = BANDS,
    rows: int = ROWS,
) -> DataFrame:
    """``id, content, class_id, kept`` of every row; a class is named by its least id.

    Of the texts that the least id has in a class, that with the least ``content`` is kept.
    """
    text = F.col(f"`{text_col}`")
    docs = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), text.alias("text"), content_of(text).alias("content"))
    schema = "id long, content long, size long, d1 long, d2 long, bands array<long>"
    sketches = materialize(docs.mapInArrow(_sketch(bands, rows), schema), "sketches")
    filled = sketches.where("size > 0 AND id IS NOT NULL")
    nodes = filled.groupBy("d1", "d2").agg(F.min(F.struct("id", "content", "bands")).alias("least"))
    nodes = nodes.select(F.xxhash64("d1", "d2").alias("node"), "least.id", "least.content", "least.bands")
    nodes = materialize(nodes, "nodes")
    named = nodes.select("node", "id", "content")
    members = nodes.select("node", F.explode("bands").alias("bucket"))
    sizes = members.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1")
    shared = materialize(members.join(sizes, "bucket"), "shared")
    neighbours = shared.groupBy("node").agg(F.sum("n").alias("neighbours"))
    ranked = shared.join(neighbours, "node").select("bucket", "node", F.struct("neighbours", -F.col("node")).alias("rank"))
    centres = ranked.groupBy("bucket").agg(F.max_by("node", "rank").alias("centre"))
    spokes = shared.join(centres, "bucket").where("node <> centre")
    spokes = spokes.select(F.least("node", "centre").alias("a"), F.greatest("node", "centre").alias("b")).distinct()
    links = _verified(docs, named, spokes, threshold)
    found = components(links)
    placed = shared.select("bucket", "node").join(found, "node", "left")
    placed = materialize(placed.withColumn("component", F.coalesce("component", "node")), "placed")
    open_ = placed.groupBy("bucket").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo <> hi")
    rest = placed.join(open_, "bucket", "left_semi").select("node", "component").distinct()
    pairs = _rare_pairs(docs, named, materialize(rest, "rest"), threshold)
    final = components(links.union(_verified(docs, named, pairs, threshold)))
    # A class is named after its least row. A large class meets that row in SALTS parts.
    linked = materialize(final.join(named, "node"), "linked")
    least = linked.groupBy("component").agg(F.min("id").alias("class_id"), F.min(F.struct("id", "content")).alias("row"))
    least = least.select("component", "class_id", F.col("row.content").alias("class_content"))
    salts = F.explode(F.array(*(F.lit(i) for i in range(SALTS))))
    salted = linked.withColumn("salt", F.pmod("node", F.lit(SALTS)).cast("int"))
    linked = salted.join(least.withColumn("salt", salts), ["component", "salt"])
    classes = named.join(linked.select("node", "class_id", "class_content"), "node", "left").select(
        "node",
        F.coalesce("class_id", "id").alias("class_id"),
        F.coalesce("class_content", "content").alias("class_content"),
    )
    rows_of = filled.select("id", "content", F.xxhash64("d1", "d2").alias("node"))
    kept = (F.col("id") == F.col("class_id")) & (F.col("content") == F.col("class_content"))
    in_class = rows_of.join(classes, "node").select("id", "content", "class_id", kept.alias("kept"))
    alone = sketches.where("size = 0 OR id IS NULL")
    return in_class.union(alone.select("id", "content", F.col("id").alias("class_id"), F.lit(True).alias("kept")))


def keep_one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """One document of each class: its least id and, of that id's texts in the class, one text.

    A row goes by id and text, so the other texts of its id stay where they are.
    """
    lost, content = fresh(docs, "lost_id"), fresh(docs, "lost_content")
    classes = near_duplicate_classes(docs, id_col, text_col, **options)
    dropped = classes.where("NOT kept").select(F.col("id").alias(lost), F.col("content").alias(content))
    dropped = checked_broadcast(materialize(dropped.distinct(), "dropped"))
    same = (F.col(f"`{id_col}`").cast("long") == F.col(lost)) & (content_of(F.col(f"`{text_col}`")) == F.col(content))
    return docs.join(dropped, same, "left_anti")


def op3_near_dedup(spark, sf_dir: str) -> DataFrame:
    """``doc_id, class_id, kept`` of every document."""
    classes = near_duplicate_classes(table(spark, sf_dir, "documents"))
    return classes.select(F.col("id").alias("doc_id"), "class_id", "kept")
