"""Best-fit packing of token sequences with certified bin counts.

Every document becomes token ids (a public tokenizer's file, no special tokens added) and one end id;
only a document longer than ``capacity`` is cut, into pieces of that size. Pieces are packed into
sequences of at most ``capacity`` tokens:

1. Pieces are dealt to partitions by hash, and each partition packs its own by best fit decreasing.
2. Dual feasible functions give lower bounds: such a function maps lengths so that every set that fits
   still fits, so the mapped total over the capacity bounds the number of sequences from below. A
   partition whose count equals its bound is certified, as is the whole when the counts add up to the
   bound over the histogram of all lengths (at most ``capacity`` rows).
3. While the whole is not certified, the partitions with a gap between count and bound exchange what lies
   in their open sequences (those with some room left): these pieces are dealt anew, to as few partitions
   as their size needs, and best fit decreasing runs again. Certified partitions are left as they are
   for as long as that saves sequences; then the open sequences of all partitions are exchanged, for
   bounds of parts may hold where that of the whole does not. A round that saves no sequence is discarded;
   the exchange ends when one of the second kind saves none, however many rounds that takes.

Partitions are sized by tokens and rows, and pieces are dealt by a number of their own, so a hot source or
a group of copies, equal rows too, only makes more of them; a partition holds numbers and no texts. Every round is a written table.

Defined cases: a null or empty text is one piece with the end id alone; repeated rows are packed once
per row; rows with a null id are packed as well; an empty table gives an empty result; extra columns
are ignored.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textforge.llm.frames import table, tidy
from textforge.llm.words import buffers, row_slices
from textforge.session import materialize

CAPACITY = 4096
END_ID = 1
#: What a partition packs: so many tokens in full sequences, and so many rows.
PARTITION_SEQUENCES, PARTITION_ROWS = 4096, 250_000
#: A sequence with more than this share of room is open: its pieces take part in the next round.
OPEN_ROOM = 1 / 64
_MARK = "\x01"  # a character of its own between chunks that are encoded together
_TAIL = b".,;:!?#$%&*|"


class ChunkEncoder:
    """Token ids of texts, made from the ids of their space-separated chunks.

    The tokenizer drops white space and no token spans it, so a text's ids are those of its chunks.
    Chunks recur, so their ids are kept in two generations: the younger one takes what is used, and
    replaces the older one when it is full.
    """

    KEPT = 120_000

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.young, self.old = {b"": b""}, {}
        vocabulary = self.tokenizer.get_vocab()
        size = max(vocabulary.values()) + 1
        self.ends_word, self.is_mark = np.zeros(size, bool), np.zeros(size, bool)
        self.ends_word[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        self.is_mark[self.ids_of(_MARK)] = True

    def ids_of(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4")

    def _learn_together(self, chunks: list[bytes], between: str, last: np.ndarray) -> None:
        """Encodes many chunks as one text; ``last`` tells the ids that end one, with ``between``."""
        mark = int(bool(between.strip()))  # the mark's own id is not the chunk's
        for at in range(0, len(chunks), 20_000):
            some = chunks[at : at + 20_000]
            ids = self.ids_of("".join(c.decode() + between for c in some))
            ends = np.flatnonzero(last[ids])
            if len(ends) != len(some):  # not as expected of this tokenizer: one by one
                self.young.update((c, self.ids_of(c.decode()).tobytes()) for c in some)
                continue
            data, begins = ids.tobytes(), np.concatenate(([0], ends + 1)).tolist()
            for c, lo, hi in zip(some, begins, (ends + 1 - mark).tolist(), strict=False):
                self.young[c] = data[4 * lo : 4 * hi]

    def _learn(self, chunks: list[bytes]) -> None:
        """Ids of new chunks. Letters alone are one word, whose last id is one that ends words; so are
        letters before some ASCII marks, which are a word of their own."""
        words, cut, rest = set(), [], []
        for c in chunks:
            word = c.rstrip(_TAIL)
            if not word.decode().isalpha():
                rest.append(c)
                continue
            words.add(word)
            if len(word) < len(c):
                cut.append((c, word, c[len(word) :]))
        tails = {tail for _, _, tail in cut}.difference(self.young)
        self.young.update((t, self.ids_of(t.decode()).tobytes()) for t in tails)
        self._learn_together(list(words.difference(self.young)), " ", self.ends_word)
        odd = [c for c in rest if _MARK.encode() in c or b"<|" in c]
        self.young.update((c, self.ids_of(c.decode()).tobytes()) for c in odd)
        self._learn_together(list(set(rest).difference(odd)), f" {_MARK} ", self.is_mark)
        self.young.update((c, self.young[word] + self.young[tail]) for c, word, tail in cut)

    def encode(self, texts: list[bytes]) -> list[bytes]:
        """The ids of each text as little-endian unsigned 32-bit numbers."""
        # The tokenizer lower-cases; doing so for A-Z here makes more chunks alike. Its special tokens are left.
        split = [(t if b"<|" in t else t.lower()).replace(b"\n", b" ").split(b" ") for t in texts]
        missing = set().union(*split).difference(self.young)
        found = {c: self.old[c] for c in missing if c in self.old}
        self.young.update(found)
        self._learn([c for c in missing if c not in found])
        ids = [b"".join(map(self.young.__getitem__, chunks)) for chunks in split]
        if len(self.young) > self.KEPT:
            self.young, self.old = {b"": b""}, self.young
        return ids


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def token_pieces(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    path: str | None = None,
    capacity: int = CAPACITY,
    with_ids: bool = False,
) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32`` of every piece, and ``ids`` if wanted."""
    path = path or tokenizer_path()
    end = np.array([END_ID], "<u4").tobytes()

    @tidy
    def pieces(batches):
        encoder = ChunkEncoder(path)
        for batch in batches:
            for begin, stop in row_slices(batch.column(1)):
                data, places = buffers(batch.column(1).slice(begin, stop - begin))
                data, places = data.tobytes(), places.tolist()
                texts = [data[a:b] for a, b in zip(places, places[1:], strict=False)]
                rows = []
                keys = batch.column(0).slice(begin, stop - begin).to_pylist()
                for key, ids in zip(keys, encoder.encode(texts), strict=True):
                    ids += end
                    for piece, lo in enumerate(range(0, len(ids), 4 * capacity)):
                        part = ids[lo : lo + 4 * capacity]
                        row = (key, piece, lo // 4, len(part) // 4, zlib.crc32(part))
                        rows.append((*row, np.frombuffer(part, "<u4").astype(np.int32)) if with_ids else row)
                yield pa.RecordBatch.from_pydict(dict(zip(names, zip(*rows, strict=True), strict=True)), arrow)

    schema = "doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * with_ids
    names = [x.split()[0] for x in schema.split(", ")]
    kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int32())]
    arrow = pa.schema(list(zip(names, kinds, strict=False)))
    return docs.select(F.col(id_col).cast("long"), F.col(text_col)).mapInArrow(pieces, schema)


def lower_bound(lengths: np.ndarray, counts: np.ndarray, capacity: int) -> int:
    """The best bound of two families of dual feasible functions over a histogram of lengths."""
    number = np.zeros(capacity + 1, np.int64)
    np.add.at(number, lengths, counts)
    below, weight = np.concatenate(([0], number.cumsum())), np.concatenate(([0], (number * np.arange(capacity + 1)).cumsum()))
    cut = np.arange(capacity // 2 + 1)
    # Lengths under the cut count nothing, those over capacity - cut a whole sequence.
    best = (capacity * (below[-1] - below[capacity - cut + 1]) + weight[capacity - cut + 1] - weight[cut]).max()
    best = -(-int(best) // capacity)
    for k in range(1, 31):  # rounding down to multiples of capacity / (k + 1)
        scaled = (k + 1) * lengths
        exact = scaled % capacity == 0
        total = int((counts * np.where(exact, lengths * k, scaled // capacity * capacity)).sum())
        best = max(best, -(-total // (k * capacity)))
    return best


def best_fit_decreasing(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bin and offset of each length, lengths given in falling order, and the fill of each bin."""
    free: list[list[int]] = [[] for _ in range(capacity + 1)]
    bins, offsets, left = [], [], []
    rooms = 0  # bit r: some bin has r places left
    for size in lengths.tolist():
        fitting = rooms >> size
        if fitting:
            room = size + (fitting & -fitting).bit_length() - 1
            own = free[room].pop()
            if not free[room]:
                rooms ^= 1 << room
        else:
            room, own = capacity, len(left)
            left.append(capacity)
        bins.append(own)
        offsets.append(capacity - room)
        room -= size
        left[own] = room
        if room:
            free[room].append(own)
            rooms |= 1 << room
    return np.array(bins, np.int64), np.array(offsets, np.int64), capacity - np.array(left, np.int64)


def _round(items: DataFrame, number: int, capacity: int) -> tuple[DataFrame, int]:
    """One run of best fit decreasing over all partitions, and the number of sequences used."""
    tokens, rows = items.agg(F.sum("length"), F.count("*")).first()
    parts = max(1, -(-(tokens or 0) // (capacity * PARTITION_SEQUENCES)), -(-rows // PARTITION_ROWS))
    columns = [c for c in items.columns if c not in ("part", "sequence_id", "offset", "fill", "bins", "bound")]
    key = F.pmod(F.xxhash64("nth", F.lit(number)), F.lit(parts))

    def pack(group: pa.Table) -> pa.Table:
        group = group.sort_by([("length", "descending"), ("doc_id", "ascending"), ("piece", "ascending")])
        lengths = group.column("length").to_numpy()
        own, offsets, fill = best_fit_decreasing(lengths, capacity)
        part = group.column("part")[0].as_py()
        bound = lower_bound(*np.unique(lengths, return_counts=True), capacity)
        n = group.num_rows
        for name, value in (
            ("sequence_id", own + ((number << 48) | (part << 24))),
            ("offset", offsets),
            ("fill", fill[own]),
            ("bins", np.full(n, len(fill))),
            ("bound", np.full(n, bound)),
        ):
            group = group.append_column(name, pa.array(value, pa.int64()))
        return group

    dealt = items.select(*columns).withColumn("part", key)
    added = ("sequence_id", "offset", "fill", "bins", "bound")
    schema = T.StructType([*dealt.schema.fields, *(T.StructField(name, T.LongType()) for name in added)])
    packed = materialize(dealt.groupBy("part").applyInArrow(pack, schema), f"packed-{number}")
    used = packed.groupBy("part").agg(F.first("bins").alias("bins")).agg(F.sum("bins")).first()[0]
    return packed, used or 0


def pack(pieces: DataFrame, capacity: int = CAPACITY, exchange: bool = True) -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset``; ``bins`` and ``bound`` of the packing partition too."""
    items = materialize(pieces.withColumn("nth", F.monotonically_increasing_id()), "pieces")
    histogram = np.array(items.groupBy("length").count().collect(), np.int64).reshape(-1, 2)
    bound = lower_bound(histogram[:, 0], histogram[:, 1], capacity)
    packed, used = _round(items, 1, capacity)
    with_room = F.col("fill") < capacity - int(capacity * OPEN_ROOM)
    with_gap = F.col("bins") > F.col("bound")
    number, among = 1, with_gap
    while exchange and used > bound:
        number += 1
        open_ = packed.where(with_room & among)
        n_open = open_.where("offset = 0").count()
        again, used_again = _round(open_, number, capacity)
        if used_again < n_open:
            packed = packed.where(~(with_room & among)).unionByName(again)
            if number % 16 == 0:  # the plan has one table per round
                packed = materialize(packed, f"repacked-{number}")
            used -= n_open - used_again
        elif among is with_gap:
            among = F.lit(True)
        else:
            break
    return packed.drop("nth")


def sequences(packed: DataFrame) -> DataFrame:
    """``sequence_id, ids`` from pieces packed with their ids; a sequence holds ``capacity`` ids at most."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(F.flatten(F.transform(parts, lambda x: x["ids"])).alias("ids"))


def pack_documents(docs: DataFrame, **options) -> DataFrame:
    packed = pack(token_pieces(docs, **options))
    return packed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op4_best_fit_packing(spark, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"))
