"""Links between the tokens of two tokenizers, counted over the corpus by minimal perfect hashing.

Space + text is encoded by A (byte-level BPE) and by B (pieces with byte fallback). Byte offsets where
tokens of both end cut them into groups, and every A token of a group is linked with every B token of it.

No token of either tokenizer goes over a place where a space follows a character that is not white space,
or where a mark ends a word of letters (A's pattern splits there, and B's vocabulary is checked for it), so
both encode the chunks between such places on their own, and groups end there. Chunks recur, so what was
learnt of one is kept for a while.

1. First pass: every parcel of documents yields its distinct id pairs, each with the number of its documents
   that hold it, as one row per shard; the shard is a hash of the pair, and shards are bounded since pairs
   are.
2. The distinct pairs of each shard get a minimal perfect hash: levels of bit arrays, in which a key's bit
   is set at the first level where no other key falls on it; its index is the number of set bits before.
3. Parcels are cut into branches; each makes a dense vector of counts per shard, indexed by the hash, and the
   vectors are summed as a tree. Keys stand at their index as well, and every look-up compares them.
4. Second pass: documents are aligned again, pairs are hashed, verified and looked up, and the counts are
   summed per document. The table goes out in blocks of at most ``BLOCK_PAIRS`` pairs, one narrow pass each;
   sums over blocks add up, so there is no limit on the pairs.

Defined cases: texts that are null or empty, or that B does not give back byte by byte (as with U+2581
itself), have no tokens: zeros and empty groups; repeated rows count as documents of their own; rows with
a null id are treated like any; an empty table gives an empty result; other columns pass through, but
those of the result's names, which are replaced.
"""

from __future__ import annotations

import functools
import json
import os
import re
import uuid
from collections import Counter
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import tiktoken
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textforge.llm.frames import table, tidy
from textforge.llm.words import mix, row_slices
from textforge.session import materialize

A_FILE, B_FILE = "byte_bpe_50k.json", "piece_bpe_32k.model"
SHARDS = 256
#: Pairs of a parcel (distinct ones per 2 MB of text), parcels that a branch of the tree adds, pairs of a broadcast block.
PARCEL_PAIRS, FAN_IN, BLOCK_PAIRS = 4_000_000, 64, 4_000_000
#: Bits per key in each level of the hash.
SPARSE = 2
NUMBERS = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")

_CHUNK = re.compile(r" ( *[^ ].*?(?=(?<=\S) (?! *\Z)|\Z))", re.DOTALL)
#: Fixed value: how A's text is split before its merges.
SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Characters from which on a chunk is encoded on its own.
LONG = 400
#: White space before a space: such texts are cut by pattern.
_ODD = [f"{chr(c)} " for c in range(0x3001) if chr(c).isspace()]
_LETTER = "[A-Za-zÀ-ÖØ-öø-ɏ]"
_TAILS = ",.;:!?"


def _bytes_of_letters() -> dict[str, int]:
    """The letters that stand for bytes in byte-level tokens: visible ones for themselves, the others from 256 on."""
    visible = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in visible]
    return {chr(b): b for b in visible} | {chr(256 + i): b for i, b in enumerate(others)}


def _starts(sizes: np.ndarray) -> np.ndarray:
    return np.concatenate(([0], np.cumsum(sizes)))


def _ranges(begins: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """All numbers of the ranges, one range after another."""
    return np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes) + np.repeat(begins, sizes)


def _distinct(numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct numbers in order, and how often each is there."""
    numbers = np.sort(numbers)
    first = np.flatnonzero(np.concatenate(([True], numbers[1:] != numbers[:-1]))[: len(numbers)])
    return numbers[first], np.diff(np.append(first, len(numbers)))


class Aligner:
    """Both tokenizers and the chunks met lately, a row of numbers each.

    ``numbers`` holds A tokens, B tokens, groups and links of each row; ``links`` all rows' links as pairs,
    ``begins`` where each row's begin; ``groups`` the groups as text; ``bad`` the rows that B does not give back.
    """

    KEPT = 300_000

    def __init__(self, a_path: str, b_path: str):
        import sentencepiece
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # the tasks are the threads
        self.a = Tokenizer.from_file(a_path)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        letters, vocabulary = _bytes_of_letters(), self.a.get_vocab()
        self.n_a, self.n_b = max(vocabulary.values()) + 1, self.b.get_piece_size()
        self.bytes_a = [b""] * self.n_a
        for token, i in vocabulary.items():
            self.bytes_a[i] = bytes(letters[c] for c in token)
        self.bytes_b = [self._piece(i) for i in range(self.n_b)]
        self.ranks = self._ranked(a_path, vocabulary)
        self.size_a, self.size_b = (np.array([*map(len, x)]) for x in (self.bytes_a, self.bytes_b))
        texts = [b.decode("utf-8", "replace") for b in self.bytes_b]
        if any(re.search("[^ ] ", x) for x in texts):
            raise ValueError("the second tokenizer has pieces with a space after another character")
        self.texts = [[f"{i}{mark}" for i in range(max(self.n_a, self.n_b))] for mark in (",", "|", ";")]
        # A mark after a letter is a chunk of its own where no piece of B has both.
        tails = [c for c in _TAILS if not any(re.search(f"{_LETTER}[{c}]", x) for x in texts)]
        # Patterns begin with what is rare, which is looked for fast.
        self.tail = re.compile(f"([{''.join(tails)}])(?<={_LETTER}.)(?= |\\Z|\\n\\S)") if tails else None
        # So is a line's end with the word after it, where no piece has it and more.
        self.line = re.compile(r"\n(?=\S)(?<=\S\n)") if not any("\n" in x[:-1] or "\n" in x[1:] for x in texts) else None
        self.mark = self.b.piece_to_id("▁")
        self.tails = {f"\x00{c}": ([vocabulary[c]], [self.b.piece_to_id(c)]) for c in tails}
        self.forget()

    def _piece(self, i: int) -> bytes:
        piece = self.b.id_to_piece(i)
        return bytes([int(piece[1:-1], 16)]) if self.b.is_byte(i) else piece.replace("▁", " ").encode()

    def forget(self) -> None:
        self.rows: dict[str, int] = {}
        self.numbers, self.bad = np.empty((0, 4), np.int64), np.empty(0, bool)
        self.links, self.begins, self.groups = np.empty(0, np.int64), np.zeros(1, np.int64), []
        self.looked_up, self.counted, self.used = "", np.empty((0, 2), np.int64), np.empty(0, np.int64)

    def _keep_frequent(self) -> None:
        """Forgets all but the half that was met most often; their uses count half from now on."""
        kept = np.sort(np.argsort(self.used, kind="stable")[-self.KEPT // 2 :])
        names = [*self.rows]
        self.rows = {names[i]: n for n, i in enumerate(kept.tolist())}
        sizes = np.diff(self.begins)[kept]
        self.links = self.links[_ranges(self.begins[kept], sizes)]
        self.begins, self.numbers, self.bad, self.used = _starts(sizes), self.numbers[kept], self.bad[kept], self.used[kept] // 2
        self.groups = [self.groups[i] for i in kept.tolist()] if len(self.groups) == len(names) else []
        self.looked_up = ""

    def chunks(self, text: str) -> list[str]:
        """The chunks of space + text: each without its first space, or with a zero before if it has none."""
        if not (text[0] == " " or text[-1] == " " or "\x00" in text or any(x in text for x in _ODD)):
            for pattern, apart in ((self.tail, " \x00\\1"), (self.line, " \x00\n")):
                text = pattern.sub(apart, text) if pattern else text
            return text.split(" ")
        found = _CHUNK.findall(f" {text}") if text.strip(" ") else [text]
        return [f"\x00 {c}" if c[0] == "\x00" else c for c in found]  # a zero of the text's own

    def _learn(self, chunks: list[str], with_groups: bool) -> None:
        """Aligns new chunks all at once: the byte offsets of one are above those of the one before."""
        plain = [c for c in chunks if c not in self.tails]
        chunks = plain + [c for c in chunks if c in self.tails]
        own = [c[1:] if c[:1] == "\x00" else f" {c}" for c in plain]
        whole = [c.encode() for c in [*own, *(c[1:] for c in chunks[len(plain) :])]]
        a, of_a = self._together(own, whole[: len(own)])
        each = self._encode_b(own)
        b, of_b = np.fromiter(chain.from_iterable(each), np.int64), np.array([*map(len, each)], np.int64)
        last = [self.tails[c] for c in chunks[len(plain) :]]
        a, b = (np.concatenate((x, np.array([i for t in last for i in t[n]], np.int64))) for n, x in enumerate((a, b)))
        of_a, of_b = (np.concatenate((x, np.array([len(t[n]) for t in last], np.int64))) for n, x in enumerate((of_a, of_b)))
        bad = np.zeros(len(chunks), bool)
        joined = b"".join(whole)
        if b"".join(map(self.bytes_a.__getitem__, a.tolist())) != joined or b"".join(map(self.bytes_b.__getitem__, b.tolist())) != joined or not self._even(a, of_a, b, of_b, whole):
            bad, a, of_a, b, of_b = self._without_bad(a, of_a, b, of_b, whole)
        ends_a, ends_b = np.cumsum(self.size_a[a]), np.cumsum(self.size_b[b])
        ends = np.intersect1d(ends_a, ends_b, assume_unique=True)
        group_a, group_b = np.searchsorted(ends, ends_a), np.searchsorted(ends, ends_b)
        in_a, in_b = np.bincount(group_a, minlength=len(ends)), np.bincount(group_b, minlength=len(ends))
        per_a = in_b[group_a] if len(a) else in_b[:0]
        links = np.repeat(a, per_a) * self.n_b + b[_ranges(_starts(in_b)[:-1][group_a], per_a)]
        last_a = _starts(of_a)
        n_groups = np.diff(np.concatenate((group_a, [len(ends)]))[last_a])
        n_links = np.diff(_starts(per_a)[last_a])
        n = len(self.bad)
        self.rows.update(zip(chunks, range(n, n + len(chunks))))
        self.bad = np.concatenate((self.bad, bad))
        self.numbers = np.concatenate((self.numbers, np.stack([of_a, of_b, n_groups, n_links], 1)))
        self.links = np.concatenate((self.links, links))
        self.begins = np.concatenate((self.begins, self.begins[-1] + np.cumsum(n_links)))
        if with_groups:
            self.groups += self._shown(a, b, group_a, group_b, _starts(n_groups), in_a, in_b)

    def _ranked(self, path: str, vocabulary: dict[str, int]):
        """The same tokenizer in a library that is faster on long texts; None if its ids aren't ranks."""
        with open(path, encoding="utf-8") as file:
            merges = json.load(file)["model"]["merges"]
        pairs = [m.split(" ") if isinstance(m, str) else m for m in merges]
        if any(vocabulary.get("".join(p)) != 256 + i for i, p in enumerate(pairs)):
            return None
        ranks = {self.bytes_a[i]: i for i in range(256 + len(pairs))}
        return tiktoken.Encoding("a", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={})

    def _encode_a(self, text: str, short: bool = False) -> list[int]:
        if short and self.ranks is not None:  # of short words
            return self.ranks.encode_ordinary(text)
        return self.a.encode_batch_fast([text], add_special_tokens=False)[0].ids

    def _encode_b(self, texts: list[str]) -> list[list[int]]:
        """B adds a space, so one is taken off; before a line's end it is a piece that is left out."""
        found = self.b.encode([t.removeprefix(" ") for t in texts], num_threads=1)
        return [x[1:] if t[0] == "\n" and x[:1] == [self.mark] else x for t, x in zip(texts, found)]

    def _together(self, own: list[str], whole: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """A's ids of all chunks, and how many each has. Short chunks that end in no white space are one
        text, cut where they end; should a token go over such a place, they are encoded one by one."""
        apart = np.array([c[-1].isspace() or len(c) > LONG for c in own], bool)
        alike = [c for c, odd in zip(own, apart) if not odd]
        ids = np.array(self._encode_a("".join(alike), True) if alike else [], np.int64)
        ends = np.cumsum(self.size_a[ids])
        wanted = np.cumsum([len(w) for w, odd in zip(whole, apart) if not odd])
        at = np.searchsorted(ends, wanted)
        if len(alike) and (at[-1] != len(ends) - 1 or (ends[at] != wanted).any()):
            each = [self._encode_a(c) for c in own]
            return np.fromiter(chain.from_iterable(each), np.int64), np.array([*map(len, each)], np.int64)
        n = np.zeros(len(own), np.int64)
        n[~apart] = np.diff(np.concatenate(([-1], at)))
        each = [self._encode_a(c) for c, odd in zip(own, apart) if odd]
        n[apart] = [*map(len, each)]
        out = np.empty(n.sum(), np.int64)
        begins = _starts(n)[:-1]
        out[_ranges(begins[~apart], n[~apart])] = ids
        out[_ranges(begins[apart], n[apart])] = np.fromiter(chain.from_iterable(each), np.int64)
        return out, n

    def _even(self, a, of_a, b, of_b, whole) -> bool:
        """Whether every chunk's tokens make up its bytes."""
        size = np.array([*map(len, whole)])
        return all((np.diff(_starts(sizes[x])[_starts(n)]) == size).all() for x, n, sizes in ((a, of_a, self.size_a), (b, of_b, self.size_b)))

    def _without_bad(self, a, of_a, b, of_b, whole):
        """Leaves out the chunks that a tokenizer changes."""
        parts = [[x[lo:hi].tolist() for lo, hi in zip(_starts(n), _starts(n)[1:])] for x, n in ((a, of_a), (b, of_b))]
        bad = np.array([b"".join(map(self.bytes_a.__getitem__, x)) != w or b"".join(map(self.bytes_b.__getitem__, y)) != w for x, y, w in zip(*parts, whole)], bool)
        of_a, of_b = np.where(bad, 0, of_a), np.where(bad, 0, of_b)
        kept = [[i for x, odd in zip(p, bad) if not odd for i in x] for p in parts]
        return bad, np.array(kept[0], np.int64), of_a, np.array(kept[1], np.int64), of_b

    def _shown(self, a, b, group_a, group_b, of_chunk, in_a, in_b) -> list[str]:
        """The groups of each chunk as text."""
        ends_a, ends_b = np.cumsum(in_a), np.cumsum(in_b)
        mark_a, mark_b = np.zeros(len(a), np.int64), np.zeros(len(b), np.int64)
        mark_a[ends_a - 1], mark_b[ends_b - 1] = 1, 2
        order = np.argsort(np.concatenate((2 * group_a, 2 * group_b + 1)), kind="stable")
        ids, marks = np.concatenate((a, b))[order].tolist(), np.concatenate((mark_a, mark_b))[order].tolist()
        parts = [self.texts[m][i] for m, i in zip(marks, ids)]
        cuts = _starts(in_a + in_b)[of_chunk].tolist()
        return ["".join(parts[lo:hi])[:-1] for lo, hi in zip(cuts, cuts[1:])]

    def align(self, texts: list[str | None], with_groups: bool = False) -> tuple[np.ndarray, np.ndarray]:
        """Rows of the chunks of all texts, and where each text's begin; none for one without tokens."""
        if with_groups and len(self.groups) < len(self.rows):
            self.forget()
        elif len(self.rows) > self.KEPT:
            self._keep_frequent()
        split = [self.chunks(t) if t else [] for t in texts]
        missing = set().union(*split).difference(self.rows)
        if missing:
            self._learn([*missing], with_groups)
        sizes = np.array([*map(len, split)], np.int64)
        rows = np.fromiter(map(self.rows.__getitem__, chain.from_iterable(split)), np.int64, sizes.sum())
        used = np.bincount(rows, minlength=len(self.bad))
        used[: len(self.used)] += self.used
        self.used = used
        text = np.repeat(np.arange(len(split)), sizes)
        lost = np.bincount(text[self.bad[rows]], minlength=len(split)) > 0
        return rows[~lost[text]], _starts(np.where(lost, 0, sizes))

    def pairs(self, rows: np.ndarray, begins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Distinct linked pairs of the texts, and in how many of them each is."""
        text = np.repeat(np.arange(len(begins) - 1), np.diff(begins))
        once, _ = _distinct(text << 40 | rows)
        text, rows = once >> 40, once & (1 << 40) - 1
        sizes = np.diff(self.begins)[rows]
        held = np.repeat(text, sizes) << 40 | self.links[_ranges(self.begins[rows], sizes)]
        return _distinct(_distinct(held)[0] & (1 << 40) - 1)


@functools.lru_cache(maxsize=1)
def aligner(a_path: str, b_path: str) -> Aligner:
    """One per worker; it outlives the task."""
    return Aligner(a_path, b_path)


def shard_of(keys: np.ndarray) -> np.ndarray:
    return (mix(keys ^ np.uint64(0x51_7C_C1_B7_27_22_0A_95)) >> np.uint64(40)).astype(np.int64) % SHARDS


class PerfectHash:
    """A minimal perfect hash of distinct 64-bit keys."""

    def __init__(self, levels: list[np.ndarray]):
        self.levels = levels
        self.before = np.cumsum([0, *(int(level.sum()) for level in levels)])
        self.ranks = [np.cumsum(level, dtype=np.int32) - 1 for level in levels]

    @staticmethod
    def _slot(keys: np.ndarray, level: int, size: int) -> np.ndarray:
        seed = np.uint64((level + 1) * 0x9E3779B97F4A7C15 & (1 << 64) - 1)
        return (mix(keys + seed) >> np.uint64(20)).astype(np.int64) % size

    @classmethod
    def of(cls, keys: np.ndarray) -> PerfectHash:
        levels = []
        while len(keys):
            size = SPARSE * len(keys) + 1
            slots = cls._slot(keys, len(levels), size)
            alone = np.bincount(slots, minlength=size) == 1
            levels.append(alone)
            keys = keys[~alone[slots]]
        return cls(levels)

    def index(self, keys: np.ndarray) -> np.ndarray:
        """The index of each key, below the number of keys; -1 for some that are none."""
        out = np.full(len(keys), -1, np.int64)
        open_ = np.arange(len(keys))
        for i, level in enumerate(self.levels):
            slots = self._slot(keys[open_], i, len(level))
            here = level[slots]
            out[open_[here]] = self.before[i] + self.ranks[i][slots[here]]
            open_ = open_[~here]
        return out

    def pack(self) -> bytes:
        return b"".join(len(x).to_bytes(8, "little") + np.packbits(x).tobytes() for x in self.levels)

    @classmethod
    def unpack(cls, data: bytes) -> PerfectHash:
        levels, at = [], 0
        while at < len(data):
            size = int.from_bytes(data[at : at + 8], "little")
            at += 8
            levels.append(np.unpackbits(np.frombuffer(data, np.uint8, -(-size // 8), at), count=size).astype(bool))
            at += -(-size // 8)
        return cls(levels)


def _pairs(a_path: str, b_path: str):
    """Texts to ``parcel, shard, keys, docs``: the distinct pairs of a parcel and their documents."""

    def rows(found: list[tuple[np.ndarray, np.ndarray]], parcel: int) -> pa.RecordBatch:
        keys, at = np.unique(np.concatenate([k for k, _ in found]), return_inverse=True)
        docs = np.bincount(at, np.concatenate([n for _, n in found]), len(keys)).astype(np.int64)
        shards = shard_of(keys.astype(np.uint64))
        order = np.argsort(shards, kind="stable")
        there, begins = np.unique(shards[order], return_index=True)
        ends = pa.array(np.append(begins, len(keys)), pa.int32())
        lists = (pa.ListArray.from_arrays(ends, pa.array(x[order])) for x in (keys, docs))
        return pa.record_batch([pa.array([parcel] * len(there)), pa.array(there, pa.int32()), *lists], names=["parcel", "shard", "keys", "docs"])

    @tidy
    def run(batches):
        own, parcel, found = aligner(a_path, b_path), TaskContext.get().partitionId() << 32, []
        for batch in batches:
            for lo, hi in row_slices(batch.column(0)):
                found.append(own.pairs(*own.align(batch.column(0).slice(lo, hi - lo).to_pylist())))
                if sum(len(k) for k, _ in found) >= PARCEL_PAIRS:
                    yield rows(found, parcel)
                    parcel, found = parcel + 1, []
        if any(len(k) for k, _ in found):
            yield rows(found, parcel)

    return run


def _numbers(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    return (column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column).to_numpy(zero_copy_only=False)


def _hash_of(group: pa.Table) -> pa.Table:
    """All distinct keys of a shard to their hash, and the keys in the order of their indices."""
    keys = _numbers(group["key"]).astype(np.uint64)
    made = PerfectHash.of(keys)
    at = made.index(keys)
    ordered = np.empty_like(keys)
    ordered[at] = keys
    return pa.table({"shard": group["shard"][:1].cast(pa.int32()), "hash": pa.array([made.pack()], pa.binary()), "ordered": pa.array([ordered.tobytes()], pa.binary())})


def _dense(group: pa.Table, shard: pa.Table) -> pa.Table:
    """A branch's pairs of one shard as a dense vector of counts."""
    made, ordered = PerfectHash.unpack(shard["hash"][0].as_py()), np.frombuffer(shard["ordered"][0].as_py(), np.uint64)
    total = np.zeros(len(ordered), np.int64)
    for keys, docs in zip(group["keys"], group["docs"]):
        keys, docs = _numbers(keys.values).astype(np.uint64), _numbers(docs.values)
        at = made.index(keys)
        if not np.array_equal(ordered[at], keys):
            raise ValueError("a pair is not where its hash says")
        total[at] += docs  # keys of a row are distinct
    return _vector(group, total)


def _vector(group: pa.Table, total: np.ndarray) -> pa.Table:
    return pa.table({"shard": group["shard"][:1].cast(pa.int32()), "branch": group["branch"][:1].cast(pa.int64()), "counts": pa.array([total.tobytes()], pa.binary())})


def _sum_vectors(group: pa.Table) -> pa.Table:
    total = None
    for data in group["counts"]:
        counts = np.frombuffer(data.as_buffer(), np.int64)
        total = counts.copy() if total is None else total + counts
    return _vector(group, total)


_VECTOR = "shard int, branch long, counts binary"


def pair_table(texts: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """``shard, hash, ordered, counts`` of all linked pairs of a one-column table of texts: the hash, the
    pairs (A id x size of B + B id) by index, and the number of documents of each, all as bytes."""
    found = texts.mapInArrow(_pairs(a_path, b_path), "parcel long, shard int, keys array<bigint>, docs array<bigint>")
    found = materialize(found, "align-pairs")
    distinct = found.select("shard", F.explode_outer("keys").alias("key")).where("key IS NOT NULL").distinct()
    hashes = distinct.groupBy("shard").applyInArrow(_hash_of, "shard int, hash binary, ordered binary")
    hashes = materialize(hashes, "align-hashes")

    n = -(-found.select("parcel").distinct().count() // FAN_IN)
    rows = found.select(_branch("parcel", n), "shard", "keys", "docs")
    per_branch = hashes.join(found.select(_branch("parcel", n), "shard").distinct(), "shard")
    by = ["shard", "branch"]
    vectors = rows.groupBy(*by).cogroup(per_branch.groupBy(*by)).applyInArrow(_dense, _VECTOR)
    while n > 1:
        vectors = materialize(vectors, "align-counts")
        n = -(-n // FAN_IN)
        vectors = vectors.withColumn("branch", _branch("branch", n)).groupBy(*by).applyInArrow(_sum_vectors, _VECTOR)
    return materialize(hashes.join(vectors.select("shard", "counts"), "shard"), "align-table")


def _branch(key: str, n: int) -> Column:
    return F.pmod(F.xxhash64(key, F.lit(n)), F.lit(max(1, n))).alias("branch")


def _best(n_pieces: int):
    """The highest count of each A id in a shard."""

    def run(batches):
        for batch in batches:
            for ordered, counts in zip(batch.column(0), batch.column(1)):
                ids = (np.frombuffer(ordered.as_buffer(), np.uint64) // np.uint64(n_pieces)).astype(np.int64)
                there, at = np.unique(ids, return_inverse=True)
                most = np.zeros(len(there), np.int64)
                np.maximum.at(most, at, np.frombuffer(counts.as_buffer(), np.int64))
                yield pa.record_batch([pa.array(there), pa.array(most)], names=["a", "most"])

    return run


class PairCounts:
    """A block of the pair table: verified look-up of counts."""

    held: tuple[str, PairCounts] | None = None  # of the worker's last broadcast

    def __init__(self, shards: list[tuple], best: bytes):
        self.shards = {
            shard: (PerfectHash.unpack(made), np.frombuffer(ordered, np.uint64), np.frombuffer(counts, np.int64))
            for shard, made, ordered, counts in shards
        }
        self.best = np.frombuffer(best, np.int64)

    @classmethod
    def of(cls, sent, token: str) -> PairCounts:
        if cls.held is None or cls.held[0] != token:
            cls.held = None
            cls.held = token, cls(*sent.value)
        return cls.held[1]

    def counts(self, keys: np.ndarray) -> np.ndarray:
        """The counts of the pairs that lie in this block; 0 for the others."""
        out = np.zeros(len(keys), np.int64)
        shards = shard_of(keys)
        order = np.argsort(shards, kind="stable")
        begins = np.searchsorted(shards[order], np.arange(SHARDS + 1))
        for shard, (made, ordered, counts) in self.shards.items():
            own = order[begins[shard] : begins[shard + 1]]
            at = made.index(keys[own])
            if not np.array_equal(ordered[at], keys[own]):
                raise ValueError("a pair of the corpus is missing in its counts")
            out[own] = counts[at]
        return out

    def of_rows(self, own: Aligner, token: str, rows: np.ndarray) -> np.ndarray:
        """Best links and sum of counts of the aligner's rows; each is looked up when it is first met."""
        if own.looked_up != token:
            own.looked_up, own.counted = token, np.empty((0, 2), np.int64)
        unknown = np.full((len(own.bad) - len(own.counted), 2), -1)
        own.counted = np.concatenate((own.counted, unknown))
        new = np.unique(rows[own.counted[rows, 0] < 0])
        sizes = np.diff(own.begins)[new]
        keys = own.links[_ranges(own.begins[new], sizes)]
        counts = self.counts(keys.astype(np.uint64))
        best = (counts == self.best[keys // own.n_b]) & (counts > 0)
        own.counted[new] = np.stack([np.diff(_starts(x)[_starts(sizes)]) for x in (best, counts)], 1)
        return own.counted[rows]


def _look_up(a_path: str, b_path: str, text: int, sent, token: str, first: bool):
    """Rows with their numbers; after the first block, only what the block's pairs add to them."""

    @tidy
    def run(batches):
        own, table_ = aligner(a_path, b_path), PairCounts.of(sent, token)
        for batch in batches:
            for lo, hi in row_slices(batch.column(text)):
                part = batch.slice(lo, hi - lo)
                rows, begins = own.align(part.column(text).to_pylist(), first)
                each = np.concatenate((own.numbers[rows], table_.of_rows(own, token, rows)), 1)
                sums = np.diff(np.concatenate((np.zeros((1, 6), np.int64), each.cumsum(0)))[begins], axis=0)
                numbers, columns = [pa.array(x) for x in sums.T.copy()], part.columns
                if first:
                    shown = [own.groups[r] for r in rows.tolist()]
                    groups = [";".join(shown[lo:hi]) for lo, hi in zip(begins.tolist(), begins[1:].tolist())]
                    columns = [*columns, *numbers, pa.array(groups, pa.string())]
                else:
                    columns[-3:-1] = [pc.add(x, y) for x, y in zip(columns[-3:-1], numbers[4:])]
                yield pa.record_batch(columns, names=[f"c{i}" for i in range(len(columns))])

    return run


def _blocks(sizes: list[tuple[int, int]]) -> list[list[int]]:
    """Shards in blocks of at most BLOCK_PAIRS pairs, a larger shard alone."""
    out, room = [[]], BLOCK_PAIRS
    for shard, n in sizes:
        if n > room and out[-1]:
            out.append([])
            room = BLOCK_PAIRS
        out[-1].append(shard)
        room -= n
    return out


def align_documents(docs: DataFrame, a_path: str, b_path: str, text_col: str = "text") -> DataFrame:
    """``docs`` with ``n_a, n_b, n_groups, n_links, n_best, count_sum`` and ``groups`` as text."""
    docs = docs.select(*[F.col(f"`{c}`") for c in docs.columns if c == text_col or c not in (*NUMBERS, "groups")])
    context = docs.sparkSession.sparkContext
    pairs = pair_table(docs.select(F.col(f"`{text_col}`").alias("text")), a_path, b_path)
    n_ids, n_pieces = _sizes(a_path, b_path)
    best = np.zeros(n_ids, np.int64)  # bounded by A's vocabulary
    most = pairs.select("ordered", "counts").mapInArrow(_best(n_pieces), "a long, most long").groupBy("a").agg(F.max("most").alias("most"))
    for r in most.collect():
        best[r.a] = r.most
    sizes = pairs.select("shard", (F.length("ordered") / 8).cast("long").alias("n")).orderBy("shard").collect()
    made = T.StructType([*(T.StructField(f"c{i}", f.dataType) for i, f in enumerate(docs.schema)), *(T.StructField(n, T.LongType()) for n in NUMBERS), T.StructField("groups", T.StringType())])
    rows, names = docs, [*docs.columns, *NUMBERS, "groups"]
    blocks = _blocks([(r.shard, r.n) for r in sizes])
    for i, shards in enumerate(blocks):
        block = pairs.where(F.col("shard").isin(shards)).collect()
        sent = context.broadcast(([(r.shard, bytes(r.hash), bytes(r.ordered), bytes(r.counts)) for r in block], best.tobytes()))
        rows = rows.mapInArrow(_look_up(a_path, b_path, docs.columns.index(text_col), sent, uuid.uuid4().hex, i == 0), made)
        if i + 1 < len(blocks):
            rows = materialize(rows, "aligned")
    return rows.toDF(*names)


def _sizes(a_path: str, b_path: str) -> tuple[int, int]:
    own = aligner(a_path, b_path)
    return own.n_a, own.n_b


def op12_tokenizer_alignment(spark, sf_dir: str) -> DataFrame:
    """The alignment of every document, with its groups as a digest."""
    import public_tokenizers

    paths = (public_tokenizers.path(name) for name in (A_FILE, B_FILE))
    found = align_documents(table(spark, sf_dir, "documents").select("doc_id", "text"), *paths)
    digest = F.when(F.col("n_a") + F.col("n_b") > 0, F.sha2("groups", 256)).otherwise(F.lit(""))
    return found.select("doc_id", *NUMBERS, digest.alias("groups_sha256"))
