"""Tokenizer alignment against plain Python over whole texts."""

import hashlib
import random
import re
from bisect import bisect_right
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from textforge.llm import align
from textforge.llm.queries import REGISTRY

FOLDER = "/root/testdata/sf0.001"
A, B = public_tokenizers.path(align.A_FILE), public_tokenizers.path(align.B_FILE)


class Whole:
    """Encodes whole texts and knows nothing of chunks."""

    def __init__(self):
        self.a = Tokenizer.from_file(A)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=B)
        visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
        self.letters = {chr(c): c for c in visible} | {chr(256 + i): c for i, c in enumerate(c for c in range(256) if c not in visible)}

    def groups(self, text):
        """Lists of A and B ids of each group; none if a tokenizer changes the text."""
        if not text:
            return []
        a = self.a.encode(" " + text, add_special_tokens=False).ids
        b = self.b.encode(text)
        a_bytes = [bytes(self.letters[c] for c in self.a.id_to_token(i)) for i in a]
        pieces = [self.b.id_to_piece(i) for i in b]
        b_bytes = [bytes([int(p[3:5], 16)]) if re.fullmatch("<0x[0-9A-F]{2}>", p) else p.replace("▁", " ").encode() for p in pieces]
        if not b"".join(a_bytes) == b"".join(b_bytes) == (" " + text).encode():
            return []
        ends_a, ends_b = np.cumsum([*map(len, a_bytes)]).tolist(), np.cumsum([*map(len, b_bytes)]).tolist()
        out, lo = [], (0, 0)
        for end in sorted({*ends_a} & {*ends_b}):
            hi = bisect_right(ends_a, end), bisect_right(ends_b, end)
            out.append((a[lo[0] : hi[0]], b[lo[1] : hi[1]]))
            lo = hi
        return out


@pytest.fixture(scope="module")
def whole():
    return Whole()


def _brute(whole, texts):
    """Numbers and groups of each text, in order."""
    aligned = [whole.groups(t) for t in texts]
    links = [[(a, b) for x, y in groups for a in x for b in y] for groups in aligned]
    counts = Counter(pair for own in links for pair in set(own))
    best = {}
    for (a, _), n in counts.items():
        best[a] = max(best.get(a, 0), n)
    out = []
    for groups, own in zip(aligned, links):
        shown = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        numbers = (sum(len(x) for x, _ in groups), sum(len(y) for _, y in groups), len(groups), len(own))
        out.append((*numbers, sum(counts[p] == best[p[0]] for p in own), sum(counts[p] for p in own), shown))
    return out


def _shown(row):
    return (row.n_a, row.n_b, row.n_groups, row.n_links, row.n_best, row.count_sum)


def test_query(spark, whole):
    rows = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()
    want = dict(zip([r.doc_id for r in rows], _brute(whole, [r.text for r in rows])))
    found = REGISTRY["op12_tokenizer_alignment"](spark, FOLDER).collect()
    assert len(found) == len(rows)
    for r in found:
        *numbers, groups = want[r.doc_id]
        assert _shown(r) == tuple(numbers), r.doc_id
        assert r.groups_sha256 == (hashlib.sha256(groups.encode()).hexdigest() if groups else "")


def test_edge_rows(spark, edge_docs, no_docs, edge_rows, whole):
    docs = edge_docs.withColumn("n_a", F.lit("own")).withColumn("c0", F.lit(1))
    found = align.align_documents(docs, A, B)
    assert found.columns == [*[c for c in docs.columns if c != "n_a"], *align.NUMBERS, "groups"]
    want = _brute(whole, [t for _, t in edge_rows])
    rows = sorted((str(r.doc_id), str(r.text), _shown(r), r.groups) for r in found.collect())
    assert rows == sorted((str(i), str(t), w[:-1], w[-1]) for (i, t), w in zip(edge_rows, want))
    assert align.align_documents(no_docs, A, B).count() == 0


def test_blocks_and_branches(spark, whole, monkeypatch):
    monkeypatch.setattr(align, "BLOCK_PAIRS", 40)
    monkeypatch.setattr(align, "FAN_IN", 2)
    texts = ["the quick brown fox", "the quick red fox", "a quick ▁ fox", "quick", "Un zorro marrón rápido y un zorro azul"] * 2
    docs = spark.createDataFrame(list(enumerate(texts)), "id long, text string").repartition(5)
    rows = align.align_documents(docs, A, B).orderBy("id").collect()
    assert [(*_shown(r), r.groups) for r in rows] == _brute(whole, texts)
    assert rows[2].n_a == 0 and rows[2].groups == ""


def test_chunks_equal_whole_texts(whole):
    own = align.Aligner(A, B)
    draw = random.Random(6)
    parts = [" ", "  ", "\n", "\t", " ", " ", "\x1c", "\x85", "a", "the", "The", "'s", "n't", "é", "é", "東京", "\U0001f600", "1", "2024", "²", ",", ".", "word, ", "end. ", "ñ; ", "...", "!?", "<s>", "<0x0A>", "<|endoftext|>", "▁", "\x00", "ﬁ", "-", "_", "Antidisestablishment", "مرحبا"]
    texts = ["".join(draw.choices(parts, k=draw.randrange(1, 14))) for _ in range(6000)]
    texts += [" ", "  ", "   ", "\n", " \n", "\n ", "a ", " a", "a  ", "  a", "a \n b"]
    seen = 0
    rows, begins = own.align(texts, True)
    for i, text in enumerate(texts):
        want = whole.groups(text)
        shown = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in want)
        mine = rows[begins[i] : begins[i + 1]]
        assert ";".join(own.groups[r] for r in mine) == shown, repr(text)
        assert own.numbers[mine].sum(0).tolist() == [sum(len(x) for x, _ in want), sum(len(y) for _, y in want), len(want), sum(len(x) * len(y) for x, y in want)]
        seen += len(want) > 3
    assert seen > 2000


def test_frequent_chunks_are_kept(whole):
    own = align.Aligner(A, B)
    own.KEPT = 40
    texts = [f"the quick word{i} and tail{i}, the end" for i in range(60)] * 2
    for lo in range(0, len(texts), 7):
        rows, begins = own.align(texts[lo : lo + 7], True)
        for i, text in enumerate(texts[lo : lo + 7]):
            want = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in whole.groups(text))
            assert ";".join(own.groups[r] for r in rows[begins[i] : begins[i + 1]]) == want
        assert len(own.rows) <= 40 + 7 * 7 and (lo < 60 or "quick" in own.rows)


def test_perfect_hash():
    draw = np.random.default_rng(7)
    keys = np.unique(draw.integers(0, 1 << 62, 50_000).astype(np.uint64))
    made = align.PerfectHash.unpack(align.PerfectHash.of(keys).pack())
    assert sorted(made.index(keys).tolist()) == list(range(len(keys)))
    assert made.index(np.empty(0, np.uint64)).tolist() == [] and len(made.pack()) < len(keys)
    assert len(align.PerfectHash.of(keys[:0]).pack()) == 0


def test_missing_pair_is_noticed():
    keys = np.arange(100, dtype=np.uint64)
    own = keys[align.shard_of(keys) == align.shard_of(keys[:1])[0]]
    made = align.PerfectHash.of(own)
    ordered = np.empty_like(own)
    ordered[made.index(own)] = own
    table = align.PairCounts([(int(align.shard_of(own[:1])[0]), made.pack(), ordered.tobytes(), np.ones(len(own), np.int64).tobytes())], b"")
    assert table.counts(own).tolist() == [1] * len(own)
    other = np.arange(100, 100_000, dtype=np.uint64)
    with pytest.raises(ValueError):
        table.counts(other[align.shard_of(other) == align.shard_of(own[:1])[0]])
