from collections import defaultdict

from tests.llm import brute
import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from textforge.llm.packing import (
    best_fit_decreasing,
    lower_bound,
    pack,
    pack_documents,
    sequences,
    token_pieces,
    tokenizer_path,
)
from textforge.llm.queries import REGISTRY

FOLDER = "/root/testdata/sf0.001"


def _check(rows, texts):
    tokenizer = Tokenizer.from_file(tokenizer_path())
    want = [p for i, t in texts for p in brute.pieces(i, tokenizer.encode(t or "", add_special_tokens=False).ids)]
    got = [(r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows]
    assert sorted(map(str, got)) == sorted(map(str, want))
    by_sequence = defaultdict(list)
    for r in rows:
        by_sequence[r.sequence_id].append((r.offset, r.length))
    for parts in by_sequence.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 4096
    return by_sequence


def test_documents(spark):
    rows = REGISTRY["op4_best_fit_packing"](spark, FOLDER).collect()
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    found = _check(rows, [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()])
    assert len(found) == -(-sum(r.length for r in rows) // 4096)  # no packing has fewer


def test_edge_rows(edge_docs, no_docs, edge_rows):
    _check(pack_documents(edge_docs).collect(), edge_rows)
    assert pack_documents(no_docs).count() == 0


def test_special_and_odd_chunks(spark):
    texts = ["a\x01b \x01 c", "x <|endoftext|> Y<|STARTOFTEXT|>", "İSTANBUL ΣΑΣ e\u0301 E\u0301", "a\u00a0b\u2003c\td\r\ne\x1cf", "it's I'LL 3rd"]
    rows = [(i, t) for i, t in enumerate(texts)]
    _check(pack_documents(spark.createDataFrame(rows, "doc_id long, text string")).collect(), rows)


def test_exchange_between_partitions(spark, monkeypatch):
    from textforge.llm import packing

    monkeypatch.setattr(packing, "PARTITION_SEQUENCES", 16)
    draw = np.random.default_rng(1)
    rows = [(i, 0, 0, int(n), i) for i, n in enumerate(draw.integers(1, 1500, 800))]
    pieces = spark.createDataFrame(rows, "doc_id long, piece int, start long, length long, ids_crc32 long")
    packed = pack(pieces).collect()
    assert len(packed) == len(rows)
    used = len({r.sequence_id for r in packed})
    bound = -(-sum(r[3] for r in rows) // 4096)
    alone = len({r.sequence_id for r in pack(pieces, exchange=False).collect()})
    assert bound <= used <= bound + 2 and used < alone
    by_sequence = defaultdict(int)
    for r in packed:
        by_sequence[r.sequence_id] += r.length
    assert max(by_sequence.values()) <= 4096


def test_rounds_go_on_while_they_save(spark, monkeypatch):
    """More than four rounds, and as many sequences as one partition needs for the whole, or less."""
    from textforge.llm import packing

    draw = np.random.default_rng(3)
    lengths = draw.choice([1366, 1365, 2049, 2047, 1024, 1025, 700, 683], 1500)
    rows = [(None, 0, 0, int(n), 7) for n in lengths]  # rows without an id are dealt like others
    pieces = spark.createDataFrame(rows, "doc_id long, piece int, start long, length long, ids_crc32 long").coalesce(1)
    monkeypatch.setattr(packing, "PARTITION_SEQUENCES", 8)
    rounds, deal = [], packing._round

    def counted(items, number, capacity):
        again, used = deal(items, number, capacity)
        rounds.append((items.count(), used, again.select("part").distinct().count()))
        return again, used

    monkeypatch.setattr(packing, "_round", counted)
    packed = pack(pieces)
    by_sequence = defaultdict(list)
    for r in packed.collect():
        by_sequence[r.sequence_id].append((r.offset, r.length))
    for parts in by_sequence.values():
        assert [o for o, _ in sorted(parts)] == np.cumsum([0, *(n for _, n in sorted(parts))])[:-1].tolist()
    assert sorted(n for parts in by_sequence.values() for _, n in parts) == sorted(lengths.tolist())
    assert max(n for _, _, n in rounds) > 20  # equal keys do not fall into one partition
    assert len(rounds) > 5 and rounds[-1][1] > 0
    assert len(by_sequence) < rounds[0][1]


def test_sequences_hold_the_ids(spark):
    docs = spark.createDataFrame([(1, "one two three"), (2, "four"), (3, "word " * 5000)], "doc_id long, text string")
    packed = pack(token_pieces(docs, with_ids=True))
    rows = sequences(packed).collect()
    assert sorted(len(r.ids) for r in rows) == sorted(
        r.n for r in packed.groupBy("sequence_id").agg({"length": "sum"}).toDF("s", "n").collect()
    )


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 100), min_size=1, max_size=60))
def test_bound_is_never_above_a_packing(lengths):
    sizes = np.sort(np.array(lengths))[::-1]
    bins, offsets, fill = best_fit_decreasing(sizes, 100)
    assert fill.max() <= 100 and np.bincount(bins, sizes).tolist() == fill.tolist()
    assert -(-sum(lengths) // 100) <= lower_bound(*np.unique(sizes, return_counts=True), 100) <= len(fill)
