import random

from tests.llm import brute
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from textforge.llm.graph import components
from textforge.llm.near_dedup import content_of, keep_one_of_each, multisets, near_duplicate_classes, signatures

FOLDER = "/root/testdata/sf0.001"


def _found(df):
    return {r.id: r.class_id for r in df.collect() if r.id is not None}


def test_edge_rows(edge_docs, no_docs, edge_rows):
    want = brute.classes([(i, t) for i, t in edge_rows if i is not None])
    rows = near_duplicate_classes(edge_docs).collect()
    assert len(rows) == len(edge_rows)
    assert {r.id: r.class_id for r in rows if r.id is not None} == want
    assert near_duplicate_classes(no_docs).count() == 0
    kept = keep_one_of_each(edge_docs)
    assert kept.columns == edge_docs.columns
    ids = [r.doc_id for r in kept.collect()]
    assert sorted({str(i) for i in ids}) == sorted({str(c) for c in want.values()} | {"None"})


def test_documents(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    want = brute.classes([(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()])
    assert len(set(want.values())) < len(want)
    assert _found(near_duplicate_classes(docs)) == want


def test_family_around_the_threshold(spark):
    """Copies of one text at many distances: no link between different texts is lost."""
    draw = random.Random(5)
    base = [f"w{draw.randrange(10**6)}" for _ in range(160)]
    rows = []
    for i in range(150):
        words = list(base)
        for _ in range(draw.randrange(12)):
            words[draw.randrange(160)] = f"x{draw.randrange(10**6)}"
        rows.append((i, " ".join(words)))
    shared = " ".join(base[:40])  # a passage alone makes no link
    rows += [(1000 + i, shared + " " + " ".join(f"y{draw.randrange(10**6)}" for _ in range(60))) for i in range(100)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    want = brute.classes(rows)
    assert 5 < len(set(want.values())) < len(rows)
    assert _found(near_duplicate_classes(df)) == want


@pytest.mark.parametrize("swap", [False, True])
def test_ids_with_several_texts(spark, swap):
    """A near copy among the texts of an id neither hides a link nor takes the id's other texts with it."""
    base = [f"w{i}" for i in range(60)]
    copy = " ".join([*base[:59], "x"])
    other = ("zz " if swap else "aa ") + " ".join(f"o{i}" for i in range(30))
    third = other + " end"
    rows = [(1, " ".join(base)), (2, copy), (2, other), (3, third), (3, copy + " x"), (4, None), (4, "one two")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    want = brute.classes([((i, t), t) for i, t in rows if t])
    found = {(r.id, r.content): (r.class_id, r.kept) for r in near_duplicate_classes(df).collect()}
    named = df.select("doc_id", "text", content_of(F.col("text")).alias("c")).collect()
    for r in named:
        key = want.get((r.doc_id, r.text), (r.doc_id, r.text))
        assert found[r.doc_id, r.c] == (key[0], key == (r.doc_id, r.text)), r
    kept = sorted(map(str, ((r.doc_id, r.text) for r in keep_one_of_each(df).collect())))
    assert kept == sorted(map(str, [(1, " ".join(base)), (2, other), (4, None), (4, "one two")]))


def test_signature_estimates_weighted_overlap():
    a, b = "a b c d e f g h " * 3 + "q r s t u v w", "a b c d e f g h " * 5 + "q r s x u v w"
    row, shingle, count = multisets(pa.array([a, b]))
    times = signatures(row, shingle, count, 2, 4000)
    x, y = brute.shingles(a), brute.shingles(b)
    true = (x & y).total() / (x | y).total()
    assert abs((times[0] == times[1]).mean() - true) < 0.04
    # The signature of a text does not depend on its neighbours.
    row, shingle, count = multisets(pa.array(["other words here", b]))
    assert (signatures(row, shingle, count, 2, 4000)[1] == times[1]).all()
    assert np.isfinite(times).all()


@pytest.mark.parametrize("seed", range(2))
def test_components(spark, seed):
    draw = random.Random(seed)
    edges = [(draw.randrange(60), draw.randrange(60)) for _ in range(35)]
    edges += [(100 + i, 101 + i) for i in range(25)] + [(200, 200 + i) for i in range(1, 30)]
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a != b:
            x, y = sorted((root(a), root(b)))
            parent[y] = x
    df = spark.createDataFrame(edges, "a long, b long")
    rows = components(df).collect()
    assert {r.node: r.component for r in rows} == {x: root(x) for x in list(parent)}
    assert len(rows) == len(parent)
    assert components(df.where("a < 0")).count() == 0
