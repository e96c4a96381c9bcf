from tests.llm import brute

from textforge.llm.exact_dedup import copies, digests, drop_copies


def _want(rows):
    groups = {}
    for i, t in rows:
        groups.setdefault(brute.sha(brute.lower(t)), []).append(i)
    return groups


def test_copies(edge_docs, no_docs, edge_rows):
    groups = _want(edge_rows)
    for words in (1, 1 << 20):  # a filter that passes everything, and one that passes little
        found = copies(digests(edge_docs, "doc_id", "text"), words).collect()
        assert len(found) == len(edge_rows)
        for r in found:
            ids = groups[r.digest]
            assert r.group_size == len(ids)
            assert r.keep_id == max((i for i in ids if i is not None), default=None)
        kept = [r.digest for r in found if r.kept]
        assert sorted(kept) == sorted(groups)
    assert copies(digests(no_docs, "doc_id", "text")).count() == 0


def test_drop_copies(spark, edge_docs, no_docs, edge_rows):
    kept = drop_copies(edge_docs)
    assert kept.columns == edge_docs.columns and kept.schema == edge_docs.schema
    rows = kept.collect()
    groups = _want(edge_rows)
    assert sorted(brute.sha(brute.lower(r.text)) for r in rows) == sorted(groups)
    for r in rows:
        assert r.doc_id == max((i for i in groups[brute.sha(brute.lower(r.text))] if i is not None), default=None)
    assert drop_copies(no_docs).count() == 0


def test_one_id_with_two_texts(spark):
    docs = spark.createDataFrame([(1, "a"), (1, "b"), (2, "A"), (1, "b"), (3, "c")], "doc_id long, text string")
    assert sorted(map(tuple, drop_copies(docs).collect())) == [(1, "b"), (2, "A"), (3, "c")]


def test_native(spark, edge_docs):
    plan = copies(digests(edge_docs, "doc_id", "text"))._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Arrow", "Pandas"))
