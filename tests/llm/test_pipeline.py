"""Each stage of the pipeline on its own input, against plain Python."""

from tests.llm import brute

import corpus_pipeline
from textforge.session import materialize

FOLDER = "/root/testdata/sf0.001"


def test_stages(spark):
    from tokenizers import Tokenizer

    from textforge.llm.packing import tokenizer_path

    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    bench = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").select("item_id", "text").collect()]
    quality = {r.doc_id: r.quality for r in spark.read.parquet(f"{FOLDER}/labels.parquet").collect()}
    names = []
    for name, stage in corpus_pipeline.STAGES:
        before = [tuple(r) for r in docs.select("doc_id", "text").collect()]
        after = materialize(stage(spark, docs, FOLDER), "stage")
        names.append(name)
        if name == "packing":
            tokenizer = Tokenizer.from_file(tokenizer_path())
            want = [p for i, t in before for p in brute.pieces(i, tokenizer.encode(t, add_special_tokens=False).ids)]
            got = after.select("doc_id", "piece", "start", "length", "ids_crc32").collect()
            assert sorted(map(tuple, got)) == sorted(want)
            break
        assert after.columns == docs.columns
        kept = {r.doc_id for r in after.select("doc_id").collect()}
        assert after.count() == len(kept)
        if name == "quality classifier":
            clean = [i for i, _ in before if quality.get(i) == 1]
            assert sum(i in kept for i in clean) > 0.95 * len(clean)
            assert sum(i in kept for i, _ in before if quality.get(i) == 0) <= 1
        elif name == "exact dedup":
            last = {}
            for i, t in before:
                last[brute.lower(t)] = max(i, last.get(brute.lower(t), i))
            assert kept == set(last.values())
        elif name == "near-duplicates":
            assert kept == set(brute.classes(before).values())
        else:
            assert kept == {i for i, t in before if not brute.contamination(t, bench)[1]}
        docs = after
    assert names == ["quality classifier", "exact dedup", "near-duplicates", "decontamination", "packing"]


def test_run_with_clashing_columns_and_nulls(spark, edge_docs, no_docs):
    for source in (edge_docs, no_docs):
        docs = source
        for name, stage in corpus_pipeline.STAGES:
            before, docs = docs, materialize(stage(spark, docs, FOLDER), "stage")
            if name != "packing":
                assert docs.columns == before.columns and docs.count() <= before.count()
