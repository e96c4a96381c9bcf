"""Quality, decontamination, scores, urls and archives on the defined cases."""

from tests.llm import brute
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from textforge.llm import decontaminate, lm_score, quality, url_filter, warc, words

FOLDER = "/root/testdata/sf0.01"


def test_words(edge_rows, monkeypatch):
    texts = [t for _, t in edge_rows]
    whole = words.word_hashes(pa.array(texts))
    assert np.diff(whole[1]).tolist() == [len(brute.words(t)) for t in texts]
    ids = {}
    for h, w in zip(whole[0].tolist(), [w for t in texts for w in brute.words(t)], strict=True):
        assert ids.setdefault(w, h) == h
    assert len(set(ids.values())) == len(ids)
    monkeypatch.setattr(words, "SLICE_BYTES", 50)
    cut = words.word_hashes(pa.array(texts).slice(3))
    assert cut[0].tolist() == whole[0][whole[1][3] :].tolist()


def test_quality_held_out(spark):
    from textforge.llm.queries import REGISTRY

    found = REGISTRY["op5_quality_classifier"](spark, FOLDER)
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    rows = found.join(labels, "doc_id").where("held_out").collect()
    assert np.mean([r.predicted == r.quality for r in rows]) > 0.95
    assert found.count() == 1000 and found.where("score < 0 OR score > 1 OR score IS NULL").count() == 0
    good = [r for r in found.join(labels, "doc_id").where("quality = 1").collect()]
    assert np.mean([r.predicted for r in good]) > 0.98


def test_quality_edge_rows(spark, edge_docs, no_docs):
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    kept = quality.drop_low_quality(edge_docs, labels)
    assert kept.columns == edge_docs.columns
    none = quality.drop_low_quality(edge_docs, labels.where("doc_id < 0"))
    assert none.count() == edge_docs.count()
    assert quality.drop_low_quality(no_docs, labels).count() == 0
    nulls = spark.createDataFrame([(None, None), (7, None), (None, 1)], "doc_id long, quality int")
    assert quality.drop_low_quality(edge_docs, nulls).count() == edge_docs.count()


def test_prior_estimate():
    draw = np.random.default_rng(0)
    positive = draw.normal(2, 1, 20_000)
    unlabelled = np.concatenate((draw.normal(2, 1, 14_000), draw.normal(-2, 1, 6_000)))
    assert abs(quality.estimate_prior(positive, unlabelled) - 0.7) < 0.05


BENCH = [
    (1, "quick brown fox jumps over the lazy dog and runs away from the very"),
    (2, "éa 東京"),
    (3, None),
    (4, "..."),
    (None, "row without"),
    (5, "one"),
    (1, "a b c d e f g h i j k l"),
    (6, "word word word word word word word word word word word word"),
    (7, "the lazy dog and runs away from the very big bear at once upon"),
]


@pytest.mark.parametrize("block_bytes, shard", [(16 << 20, 1 << 20), (40, 97)])
def test_contamination(spark, edge_docs, no_docs, edge_rows, monkeypatch, block_bytes, shard):
    bench = spark.createDataFrame(BENCH, "item_id long, text string")
    rows = [r for r in edge_rows if r[0] not in (9, 10, 17)] if shard < 1000 else edge_rows
    docs = edge_docs.where("doc_id IS NULL OR doc_id NOT IN (9, 10, 17)") if shard < 1000 else edge_docs
    # The size is read where the tasks run, so it is set through the function that they are given.
    batch_hits = decontaminate._batch_hits
    monkeypatch.setattr(decontaminate, "SHARD_WORDS", shard)
    for texts in ([t for _, t in rows],):
        block = decontaminate.TestBlock(["null" if i is None else str(i) for i, t in BENCH], [t for _, t in BENCH], 10)
        for got, text in zip(batch_hits(pa.array(texts), block), texts, strict=True):
            n, hit, items = brute.contamination(text, BENCH)
            assert (got["n_words"], sum(b - a for a, b in got["spans"]), got["items"]) == (n, hit, items)
    found = decontaminate.find_contamination(docs, bench, "result", block_bytes=block_bytes)
    assert found.columns == [*docs.columns, "result"]
    got = found.select("doc_id", "text", "result", decontaminate.n_hit("result").alias("n_hit")).collect()
    assert len(got) == len(rows)
    for r in got:
        assert (r.result.n_words, r.n_hit, list(r.result["items"])) == brute.contamination(r.text, BENCH), r.doc_id
    clean = decontaminate.remove_contaminated(docs, bench)
    assert clean.columns == docs.columns
    assert clean.count() == sum(brute.contamination(t, BENCH)[1] == 0 for _, t in rows)
    assert decontaminate.remove_contaminated(no_docs, bench).count() == 0
    assert decontaminate.remove_contaminated(docs, bench.where("item_id < 0")).count() == len(rows)


def test_longest_match(spark):
    bench = spark.createDataFrame([(1, " ".join(f"w{i}" for i in range(60)))], "item_id long, text string")
    text = "x " * 5 + " ".join(f"w{i}" for i in range(20, 48)) + " y " + " ".join(f"w{i}" for i in range(12))
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    best = decontaminate.find_contamination(docs, bench, "r").first().r.longest
    assert (best.item_id, best.item_word, best.doc_word, best.n_words) == ("1", 20, 5, 28)


def test_long_matches(monkeypatch):
    """Matches of any length, over the borders of shards, and in texts of one word over and over."""
    monkeypatch.setattr(decontaminate, "SHARD_WORDS", 1 << 15)
    item = [f"w{i}" for i in range(70_000)]
    bench = [(1, " ".join(item)), (2, " ".join(["same"] * 300)), (3, "p q r"), (4, " ".join(item[50:75]))]
    block = decontaminate.TestBlock([str(i) for i, _ in bench], [t for _, t in bench], 10)
    texts = [
        "x " + " ".join(item) + " y " + " ".join(item[:20]),
        "same " * 700,
        "p q p q r",
        " ".join(item[100:112]) + " - " + " ".join(item[40:60]),
        "nothing",
        None,
    ]
    found = decontaminate._batch_hits(pa.array(texts), block)
    longest = [r["longest"] and tuple(r["longest"].values()) for r in found]
    assert longest == [("1", 0, 1, 70_000), ("2", 0, 0, 300), ("3", 0, 2, 3), ("1", 40, 12, 20), None, None]
    assert found[0]["spans"] == [[1, 70_001], [70_002, 70_022]] and found[0]["items"] == ["1", "4"]
    assert found[1]["spans"] == [[0, 700]] and found[3]["items"] == ["1", "4"]


@pytest.mark.parametrize("order", [1, 2, 3])
def test_lm_scores(spark, edge_docs, no_docs, edge_rows, monkeypatch, order):
    monkeypatch.setattr(lm_score, "PARTITION_NGRAMS", 20_000)
    rows = lm_score.score_documents(edge_docs, order=order).collect()
    assert len(rows) == len(edge_rows)
    if order == 2:
        key = lambda r: (str(r[0]), r[1], r[2], round(r[3], 3))
        assert sorted(map(key, rows)) == sorted(map(key, brute.lm_scores(edge_rows)))
    assert all(np.isfinite(r.score) and r.score <= 0 for r in rows)
    assert lm_score.score_documents(no_docs).count() == 0


def test_lm_trigrams(spark):
    docs = spark.createDataFrame([(1, "a b c a b d"), (2, "a b c")], "doc_id long, text string")
    scores = {r.id: r.score for r in lm_score.score_documents(docs, order=3).collect()}
    n = {"a": 3, "b": 3, "c": 2, "d": 1, "ab": 3, "bc": 2, "abc": 2}
    want = np.log(n["a"] / 9) + np.log(n["ab"] / n["a"]) + np.log(n["abc"] / n["ab"])
    assert abs(scores[2] - want) < 1e-9
    # c a is seen once: back off to a; after it "c a b" is seen once, "a b" is known; "a b d": b d once, then d.
    want += np.log(0.4 * 0.4 * n["a"] / 9) + np.log(0.4 * n["ab"] / n["a"]) + np.log(0.4 * 0.4 * n["d"] / 9)
    assert abs(scores[1] - want) < 1e-9


def test_full_scores_keep_single_counts(spark, tmp_path):
    from textforge.llm.queries import REGISTRY

    docs = spark.createDataFrame([(1, "a b c a b d"), (2, "a b c"), (3, None)], "doc_id long, text string")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    rows = {r.doc_id: (r.n_words, r.n_backoff, r.score) for r in REGISTRY["op9_lm_scoring_full"](spark, str(tmp_path)).collect()}
    # "c a", "b c a", "c a b" and "a b d" occur once each and count: c a b after c a is sure.
    first = np.log(3 / 9) + np.log(3 / 3) + np.log(2 / 3) + np.log(1 / 2) + np.log(1 / 1) + np.log(1 / 3)
    second = np.log(3 / 9) + np.log(3 / 3) + np.log(2 / 3)
    assert rows == {1: (6, 0, round(first, 4)), 2: (3, 0, round(second, 4)), 3: (0, 0, 0.0)}


URLS = [
    (1, None), (2, ""), (3, "no-scheme.org/es/"), (4, "http://EXAMPLE.org/es/x?y#z"), (5, "http://sub.example.org/en/12"),
    (6, "http://notexample.org/en/12"), (7, "http://org/"), (8, "http://a.org"), (9, "http://a.com/fr/://b.org/"),
    (10, "x://spam-farm.example.com/"), (11, "x://www.spam-farm.example.com/q"), (12, "x://spam-farm.example.com"),
    (13, "http://a.com/de/?x=/fr/"), (14, "http://a.com?/fr/"), (15, "http://ünï.org/é"), (15, "http://ünï.org/é"),
]


@pytest.mark.parametrize("block_rules", [1 << 20, 4])
def test_urls(spark, block_rules):
    from textforge.llm.queries import ORACLES

    pages = spark.createDataFrame(URLS, "page_id long, url string").withColumn("host", F.lit("own"))
    found = url_filter.judge(pages, url_filter.rules_and_list(spark), "found", block_rules=block_rules)
    assert found.columns == ["page_id", "url", "host", "found"]
    rows = {r.page_id: (r.found.entry if r.found["rank"] == 0 else None, r.found.verdict) for r in found.collect()}
    assert rows[1] == rows[2] == rows[3] == rows[8 + 4] == (None, "allow")
    assert rows[4] == ("example.org/es/", "block") and rows[5] == ("example.org/en/1", "block")
    assert rows[6] == rows[7] == rows[15] == ("org/", "allow") and rows[8] == (None, "allow")
    assert rows[9] == ("com/fr/", "allow") and rows[13] == ("com/de/", "block") and rows[14] == (None, "allow")
    assert rows[10] == rows[11] == (None, "block")
    assert "op1_url_filter" in ORACLES
    assert url_filter.judge(pages.where("page_id < 0"), url_filter.rules_and_list(spark), "f").count() == 0
    none = url_filter.judge(pages, url_filter.rules_and_list(spark).where("rank > 5"), "f")
    assert {r.f.verdict for r in none.collect()} == {"allow"}


def test_long_hosts_and_a_large_list(spark):
    """Hosts of half a million labels, and a list of 100,000 hosts, against a dictionary."""
    listed = [(f"h{i}.example.{'net' if i % 3 else 'co.uk'}/", "block", 1) for i in range(100_000)]
    array = url_filter.DigestArray([*listed, ("org/", "allow", 0)])
    long = "a." * 500_000
    hosts = [long + "org", long + "h7.example.net", long, "h3.example.co.uk", "example.co.uk", "h3.example.net", "", "."]
    paths = ["/" + "p" * 1_000_000, "/", "/", "/x", "/", "/", "/", "/"]
    known = {e: (e, v, r) for e, v, r in listed}
    want = [("org/", "allow", 0), known["h7.example.net/"], None, known["h3.example.co.uk/"], None, None, None, None]
    assert url_filter._best(array, hosts, paths) == want
    hosts = [f"w.h{i}.example.net" for i in range(0, 100_000, 7)]
    found = url_filter._best(array, hosts, ["/"] * len(hosts))
    assert found == [known.get(h[2:] + "/") for h in hosts]


def test_digest_collisions(monkeypatch):
    monkeypatch.setattr(url_filter.xxhash, "xxh64_intdigest", lambda text: 7)
    array = url_filter.DigestArray([("a.org/", "block", 0), ("b.org/", "allow", 0)])
    assert array.probe(["b.org/", "c.org/", "a.org/"]) == [("b.org/", "allow", 0), None, ("a.org/", "block", 0)]


PAGES = [
    (1, "http://a/1", "same"), (2, "http://a/2", "same"), (3, "http://a/3", None), (4, None, ""),
    (5, "http://a/5", "WARC/1.1\r\nContent-Length: 3\r\n\r\nabc\r\n\r\nWARC/1.1\r\n\r\n"), (6, "http://a/\r\n6", "é東😀\x00" * 1000),
    (None, "http://a/7", "no id"), (8, "http://a/8", "x" * 500_000), (9, "http://a/9", "tie"), (9, "http://a/9", "tie"),
]


def test_archives(spark, tmp_path):
    pages = spark.createDataFrame(PAGES, "id long, url string, payload string").fillna("", ["payload"]).repartition(3)
    warc.write_archives(warc.captures(pages), f"{tmp_path}/w")
    found = warc.read_records(spark, f"{tmp_path}/w")
    assert found.count() == 3 * len(PAGES)
    rows = warc.assemble(found).collect()
    assert len(rows) == len(PAGES) and all(r.request and r.metadata for r in rows)
    payloads = {i: p or "" for i, _, p in PAGES}
    for r in rows:
        body = payloads[r.metadata.page].encode()
        assert r.metadata.noted_bytes == len(body) and r.response.digest == warc._sha1(body)
        assert r.response.payload == (body if r.response.kind == "response" else b"")
    kinds = sorted((str(r.metadata.page), r.response.kind) for r in rows)
    assert ("1", "revisit") in kinds and ("2", "response") in kinds
    assert ("3", "revisit") in kinds and ("4", "response") in kinds
    assert [k for p, k in kinds if p == "9"] == ["response", "revisit"]
    warc.write_archives(warc.captures(pages, least_bytes=10**6), f"{tmp_path}/all")
    assert {r.kind for r in warc.read_records(spark, f"{tmp_path}/all").collect()} == {"request", "response", "metadata"}
    warc.write_archives(warc.captures(pages.where("id < 0")), f"{tmp_path}/none")
    assert warc.assemble(warc.read_records(spark, f"{tmp_path}/none")).count() == 0
