import hashlib
import math
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from textforge.operators import evaluate as E
from textforge.operators import labels as L
from textforge.operators import profile as P
from textforge.operators import split as S
from textforge.operators import vectorize as V
from textforge.operators import words as W


def _order(key, seed=42):
    return hashlib.md5(f"{key}|{seed}".encode()).hexdigest(), key


@pytest.fixture(scope="module")
def classes(spark):
    """3,000 rows; one class holds most of them, one a single row, one null label."""
    def label(i):
        return "only" if i == 5 else None if i % 97 == 0 else "hot" if i % 3 else "cold"

    rows = [(i, label(i)) for i in range(3000)]
    return rows, spark.createDataFrame(rows, "id bigint, label string")


def _by_class(rows):
    groups = defaultdict(list)
    for key, label in rows:
        groups[label].append(key)
    return {c: sorted(keys, key=_order) for c, keys in groups.items()}


def test_random_split_is_exact(spark, classes):
    rows, df = classes
    got = {r.id for r in S.random_split(df, "id").filter("split = 'test'").collect()}
    assert got == set(sorted((k for k, _ in rows), key=_order)[: math.ceil(0.2 * len(rows))])


def test_bucket_split_is_a_stable_partition(spark, classes):
    _, df = classes
    full = {r.id: r.split for r in S.random_split(df, "id", exact=False).collect()}
    half = {r.id: r.split for r in S.random_split(df.filter("id % 2 = 0"), "id", exact=False).collect()}
    assert all(full[k] == v for k, v in half.items())
    assert abs(sum(v == "test" for v in full.values()) / len(full) - 0.2) < 0.03


def test_stratified_split(spark, classes):
    rows, df = classes
    out = S.stratified_split(df, "id", "label")
    test = defaultdict(set)
    for r in out.filter("split = 'test'").collect():
        test[r.label].add(r.id)
    n, groups = len(rows), _by_class(rows)
    assert sum(map(len, test.values())) == math.ceil(0.2 * n)
    for label, keys in groups.items():
        assert test[label] == set(keys[: len(test[label])])
        assert abs(len(test[label]) - 0.2 * len(keys)) < 1
    assert out.count() == n


def test_folds_are_equal_parts(spark, classes):
    rows, df = classes
    got = {r.id: r.fold for r in S.kfold(df, "id", "label", 5).collect()}
    assert len(got) == len(rows)
    for keys in _by_class(rows).values():
        n = len(keys)
        want = [sum(i >= n * f // 5 for f in range(1, 5)) for i in range(n)]
        assert [got[k] for k in keys] == want


def test_undersample(spark, classes):
    rows, df = classes
    cut = df.filter("label <> 'only'")
    groups = _by_class([r for r in rows if r[1] not in (None, "only")])
    least = min(map(len, groups.values()))
    got = {r.id for r in S.undersample(cut, "id", "label").collect()}
    assert got == {k for keys in groups.values() for k in keys[:least]}


def test_class_weights(spark, classes):
    rows, df = classes
    counts = Counter(c for _, c in rows if c)
    got = {r.label: r.weight for r in S.class_weights(df, "label").collect()}
    total = sum(counts.values())
    assert got == pytest.approx({c: total / (3 * n) for c, n in counts.items()})
    weighted = S.with_class_weight(df, "label")
    assert weighted.agg(F.sum("weight")).first()[0] == pytest.approx(total)


def test_split_does_not_shuffle_the_rows(spark, classes):
    _, df = classes
    plan = S.stratified_split(df, "id", "label")._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan


DOCS = ["The cat sat on the cat", "dog cat", "", "a b", None, "dog dog dog bird", "bird"]


def _brute(opts):
    def terms(text):
        import re

        words = [w for w in re.findall(r"\w\w+", (text or "").lower()) if w not in opts.stop_words]
        low, high = opts.ngram_range
        return [" ".join(words[i : i + n]) for n in range(low, high + 1) for i in range(len(words) - n + 1)]

    docs = [Counter(terms(t)) for t in DOCS]
    cf, df = Counter(), Counter()
    for d in docs:
        cf.update(d)
        df.update(d.keys())
    top = sorted(cf, key=lambda t: (-cf[t], t))[: opts.max_features]
    index = {t: i for i, t in enumerate(sorted(top))}
    weights = {}
    for i, d in enumerate(docs):
        raw = {
            t: n * (math.log((1 + len(DOCS)) / (1 + df[t])) + 1 if opts.method == "tfidf" else 1)
            for t, n in d.items()
            if t in index
        }
        norm = math.sqrt(sum(x * x for x in raw.values())) if opts.method == "tfidf" else 1.0
        weights |= {(i, index[t]): x / norm for t, x in raw.items()}
    return index, cf, df, weights


@pytest.mark.parametrize("cap", [None, 4, 3])
@pytest.mark.parametrize("method", ["tfidf", "count"])
def test_vectorizer_against_brute_force(spark, method, cap):
    opts = V.VectorizerOptions(method, cap, (1, 2), ("the", "on"))
    df = spark.createDataFrame(list(enumerate(DOCS)), "id int, text string")
    index, cf, docs, weights = _brute(opts)
    fitted = V.fit_vectorizer(df, "text", opts)
    vocab = {r.term: (r.idx, r.cf, r.df) for r in fitted.vocab.collect()}
    assert vocab == {t: (i, cf[t], docs[t]) for t, i in index.items()}
    entries = V.vector_entries(fitted.transform(df), "id").collect()
    assert {(r.id, r.idx): r.value for r in entries} == pytest.approx(weights)
    joined = V.tfidf_table(df, "id", "text", opts).collect()
    assert {(r.id, r.idx): r.weight for r in joined} == pytest.approx(weights)


MANY = [" ".join(f"w{i * j * j % 17}" + "x" * (j % 5 == 4) for j in range(i % 40)) for i in range(60)] + DOCS


@pytest.mark.parametrize("known_bytes", [1 << 20, 0])
@pytest.mark.parametrize("grams", [(1, 1), (1, 2), (1, 3), (2, 3)])
def test_capped_vocabulary_against_brute_force(spark, monkeypatch, grams, known_bytes):
    monkeypatch.setitem(_brute.__globals__, "DOCS", MANY)
    monkeypatch.setattr(V, "KNOWN_BYTES", known_bytes)
    df = spark.createDataFrame(list(enumerate(MANY)), "id int, text string")
    for cap in (1, 12, 5000) if known_bytes else (12,):
        opts = V.VectorizerOptions("tfidf", cap, grams, ("the",))
        index, cf, docs, weights = _brute(opts)
        fitted, rows = V.fit_transform(df, "text", opts)
        vocab = {r.term: (r.idx, r.cf, r.df) for r in fitted.vocab.collect()}
        assert vocab == {t: (i, cf[t], docs[t]) for t, i in index.items()}
        entries = V.vector_entries(rows, "id").collect()
        assert {(r.id, r.idx): r.value for r in entries} == pytest.approx(weights)
        assert rows.columns == ["id", "text", "features"] and rows.count() == len(MANY)


def test_only_grams_of_frequent_words_are_counted(spark):
    texts = ["cat dog cat dog"] * 3 + [f"cat r{i} s{i} dog" for i in range(200)] + [None, ""]
    words = spark.createDataFrame([(t,) for t in texts], "words string")
    stats = V.frequent_stats(words, "words", V.VectorizerOptions("count", 2, (1, 3))).collect()
    assert {r.term: (r.cf, r.df) for r in stats} == {"cat": (206, 203), "dog": (206, 203)}
    known = spark.createDataFrame([("cat",), ("dog",)], "word string")
    grams = {r.term: (r.cf, r.df) for r in V.count_grams(words, "words", 2, 3, known).collect()}
    assert grams == {"cat dog": (6, 3), "dog cat": (3, 3), "cat dog cat": (3, 3), "dog cat dog": (3, 3)}


def test_runs_of_rows_hold_every_row(monkeypatch):
    import pyarrow as pa

    from textforge.operators import terms

    monkeypatch.setattr(terms, "RUN_BYTES", 10)
    texts = pa.array(["a b", None, "c" * 50, "", "d e f g", "h", "i j k l m n"])
    runs = list(terms.row_runs(texts.slice(1)))
    assert [x for run in runs for x in run.to_pylist()] == texts.to_pylist()[1:]
    assert len(runs) > 2 and all(len(run) == 1 or sum(len(x or "") for x in run.to_pylist()) <= 10 for run in runs)


def test_vectorizer_options_are_checked(spark):
    with pytest.raises(ValueError):
        V.VectorizerOptions("other")
    empty = spark.createDataFrame([("",)], "text string")
    with pytest.raises(ValueError, match="empty vocabulary"):
        V.fit_vectorizer(empty, "text", V.VectorizerOptions())


def test_top_words_by_label_fills_zeros(spark):
    rows = [("a a b", "x"), ("b c", "y"), ("a", None)]
    df = spark.createDataFrame(rows, "text string, label string")
    got = {(r.word, r.label): (r.rank, r.n) for r in W.top_words_by_label(df, "text", "label", 2).collect()}
    assert got == {
        ("a", "x"): (1, 2), ("a", "y"): (1, 0), ("a", None): (1, 1),
        ("b", "x"): (2, 1), ("b", "y"): (2, 1), ("b", None): (2, 0),
    }


def test_characters(spark):
    texts = ["añ 😀", None, "", "aa\n"]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    got = {r.char: r.freq for r in W.char_freq(df, "text").collect()}
    assert got == dict(Counter("".join(t or "" for t in texts)))


def test_lemmas_keep_order_and_empty_rows(spark):
    df = spark.createDataFrame(
        [(1, ["cats", "eat", "cats", "boxes"]), (2, []), (3, ["men", "gas"])],
        "id int, tokens array<string>",
    )
    known = spark.createDataFrame([("cat",), ("box",), ("boxe",), ("man",), ("gas",)], "word string")
    words = df.select(F.explode("tokens").alias("word"))
    lemmas = W.lemma_table(words, known)
    got = {r.id: r.tokens for r in W.lemmatize(df, "id", "tokens", lemmas).collect()}
    assert got == {1: ["cat", "eat", "cat", "box"], 2: [], 3: ["man", "gas"]}


def test_duplicates_with_a_hot_copy(spark):
    rows = [(i, "same" if i % 3 == 0 else f"t{i}", "l" if i % 2 else None) for i in range(300)]
    df = spark.createDataFrame(rows, "id bigint, text string, label string")
    first = {}
    for key, *content in rows:
        first.setdefault(tuple(content), key)
    kept = {r.id for r in P.drop_duplicate_rows(df, "id", "text", "label").collect()}
    assert kept == set(first.values())
    gone = {r.id for r in P.duplicate_rows(df, "id", "text", "label").collect()}
    assert gone == {r[0] for r in rows} - kept
    assert P.duplicate_count(df, "text", "label").first()[0] == len(gone)
    # Content is not confused by where one cell ends and the next begins.
    tricky = spark.createDataFrame([(1, "a|1:b", "c"), (2, "a", "b|1:c"), (3, "", None), (4, None, "")],
                                   "id int, x string, y string")
    assert P.duplicate_count(tricky, "x", "y").first()[0] == 0


def test_numeric_summary(spark):
    df = spark.createDataFrame([(float(x),) for x in (1, 2, 2, 10)], "x double")
    row = P.numeric_summary(df, "x").first()
    assert (row["count"], row["mean"], row["p25"], row["p50"], row["p75"]) == (4, 3.75, 1.75, 2.0, 4.0)
    assert row["std"] == pytest.approx(4.193249)
    import numpy as np

    values = np.random.default_rng(6).normal(size=501).round(2)
    values[:200] = 0.25  # one value holds many rows
    df = spark.createDataFrame([(float(x),) for x in values] + [(None,)], "x double")
    row = P.numeric_summary(df, "x").first()
    assert (row["p25"], row["p50"], row["p75"]) == pytest.approx(tuple(np.quantile(values, [0.25, 0.5, 0.75])))
    assert (row["count"], row["min"], row["max"]) == (501, values.min(), values.max())
    assert row["std"] == pytest.approx(values.std(ddof=1), abs=1e-6)


def test_label_codes(spark):
    df = spark.createDataFrame([(1, 10), (2, 9), (3, None), (4, -1)], "id int, label int")
    coded, classes = L.encode_labels(df, "label")
    assert L.class_names(classes) == ["-1", "10", "9"]  # sorted as strings
    assert {r.id: r.code for r in coded.collect()} == {1: 1, 2: 2, 4: 0}
    own, _ = L.encode_labels(df, "label", null_label="nan")
    assert {r.id: r.code for r in own.collect()} == {1: 1, 2: 2, 3: 3, 4: 0}
    back = L.decode_labels(coded.select("id", "code"), "code", classes)
    assert {r.id: r.label for r in back.collect()} == {1: "10", 2: "9", 4: "-1"}


# Published reports: class counts, hits and predictions per class, and what they gave.
REPORTS = {
    "logistic": ((36, 30, 34), (22, 25, 22), (27, 46, 27), 0.69, 0.6940428941205474, 0.724369296833065),
    "forest": ((36, 30, 34), (8, 26, 20), (8, 67, 25), 0.54, 0.5222423077534033, 0.7293532338308458),
    "boosted": ((36, 30, 34), (16, 25, 23), (19, 50, 31), 0.64, 0.63756993006993, 0.6946802490096209),
    "stacking": ((36, 30, 34), (25, 22, 24), (35, 35, 30), 0.71, 0.7115980498374864, 0.7142857142857144),
}


def _pairs(actual, hits, predicted):
    pairs = [(c, c) for c in range(3) for _ in range(hits[c])]
    missing = [c for c in range(3) for _ in range(actual[c] - hits[c])]
    wrong = [c for c in range(3) for _ in range(predicted[c] - hits[c])]
    # Any pairing has the same margins; avoid accidental hits by rotating.
    for shift in range(len(wrong)):
        turned = wrong[shift:] + wrong[:shift]
        if all(a != p for a, p in zip(missing, turned)):
            return pairs + list(zip(missing, turned))
    rest, out = Counter(wrong), []
    for a in sorted(missing, key=lambda c: -Counter(missing)[c]):
        p = max((c for c in rest if c != a and rest[c]), key=lambda c: rest[c])
        rest[p] -= 1
        out.append((a, p))
    return pairs + out


def test_published_reports(spark):
    rows = [(m, a, p) for m, r in REPORTS.items() for a, p in _pairs(*r[:3])]
    df = spark.createDataFrame(rows, "model string, y int, p int")
    report = {(r.model, r.label): r for r in E.classification_report(df, "y", "p", "model").collect()}
    for model, (actual, hits, predicted, accuracy, f1, macro) in REPORTS.items():
        for c in range(3):
            row = report[model, str(c)]
            assert row.precision == pytest.approx(hits[c] / predicted[c], abs=1e-12)
            assert row.recall == pytest.approx(hits[c] / actual[c], abs=1e-12)
            assert row.support == actual[c]
        assert report[model, "accuracy"].support == pytest.approx(accuracy, abs=1e-12)
        assert report[model, "weighted avg"].f1_score == pytest.approx(f1, abs=1e-9)
        assert report[model, "weighted avg"].recall == pytest.approx(accuracy, abs=1e-12)
        assert report[model, "macro avg"].precision == pytest.approx(macro, abs=1e-9)
    order = [r.model for r in E.compare_models(df, "y", "p").collect()]
    assert order == ["stacking", "logistic", "boosted", "forest"]
    best = E.best_model(E.summary(df, "y", "p", "model")).first()
    assert (best.model, best.accuracy) == ("stacking", 0.71)


def test_confusion_matrix_covers_both_label_sets(spark):
    df = spark.createDataFrame([("a", "b"), ("a", "a")], "y string, p string")
    got = {(r.actual, r.predicted): r.n for r in E.confusion_matrix(df, "y", "p").collect()}
    assert got == {("a", "a"): 1, ("a", "b"): 1, ("b", "a"): 0, ("b", "b"): 0}


def test_best_model_first_wins_ties(spark):
    df = spark.createDataFrame([("b", 0.5), ("a", 0.5), ("c", 0.1)], "model string, accuracy double")
    assert E.best_model(df).first().model == "a"


def test_numeric_summary_of_large_values(spark):
    from textforge.operators.profile import numeric_summary

    for base in (10**9, 10**15):
        df = spark.range(1000).selectExpr(f"{base}L + id % 3 AS x")
        row = numeric_summary(df, "x").first()
        if base == 10**9:
            assert abs(row["std"] - 0.817) < 1e-3
        assert row["count"] == 1000 and row["p50"] == base + 1


def test_data_statistics(spark):
    from textforge.operators.profile import data_stats

    df = spark.createDataFrame([("a", "x"), (None, "x"), ("b", "y"), ("c", None)], "text string, label string")
    assert data_stats(df, "text", "label").first().asDict() == {
        "total_rows": 4, "total_columns": 2, "missing_text": 1, "missing_label": 1,
        "unique_labels": 2, "label_shares": "x:0.6667,y:0.3333",
    }
    assert data_stats(df.where("text = 'none'"), "text", "label").first().total_rows == 0


def test_english_stop_words(spark):
    from textforge.operators.vectorize import VectorizerOptions, fit_vectorizer

    df = spark.createDataFrame([("the cat is here and sat",)], "text string")
    fitted = fit_vectorizer(df, "text", VectorizerOptions("count", 10, (1, 1), "english"))
    assert [r.term for r in fitted.vocab.orderBy("idx").collect()] == ["cat", "sat"]
    with pytest.raises(ValueError, match="klingon"):
        VectorizerOptions(stop_words="klingon")


def test_lemmas_by_join_equal_lemmas_by_look_up(spark, monkeypatch):
    from textforge.operators import words as W

    df = spark.createDataFrame([(1, ["cats", "sat", "cats"]), (2, []), (3, None), (4, ["dogs"])], "id int, t array<string>")
    lemmas = spark.createDataFrame([("cats", "cat"), ("dogs", "dog"), ("sat", "sat")], "word string, lemma string")
    near = sorted(map(str, W.lemmatize(df, "id", "t", lemmas).collect()))
    monkeypatch.setattr(W, "LEMMA_BYTES", 0)
    assert sorted(map(str, W.lemmatize(df, "id", "t", lemmas).collect())) == near
    assert "cat" in near[0]


def test_lemmas_of_a_batch_build_no_table_of_all_words(monkeypatch):
    import pyarrow as pa

    from textforge.operators import words as W

    sets = []
    index_in = W.pc.index_in
    monkeypatch.setattr(W.pc, "index_in", lambda x, value_set: sets.append(len(value_set)) or index_in(x, value_set=value_set))
    monkeypatch.setattr(W, "RUN_TOKENS", 7)
    words, lemmas = [f"w{i}s" for i in range(50)], [f"w{i}" for i in range(50)]
    old = pa.array(["w49s", "other", None, "w0s", "w7s", "other"])
    # A word that comes again keeps its first lemma, in one slice of the table or another.
    new = W._changed(old, pa.array([*words, "w7s", "w49s"]), pa.array([*lemmas, "late", "late"]))
    assert new.to_pylist() == ["w49", "other", None, "w0", "w7", "other"] and max(sets) <= len(old)
    many = pa.array(["w49s", "x", None] * 30)
    assert W._changed(many, pa.array(words), pa.array(lemmas)).to_pylist() == ["w49", "x", None] * 30
    assert W._changed(old, pa.array([], pa.string()), pa.array([], pa.string())).equals(old)
    assert W._changed(old[:0], pa.array(words), pa.array(lemmas)).to_pylist() == []


def test_tokens_go_back_into_rows_by_runs(spark, monkeypatch):
    import numpy as np

    from textforge.operators import words as W

    monkeypatch.setattr(W, "RUN_TOKENS", 5)
    assert list(W._runs(np.array([0, 2, 2, 5, 6, 20, 20, 21]))) == [(0, 3), (3, 4), (4, 5), (5, 7)]
    assert list(W._runs(np.array([0]))) == []
    rows = [(i, None if i % 7 == 0 else ["cats", None, f"w{i}"] * (i % 3)) for i in range(50)]
    lemmas = spark.createDataFrame([("cats", "cat")], "word string, lemma string")
    got = W.lemmatize(spark.createDataFrame(rows, "id int, t array<string>"), "id", "t", lemmas)
    want = {i: t if t is None else ["cat" if w == "cats" else w for w in t] for i, t in rows}
    assert {r.id: r.t for r in got.collect()} == want
