import numpy as np
import pytest
from pyspark.sql import functions as F

from textforge.operators import evaluate as E
from textforge.operators import models as M
from textforge.operators.vectorize import VectorizerOptions
from textforge.plans import flows
from textforge.session import scratch_path
from textforge.streaming import scoring

TOPICS = {"good": "love great nice happy", "bad": "awful poor sad hate", "so": "table chair door room"}

LOGISTIC = M.ModelSpec("logistic", "logistic_regression", {"max_iter": 30, "class_weight": "balanced"})
FOREST = M.ModelSpec("forest", "random_forest", {"n_estimators": 5, "max_depth": 4, "min_samples_split": 5})
BOOSTED = M.ModelSpec("boosted", "boosted_trees", {"n_estimators": 2, "max_depth": 2})
NEAREST = M.ModelSpec("knn", "knn", {"n_neighbors": 3})


def _texts(labels, n):
    rng = np.random.default_rng(0)
    rows = []
    for i in range(n):
        label = labels[i % len(labels)]
        words = list(rng.choice(TOPICS[label].split(), 3)) + list(rng.choice(["the", "and", "item"], 3))
        rows.append((f"k{i}", " ".join(words) + "!", label))
    return rows


@pytest.fixture(scope="module")
def three(spark):
    df = spark.createDataFrame(_texts(list(TOPICS), 90), "id string, text string, label string")
    options = VectorizerOptions(max_features=40, ngram_range=(1, 2))
    return df, flows.prepare(df, "id", "text", "label", vectorizer=options, stratify=True)


def _shares(scored):
    return [
        (r.key, [round(x, 9) for x in r.probability], r.prediction)
        for r in scored.select("key", "probability", "prediction").orderBy("key").collect()
    ]


def test_prepare_fits_on_train_rows_only(three, spark):
    df, prepared = three
    assert (prepared.n_classes, prepared.train.count(), prepared.test.count()) == (3, 72, 18)
    assert prepared.vectorizer.n_docs == 72
    norms = prepared.features.select(
        F.aggregate(F.unwrap_udt("features")["values"], F.lit(0.0), lambda s, x: s + x * x).alias("n")
    )
    assert norms.filter("abs(n - 1) > 1e-9 AND n <> 0").count() == 0
    options = VectorizerOptions(max_features=40)
    everything = flows.prepare(df, "id", "text", "label", vectorizer=options, fit_on="all")
    assert everything.vectorizer.n_docs == 90
    with pytest.raises(ValueError):
        flows.prepare(df, "id", "text", "label", fit_on="test")


@pytest.mark.parametrize("spec", [LOGISTIC, FOREST, BOOSTED, NEAREST], ids=lambda s: s.name)
def test_models_learn_and_survive_saving(three, spark, spec):
    _, prepared = three
    model = M.fit_model(prepared.train, spec, 3)
    scored = model.score(prepared.test)
    shares = _shares(scored)
    assert len(shares) == 18 and all(abs(sum(p) - 1) < 1e-6 and len(p) == 3 for _, p, _ in shares)
    assert E.summary(scored, "label", "prediction").first().accuracy > 0.6
    path = scratch_path(spark, spec.name)
    model.save(spark, path)
    assert _shares(M.load_model(spark, path).score(prepared.test)) == shares


def test_logistic_minimises_the_stated_loss(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(120, 3))
    y = (x @ [1.0, -2.0, 0.5] + rng.normal(size=120) > 0.4).astype(float)
    from pyspark.ml.linalg import Vectors

    rows = [(str(i), float(c), Vectors.dense(v)) for i, (v, c) in enumerate(zip(x, y))]
    df = spark.createDataFrame(rows, ["key", "label", "features"])
    spec = M.ModelSpec("l", "logistic_regression", {"C": 0.5, "max_iter": 1000, "class_weight": "balanced"})
    model = M.fit_model(df, spec, 2).model
    coef, bias = model.coefficients.toArray(), model.intercept
    weight = np.where(y == 1, 120 / (2 * y.sum()), 120 / (2 * (120 - y.sum())))
    residual = weight * (1 / (1 + np.exp(-(x @ coef + bias))) - y)
    # At the minimum of C * sum(w * loss) + |W|^2 / 2 both gradients vanish.
    assert np.abs(0.5 * x.T @ residual + coef).max() < 1e-3
    assert abs(0.5 * residual.sum()) < 1e-3


def test_out_of_fold_covers_every_row_once(three):
    _, prepared = three
    oof = M.out_of_fold(prepared.train, [LOGISTIC, NEAREST], 3, cv=3)
    assert oof.count() == oof.select("key").distinct().count() == prepared.train.count()
    assert oof.groupBy("fold").count().count() == 3
    sizes = oof.select(F.size(F.unwrap_udt("features")["values"]).alias("n")).distinct().collect()
    assert [r.n for r in sizes] == [6]


def test_stacking_two_classes(spark):
    df = spark.createDataFrame(_texts(["good", "bad"], 60), "id string, text string, label string")
    prepared = flows.prepare(df, "id", "text", "label", vectorizer=VectorizerOptions(max_features=30))
    specs = [LOGISTIC, FOREST, M.ModelSpec("stack", "stacking", {
        "base_models": ("logistic", "forest"), "meta_model": "logistic", "cv": 2})]
    trained = flows.train_all(prepared, specs)
    assert {r.model for r in trained.scores.collect()} == {"logistic", "forest", "stack"}
    stack = trained.models["stack"]
    scored = _shares(stack.score(prepared.test))
    path = scratch_path(spark, "stack")
    stack.save(spark, path)
    assert _shares(M.load_model(spark, path).score(prepared.test)) == scored
    by_path = flows.compare_stored(spark, {"stack": path}, prepared.test).first()
    assert by_path.accuracy == trained.scores.filter("model = 'stack'").first().accuracy


def test_stack_variant(three):
    _, prepared = three
    spec = M.ModelSpec("v", "stacking", {
        "base_models": (BOOSTED, NEAREST, LOGISTIC), "meta_model": FOREST, "cv": 2})
    scored = flows.train_stack_variant(prepared, spec).score(prepared.test)
    assert E.summary(scored, "label", "prediction").first().accuracy > 0.5


def test_stack_variant_query_fits_the_whole_recipe(spark, monkeypatch):
    from textforge.plans.queries import REGISTRY

    asked = []

    def fit(train, spec, n_classes, **options):
        asked.append(spec)
        return M.fit_model(train, LOGISTIC, n_classes)

    monkeypatch.setattr(flows, "fit_model", fit)
    assert REGISTRY["stack_variant"](spark, "/root/testdata/sf0.001").count() > 0
    assert asked == [flows.STACK_VARIANT]
    assert flows.STACK_VARIANT.params["base_models"][0].params["n_estimators"] == 367


def test_sweeps(three, spark):
    df, prepared = three
    cleaned = prepared.cleaned
    settings = [VectorizerOptions("count", 10, (1, 1)), VectorizerOptions("tfidf", 20, (1, 3))]
    out = flows.sweep_vectorizers(cleaned, settings, {"count": FOREST, "tfidf": FOREST}, 3).collect()
    assert {r.model for r in out} == {"count 1-1 10", "tfidf 1-3 20"}
    balanced = flows.sweep_balancing(prepared, ("none", "smote"), FOREST).collect()
    assert {r.model for r in balanced} == {"none", "smote"}
    assert len(flows.sweep_settings()) == 16


def test_training_run_writes_everything(three, spark):
    df, _ = three
    out = scratch_path(spark, "training")
    options = VectorizerOptions(max_features=30)
    trained = flows.run_training(df, "id", "text", "label", out, specs=[LOGISTIC], vectorizer=options)
    assert spark.read.parquet(f"{out}/processed").count() == 90
    assert spark.read.parquet(f"{out}/features").filter("split = 'test'").count() == 18
    assert spark.read.parquet(f"{out}/reports").select("model").distinct().count() == 1
    metrics = spark.read.parquet(f"{out}/run_metrics").filter("metric = 'accuracy'").first()
    assert metrics.value == pytest.approx(trained.scores.first().accuracy)


def test_stream_equals_batch(three, spark, tmp_path):
    df, prepared = three
    classifier = flows.TextClassifier.of(prepared, M.fit_model(prepared.train, LOGISTIC, 3))
    path = scratch_path(spark, "classifier")
    classifier.save(spark, path)
    loaded = flows.TextClassifier.load(spark, path)
    assert loaded.names == ["bad", "good", "so"]
    lines = ["I love this, great!", "  ", "awful and sad", "a chair", "<b>love</b> &amp; nice"]
    (tmp_path / "one.txt").write_text("\n".join(lines), encoding="utf-8")
    stream = scoring.score_stream(scoring.read_line_stream(spark, str(tmp_path)), loaded)
    scored = scoring.run_stream(
        stream.select("text", "predicted_label"),
        scratch_path(spark, "stream"),
        scratch_path(spark, "stream-checkpoint"),
    )
    batch = spark.createDataFrame([(t.strip(),) for t in lines if t.strip()], "text string")
    want = sorted(map(tuple, classifier.score(batch).select("text", "predicted_label").collect()))
    assert sorted(map(tuple, scored.collect())) == want
    assert ("I love this, great!", "good") in want


def test_null_labels_are_a_class(spark):
    rows = [(f"k{i}", f"word{i % 7} text", None if i % 3 == 0 else "ab"[i % 2]) for i in range(30)]
    df = spark.createDataFrame(rows, "id string, text string, label string")
    options = VectorizerOptions(max_features=20)
    prepared = flows.prepare(df, "id", "text", "label", vectorizer=options)
    assert prepared.features.count() == 30 and prepared.n_classes == 3
    assert flows.processed_table(df, "id", "text", "label")[0].count() == 30
    assert flows.prepare(df, "id", "text", "label", vectorizer=options, null_label=None).features.count() == 20


def test_training_run_leaves_no_intermediate_tables(three, spark):
    from pathlib import Path

    from textforge.session import shared_dir

    df, _ = three
    out = scratch_path(spark, "training")
    folder = Path(shared_dir(spark).removeprefix("file:")) / "textforge"
    before = set(folder.iterdir()) if folder.exists() else set()
    specs = [LOGISTIC, NEAREST, M.ModelSpec("stack", "stacking", {
        "base_models": ("logistic", "knn"), "meta_model": "logistic", "cv": 2})]
    options = VectorizerOptions(max_features=30)
    trained = flows.run_training(df, "id", "text", "label", out, specs=specs, vectorizer=options)
    assert {p.name for p in set(folder.iterdir()) - before} == {Path(out).name}
    assert trained.scores.count() == 3 and spark.read.parquet(f"{out}/best_model").count() == 1
    classifier = flows.TextClassifier.load(spark, f"{out}/models/stack")
    assert classifier.score(df.withColumnRenamed("id", "key")).count() == 90


def test_empty_resampling_keeps_its_row(three, monkeypatch):
    _, prepared = three
    real = flows.balanced
    monkeypatch.setattr(flows, "balanced", lambda df, m, *a: real(df, "none", *a).limit(0 if m == "smoteenn" else 1000))
    out = {r.model: r.accuracy for r in flows.sweep_balancing(prepared, ("none", "smoteenn"), FOREST).collect()}
    assert out["smoteenn"] is None and out["none"] > 0.5


def test_stacked_neighbors_score_a_stream(three, spark, tmp_path):
    df, prepared = three
    spec = M.ModelSpec("v", "stacking", {
        "base_models": (NEAREST, LOGISTIC), "meta_model": FOREST, "cv": 2})
    classifier = flows.TextClassifier.of(prepared, flows.train_stack_variant(prepared, spec))
    df.withColumnRenamed("id", "key").write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("key string, text string, label string").parquet(str(tmp_path / "in"))
    out = scratch_path(spark, "scored")
    scoring.write_scored(stream, classifier, out, scratch_path(spark, "scored-checkpoint")).awaitTermination()
    streamed = {r.key: r.predicted_label for r in spark.read.parquet(out).collect()}
    batch = classifier.score(df.withColumnRenamed("id", "key")).select("key", "predicted_label").collect()
    assert streamed == {r.key: r.predicted_label for r in batch} and len(streamed) == 90
