"""Whole flows: prepare, train, compare, score, and the experiment sweeps."""

from __future__ import annotations

from collections.abc import Iterable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, replace

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textforge.functions.cleaning import FULL, CleanOptions, notebook_tokens, with_clean
from textforge.functions.stages import TextCleaner
from textforge.functions.stopwords import KEPT_NEGATIONS
from textforge.functions.tokens import explode_terms
from textforge.operators import evaluate
from textforge.operators.labels import class_names, encode_labels
from textforge.operators.models import (
    DEFAULT_MODELS,
    ModelSpec,
    fit_many,
    fit_model,
    load_model,
    predict_all,
)
from textforge.operators.profile import drop_duplicate_rows, drop_null_rows, non_blank_rows
from textforge.operators.resample import balanced
from textforge.operators.split import random_split, stratified_split
from textforge.operators.vectorize import (
    VectorizerOptions,
    Vectorizer,
    document_terms,
    fit_transform,
    term_stats,
    vectorizer_from_stats,
)
from textforge.operators.words import lemma_table, lemmatize
from textforge.session import materialize, scratch_scope
from textforge.sources import sinks


def processed_table(
    df: DataFrame,
    key: str,
    text: str,
    label: str,
    opts: CleanOptions = FULL,
    null_label: str | None = "nan",
) -> tuple[DataFrame, DataFrame]:
    """``key, original_text, cleaned_text, original_label, encoded_label`` and the classes.

    A null label is the class ``null_label``; with None such rows are left out.
    """
    coded, classes = encode_labels(df, label, "encoded_label", null_label)
    cleaned = with_clean(coded, text, "cleaned_text", opts)
    out = cleaned.select(
        key,
        F.col(text).alias("original_text"),
        "cleaned_text",
        F.col(label).alias("original_label"),
        "encoded_label",
    )
    return out, classes


def notebook_clean(
    df: DataFrame, key: str, text: str, stop_words, lemmas: DataFrame | None = None, newline: str = ""
) -> DataFrame:
    """The notebook recipe: drop null, duplicate and blank rows, then reduce the text to
    lemmas of its non-stop words. Negations are kept. Adds ``cleaned``.

    Without a lemma table one is built from the corpus's own words.
    """
    kept_words = [w for w in stop_words if w not in KEPT_NEGATIONS]
    content = [c for c in df.columns if c != key]
    rows = drop_duplicate_rows(drop_null_rows(df), key, *content)
    rows = non_blank_rows(rows, text)
    rows = rows.withColumn("_tokens", notebook_tokens(F.col(text), kept_words, newline))
    rows = materialize(rows.drop(text), "notebook-tokens")
    if lemmas is None:
        words = explode_terms(rows, "_tokens").distinct()
        words = materialize(words, "notebook-words")
        lemmas = materialize(lemma_table(words, words), "lemmas")
    out = lemmatize(rows, key, "_tokens", lemmas)
    return out.withColumn("cleaned", F.array_join("_tokens", " ")).drop("_tokens")


@dataclass
class Prepared:
    """``features``: key, label (double code), split, features; ``cleaned``: the same rows as text."""

    features: DataFrame
    cleaned: DataFrame
    classes: DataFrame
    vectorizer: Vectorizer
    cleaner: TextCleaner
    n_classes: int

    @property
    def train(self) -> DataFrame:
        return self.features.filter(F.col("split") == "train")

    @property
    def test(self) -> DataFrame:
        return self.features.filter(F.col("split") == "test")


def prepare(
    df: DataFrame,
    key: str,
    text: str,
    label: str,
    *,
    cleaning: CleanOptions = FULL,
    vectorizer: VectorizerOptions = VectorizerOptions(ngram_range=(1, 2), stop_words="english"),
    test_size: float = 0.2,
    seed: int = 42,
    stratify: bool = False,
    fit_on: str = "train",
    keep_text: bool = False,
    null_label: str | None = "nan",
) -> Prepared:
    """Clean, encode, split, fit the vectorizer and transform.

    The text is cleaned once and the cleaned table written; everything after reads
    it. ``fit_on="all"`` fits the vocabulary before the split, test rows included.
    ``keep_text`` keeps the original text and label in ``cleaned``. A null label is the
    class ``null_label``; with None such rows are left out.
    """
    if fit_on not in ("train", "all"):
        raise ValueError("fit_on must be 'train' or 'all'")
    coded, classes = encode_labels(df.select(key, text, label), label, null_label=null_label)
    names = class_names(classes)
    cleaner = TextCleaner.of(cleaning, inputCol=text, outputCol="cleaned")
    keyed = coded.select(key, text, F.col(label).alias("original_label"), "code")
    if stratify:
        parted = stratified_split(keyed, key, "code", test_size, seed)
    else:
        parted = random_split(keyed, key, test_size, seed)
    originals = [F.col(text).alias("original_text"), "original_label"] if keep_text else []
    cleaned = materialize(
        cleaner.transform(parted).select(
            F.col(key).alias("key"),
            F.col("code").cast("double").alias("label"),
            "split",
            "cleaned",
            *originals,
        ),
        "cleaned",
    )
    is_train = F.col("split") == "train"
    source = cleaned if fit_on == "all" else cleaned.filter(is_train)
    fitted, known = fit_transform(source, "cleaned", vectorizer)
    if fit_on == "train":
        known = known.unionByName(fitted.transform(cleaned.filter(~is_train)))
    features = materialize(known.select("key", "label", "split", "features"), "features")
    return Prepared(features, cleaned, classes, fitted, cleaner, len(names))


@dataclass
class Trained:
    models: dict[str, object]
    predictions: DataFrame  # model, key, actual, predicted
    scores: DataFrame  # one row per model, best first


def train_all(prepared: Prepared, specs: Iterable[ModelSpec] = DEFAULT_MODELS) -> Trained:
    """Fit every spec on the train rows and compare them on the test rows.

    Plain models are fitted together over the same feature table, then stacks, which take them as
    their bases; all predictions are scored by one aggregation.
    """
    specs = list(specs)
    by_name = {spec.name: spec for spec in specs}
    plain = [spec for spec in specs if spec.kind != "stacking"]
    fitted = fit_many([(prepared.train, spec) for spec in plain], prepared.n_classes)
    models: dict[str, object] = {spec.name: model for spec, model in zip(plain, fitted)}
    for spec in specs:
        if spec.kind == "stacking":
            models[spec.name] = fit_model(
                prepared.train, spec, prepared.n_classes, others=by_name, fitted=models
            )
    models = {spec.name: models[spec.name] for spec in specs}
    predictions = materialize(predict_all(models, prepared.test), "predictions")
    scores = evaluate.compare_models(predictions, "actual", "predicted")
    return Trained(models, predictions, scores)


@dataclass
class TextClassifier:
    """Cleaner, vectorizer, model and class names: scores raw text, batch or stream."""

    features: PipelineModel
    model: object
    names: list[str]

    @classmethod
    def of(cls, prepared: Prepared, model) -> TextClassifier:
        stages = [prepared.cleaner, *prepared.vectorizer.pipeline.stages]
        return cls(PipelineModel(stages), model, class_names(prepared.classes))

    def score(self, df: DataFrame) -> DataFrame:
        """Add ``prediction``, ``probability`` and the class name ``predicted_label``."""
        scored = self.model.score(self.features.transform(df))
        names = F.array(*(F.lit(n) for n in self.names))
        return scored.withColumn(
            "predicted_label", F.get(names, F.col("prediction").cast("int"))
        ).drop("cleaned", "_terms", "_counts", "_weighted", "features")

    def save(self, spark: SparkSession, path: str) -> None:
        self.features.write().overwrite().save(f"{path}/features")
        self.model.save(spark, f"{path}/model")
        rows = [(i, n) for i, n in enumerate(self.names)]
        classes = spark.createDataFrame(rows, "code int, label string")
        classes.write.mode("overwrite").parquet(f"{path}/classes")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> TextClassifier:
        return cls(
            PipelineModel.load(f"{path}/features"),
            load_model(spark, f"{path}/model"),
            class_names(spark.read.parquet(f"{path}/classes")),
        )


def evaluate_model(model, test: DataFrame, name: str) -> tuple[DataFrame, DataFrame]:
    """``summary`` (accuracy, weighted scores, test rows) and ``report`` of one model."""
    rows = materialize(predict_all({name: model}, test), "predictions")
    return (
        evaluate.summary(rows, "actual", "predicted", "model"),
        evaluate.classification_report(rows, "actual", "predicted", "model"),
    )


def compare_stored(spark: SparkSession, paths: dict[str, str], test: DataFrame) -> DataFrame:
    """Load saved models and compare them on the same test rows, best first."""
    models = {name: load_model(spark, path) for name, path in paths.items()}
    rows = materialize(predict_all(models, test), "predictions")
    return evaluate.compare_models(rows, "actual", "predicted")


def run_training(
    df: DataFrame,
    key: str,
    text: str,
    label: str,
    out: str,
    *,
    specs: Iterable[ModelSpec] = DEFAULT_MODELS,
    run: str = "run",
    **preparation,
) -> Trained:
    """The whole training job; everything it learns ends up below ``out``.

    ``processed`` (texts and codes), ``features`` (by split), ``models/<name>`` (ready to
    score raw text), ``reports`` (by model), ``run_metrics`` (appended per run), ``predictions``,
    ``scores`` and ``best_model``. What it returns is read from there; its intermediate tables are deleted.
    """
    spark = df.sparkSession
    specs = list(specs)
    with scratch_scope(spark):
        prepared = prepare(df, key, text, label, keep_text=True, **preparation)
        processed = prepared.cleaned.select(
            "key",
            "original_text",
            F.col("cleaned").alias("cleaned_text"),
            "original_label",
            F.col("label").cast("int").alias("encoded_label"),
        )
        sinks.write_processed(processed, f"{out}/processed")
        sinks.write_features(prepared.features, f"{out}/features")
        trained = train_all(prepared, specs)
        for name, model in trained.models.items():
            TextClassifier.of(prepared, model).save(spark, f"{out}/models/{name}")
        report = materialize(
            evaluate.classification_report(trained.predictions, "actual", "predicted", "model"),
            "reports",
        )
        sinks.write_report(report, f"{out}/reports")
        for name in trained.models:
            metrics = sinks.report_metrics(report.filter(F.col("model") == name))
            sinks.append_run_metrics(metrics, f"{out}/run_metrics", run, {"model": name})
        for name, rows in (
            ("predictions", trained.predictions),
            ("scores", trained.scores),
            ("best_model", evaluate.best_model(trained.scores)),
        ):
            rows.write.mode("overwrite").parquet(f"{out}/{name}")
    return Trained(
        {spec.name: load_model(spark, f"{out}/models/{spec.name}/model") for spec in specs},
        spark.read.parquet(f"{out}/predictions"),
        spark.read.parquet(f"{out}/scores").orderBy(F.desc("accuracy"), "model"),
    )


#: Feature tables of a sweep that are written at the same time.
TABLES_AT_ONCE = 4

# The vectorizer sweep and its two forests.
SWEEP_RANGES = ((1, 1), (1, 2), (1, 3))
SWEEP_CAPS = tuple(range(1000, 10001, 1000))
COUNT_FOREST = ModelSpec("forest_count", "random_forest", {"n_estimators": 200, "max_depth": 15})
TFIDF_FOREST = ModelSpec("forest_tfidf", "random_forest", {"n_estimators": 150, "max_depth": 20})


def sweep_settings(max_features: int = 10000) -> list[VectorizerOptions]:
    """n-gram ranges by vectorizer, then caps for the widest TF-IDF range."""
    ranges = [
        VectorizerOptions(method, max_features, span)
        for span in SWEEP_RANGES
        for method in ("count", "tfidf")
    ]
    caps = [VectorizerOptions("tfidf", cap, SWEEP_RANGES[-1]) for cap in SWEEP_CAPS]
    return ranges + caps


def sweep_vectorizers(
    cleaned: DataFrame,
    settings: Iterable[VectorizerOptions],
    specs: dict[str, ModelSpec] | None = None,
    n_classes: int = 2,
) -> DataFrame:
    """One model per vectorizer setting, all fitted together: ``setting, accuracy, f1_weighted, ...``.

    ``cleaned`` has key, label, split, cleaned. N-grams are counted once for the
    widest range; a setting only filters that table by length and rank.
    """
    settings = list(settings)
    specs = specs or {"count": COUNT_FOREST, "tfidf": TFIDF_FOREST}
    widest = max(s.ngram_range[1] for s in settings)
    train = cleaned.filter(F.col("split") == "train")
    widest_opts = replace(settings[0], ngram_range=(1, widest), max_features=None)
    stats = term_stats(document_terms(train, "key", "cleaned", widest_opts))
    stats = materialize(stats.withColumn("words", F.size(F.split("term", " "))), "ngram-stats")
    n_docs = train.count()

    def table_of(opts: VectorizerOptions) -> DataFrame:
        low, high = opts.ngram_range
        fitted = vectorizer_from_stats(
            stats.filter(F.col("words").between(low, high)), n_docs, opts, "cleaned"
        )
        return materialize(
            fitted.transform(cleaned).select("key", "label", "split", "features"), "sweep-features"
        )

    named = {f"{o.method} {o.ngram_range[0]}-{o.ngram_range[1]} {o.max_features}": o for o in settings}
    with ThreadPoolExecutor(TABLES_AT_ONCE) as pool:
        tables = dict(zip(named, pool.map(table_of, named.values())))
    requests = [(tables[n].filter("split = 'train'"), specs[o.method]) for n, o in named.items()]
    models = fit_many(requests, n_classes)
    parts = [
        predict_all({name: model}, rows.filter("split = 'test'"))
        for (name, rows), model in zip(tables.items(), models)
    ]
    return _compare(parts)


def sweep_balancing(
    prepared: Prepared,
    methods: Iterable[str] = ("none", "undersample", "smote", "adasyn", "smoteenn"),
    spec: ModelSpec = TFIDF_FOREST,
) -> DataFrame:
    """One model per class-balancing method, judged on the untouched test rows.

    A method that leaves no rows has null scores.
    """
    tables, empty = {}, []
    for method in methods:
        rows = materialize(balanced(prepared.train, method, "key", "features", "label"), "balanced")
        if rows.isEmpty():  # editing may leave nothing to learn from
            empty.append((method,))
        else:
            tables[method] = rows
    models = fit_many([(rows, spec) for rows in tables.values()], prepared.n_classes)
    parts = [predict_all({method: model}, prepared.test) for method, model in zip(tables, models)]
    scores = _compare(parts)
    unscored = scores.sparkSession.createDataFrame(empty, "model string")
    return scores.unionByName(unscored, allowMissingColumns=True)


def _compare(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return evaluate.compare_models(materialize(out, "sweep-predictions"), "actual", "predicted")


# The second stacking recipe.
STACK_VARIANT = ModelSpec(
    "stack_variant",
    "stacking",
    {
        "base_models": (
            ModelSpec(
                "boosted",
                "boosted_trees",
                {
                    "n_estimators": 367,
                    "max_depth": 20,
                    "learning_rate": 0.1,
                    "reg_alpha": 0.1,
                    "num_leaves": 31,
                    "min_child_samples": 20,
                    "class_weight": "balanced",
                },
            ),
            ModelSpec("knn", "knn", {"n_neighbors": 5}),
            ModelSpec(
                "logistic",
                "logistic_regression",
                {"C": 1.0, "max_iter": 1000, "class_weight": "balanced"},
            ),
        ),
        "meta_model": ModelSpec("forest", "random_forest", {"n_estimators": 150, "max_depth": 20}),
        "cv": 5,
    },
)


def train_stack_variant(prepared: Prepared, spec: ModelSpec = STACK_VARIANT):
    """Under-sample the train rows, then stack boosted trees, k-NN and logistic under a forest."""
    rows = materialize(
        balanced(prepared.train, "undersample", "key", "features", "label"), "stack-train"
    )
    return fit_model(rows, spec, prepared.n_classes)
