"""Classifiers: logistic regression, forest, boosted trees, k-NN and stacking.

Forests and boosted trees are grown by ``trees``, any number of models together (``fit_many``); logistic
regressions are fitted side by side. Every fitted model has ``score(df)``, which adds ``prediction`` (double) and
``probability`` (array of K doubles) to the rows, and can be saved and loaded.
"""

from __future__ import annotations

import json
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textforge.operators.neighbors import build_index, first_rows, knn_votes
from textforge.operators.split import kfold, with_class_weight
from textforge.operators.trees import Job, Rule, TreeModel, fit_trees
from textforge.session import materialize

SEED = 42
#: Models that are fitted at the same time, each by its own jobs.
FITS_AT_ONCE = 6
#: Stored numbers of a partition that logistic regression goes over again and again.
FIT_NUMBERS = 1 << 22


@dataclass(frozen=True)
class ModelSpec:
    """``kind`` is one of logistic_regression, random_forest, boosted_trees, knn, stacking."""

    name: str
    kind: str
    params: dict = field(default_factory=dict)


# The default training configuration.
DEFAULT_MODELS = (
    ModelSpec(
        "logistic_regression",
        "logistic_regression",
        {"C": 1.0, "max_iter": 1000, "class_weight": "balanced"},
    ),
    ModelSpec(
        "random_forest",
        "random_forest",
        {"n_estimators": 200, "max_depth": 10, "min_samples_split": 5, "class_weight": "balanced"},
    ),
    ModelSpec(
        "boosted_trees",
        "boosted_trees",
        {"n_estimators": 150, "max_depth": 6, "learning_rate": 0.1},
    ),
    ModelSpec(
        "stacking",
        "stacking",
        {
            "base_models": ("logistic_regression", "random_forest"),
            "meta_model": "logistic_regression",
            "cv": 5,
        },
    ),
)

def _write_note(spark: SparkSession, path: str, note: dict) -> None:
    note_text = spark.range(1).select(F.lit(json.dumps(note)).alias("value"))
    note_text.write.mode("overwrite").text(f"{path}/note")


def _read_note(spark: SparkSession, path: str) -> dict:
    return json.loads(spark.read.text(f"{path}/note").first()["value"])


class MLModel:
    """A Spark ML classification model."""

    def __init__(self, model, kind: str):
        self.model, self.kind = model, kind

    def score(self, df: DataFrame) -> DataFrame:
        scored = self.model.transform(df)
        scored = scored.withColumn("probability", vector_to_array("probability"))
        return scored.drop("rawPrediction")

    def save(self, spark: SparkSession, path: str) -> None:
        self.model.write().overwrite().save(f"{path}/model")
        _write_note(spark, path, {"kind": self.kind})


class NearestModel:
    """k-NN votes against a stored training table. ``score`` takes batches only; streams are
    scored batch by batch (``streaming.scoring.write_scored``)."""

    def __init__(self, train: DataFrame, k: int, n_classes: int, key: str):
        self.train, self.k, self.n_classes, self.key = train, k, n_classes, key
        self.index = None  # built when first needed, for all later batches

    def score(self, df: DataFrame) -> DataFrame:
        key = self.key
        self.index = self.index or build_index(self.train, self.k, key=key, vec="features")
        near = self.index.search(df)
        votes = knn_votes(near, self.train, key, "label")
        shares = votes.groupBy(key).agg(
            F.map_from_entries(
                F.collect_list(F.struct(F.col("label").cast("int").alias("label"), "share"))
            ).alias("_shares")
        )
        classes = F.array(*(F.lit(i) for i in range(self.n_classes)))
        probability = F.transform(
            classes, lambda c: F.coalesce(F.try_element_at(F.col("_shares"), c), F.lit(0.0))
        )
        # The first largest share: the smallest class wins a tie.
        best = F.array_position("probability", F.array_max("probability")) - 1
        return (
            df.join(shares, key, "left")
            .withColumn("probability", probability)
            .withColumn("prediction", best.cast("double"))
            .drop("_shares")
        )

    def save(self, spark: SparkSession, path: str) -> None:
        self.train.write.mode("overwrite").parquet(f"{path}/train")
        note = {"kind": "knn", "k": self.k, "n_classes": self.n_classes, "key": self.key}
        _write_note(spark, path, note)


class StackedModel:
    """Base models' class probabilities feed a meta model."""

    def __init__(self, bases: list, meta, n_classes: int):
        self.bases, self.meta, self.n_classes = bases, meta, n_classes

    def score(self, df: DataFrame) -> DataFrame:
        stacked = stack_features(df, self.bases, self.n_classes)
        renamed = stacked.withColumnsRenamed({"features": "_text_features", "_stacked": "features"})
        scored = self.meta.score(renamed)
        return scored.drop("features").withColumnRenamed("_text_features", "features")

    def save(self, spark: SparkSession, path: str) -> None:
        for i, base in enumerate(self.bases):
            base.save(spark, f"{path}/base{i}")
        self.meta.save(spark, f"{path}/meta")
        note = {"kind": "stacking", "bases": len(self.bases), "n_classes": self.n_classes}
        _write_note(spark, path, note)


def load_model(spark: SparkSession, path: str):
    note = _read_note(spark, path)
    if note["kind"] == "knn":
        train = spark.read.parquet(f"{path}/train")
        return NearestModel(train, note["k"], note["n_classes"], note["key"])
    if note["kind"] == "stacking":
        bases = [load_model(spark, f"{path}/base{i}") for i in range(note["bases"])]
        return StackedModel(bases, load_model(spark, f"{path}/meta"), note["n_classes"])
    if note["kind"] in TREES:
        return FittedTrees(TreeModel.load(spark, path, note))
    return MLModel(LogisticRegressionModel.load(f"{path}/model"), note["kind"])


TREES = ("random_forest", "boosted_trees")


class FittedTrees:
    """A forest or a boosted model with its note."""

    def __init__(self, model: TreeModel):
        self.model, self.kind = model, model.kind

    def score(self, df: DataFrame) -> DataFrame:
        return self.model.score(df)

    def save(self, spark: SparkSession, path: str) -> None:
        self.model.save(spark, path)
        _write_note(spark, path, self.model.note())


def _weighted(train: DataFrame, spec: ModelSpec) -> DataFrame:
    if spec.params.get("class_weight") == "balanced":
        return with_class_weight(train, "label")
    return train.withColumn("weight", F.lit(1.0))


def tree_job(train: DataFrame, spec: ModelSpec, n_classes: int, seed: int = SEED) -> Job:
    """What to grow for a spec. ``num_leaves`` makes boosted trees grow leaf by leaf."""
    p, rows = spec.params, _weighted(train, spec)
    if spec.kind == "random_forest":
        rule = Rule(max_depth=p.get("max_depth"), min_split=p.get("min_samples_split", 2), features=1)
        return Job(rows, spec.kind, n_classes, p.get("n_estimators", 100), rule, seed=seed)
    leaf_wise = "num_leaves" in p
    rule = Rule(
        newton=True,
        max_depth=p.get("max_depth", 6),
        leaves=p.get("num_leaves"),
        min_split=2,
        min_leaf=p.get("min_child_samples", 1),
        min_hessian=p.get("min_child_weight", 1e-3 if leaf_wise else 1.0),
        l1=p.get("reg_alpha", 0.0),
        l2=p.get("reg_lambda", 0.0 if leaf_wise else 1.0),
    )
    # Both usual bounds on the softmax's second derivative.
    curvature = n_classes / max(1, n_classes - 1) if leaf_wise else 2.0
    rate = p.get("learning_rate", 0.1)
    return Job(rows, spec.kind, n_classes, p.get("n_estimators", 100), rule, rate, curvature, leaf_wise, seed)


def _fit_logistic(train: DataFrame, spec: ModelSpec, n_classes: int) -> MLModel:
    p, numbers = spec.params, F.size(F.unwrap_udt("features")["values"]).cast("long")
    rows, n = train.agg(F.count(F.lit(1)), F.sum(numbers)).first()  # balanced weights add up to the rows as well
    # C * sum of weighted losses + 1/2 |W|^2, divided by C * total weight.
    est = LogisticRegression(
        family="binomial" if n_classes == 2 else "multinomial",
        regParam=1.0 / (p.get("C", 1.0) * rows),
        elasticNetParam=0.0,
        standardization=False,
        maxIter=p.get("max_iter", 100),
        weightCol="weight",
    )
    # Every iteration is a job over all partitions, so there are no more than the numbers need.
    few = _weighted(train, spec).coalesce(max(1, -(-(n or 0) // FIT_NUMBERS)))
    return MLModel(est.fit(few), spec.kind)


def fit_many(requests: list[tuple[DataFrame, ModelSpec]], n_classes: int, *, key: str = "key", seed: int = SEED) -> list:
    """Fit many specs, each on its own ``key, label (0..K-1), features``: all trees together, the rest side by side."""
    out: list = [None] * len(requests)
    trees = [i for i, (_, spec) in enumerate(requests) if spec.kind in TREES]

    def grow() -> list:
        models = fit_trees([tree_job(*requests[i], n_classes, seed) for i in trees], key)
        return [FittedTrees(model) for model in models]

    def fit(i: int):
        train, spec = requests[i]
        if spec.kind == "logistic_regression":
            return _fit_logistic(train, spec, n_classes)
        if spec.kind == "knn":
            rows = first_rows(train.select(key, "label", "features"), key, spec.params.get("max_fit_rows"))
            return NearestModel(materialize(rows, "knn-train"), spec.params.get("n_neighbors", 5), n_classes, key)
        raise ValueError(f"unsupported model kind: {spec.kind}")

    rest = [i for i in range(len(requests)) if i not in trees]
    with ThreadPoolExecutor(FITS_AT_ONCE) as pool:
        grown = pool.submit(grow) if trees else None
        for i, model in zip(rest, pool.map(fit, rest)):
            out[i] = model
        for i, model in zip(trees, grown.result() if grown else []):
            out[i] = model
    return out


def fit_model(
    train: DataFrame,
    spec: ModelSpec,
    n_classes: int,
    *,
    key: str = "key",
    others: dict[str, ModelSpec] | None = None,
    fitted: dict[str, object] | None = None,
    seed: int = SEED,
):
    """Fit one spec on ``key, label (0..K-1), features``.

    ``others`` names the specs a stacking spec refers to; those among them that are already
    fitted on the same rows can be handed in as ``fitted``. k-NN's parameter ``max_fit_rows`` bounds
    the stored rows, the first in hash order.
    """
    if spec.kind == "stacking":
        by_name = others or {}
        known = {
            by_name[b].name: (fitted or {})[b]
            for b in spec.params["base_models"]
            if isinstance(b, str) and b in (fitted or {})
        }
        bases = [
            b if isinstance(b, ModelSpec) else by_name[b] for b in spec.params["base_models"]
        ]
        meta = spec.params["meta_model"]
        meta = meta if isinstance(meta, ModelSpec) else by_name[meta]
        return fit_stack(
            train, bases, meta, n_classes, spec.params.get("cv", 5), key=key, seed=seed, fitted=known
        )
    return fit_many([(train, spec)], n_classes, key=key, seed=seed)[0]


def stack_features(df: DataFrame, models: list, n_classes: int) -> DataFrame:
    """Add ``_stacked``: all models' class probabilities (two classes: only the second)."""
    names = []
    for i, model in enumerate(models):
        name = f"_p{i}"
        df = (
            model.score(df)
            .withColumnRenamed("probability", name)
            .drop("prediction")
        )
        names.append(name)
    parts = [F.slice(n, 2, 1) if n_classes == 2 else F.col(n) for n in names]
    stacked = F.concat(*parts) if len(parts) > 1 else parts[0]
    return df.withColumn("_stacked", array_to_vector(stacked)).drop(*names)


def out_of_fold(
    train: DataFrame,
    bases: list[ModelSpec],
    n_classes: int,
    cv: int = 5,
    *,
    key: str = "key",
    seed: int = SEED,
) -> DataFrame:
    """``key, label, fold, features``: probabilities from models that never saw the row.

    All bases of all folds are fitted together.
    """
    folded = materialize(kfold(train, key, "label", cv, seed), "stack-folds")
    return _out_of_fold(folded, fit_many(_fold_requests(folded, bases, cv), n_classes, key=key, seed=seed), bases, n_classes, cv, key)


def _fold_requests(folded: DataFrame, bases: list[ModelSpec], cv: int) -> list[tuple[DataFrame, ModelSpec]]:
    return [(folded.filter(F.col("fold") != fold), base) for fold in range(cv) for base in bases]


def _out_of_fold(folded: DataFrame, models: list, bases: list, n_classes: int, cv: int, key: str) -> DataFrame:
    parts = []
    for fold in range(cv):
        own = models[fold * len(bases) : (fold + 1) * len(bases)]
        held = stack_features(folded.filter(F.col("fold") == fold), own, n_classes)
        parts.append(held.select(key, "label", "fold", F.col("_stacked").alias("features")))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return materialize(out, "stack-oof")


def fit_stack(
    train: DataFrame,
    bases: list[ModelSpec],
    meta: ModelSpec,
    n_classes: int,
    cv: int = 5,
    *,
    key: str = "key",
    seed: int = SEED,
    fitted: dict[str, object] | None = None,
) -> StackedModel:
    """The meta model learns from out-of-fold probabilities; the bases are fitted on all rows
    unless ``fitted`` has them by name."""
    folded = materialize(kfold(train, key, "label", cv, seed), "stack-folds")
    missing = [b for b in bases if b.name not in (fitted or {})]
    requests = _fold_requests(folded, bases, cv) + [(folded, b) for b in missing]
    models = fit_many(requests, n_classes, key=key, seed=seed)
    known = (fitted or {}) | {b.name: m for b, m in zip(missing, models[cv * len(bases) :])}
    oof = _out_of_fold(folded, models, bases, n_classes, cv, key)
    meta_model = fit_model(oof, meta, n_classes, key=key, seed=seed)
    whole = [known[b.name] for b in bases]
    return StackedModel(whole, meta_model, n_classes)


def predict_all(models: dict[str, object], test: DataFrame, key: str = "key") -> DataFrame:
    """Long predictions ``model, key, actual, predicted`` of several models."""
    parts = [
        model.score(test).select(
            F.lit(name).alias("model"),
            key,
            F.col("label").cast("int").alias("actual"),
            F.col("prediction").cast("int").alias("predicted"),
        )
        for name, model in models.items()
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out

