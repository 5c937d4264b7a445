"""Training several classifiers, logging them as runs, scoring with the best."""

from __future__ import annotations

import time
import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from datetime import datetime, timezone
from math import ceil

from pyspark import StorageLevel
from pyspark.ml import Estimator, Model, PipelineModel
from pyspark.ml.classification import (
    DecisionTreeClassifier, GBTClassifier, LogisticRegression, NaiveBayes, OneVsRest,
    RandomForestClassifier,
)
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from millrace.operators.evaluation import (
    area_per_class, confusion_matrix, macro_auc, per_class_metrics,
    scores_as_array, weighted_metrics,
)
from millrace.operators.features import decode_labels, label_index, model_input, with_label
from millrace.operators.runs import ERROR_CHARS, append_run, best_run
from millrace.operators.sampling import hash_sample, hash_split
from millrace.operators.toplists import largest
from millrace.session import broadcast_if_small, materialize, scratch_path
from millrace.sources.text import write_result
from millrace.spec import INCIDENTS, MODEL_FEATURES, PREDICTION_COLUMNS, EventSpec

# How many parts the training rows are dealt into at least, by their keys, and the most rows of a part. Fits depend on it, so
# it follows the rows alone and not the cores: the same rows make the same parts everywhere.
PARTITIONS, PART_ROWS = 16, 200_000

# The most rows that one-vs-rest members fitted side by side have together. Beyond that a member's parts fill the cores.
SIDE_ROWS = 1_000_000

# Hyper-parameters of the five classifiers; ``LIGHT`` is the smaller forest and
# boosting that fit small machines, used only on demand.
SEED = 42
PARAMS = {
    "logistic_regression": {"maxIter": 50, "regParam": 0.0, "elasticNetParam": 0.0,
                            "family": "multinomial"},
    "decision_tree": {"maxDepth": 15, "maxBins": 64},
    "random_forest": {"numTrees": 100, "maxDepth": 15, "featureSubsetStrategy": "auto"},
    "gbt_ovr": {"maxIter": 30, "maxDepth": 5},
    "naive_bayes": {"modelType": "gaussian"},
}
LIGHT = {
    "random_forest": {"numTrees": 40, "maxDepth": 10},
    "gbt_ovr": {"maxIter": 15, "maxDepth": 4},
}


@dataclass(frozen=True)
class TrainingData:
    """Feature rows on shared storage, split by folder, the closed class list, the features' names."""

    rows: DataFrame
    labels: DataFrame
    classes: tuple[str, ...]
    total: int
    features: tuple[str, ...] = MODEL_FEATURES
    partitions: int = PARTITIONS
    settings: Mapping[str, str] = field(default_factory=dict)

    @property
    def train(self) -> DataFrame:
        """Dealt out and sorted by key: the same rows at the same places however many cores there are."""
        return self.rows.where("is_train").repartition(self.partitions, "_key").sortWithinPartitions(
            "_key", F.xxhash64(vector_to_array("features"))).drop("_key")

    @property
    def test(self) -> DataFrame:
        return self.rows.where(~F.col("is_train")).drop("_key")


def labelled_rows(df: DataFrame, labels: DataFrame, spec: EventSpec = INCIDENTS) -> DataFrame:
    """Model input with its label and class number, after a class list fixed at training time."""
    top = labels.select(F.col("label").alias(spec.type))
    numbers = labels.select(F.col("label").alias("label_raw"), F.col("idx").cast("double").alias("label"))
    return with_label(df, top, spec).join(broadcast_if_small(numbers), "label_raw", "left")


def prepare(df: DataFrame, spec: EventSpec = INCIDENTS, fraction: float = 1.0, top_n: int = 5,
            train_ratio: float = 0.8, features: Sequence[str] = MODEL_FEATURES,
            portable: bool = False, partitions: int = PARTITIONS) -> TrainingData:
    """Sample, label (top types, else OTHER), assemble, split. Rows to fit are dealt into ``partitions``, and more
    from ``PART_ROWS`` rows a part on: a fit keeps its rows in memory, where large parts fill few cores and fit badly.

    ``portable`` decides sample and split by a hash that other engines have too.

    The assembled rows are written once to the shared folder: every fit and evaluation reads them
    from there, and they survive lost executors.
    """
    rows = hash_sample(model_input(df, spec, features), spec.key, fraction, portable=portable)
    # One pass counts the types; top list and class list both come from those counts.
    counts = materialize(rows.groupBy(spec.type).agg(F.count("*").alias("n")), "type-counts")
    top = largest(counts, "n", top_n, [spec.type]).select(spec.type)
    labels = materialize(label_index(with_label(counts, top, spec), weight="n"), "labels")
    # At most top_n + 1 names come to the driver.
    classes = tuple(row["label"] for row in labels.orderBy("idx").select("label").limit(top_n + 1).collect())
    assembler = VectorAssembler(inputCols=list(features), outputCol="features", handleInvalid="skip")
    assembled = assembler.transform(labelled_rows(rows, labels, spec))
    split = hash_split(assembled, spec.key, train_ratio, portable=portable)
    stored = materialize(split.select(F.col(spec.key).alias("_key"), "features", "label", "is_train"),
                         "training-rows", ("is_train",))
    settings = {"top_n_types": str(top_n), "train_ratio": str(train_ratio),
                "sample_fraction": str(fraction)}
    total = stored.count()
    parts = max(partitions, ceil(total * train_ratio / PART_ROWS))
    return TrainingData(with_class_names(stored, classes), labels, classes, total, tuple(features), parts, settings)


def with_class_names(rows: DataFrame, classes: Sequence[str]) -> DataFrame:
    """Attaches the class list to the label column, so estimators need no pass to count classes."""
    about = {"ml_attr": {"type": "nominal", "name": "label", "vals": list(classes)}}
    return rows.withColumn("label", F.col("label").alias("label", metadata=about))


def estimator(name: str, light: bool = False, parallelism: int = 1, **override) -> Estimator:
    """One of the five classifiers, with its stored hyper-parameters; ``parallelism`` is the number
    of one-vs-rest members fitted at a time, each with the training rows in memory. ``fit`` takes fewer of large tables."""
    params = {**PARAMS[name], **(LIGHT.get(name, {}) if light else {}), **override}
    if name == "logistic_regression":
        return LogisticRegression(**params)
    if name == "decision_tree":
        return DecisionTreeClassifier(seed=SEED, **params)
    if name == "random_forest":
        return RandomForestClassifier(seed=SEED, **params)
    if name == "gbt_ovr":
        return OneVsRest(classifier=GBTClassifier(seed=SEED, **params), parallelism=parallelism)
    return NaiveBayes(**params)


def side_by_side(wanted: int, rows: int, parts: int, cores: int) -> int:
    """How many one-vs-rest members to fit at a time, ``wanted`` at most: several while they are small together, or while
    the parts of fewer leave cores idle."""
    return max(1, min(wanted, max(SIDE_ROWS // max(rows, 1), ceil(cores / parts))))


def fit(est: Estimator, data: TrainingData) -> Model:
    """Fit on the training rows.

    A boosted member holds 200 to 300 bytes a row in memory, and reads them all for each level of each tree. Members that
    do not fit beside one another drive each other's rows to disk every time, so large tables have them one after the other;
    the models are the same. The rows as dealt wait on disk: only the start of a member reads them.
    """
    if not isinstance(est, OneVsRest):
        return est.fit(data.train)
    cores = data.rows.sparkSession.sparkContext.defaultParallelism
    members = side_by_side(est.getParallelism(), data.total, data.partitions, cores)
    rows = data.train.persist(StorageLevel.DISK_ONLY)
    try:
        return est.fit(rows, {est.parallelism: members})
    finally:
        rows.unpersist()


def logged_params(est: Estimator) -> dict[str, str]:
    """The settings that differ from the defaults, as text."""
    inner = est.getClassifier() if isinstance(est, OneVsRest) else est
    return {param.name: str(value) for param, value in inner.extractParamMap().items()
            if inner.isSet(param) and not param.name.endswith("Col")}


def feature_importance(spark: SparkSession, model: Model,
                       features: Sequence[str] = MODEL_FEATURES) -> DataFrame:
    """(feature, importance), largest first: one number per feature, read off the fitted model.

    Trees give their own importances; linear models the mean absolute coefficient over classes;
    one-vs-rest the mean over its members.
    """
    weights = _weights(model)
    rows = [] if weights is None else list(zip(features, map(float, weights), strict=True))
    table = spark.createDataFrame(rows, "feature STRING, importance DOUBLE")
    return table.orderBy(F.desc("importance"), "feature")


def _weights(model: Model):
    if hasattr(model, "models"):
        members = [w for w in map(_weights, model.models) if w is not None]
        return sum(members) / len(members) if members else None
    if hasattr(model, "featureImportances"):
        return model.featureImportances.toArray()
    if hasattr(model, "coefficientMatrix"):
        return abs(model.coefficientMatrix.toArray()).mean(axis=0)
    return None


def evaluate(predictions: DataFrame, auc_digits: int | None = None) -> tuple[DataFrame, DataFrame]:
    """Counts and per-class AUC of a scored test set.

    The model is applied once: rows are counted by label, prediction, class and score before anything
    is written. ``auc_digits`` rounds the scores, which leaves few different ones to write and sort.
    """
    exploded = scores_as_array(predictions).select(
        "label", "prediction", F.posexplode("scores").alias("class", "score"))
    if auc_digits is not None:
        exploded = exploded.withColumn("score", F.round("score", auc_digits))
    counts = materialize(exploded.groupBy("label", "prediction", "class", "score").agg(
        F.count("*").alias("n")), "score-counts")
    confusion = counts.where(F.col("class") == 0).groupBy("label", "prediction").agg(F.sum("n").alias("n"))
    return confusion, area_per_class(counts)


@dataclass(frozen=True)
class Trained:
    run: dict
    model: Model | None = None
    confusion: DataFrame | None = None
    auc: DataFrame | None = None


def train_one(data: TrainingData, name: str, est: Estimator, model_root: str | None = None,
              auc_digits: int | None = None) -> Trained:
    """Fit, evaluate and describe one model; a failure becomes the run's error text."""
    run = {
        "run_id": uuid.uuid4().hex, "run_name": f"model-{name}", "model_type": name,
        "start_time": datetime.now(timezone.utc),
        "n_rows": data.total, "n_features": len(data.features), "n_classes": len(data.classes),
    }
    try:
        params = logged_params(est)
        run["params"] = {**data.settings, **params}
        for shown in ("numTrees", "maxDepth"):
            run[shown] = int(params[shown]) if shown in params else None
        started = time.monotonic()
        model = fit(est, data)
        run["train_seconds"] = time.monotonic() - started
        confusion, auc = evaluate(model.transform(data.test), auc_digits)
        quality = weighted_metrics(per_class_metrics(confusion)).drop("n_rows")
        run.update(quality.first().asDict())
        run["auc_ovr_macro"] = macro_auc(auc).first()["auc_ovr_macro"]
        if model_root:
            run["model_path"] = f"{model_root}/{run['run_id']}"
            save_model(model, data.labels, run["model_path"])
            save_results(model, confusion, data, run["model_path"])
            write_names(data, run["model_path"])
    except Exception as failure:  # one model's failure must not stop the others
        run["error"] = str(failure)[:ERROR_CHARS]
        return Trained(run)
    return Trained(run, model, confusion, auc)


def train_all(spark: SparkSession, data: TrainingData, runs_path: str, model_root: str,
              names: Sequence[str] = tuple(PARAMS), light: bool = False,
              auc_digits: int | None = None, parallelism: int = 1) -> Mapping[str, Trained]:
    """Train the models one after the other; each fit uses the whole cluster."""
    results = {}
    for name in names:
        results[name] = train_one(
            data, name, estimator(name, light, parallelism), model_root, auc_digits)
        append_run(spark, runs_path, results[name].run)
    return results


def save_model(model: Model, labels: DataFrame, path: str) -> None:
    """The model together with the class list it was trained with."""
    PipelineModel([model]).write().overwrite().save(f"{path}/model")
    labels.write.mode("overwrite").parquet(f"{path}/labels")


def write_names(data: TrainingData, path: str) -> None:
    """The features in the order the model knows them by."""
    spark = data.rows.sparkSession
    spark.createDataFrame(list(enumerate(data.features)), "position INT, feature STRING").write.mode(
        "overwrite").parquet(f"{path}/features")


def named_confusion(confusion: DataFrame, classes: Sequence[str]) -> DataFrame:
    """Confusion counts with class names on both sides."""
    names = F.array(*map(F.lit, classes))

    def name(number: str) -> Column:
        return F.element_at(names, F.col(number).cast("int") + 1)

    return confusion.select(name("label").alias("actual"), name("prediction").alias("predicted"), "n")


def save_results(model: Model, confusion: DataFrame, data: TrainingData, path: str) -> None:
    """Per-class metrics, confusion matrix and importances as delimited files beside the model."""
    named = named_confusion(confusion, data.classes)
    per_class = per_class_metrics(named, "actual", "predicted", data.labels.select("label"))
    write_result(per_class, f"{path}/per_class")
    matrix = confusion_matrix(named, data.classes, "actual", "predicted")
    write_result(matrix, f"{path}/confusion_matrix")
    write_result(feature_importance(confusion.sparkSession, model, data.features), f"{path}/feature_importance")


def predict(spark: SparkSession, df: DataFrame, model_path: str, spec: EventSpec = INCIDENTS,
            fraction: float = 1.0) -> DataFrame:
    """Score a table with a stored model, its own class list and its own features."""
    model = PipelineModel.load(f"{model_path}/model")
    names = spark.read.parquet(f"{model_path}/features").orderBy("position").collect()
    features = [row["feature"] for row in names]
    labels = spark.read.parquet(f"{model_path}/labels")
    rows = hash_sample(model_input(df, spec, features), spec.key, fraction, salt="inference")
    labelled = labelled_rows(rows, labels, spec)
    assembler = VectorAssembler(inputCols=list(features), outputCol="features", handleInvalid="skip")
    scored = model.transform(assembler.transform(labelled))
    named = decode_labels(scored, labels)
    return named.withColumnRenamed("label_raw", "actual_label").select(*PREDICTION_COLUMNS)


def predict_best(spark: SparkSession, df: DataFrame, runs_path: str,
                 spec: EventSpec = INCIDENTS, fraction: float = 1.0) -> DataFrame:
    """Score with the most accurate run of the runs table."""
    best = best_run(spark.read.parquet(runs_path).where("model_path IS NOT NULL")).first()
    if best is None:
        raise RuntimeError("no finished run has a stored model")
    return predict(spark, df, best["model_path"], spec, fraction)


def new_model_root(spark: SparkSession) -> str:
    return scratch_path(spark, "models")
