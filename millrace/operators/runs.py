"""The table of model runs: one row per run, compared with plain queries."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from millrace.operators.ranking import running_maximum
from millrace.operators.toplists import largest

RUNS_SCHEMA = (
    "run_id STRING, run_name STRING, model_type STRING, start_time TIMESTAMP, "
    "accuracy DOUBLE, weighted_f1 DOUBLE, weighted_precision DOUBLE, weighted_recall DOUBLE, "
    "auc_ovr_macro DOUBLE, majority_share DOUBLE, train_seconds DOUBLE, n_rows BIGINT, "
    "n_features INT, n_classes INT, numTrees INT, maxDepth INT, params MAP<STRING, STRING>, "
    "model_path STRING, error STRING"
)
METRICS = ("accuracy", "weighted_f1", "weighted_precision", "weighted_recall")
# Length of a stored error text, size of the recent list.
ERROR_CHARS = 500
RECENT = 50


def append_run(spark: SparkSession, path: str, run: Mapping) -> None:
    """Append one run; fields it lacks stay NULL."""
    names = spark.createDataFrame([], RUNS_SCHEMA).columns
    spark.createDataFrame([tuple(run.get(name) for name in names)], RUNS_SCHEMA).write.mode(
        "append").parquet(path)


def typed_runs(raw: DataFrame, renames: Mapping[str, str], numbers: Sequence[str]) -> DataFrame:
    """Logged text to comparable columns: renamed, numbers parsed where they can be."""
    renamed = raw.withColumnsRenamed(dict(renames))
    return renamed.withColumns({name: F.col(name).try_cast("double") for name in numbers})


def finished(runs: DataFrame) -> DataFrame:
    return runs.na.drop(subset=["accuracy", "model_type"])


def best_per_model(runs: DataFrame) -> DataFrame:
    """The most accurate run of each model type, best type first."""
    order = Window.partitionBy("model_type").orderBy(F.desc("accuracy"), F.asc("run_id"))
    ranked = finished(runs).withColumn("_rank", F.row_number().over(order))
    return ranked.where("_rank = 1").drop("_rank").orderBy(F.desc("accuracy"), "run_id")


def best_run(runs: DataFrame) -> DataFrame:
    """The most accurate run of all."""
    return largest(finished(runs), "accuracy", 1, ["run_id"])


def recent_runs(runs: DataFrame, k: int = RECENT) -> DataFrame:
    return largest(runs, "start_time", k, ["run_id"])


def sweep(runs: DataFrame, fixed: str, varied: str) -> DataFrame:
    """Runs at the most usual value of ``fixed`` (the smallest of equals), ordered by ``varied``.

    The usual value is the first row of a sorted count, so it stays a one-row table.
    """
    complete = finished(runs)
    usual = complete.where(F.col(fixed).isNotNull()).groupBy(fixed).agg(F.count("*").alias("_n"))
    usual = usual.orderBy(F.desc("_n"), F.asc(fixed)).limit(1)
    return complete.join(F.broadcast(usual.select(fixed)), fixed, "left_semi").orderBy(varied, "run_id")


def accuracy_time_pairs(runs: DataFrame) -> DataFrame:
    """Accuracy against training time, runs with both."""
    return finished(runs).na.drop(subset=["train_seconds"]).select(
        "run_id", "model_type", "train_seconds", "accuracy")


def frontier(runs: DataFrame) -> DataFrame:
    """Runs that no other run beats in accuracy without taking longer: each is more accurate than all faster ones.

    Of runs that took equally long the most accurate one stands for them, of equal ones the first by id. The largest
    accuracy so far is carried from slice to slice of the sorted times, so no task sees all times. Runs jobs while it is planned.
    """
    pairs = accuracy_time_pairs(runs)
    best = pairs.groupBy("train_seconds").agg(F.min_by(F.struct("run_id", "model_type", "accuracy"), F.struct(
        -F.col("accuracy"), F.col("run_id"))).alias("_best"))
    sorted_times = best.select("_best.run_id", "_best.model_type", "train_seconds", "_best.accuracy")
    reached = running_maximum(sorted_times, ["train_seconds"], "accuracy", "_reached")
    return reached.where(F.col("_reached").isNull() | (F.col("accuracy") > F.col("_reached"))).drop("_reached")
