"""Evaluation of predictions that follow a rule, so that another engine can check them."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.operators import evaluation
from millrace.operators.toplists import top_counts
from workload import Query
from workload.aggregate import rounded
from workload.bindings import PAYLOAD, payload

CLASSES = 5


def rule_predictions(spark, sf):
    """Class = district modulo 5; every third prediction is off by a step that varies."""
    label = (F.col("district") % CLASSES).cast("double")
    step = F.when(F.col("id") % 3 == 0, F.col("beat") % CLASSES).otherwise(0)
    scores = F.array(*[
        ((F.col("id") * 31 + number * 17) % 101 + F.when(F.col("district") % CLASSES == number, 9).otherwise(0)) / 101.0
        for number in range(CLASSES)])
    return payload(spark, sf).select(
        "id", label.alias("label"), ((label + step) % CLASSES).alias("prediction"), scores.alias("scores"),
        F.concat(F.lit("class_"), label.cast("int")).alias("actual_label"),
        F.concat(F.lit("class_"), ((label + step) % CLASSES).cast("int")).alias("predicted_label"))


PREDICTIONS = f"""{PAYLOAD}, predictions AS (
SELECT id, CAST(district % 5 AS DOUBLE) AS label,
       CAST((district % 5 + CASE WHEN id % 3 = 0 THEN beat % 5 ELSE 0 END) % 5 AS DOUBLE) AS prediction
FROM payload)"""


def confusion_matrix(spark, sf):
    """With missing actual classes, and with predictions of a class that is not in the list."""
    gaps = rule_predictions(spark, sf).withColumns({
        "actual_label": F.when(F.col("id") % 29 != 0, F.col("actual_label")),
        "predicted_label": F.when(F.col("id") % 37 == 0, "class_9").when(
            F.col("id") % 41 != 0, F.col("predicted_label"))})
    counts = evaluation.confusion_counts(gaps, "actual_label", "predicted_label")
    names = [f"class_{number}" for number in range(CLASSES)]
    return evaluation.confusion_matrix(counts, names, "actual_label", "predicted_label")


def per_class_metrics(spark, sf):
    rated = evaluation.per_class_metrics(evaluation.confusion_counts(rule_predictions(spark, sf)))
    return rounded(rated, "precision", "recall", "f1")


_PER_CLASS = """classes AS (
SELECT label, COUNT(*) FILTER (WHERE prediction = label) AS tp, COUNT(*) AS seen FROM predictions GROUP BY label),
called AS (SELECT prediction, COUNT(*) AS n FROM predictions GROUP BY prediction),
rated AS (SELECT label, tp, COALESCE(n, 0) - tp AS fp, seen - tp AS fn,
       COALESCE(tp / NULLIF(COALESCE(n, 0), 0), 0) AS p, COALESCE(tp / NULLIF(seen, 0), 0) AS r
FROM classes LEFT JOIN called ON label = prediction)"""
PER_CLASS = f"""WITH {PREDICTIONS}, {_PER_CLASS}
SELECT label, tp, fp, fn, round(p, 6) AS precision, round(r, 6) AS recall,
       round(COALESCE(2 * p * r / NULLIF(p + r, 0), 0), 6) AS f1 FROM rated"""


def precision_recall_points(spark, sf):
    return evaluation.precision_recall_points(per_class_metrics(spark, sf))


def weighted_metrics(spark, sf):
    counts = evaluation.confusion_counts(rule_predictions(spark, sf))
    summary = evaluation.weighted_metrics(evaluation.per_class_metrics(counts))
    return rounded(summary, *[name for name in summary.columns if name != "n_rows"])


WEIGHTED = f"""WITH {PREDICTIONS}, {_PER_CLASS}
SELECT CAST(SUM(tp + fn) AS BIGINT) AS n_rows, round(SUM(tp) / SUM(tp + fn), 6) AS accuracy,
       round(SUM((tp + fn) * COALESCE(2 * p * r / NULLIF(p + r, 0), 0)) / SUM(tp + fn), 6) AS weighted_f1,
       round(SUM((tp + fn) * p) / SUM(tp + fn), 6) AS weighted_precision,
       round(SUM((tp + fn) * r) / SUM(tp + fn), 6) AS weighted_recall,
       round(MAX(tp + fn) / SUM(tp + fn), 6) AS majority_share
FROM rated"""


def auc_ovr(spark, sf):
    return rounded(evaluation.auc_per_class(rule_predictions(spark, sf)), "auc")


# Mean rank form: the average rank of tied scores, independent of the running sums in Spark.
AUC = f"""WITH {PREDICTIONS}, exploded AS (
SELECT CAST(c AS INTEGER) AS class, label = c AS hit,
       ((id * 31 + c * 17) % 101 + CASE WHEN label = c THEN 9 ELSE 0 END) AS score
FROM predictions, (VALUES (0), (1), (2), (3), (4)) AS numbers(c)), ranked AS (
SELECT class, hit, RANK() OVER (PARTITION BY class ORDER BY score)
       + (COUNT(*) OVER (PARTITION BY class, score) - 1) / 2.0::DOUBLE AS rk FROM exploded)
SELECT class, COUNT(*) FILTER (WHERE hit) AS positives, COUNT(*) FILTER (WHERE NOT hit) AS negatives,
       round((SUM(rk) FILTER (WHERE hit) - COUNT(*) FILTER (WHERE hit) * (COUNT(*) FILTER (WHERE hit) + 1) / 2.0::DOUBLE)
             / (COUNT(*) FILTER (WHERE hit) * COUNT(*) FILTER (WHERE NOT hit)), 6) AS auc
FROM ranked GROUP BY class"""


def auc_macro(spark, sf):
    per_class = evaluation.auc_per_class(rule_predictions(spark, sf))
    return rounded(evaluation.macro_auc(per_class), "auc_ovr_macro")


def match_rate(spark, sf):
    return rounded(evaluation.match_rate(rule_predictions(spark, sf)), "match_rate")


def prediction_distribution(spark, sf):
    return top_counts(rule_predictions(spark, sf), "predicted_label", 10, "rows")


_CELLS = ", ".join(
    f"COUNT(*) FILTER (WHERE shown AND prediction = {number}) AS class_{number}" for number in range(CLASSES))

QUERIES = {
    "confusion_matrix": Query(confusion_matrix, f"""WITH {PREDICTIONS}
SELECT CASE WHEN id % 29 <> 0 THEN 'class_' || CAST(label AS INTEGER) END AS actual_label, {_CELLS},
       COUNT(*) FILTER (WHERE NOT shown) AS unlisted
FROM (SELECT *, id % 37 <> 0 AND id % 41 <> 0 AS shown FROM predictions) GROUP BY 1"""),
    "per_class_metrics": Query(per_class_metrics, PER_CLASS),
    "precision_recall_points": Query(
        precision_recall_points, f"SELECT label, recall, precision, f1, tp FROM ({PER_CLASS})"),
    "weighted_metrics": Query(weighted_metrics, WEIGHTED),
    "auc_ovr": Query(auc_ovr, AUC),
    "auc_macro": Query(auc_macro, f"""WITH areas AS ({AUC.replace(', 6) AS auc', ', 15) AS auc')})
SELECT round(AVG(auc), 6) AS auc_ovr_macro, COUNT(auc) AS classes FROM areas"""),
    "match_rate": Query(match_rate, f"""WITH {PREDICTIONS}
SELECT round(AVG(CASE WHEN label = prediction THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END), 6) AS match_rate FROM predictions"""),
    "prediction_distribution": Query(prediction_distribution, f"""WITH {PREDICTIONS}
SELECT 'class_' || CAST(prediction AS INTEGER) AS predicted_label, COUNT(*) AS rows
FROM predictions GROUP BY prediction ORDER BY rows DESC, predicted_label LIMIT 10"""),
}
