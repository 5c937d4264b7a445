"""Quality of predictions, all from one pass over them (two with AUC)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, functions as F

from millrace.operators.ranking import running_totals
from millrace.operators.reshape import crosstab


def confusion_counts(predictions: DataFrame, actual: str = "label",
                     predicted: str = "prediction") -> DataFrame:
    """Rows per actual and predicted class: the base of every count-based measure."""
    return predictions.groupBy(actual, predicted).agg(F.count("*").alias("n"))


def confusion_matrix(counts: DataFrame, classes: Sequence, actual: str = "label",
                     predicted: str = "prediction", prefix: str = "",
                     rest: str = "unlisted") -> DataFrame:
    """Actual classes down, predicted ones across, empty cells 0.

    Predictions outside ``classes`` are counted under ``rest``, and missing actual classes are a
    row, so the cells sum to the number of predictions.
    """
    return crosstab(counts, actual, predicted, classes, "n", prefix, rest)


def per_class_metrics(counts: DataFrame, actual: str = "label",
                      predicted: str = "prediction", classes: DataFrame | None = None) -> DataFrame:
    """True and false positives, false negatives, precision, recall and F1 per class.

    Ratios without a denominator are 0. ``classes`` (one column ``label``) adds classes that occur
    on neither side.
    """
    def side(owner, hit, called, seen):
        return F.struct(owner.alias("label"), hit.alias("tp"), called.alias("called"),
                        seen.alias("seen"))

    n, zero = F.col("n"), F.lit(0).cast("bigint")
    own, other = F.col(actual), F.col(predicted)
    sides = F.array(side(own, F.when(own == other, n).otherwise(zero), zero, n),
                    side(other, zero, n, zero))
    tally = counts.select(F.inline(sides))
    if classes is not None:
        tally = tally.unionByName(classes.select(
            "label", zero.alias("tp"), zero.alias("called"), zero.alias("seen")))
    sums = tally.groupBy("label").agg(*[F.sum(c).alias(c) for c in ("tp", "called", "seen")])

    def ratio(top, bottom):
        return F.coalesce(F.try_divide(top, bottom), F.lit(0.0))

    rated = sums.select(
        "label", "tp",
        (F.col("called") - F.col("tp")).alias("fp"),
        (F.col("seen") - F.col("tp")).alias("fn"),
        ratio(F.col("tp"), F.col("called")).alias("precision"),
        ratio(F.col("tp"), F.col("seen")).alias("recall"),
    )
    p, r = F.col("precision"), F.col("recall")
    return rated.withColumn("f1", ratio(2 * p * r, p + r))


def weighted_metrics(per_class: DataFrame) -> DataFrame:
    """Accuracy, class-weighted F1, precision and recall, and the share of the largest class."""
    support = F.col("tp") + F.col("fn")
    total = F.sum(support)

    def weighted(name):
        return F.coalesce(F.try_divide(F.sum(support * F.col(name)), total), F.lit(0.0))

    return per_class.agg(
        total.alias("n_rows"),
        F.coalesce(F.try_divide(F.sum("tp"), total), F.lit(0.0)).alias("accuracy"),
        weighted("f1").alias("weighted_f1"),
        weighted("precision").alias("weighted_precision"),
        weighted("recall").alias("weighted_recall"),
        F.coalesce(F.try_divide(F.max(support), total), F.lit(0.0)).alias("majority_share"),
    )


def precision_recall_points(per_class: DataFrame) -> DataFrame:
    """One point per class, for plotting."""
    return per_class.select("label", "recall", "precision", "f1", "tp")


def scores_as_array(predictions: DataFrame) -> DataFrame:
    """Class scores as an array ``scores``: probabilities, else raw scores.

    A one-vs-rest model has no probabilities, but its raw scores rank as well.
    """
    source = "probability" if "probability" in predictions.columns else "rawPrediction"
    return predictions.withColumn("scores", vector_to_array(F.col(source)))


def auc_per_class(predictions: DataFrame, label: str = "label", scores: str = "scores",
                  digits: int | None = None) -> DataFrame:
    """Area under the ROC curve of each class against the rest, by rank sums, ties at one half.

    Equal scores are counted together before the shuffle; ``digits`` rounds scores to have fewer
    different ones. Classes with only positive or only negative rows have no area and get NULL.
    """
    exploded = predictions.select(label, F.posexplode(scores).alias("class", "score"))
    if digits is not None:
        exploded = exploded.withColumn("score", F.round("score", digits))
    counts = exploded.groupBy(label, "class", "score").agg(F.count("*").alias("n"))
    return area_per_class(counts, label)


def area_per_class(counts: DataFrame, label: str = "label") -> DataFrame:
    """The same from rows counted (``n``) by label, class and score."""
    hit, n = F.col(label) == F.col("class"), F.col("n")
    zero = F.lit(0).cast("bigint")
    tied = counts.groupBy("class", "score").agg(
        F.sum(F.when(hit, n).otherwise(zero)).alias("pos"), F.sum(F.when(hit, zero).otherwise(n)).alias("neg"))
    ranked = running_totals(tied, ["class"], ["score"], ["neg"])
    # Products of counts outgrow 64 bits on large tables.
    pos, neg = F.col("pos").cast("double"), F.col("neg").cast("double")
    wins = F.sum(pos * (F.col("before_neg").cast("double") + neg / 2))
    return ranked.groupBy("class").agg(
        F.sum("pos").alias("positives"), F.sum("neg").alias("negatives"),
        F.try_divide(wins, F.sum(pos) * F.sum(neg)).alias("auc"))


def macro_auc(per_class: DataFrame) -> DataFrame:
    """Mean over the classes that have an area."""
    return per_class.agg(F.avg("auc").alias("auc_ovr_macro"), F.count("auc").alias("classes"))


def match_rate(predictions: DataFrame, actual: str = "actual_label",
               predicted: str = "predicted_label") -> DataFrame:
    """Share of rows on which two columns agree, over the whole table."""
    agree = F.col(actual).eqNullSafe(F.col(predicted))
    return predictions.agg(F.avg(agree.cast("int")).alias("match_rate"))
