"""Feature columns and labels."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from millrace.functions.calendar import is_night, is_weekend
from millrace.operators.ranking import running_totals
from millrace.operators.toplists import top_counts
from millrace.session import broadcast_if_small
from millrace.spec import FEATURE_VIEW_COLUMNS, INCIDENTS, MODEL_FEATURES, EventSpec

# The label of everything outside the top list, and of an unknown class number.
OTHER = "OTHER"
UNKNOWN = "UNKNOWN"


def flags_as_int(df: DataFrame, spec: EventSpec = INCIDENTS) -> DataFrame:
    return df.withColumns({f"{flag}_int": F.col(flag).cast("int") for flag in spec.flags})


def feature_view(df: DataFrame, spec: EventSpec = INCIDENTS,
                 columns: Sequence[str] = FEATURE_VIEW_COLUMNS) -> DataFrame:
    """Typed rows with numeric flags and the weekend and night marks."""
    typed = flags_as_int(df.where(F.col(spec.type).isNotNull()), spec)
    return typed.withColumns({
        "is_weekend": is_weekend(F.col("day_of_week")),
        "is_night": is_night(F.col("hour_of_day")),
    }).select(*columns)


def fill_zero(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """NULL and NaN become 0 in the numeric columns among ``columns``; other types stay."""
    return df.na.fill(0, list(columns))


def model_input(df: DataFrame, spec: EventSpec = INCIDENTS,
                features: Sequence[str] = MODEL_FEATURES) -> DataFrame:
    """Rows with a type, numeric flags, and no gaps in the features."""
    return fill_zero(flags_as_int(df.where(F.col(spec.type).isNotNull()), spec), features)


def top_labels(df: DataFrame, spec: EventSpec = INCIDENTS, n: int = 5) -> DataFrame:
    """The ``n`` most frequent types: at most ``n`` rows."""
    return top_counts(df, spec.type, n).select(spec.type)


def with_label(df: DataFrame, top: DataFrame, spec: EventSpec = INCIDENTS,
               output: str = "label_raw") -> DataFrame:
    """The type where it is in the top list, else OTHER."""
    listed = top.select(spec.type, F.lit(True).alias("_listed"))
    joined = df.join(broadcast_if_small(listed), spec.type, "left")
    label = F.when(F.col("_listed"), F.col(spec.type)).otherwise(F.lit(OTHER))
    return joined.withColumn(output, label).drop("_listed")


def label_index(labelled: DataFrame, label: str = "label_raw",
                weight: str | None = None) -> DataFrame:
    """Number, label and count of each class, most frequent first, then by name.

    ``weight`` counts for that many rows, where the input is counted already. Places come from
    running totals over the counted labels, so any number of them is numbered without one task
    seeing all.
    """
    size = F.sum(weight) if weight else F.count("*")
    counts = labelled.groupBy(label).agg(size.alias("label_count"))
    ordered = counts.select(
        F.col(label).alias("label"), "label_count", (-F.col("label_count")).alias("_falling"),
        F.lit(1).cast("bigint").alias("_one"))
    placed = running_totals(ordered, [], ["_falling", "label"], ["_one"])
    return placed.select(F.col("before__one").cast("int").alias("idx"), "label", "label_count")


def decode_labels(df: DataFrame, labels: DataFrame, prediction: str = "prediction",
                  output: str = "predicted_label") -> DataFrame:
    """Class numbers back to names; numbers without a name become UNKNOWN.

    ``labels`` is a stored class list as ``label_index`` makes it, one row per class.
    """
    names = labels.select(F.col("idx").cast("double").alias("_idx"), F.col("label").alias("_name"))
    joined = df.join(broadcast_if_small(names), F.col(prediction).cast("double") == F.col("_idx"), "left")
    return joined.withColumn(output, F.coalesce("_name", F.lit(UNKNOWN))).drop("_idx", "_name")
