"""Top lists: the limit is the feature, each with a total order."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from millrace.operators.reshape import crosstab
from millrace.session import broadcast_if_small
from millrace.spec import INCIDENTS, EventSpec


def top_counts(df: DataFrame, column: str, k: int, count: str = INCIDENTS.count) -> DataFrame:
    """The ``k`` most frequent values; equal counts in value order."""
    counts = df.groupBy(column).agg(F.count("*").alias(count))
    return largest(counts, count, k, [column])


def largest(df: DataFrame, measure: str, k: int, tie_break: list[str]) -> DataFrame:
    """The ``k`` rows with the largest ``measure``."""
    return df.orderBy(F.desc_nulls_last(measure), *map(F.asc, tie_break)).limit(k)


def only_top(df: DataFrame, top: DataFrame, key: str) -> DataFrame:
    """Rows whose key is in a top list, which travels to the rows if it is small."""
    return df.join(broadcast_if_small(top.select(key)), key, "left_semi")


def top_by_hour(hourly: DataFrame, k: int = 10, spec: EventSpec = INCIDENTS) -> DataFrame:
    """The ``k`` largest types of an hourly table, one column per hour, largest type first.

    Events without an hour have no column; they count towards no total here.
    """
    hourly = hourly.where(F.col("hour_of_day").isNotNull())
    totals = hourly.groupBy(spec.type).agg(F.sum(spec.count).alias(spec.count))
    chosen = only_top(hourly, largest(totals, spec.count, k, [spec.type]), spec.type)
    grid = crosstab(chosen, spec.type, "hour_of_day", range(24), spec.count, prefix="hour_")
    total = sum((F.col(f"hour_{hour}") for hour in range(1, 24)), F.col("hour_0"))
    return grid.withColumn(spec.count, total).orderBy(F.desc(spec.count), spec.type)
