"""From decoded messages to the clean table; the same function serves batch and stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from millrace.functions.calendar import calendar_parts
from millrace.spec import INCIDENTS, SILVER_COLUMNS, EventSpec


def complete_rows(df: DataFrame, spec: EventSpec = INCIDENTS) -> DataFrame:
    """Rows whose required columns are all present. NaN is a value here, not a gap."""
    for name in spec.required:
        df = df.where(F.col(name).isNotNull())
    return df


def newest_per_key(df: DataFrame, key: str | list[str], recency: list[str]) -> DataFrame:
    """One row per key: the latest by ``recency``, the remaining columns break ties.

    ``rank = 1`` lets Spark keep one row per key and task before the shuffle, so a key with a
    third of all rows reaches its reducer as one row per task.
    """
    keys = [key] if isinstance(key, str) else list(key)
    rest = [name for name in df.columns if name not in keys and name not in recency]
    order = [F.col(name).desc_nulls_last() for name in [*recency, *rest]]
    ranked = df.withColumn("_rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.where("_rank = 1").drop("_rank")


def clean_events(events: DataFrame, spec: EventSpec = INCIDENTS,
                 columns: tuple[str, ...] = SILVER_COLUMNS) -> DataFrame:
    """Complete, one row per key, with calendar parts, in the fixed column order.

    Columns that ``events`` does not have, because nothing has sent them yet, are left out.
    """
    recency = [name for name in spec.recency if name in events.columns]
    unique = newest_per_key(complete_rows(events, spec), spec.key, recency)
    timed = unique.withColumns(calendar_parts(F.col(spec.time)))
    return timed.select(*[name for name in columns if name in timed.columns])
