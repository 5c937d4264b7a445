"""Wide and long forms."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F


def crosstab(df: DataFrame, rows: str, columns: str, values: Sequence, measure: str,
             prefix: str = "", rest: str | None = None) -> DataFrame:
    """Sum of ``measure`` per row value (down) and column value (across), empty cells 0.

    The column values are given, so no extra job looks for them and the schema is fixed. What has
    another column value, or none, is summed under ``rest``; without that name it is an error. A
    missing row value stays a row of its own.
    """
    def cell(condition):
        return F.coalesce(F.sum(F.when(condition, F.col(measure))), F.lit(0).cast("bigint"))

    cells = [cell(F.col(columns) == value).alias(f"{prefix}{value}") for value in values]
    listed = F.coalesce(F.col(columns).isin(list(values)), F.lit(False))
    if rest is not None:
        return df.groupBy(rows).agg(*cells, cell(~listed).alias(rest))
    known = F.when(listed, F.col(columns)).otherwise(
        F.raise_error(F.concat(F.lit(f"unlisted {columns}: "), F.coalesce(F.col(columns).cast("string"), F.lit("NULL")))))
    return df.withColumn(columns, known).groupBy(rows).agg(*cells)


def melt(df: DataFrame, ids: Sequence[str], measures: Sequence[str],
         name: str = "metric", value: str = "value") -> DataFrame:
    """One row per id and measure."""
    return df.unpivot(list(ids), list(measures), name, value)
