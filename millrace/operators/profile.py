"""Profiles of an event table: overview, gaps, distributions, trends."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from millrace.functions.calendar import DAY_NAMES, day_name
from millrace.spec import INCIDENTS, EventSpec


def distinct_with_null(name: str) -> Column:
    """Distinct values of a column with NULL as one of them, as ``distinct().count()`` has it."""
    return F.count_distinct(F.col(name)) + F.coalesce(
        F.max(F.col(name).isNull().cast("int")), F.lit(0))


def share_of_true(flag: str) -> Column:
    """True rows over all rows; NULL is not true, and an empty table has share 0."""
    return F.coalesce(F.try_divide(F.count_if(F.col(flag)), F.count("*")), F.lit(0.0))


def as_metrics(one_row: DataFrame) -> DataFrame:
    """A row of scalars as a long (metric, value) table."""
    numbers = one_row.select([F.col(name).cast("double").alias(name) for name in one_row.columns])
    return numbers.unpivot([], numbers.columns, "metric", "value")


def overview(df: DataFrame, spec: EventSpec = INCIDENTS,
             distinct: Sequence[str] = ()) -> DataFrame:
    """Row count, distinct counts and flag rates in one pass, as (metric, value)."""
    names = list(distinct) or [spec.type, spec.region]
    scalars = df.agg(
        F.count("*").alias("total_rows"),
        *[distinct_with_null(name).alias(f"unique_{name}") for name in names],
        *[share_of_true(flag).alias(f"{flag}_rate") for flag in spec.flags],
    )
    return as_metrics(scalars)


def null_profile(df: DataFrame) -> DataFrame:
    """Missing values per column, columns without any left out; one pass for all columns."""
    gaps = df.agg(*[F.count_if(F.col(name).isNull()).alias(name) for name in df.columns])
    return gaps.unpivot([], gaps.columns, "column_name", "null_count").where("null_count > 0")


def describe_numeric(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Count, mean, sample deviation, minimum and maximum: one row per statistic."""
    statistics = {
        "count": F.count, "mean": F.avg, "stddev": F.stddev_samp, "min": F.min, "max": F.max,
    }
    rows = [
        F.struct(F.lit(title).alias("summary"),
                 *[measure(name).cast("double").alias(name) for name in columns])
        for title, measure in statistics.items()
    ]
    return df.agg(F.array(*rows).alias("_rows")).select(F.inline("_rows"))


def yearly_trend(df: DataFrame, spec: EventSpec = INCIDENTS, year: str = "event_year") -> DataFrame:
    """Events per year and the share of true flags among rows that have one."""
    return df.groupBy(year).agg(
        F.count("*").alias(spec.count),
        F.avg(F.col(spec.main_flag).cast("int")).alias(f"{spec.main_flag}_rate"),
    ).orderBy(year)


def hourly_trend(df: DataFrame, spec: EventSpec = INCIDENTS) -> DataFrame:
    return df.groupBy("hour_of_day").agg(F.count("*").alias(spec.count)).orderBy("hour_of_day")


def weekly_trend(df: DataFrame, spec: EventSpec = INCIDENTS,
                 names: tuple[str, ...] = DAY_NAMES) -> DataFrame:
    """Events per day of week, Sunday first, with the day's name."""
    counts = df.groupBy("day_of_week").agg(F.count("*").alias(spec.count))
    return counts.withColumn("day_name", day_name(F.col("day_of_week"), names)).orderBy("day_of_week")


def year_range(trend: DataFrame, year: str = "event_year") -> DataFrame:
    return trend.agg(F.min(year).alias("first_year"), F.max(year).alias("last_year"))


def flag_share(df: DataFrame, flag: str, count: str = INCIDENTS.count) -> DataFrame:
    """Share of rows that are true, and of those that are not (false or NULL)."""
    shares = df.agg(share_of_true(flag).alias("share"), F.count("*").alias("total"),
                    F.count_if(F.col(flag)).alias("hits"))
    sides = F.inline(F.array(
        F.struct(F.lit(True).alias(flag), F.col("hits").alias(count), F.col("share")),
        F.struct(F.lit(False).alias(flag), (F.col("total") - F.col("hits")).alias(count),
                 (1 - F.col("share")).alias("share")),
    ))
    return shares.select(sides)
