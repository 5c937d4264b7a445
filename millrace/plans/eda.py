"""The summary document of a clean table."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from millrace.operators.profile import (
    describe_numeric, null_profile, overview,
)
from millrace.operators.toplists import largest
from millrace.session import materialize
from millrace.spec import INCIDENTS, EventSpec

TOP_TYPES = 15
# Columns described, and columns whose values are counted.
DESCRIBED = ("latitude", "longitude", "year")
COUNTED = ("primary_type", "district", "ward", "community_area", "event_year")

# The published part of the overview, as (metric, value).
OVERVIEW_METRICS = (
    "total_rows", "unique_primary_type", "unique_district", "arrest_rate", "domestic_rate",
)
# Fixed value: shape of the summary document.
DOCUMENT_SCHEMA = (
    "total_rows BIGINT, unique_primary_type BIGINT, unique_district BIGINT, unique_ward BIGINT, "
    "unique_community_area BIGINT, unique_year BIGINT, arrest_rate DOUBLE, domestic_rate DOUBLE, "
    "null_counts MAP<STRING, BIGINT>, "
    "top_primary_types ARRAY<STRUCT<primary_type: STRING, count: BIGINT>>, "
    "yearly_trend ARRAY<STRUCT<year: INT, crime_count: BIGINT, arrest_rate: DOUBLE>>, "
    "hourly_trend ARRAY<STRUCT<hour: INT, crime_count: BIGINT>>, "
    "weekly_trend ARRAY<STRUCT<day_of_week: INT, crime_count: BIGINT>>, "
    "numeric_describe MAP<STRING, MAP<STRING, DOUBLE>>"
)


def _section(name: str, df: DataFrame, position: Column, label: Column,
             amount: Column, value: Column) -> DataFrame:
    return df.select(
        F.lit(name).alias("section"), position.cast("bigint").alias("position"),
        label.cast("string").alias("label"), amount.cast("bigint").alias("amount"),
        value.cast("double").alias("value"))


def summary_sections(df: DataFrame, spec: EventSpec = INCIDENTS) -> DataFrame:
    """All sections of the summary as one narrow table.

    Three passes over the events: the calendar cells, the distinct counts, the per-column scalars.
    The cells (type, year, hour, weekday) are written once and rolled up for the top list and the
    three trends.
    """
    none = F.lit(None)
    c = F.col
    cells = materialize(
        df.groupBy(spec.type, "event_year", "hour_of_day", "day_of_week").agg(
            F.count("*").alias("n"),
            F.count_if(c(spec.main_flag)).alias("hits"),
            F.count(spec.main_flag).alias("known"),
        ), "calendar-cells")

    def rolled(key: str) -> DataFrame:
        return cells.groupBy(key).agg(
            F.sum("n").alias("n"), F.try_divide(F.sum("hits"), F.sum("known")).alias("rate"))

    top = largest(rolled(spec.type), "n", TOP_TYPES, [spec.type])
    described = describe_numeric(df, DESCRIBED).unpivot(
        ["summary"], list(DESCRIBED), "column", "number")
    parts = [
        _section("overview", overview(df, spec, COUNTED), none, c("metric"), none, c("value")),
        _section("null_counts", null_profile(df), none, c("column_name"), c("null_count"), none),
        _section("top_primary_types", top, -c("n"), c(spec.type), c("n"), none),
        _section("yearly_trend", rolled("event_year"), c("event_year"), c("event_year"), c("n"), c("rate")),
        _section("hourly_trend", rolled("hour_of_day"), c("hour_of_day"), c("hour_of_day"), c("n"), none),
        _section("weekly_trend", rolled("day_of_week"), c("day_of_week"), c("day_of_week"), c("n"), none),
        _section("numeric_describe", described, none, F.concat_ws(":", "summary", "column"),
                 none, c("number")),
    ]
    return reduce(DataFrame.unionByName, parts)


def summary_document(sections: DataFrame) -> DataFrame:
    """The sections as one nested row.

    Bounded: years, 24 hours, 7 days, the top list, and a few entries per column of the table.
    """
    def entries(name: str) -> Column:
        entry = F.struct("position", "label", "amount", "value")
        return F.sort_array(F.collect_list(F.when(F.col("section") == name, entry)))

    def as_map(name: str, value: str) -> Column:
        return F.map_from_entries(F.transform(
            F.col(name), lambda e: F.struct(e["label"], e[value])))

    gathered = sections.agg(*[entries(name).alias(name) for name in (
        "overview", "null_counts", "top_primary_types", "yearly_trend", "hourly_trend",
        "weekly_trend", "numeric_describe")])

    def trend(name: str, key: str, rate: bool = False) -> Column:
        return F.transform(F.col(name), lambda e: F.struct(
            e["label"].cast("int").alias(key), e["amount"].alias("crime_count"),
            *([e["value"].alias("arrest_rate")] if rate else [])))

    # label is "statistic:column"
    statistics = F.array_distinct(F.transform(
        F.col("numeric_describe"), lambda e: F.substring_index(e["label"], ":", 1)))
    described = F.map_from_entries(F.transform(statistics, lambda s: F.struct(
        s, F.map_from_entries(F.transform(
            F.filter(F.col("numeric_describe"),
                     lambda e: F.substring_index(e["label"], ":", 1) == s),
            lambda e: F.struct(F.substring_index(e["label"], ":", -1), e["value"]))))))
    metrics = as_map("overview", "value")

    def metric(name: str, kind: str) -> Column:
        return F.element_at(metrics, name).cast(kind)

    return gathered.select(
        metric("total_rows", "bigint").alias("total_rows"),
        *[metric(f"unique_{name}", "bigint").alias(f"unique_{name.removeprefix('event_')}")
          for name in COUNTED],
        *[metric(name, "double").alias(name) for name in ("arrest_rate", "domestic_rate")],
        as_map("null_counts", "amount").alias("null_counts"),
        F.transform(F.col("top_primary_types"), lambda e: F.struct(
            e["label"].alias("primary_type"), e["amount"].alias("count"))).alias("top_primary_types"),
        trend("yearly_trend", "year", rate=True).alias("yearly_trend"),
        trend("hourly_trend", "hour").alias("hourly_trend"),
        trend("weekly_trend", "day_of_week").alias("weekly_trend"),
        described.alias("numeric_describe"),
    )
