"""Profiles: overview, gaps, distributions, trends, the summary document."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import functions as F

from millrace.operators import profile
from millrace.plans.eda import (
    COUNTED, DOCUMENT_SCHEMA, summary_document, summary_sections,
)
from millrace.session import scratch_path
from millrace.sources.documents import read_document, write_document
from millrace.spec import INCIDENTS as SPEC
from workload import Query
from workload.aggregate import rounded
from workload.bindings import INCIDENTS, incidents, table


def eda_overview(spark, sf):
    return rounded(profile.overview(incidents(spark, sf), distinct=COUNTED), "value")


def _distinct_sql(name: str) -> str:
    return (f"CAST(COUNT(DISTINCT {name}) + MAX(CASE WHEN {name} IS NULL THEN 1 ELSE 0 END) "
            f"AS DOUBLE) AS unique_{name}")


_OVERVIEW = f"""SELECT CAST(COUNT(*) AS DOUBLE) AS total_rows,
       {', '.join(map(_distinct_sql, COUNTED))},
       COUNT(*) FILTER (WHERE arrest) / COUNT(*) AS arrest_rate,
       COUNT(*) FILTER (WHERE domestic) / COUNT(*) AS domestic_rate
FROM incidents"""


def null_profile(spark, sf):
    return profile.null_profile(incidents(spark, sf))


def _nulls_sql(source: str) -> str:
    from millrace.spec import SILVER_COLUMNS
    counts = " UNION ALL ".join(
        f"SELECT '{name}' AS column_name, COUNT(*) - COUNT({name}) AS null_count FROM {source}"
        for name in SILVER_COLUMNS)
    return f"SELECT * FROM ({counts}) WHERE null_count > 0"


NUMBERS = ("latitude", "longitude", "year")


def describe_numeric(spark, sf):
    return rounded(profile.describe_numeric(incidents(spark, sf), NUMBERS), *NUMBERS)


def _describe_sql(source: str) -> str:
    def row(title, function):
        cells = ", ".join(
            f"round(CAST({function}({name}) AS DOUBLE), 6) AS {name}" for name in NUMBERS)
        return f"SELECT '{title}' AS summary, {cells} FROM {source}"
    return " UNION ALL ".join([row("count", "COUNT"), row("mean", "AVG"),
                               row("stddev", "STDDEV_SAMP"), row("min", "MIN"), row("max", "MAX")])


ORDER_SPEC = replace(SPEC, flags=("finished",), count="order_count")


def _orders(spark, sf):
    return table(spark, sf, "orders").select(
        F.year("o_orderdate").alias("event_year"),
        F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus") == "F").alias("finished"))


def yearly_trend(spark, sf):
    return rounded(profile.yearly_trend(_orders(spark, sf), ORDER_SPEC), "finished_rate")


_YEARLY = """SELECT CAST(year(o_orderdate) AS INTEGER) AS event_year, COUNT(*) AS order_count,
       round(AVG(CASE o_orderstatus WHEN 'F' THEN 1.0::DOUBLE WHEN 'P' THEN NULL ELSE 0.0::DOUBLE END), 6)
       AS finished_rate
FROM orders GROUP BY 1"""


def hourly_trend(spark, sf):
    return profile.hourly_trend(incidents(spark, sf))


def weekly_trend(spark, sf):
    return profile.weekly_trend(incidents(spark, sf))


_DAYS = "['Sunday', 'Monday', 'Tuesday', 'Wednesday', 'Thursday', 'Friday', 'Saturday']"


def year_range(spark, sf):
    return profile.year_range(profile.yearly_trend(_orders(spark, sf), ORDER_SPEC))


def flag_share(spark, sf):
    return rounded(profile.flag_share(incidents(spark, sf), "arrest"), "share")


def eda_json_roundtrip(spark, sf):
    """The nested summary written as JSON, read back and laid out as rows again."""
    path = scratch_path(spark, "summary")
    write_document(summary_document(summary_sections(incidents(spark, sf))), path)
    document = read_document(spark, path, DOCUMENT_SCHEMA)

    def entries(section, label, amount, value):
        return F.transform(F.col(section), lambda e: F.struct(
            F.lit(section).alias("section"), label(e).cast("string").alias("label"),
            amount(e).cast("bigint").alias("amount"), value(e).cast("double").alias("value")))

    def of(name):
        return lambda e: e[name]

    def nothing(e):
        return F.lit(None)

    def pairs(section, amount, value):
        return F.transform(F.map_entries(section), lambda e: F.struct(
            F.lit(section).alias("section"), e["key"].alias("label"),
            amount(e).cast("bigint").alias("amount"), value(e).cast("double").alias("value")))

    described = F.flatten(F.transform(F.map_entries("numeric_describe"), lambda s: F.transform(
        F.map_entries(s["value"]), lambda e: F.struct(
            F.lit("numeric_describe").alias("section"),
            F.concat_ws(":", s["key"], e["key"]).alias("label"),
            F.lit(None).cast("bigint").alias("amount"), e["value"].alias("value")))))
    rows = document.select(F.inline(F.concat(
        F.array(*[F.struct(F.lit("overview").alias("section"), F.lit(name).alias("label"),
                           F.lit(None).cast("bigint").alias("amount"),
                           F.col(name).cast("double").alias("value"))
                  for name in document.columns[:document.columns.index("null_counts")]]),
        pairs("null_counts", of("value"), nothing),
        entries("top_primary_types", of("primary_type"), of("count"), nothing),
        entries("yearly_trend", of("year"), of("crime_count"), of("arrest_rate")),
        entries("hourly_trend", of("hour"), of("crime_count"), nothing),
        entries("weekly_trend", of("day_of_week"), of("crime_count"), nothing),
        described,
    )))
    return rounded(rows, "value")


def _trend_sql(section: str, key: str, rate: str = "CAST(NULL AS DOUBLE)") -> str:
    return (f"SELECT '{section}' AS section, CAST({key} AS VARCHAR) AS label, COUNT(*) AS amount, "
            f"{rate} AS value FROM incidents GROUP BY {key}")


EDA_JSON = f"""WITH {INCIDENTS}
SELECT 'overview' AS section, replace(metric, 'event_', '') AS label, CAST(NULL AS BIGINT) AS amount, round(value, 6) AS value
FROM (UNPIVOT ({_OVERVIEW}) ON COLUMNS(*) INTO NAME metric VALUE value)
UNION ALL SELECT 'null_counts', column_name, null_count, NULL FROM ({_nulls_sql('incidents')})
UNION ALL SELECT * FROM ({_trend_sql('top_primary_types', 'primary_type')} ORDER BY amount DESC, label LIMIT 15)
UNION ALL {_trend_sql('yearly_trend', 'event_year', 'round(AVG(CAST(arrest AS INTEGER)), 6)')}
UNION ALL {_trend_sql('hourly_trend', 'hour_of_day')}
UNION ALL {_trend_sql('weekly_trend', 'day_of_week')}
UNION ALL SELECT 'numeric_describe', summary || ':' || name, NULL, value
FROM (UNPIVOT ({_describe_sql('incidents')}) ON latitude, longitude, year INTO NAME name VALUE value)"""

QUERIES = {
    "eda_overview": Query(eda_overview, f"""WITH {INCIDENTS}
SELECT metric, round(value, 6) AS value
FROM (UNPIVOT ({_OVERVIEW}) ON COLUMNS(*) INTO NAME metric VALUE value)"""),
    "null_profile": Query(null_profile, f"WITH {INCIDENTS} {_nulls_sql('incidents')}"),
    "describe_numeric": Query(describe_numeric, f"WITH {INCIDENTS} {_describe_sql('incidents')}"),
    "yearly_trend": Query(yearly_trend, _YEARLY),
    "hourly_trend": Query(hourly_trend, f"""WITH {INCIDENTS}
SELECT hour_of_day, COUNT(*) AS crime_count FROM incidents GROUP BY hour_of_day"""),
    "weekly_trend": Query(weekly_trend, f"""WITH {INCIDENTS}
SELECT day_of_week, COUNT(*) AS crime_count, ({_DAYS})[day_of_week] AS day_name
FROM incidents GROUP BY day_of_week"""),
    "year_range": Query(year_range, """
SELECT CAST(MIN(year(o_orderdate)) AS INTEGER) AS first_year,
       CAST(MAX(year(o_orderdate)) AS INTEGER) AS last_year FROM orders"""),
    "flag_share": Query(flag_share, f"""WITH {INCIDENTS}
SELECT arrest, n AS crime_count, round(n / total, 6) AS share
FROM (SELECT arrest, COUNT(*) AS n, SUM(COUNT(*)) OVER () AS total FROM incidents GROUP BY arrest)"""),
    "eda_json_roundtrip": Query(eda_json_roundtrip, EDA_JSON),
}
