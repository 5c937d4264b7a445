"""Aggregate tables by type, region and hour; top lists."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.operators import aggregates, toplists
from millrace.session import materialize
from workload import Query
from workload.bindings import INCIDENTS, incidents, table

SIX = 6


def rounded(df, *names):
    return df.withColumns({name: F.round(name, SIX) for name in names})


def type_stats(spark, sf):
    return rounded(aggregates.type_stats(incidents(spark, sf)), "arrest_rate", "domestic_rate")


TYPE_STATS = f"""WITH {INCIDENTS}
SELECT *, round(arrest_count / crime_count, 6) AS arrest_rate,
       round(domestic_count / crime_count, 6) AS domestic_rate,
       CASE WHEN crime_count >= 100000 THEN 'very_high' WHEN crime_count >= 10000 THEN 'high'
            WHEN crime_count >= 1000 THEN 'medium' ELSE 'low' END AS frequency_bucket
FROM (SELECT primary_type, COUNT(*) AS crime_count,
             COUNT(*) FILTER (WHERE arrest) AS arrest_count,
             COUNT(*) FILTER (WHERE domestic) AS domestic_count,
             MIN(event_time) AS first_seen, MAX(event_time) AS last_seen
      FROM incidents GROUP BY primary_type)"""


def region_stats(spark, sf):
    stats = aggregates.region_stats(incidents(spark, sf))
    return rounded(stats, "avg_latitude", "avg_longitude", "arrest_rate")


_TOP_TYPE = """top AS (
SELECT district, primary_type AS top_primary_type, n AS top_primary_type_count
FROM (SELECT district, primary_type, COUNT(*) AS n,
             ROW_NUMBER() OVER (PARTITION BY district ORDER BY COUNT(*) DESC, primary_type) AS rk
      FROM incidents WHERE district IS NOT NULL GROUP BY district, primary_type)
WHERE rk = 1)"""

REGION_STATS = f"""WITH {INCIDENTS}, base AS (
SELECT district, COUNT(*) AS crime_count, COUNT(*) FILTER (WHERE arrest) AS arrest_count,
       AVG(latitude) AS lat, AVG(longitude) AS lon, COUNT(DISTINCT primary_type) AS unique_types
FROM incidents WHERE district IS NOT NULL GROUP BY district), {_TOP_TYPE}
SELECT base.district, crime_count, arrest_count, round(lat, 6) AS avg_latitude,
       round(lon, 6) AS avg_longitude, unique_types,
       round(arrest_count / crime_count, 6) AS arrest_rate,
       top_primary_type, top_primary_type_count,
       CASE WHEN crime_count >= 200000 THEN 'large' WHEN crime_count >= 50000 THEN 'medium'
            ELSE 'small' END AS size_bucket
FROM base LEFT JOIN top ON base.district = top.district"""


def top_type_per_region(spark, sf):
    return aggregates.top_type_per_region(incidents(spark, sf))


TOP_TYPE_PER_REGION = f"WITH {INCIDENTS}, {_TOP_TYPE} SELECT * FROM top"


def region_with_winner(spark, sf):
    """Orders per customer nation, with the segment that places most of them."""
    customer = table(spark, sf, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    # Added up per customer first: a customer with very many orders joins as one row.
    per_customer = table(spark, sf, "orders").groupBy("o_custkey").agg(F.count("*").alias("n"))
    cells = (
        per_customer.join(customer, F.col("o_custkey") == F.col("c_custkey"))
        .groupBy("c_nationkey", "c_mktsegment").agg(F.sum("n").alias("n"))
    )
    base = aggregates.roll_up(cells, "c_nationkey", "n")
    standing = F.struct(-F.col("n"), F.col("c_mktsegment"))
    winner = cells.groupBy("c_nationkey").agg(
        F.min_by("c_mktsegment", standing).alias("top_segment"), F.max("n").alias("top_orders"))
    return aggregates.with_winner(base, winner, "c_nationkey")


REGION_WITH_WINNER = """WITH cells AS (
SELECT c_nationkey, c_mktsegment, COUNT(*) AS n FROM orders JOIN customer ON o_custkey = c_custkey
GROUP BY c_nationkey, c_mktsegment), ranked AS (
SELECT *, ROW_NUMBER() OVER (PARTITION BY c_nationkey ORDER BY n DESC, c_mktsegment) AS rk FROM cells)
SELECT base.c_nationkey, base.n, c_mktsegment AS top_segment, ranked.n AS top_orders
FROM (SELECT c_nationkey, CAST(SUM(n) AS BIGINT) AS n FROM cells GROUP BY c_nationkey) AS base
LEFT JOIN ranked ON base.c_nationkey = ranked.c_nationkey AND rk = 1"""


def hourly_stats(spark, sf):
    return aggregates.hourly_stats(incidents(spark, sf))


_HOURLY = """SELECT hour_of_day, primary_type, COUNT(*) AS crime_count
FROM incidents WHERE hour_of_day IS NOT NULL GROUP BY hour_of_day, primary_type"""


def hourly_total(spark, sf):
    return aggregates.roll_up(hourly_stats(spark, sf), "hour_of_day")


def top_types(spark, sf):
    return toplists.top_counts(incidents(spark, sf), "primary_type", 15)


def largest_types(spark, sf):
    return toplists.largest(type_stats(spark, sf), "crime_count", 20, ["primary_type"])


def heatmap_top10(spark, sf):
    """From the stored hourly table, which both the totals and the grid read."""
    return toplists.top_by_hour(materialize(hourly_stats(spark, sf), "hourly-stats"), 10)


_HOURS = ", ".join(
    f"COUNT(*) FILTER (WHERE hour_of_day = {hour}) AS hour_{hour}" for hour in range(24))
HEATMAP = f"""WITH {INCIDENTS}, top AS (
SELECT primary_type FROM incidents GROUP BY primary_type ORDER BY COUNT(*) DESC, primary_type LIMIT 10)
SELECT primary_type, COUNT(*) AS crime_count, {_HOURS}
FROM incidents WHERE primary_type IN (SELECT primary_type FROM top) GROUP BY primary_type"""

QUERIES = {
    "type_stats": Query(type_stats, TYPE_STATS),
    "region_stats": Query(region_stats, REGION_STATS),
    "top_type_per_region": Query(top_type_per_region, TOP_TYPE_PER_REGION),
    "region_with_winner": Query(region_with_winner, REGION_WITH_WINNER),
    "hourly_stats": Query(hourly_stats, f"WITH {INCIDENTS} {_HOURLY}"),
    "hourly_total": Query(hourly_total, f"""WITH {INCIDENTS}
SELECT hour_of_day, COUNT(*) AS crime_count FROM incidents GROUP BY hour_of_day"""),
    "top_types": Query(top_types, f"""WITH {INCIDENTS}
SELECT primary_type, COUNT(*) AS crime_count FROM incidents GROUP BY primary_type
ORDER BY crime_count DESC, primary_type LIMIT 15"""),
    "largest_types": Query(largest_types, f"""SELECT * FROM ({TYPE_STATS})
ORDER BY crime_count DESC, primary_type LIMIT 20"""),
    "heatmap_top10": Query(heatmap_top10, HEATMAP),
}
