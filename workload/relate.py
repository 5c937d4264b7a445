"""Joins by time, totals over several groupings, sketches, differences of tables, and fields outside the schema."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.functions.calendar import wall_instant
from millrace.functions.variants import field, parsed, undeclared
from millrace.operators import sketches
from millrace.operators.timejoins import asof_join, interval_join
from millrace.operators.totals import grouped_totals, rollup_sets, table_difference
from millrace.session import materialize
from workload import Query
from workload.bindings import RAW_EVENTS, raw_events, table


def _known_users(spark, sf):
    return table(spark, sf, "events").withColumn("user_id", F.when(F.col("event_id") % 41 != 0, F.col("user_id")))


def asof_last_purchase(spark, sf):
    """Every other event with its user's last purchase before it."""
    events = _known_users(spark, sf)
    purchase = F.col("event_type") == "purchase"
    return asof_join(events.where(~purchase).select("event_id", "user_id", "event_type", "ts"),
                     events.where(purchase).select("event_id", "user_id", "ts", "value"), ["user_id"], "ts").drop("last_user_id")


MINUTE = 60_000_000
# Minutes an error or a purchase lasts, by its number; every so many lasts for weeks.
MOST_MINUTES, RARE, WEEKS = 300, 97, 30_000


def interval_overlaps(spark, sf):
    """Errors and purchases of one user whose spans overlap: an error lasts from its time on, a purchase up to its time."""
    events = _known_users(spark, sf)
    at = F.unix_micros(wall_instant(F.col("ts")))
    i = F.col("event_id")
    lasts = F.when(i % RARE == 0, WEEKS).otherwise(i % MOST_MINUTES) * MINUTE

    def of(kind):
        return events.where(F.col("event_type") == kind).select("event_id", "user_id", at.alias("at"), lasts.alias("lasts"))

    return interval_join(of("error"), of("purchase"), (F.col("at"), F.col("at") + F.col("lasts")),
                         (F.col("at") - F.col("lasts"), F.col("at")), ["user_id"]).select("event_id", "user_id", "other_event_id")


def _measures():
    return {"events": (F.count("*"), F.sum), "arrests": (F.count_if("arrest"), F.sum), "first_seen": (F.min("event_time"), F.min),
            "highest": (F.max("latitude"), F.max)}


DIMS = ("district", "primary_type", "hour_of_day")


def cube_stats(spark, sf):
    rows = raw_events(spark, sf).withColumn("hour_of_day", F.hour("event_time"))
    return grouped_totals(rows, DIMS, _measures())


def rollup_stats(spark, sf):
    rows = raw_events(spark, sf).withColumn("hour_of_day", F.hour("event_time"))
    return grouped_totals(rows, DIMS, _measures(), rollup_sets(DIMS))


def _totals_sql(kind: str) -> str:
    over = ", ".join(f"CASE WHEN GROUPING({name}) = 1 THEN '{name}' END" for name in DIMS)
    return f"""WITH {RAW_EVENTS}
SELECT district, primary_type, hour_of_day, concat_ws(',', {over}) AS total_over, count(*) AS events,
       count(*) FILTER (arrest) AS arrests, min(event_time) AS first_seen, max(latitude) AS highest
FROM (SELECT *, CAST(hour(event_time) AS INTEGER) AS hour_of_day FROM raw_events) GROUP BY {kind} ({', '.join(DIMS)})"""


WEEK = 7


def sketch_weeks(spark, sf):
    """Every seven days' distinct users and events and median value out of daily sketches, held against exact values."""
    events = table(spark, sf, "events").withColumn("day", F.to_date("ts"))
    daily = materialize(sketches.daily_sketches(events, F.col("day"), ["user_id", "event_id"], ["value"]), "daily-sketches")
    week = F.floor(F.datediff("day", F.lit("2024-01-01").cast("date")) / WEEK).alias("week")
    about = sketches.merged(daily, ["user_id", "event_id"], ["value"], [week]).select(
        "week", "rows", sketches.distinct_count(F.col("user_id_distinct")).alias("about_users"),
        sketches.distinct_count(F.col("event_id_distinct")).alias("about_events"),
        sketches.quantile(F.col("value_quantiles"), 0.5).alias("about_median"))
    exact = events.groupBy(week).agg(
        F.count_distinct("user_id").alias("users"), F.count_distinct("event_id").alias("events"))
    ranks = events.withColumn("week", week).join(about.select("week", "about_median"), "week").groupBy("week").agg(
        (F.count_if(F.col("value") < F.col("about_median")) / F.count("*")).alias("below"),
        (F.count_if(F.col("value") <= F.col("about_median")) / F.count("*")).alias("up_to"))

    def near(name):
        return F.abs(F.col(f"about_{name}") - F.col(name)) <= F.greatest(F.col(name) * sketches.DISTINCT_ERROR, F.lit(1))

    return about.join(exact, "week").join(ranks, "week").select(
        "week", "rows", "users", "events", near("users").alias("users_near"), near("events").alias("events_near"),
        ((F.col("below") <= 0.5 + sketches.RANK_ERROR) & (F.col("up_to") >= 0.5 - sketches.RANK_ERROR)).alias("median_near"))


def lines_difference(spark, sf):
    """Order lines against a copy that lacks some and holds others twice."""
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", F.when(
        F.col("l_partkey") % 5 != 0, F.col("l_shipdate")).alias("l_shipdate"))
    copy = lines.where("l_orderkey % 7 <> 0").unionByName(lines.where("l_orderkey % 11 = 0"))
    return table_difference(lines, copy)


def payload_fields(spark, sf):
    """Payloads that carry more than the schema names: nested fields by path, the rest as it came, broken text as missing."""
    i = F.col("event_id")
    text = F.when(i % 17 == 0, F.lit("{\"k\": ")).when(i % 19 != 0, F.concat(
        F.lit("{\"k\": "), F.get_json_object("props", "$.k"), F.lit(", \"user\": {\"id\": "), F.col("user_id"),
        F.lit(", \"tags\": [\""), F.col("event_type"), F.lit("\", \"t"), i % 3, F.lit("\"]}"),
        F.when(i % 5 == 0, F.lit(", \"score\": \"high\"")).otherwise(F.concat(F.lit(", \"score\": "), i % 10)), F.lit("}")))
    stored = materialize(table(spark, sf, "events").select("event_id", parsed(text).alias("payload")), "payloads")
    payload = F.col("payload")
    return stored.select(
        "event_id", field(payload, "$.k", "int").alias("k"), field(payload, "$.user.id", "bigint").alias("user_id"),
        field(payload, "$.user.tags[1]", "string").alias("second_tag"), field(payload, "$.score", "int").alias("score"),
        field(payload, "$.user.absent", "string").alias("absent"),
        F.array_join(F.array_sort(F.map_keys(undeclared(payload, ["k"]))), ",").alias("others"))


QUERIES = {
    "asof_last_purchase": Query(asof_last_purchase, """
WITH known AS (SELECT * REPLACE (CASE WHEN event_id % 41 <> 0 THEN user_id END AS user_id) FROM events)
SELECT l.event_id, l.user_id, l.event_type, l.ts, r.event_id AS last_event_id, r.ts AS last_ts, r.value AS last_value
FROM (SELECT * FROM known WHERE event_type <> 'purchase') l
ASOF LEFT JOIN (SELECT * FROM known WHERE event_type = 'purchase') r ON l.user_id = r.user_id AND l.ts >= r.ts"""),
    "interval_overlaps": Query(interval_overlaps, f"""
WITH spans AS (
    SELECT event_id, CASE WHEN event_id % 41 <> 0 THEN user_id END AS user_id, event_type, epoch_us(ts) AS at,
           CASE WHEN event_id % {RARE} = 0 THEN {WEEKS} ELSE event_id % {MOST_MINUTES} END * {MINUTE} AS lasts FROM events)
SELECT l.event_id, l.user_id, r.event_id AS other_event_id FROM spans l JOIN spans r ON l.user_id = r.user_id
AND l.event_type = 'error' AND r.event_type = 'purchase' AND l.at <= r.at AND r.at - r.lasts <= l.at + l.lasts"""),
    "cube_stats": Query(cube_stats, _totals_sql("CUBE")),
    "rollup_stats": Query(rollup_stats, _totals_sql("ROLLUP")),
    "sketch_weeks": Query(sketch_weeks, f"""
SELECT date_diff('day', DATE '2024-01-01', CAST(ts AS DATE)) // {WEEK} AS week, count(*) AS rows,
       count(DISTINCT user_id) AS users, count(DISTINCT event_id) AS events, TRUE AS users_near, TRUE AS events_near,
       TRUE AS median_near
FROM events GROUP BY week"""),
    "lines_difference": Query(lines_difference, """
WITH lines AS (SELECT l_orderkey, l_linenumber, l_quantity, CASE WHEN l_partkey % 5 <> 0 THEN l_shipdate END AS l_shipdate FROM lineitem),
copy AS (SELECT * FROM lines WHERE l_orderkey % 7 <> 0 UNION ALL SELECT * FROM lines WHERE l_orderkey % 11 = 0),
gone AS (SELECT *, 1 AS m, 0 AS s FROM (SELECT * FROM lines EXCEPT ALL SELECT * FROM copy)),
extra AS (SELECT *, 0 AS m, 1 AS s FROM (SELECT * FROM copy EXCEPT ALL SELECT * FROM lines))
SELECT l_orderkey, l_linenumber, l_quantity, l_shipdate, CAST(sum(m) AS BIGINT) AS missing, CAST(sum(s) AS BIGINT) AS surplus
FROM (SELECT * FROM gone UNION ALL SELECT * FROM extra) GROUP BY ALL"""),
    "payload_fields": Query(payload_fields, """
WITH told AS (SELECT *, event_id % 17 = 0 OR event_id % 19 = 0 AS broken, CAST(regexp_extract(props, '[0-9]+') AS INTEGER) AS n FROM events)
SELECT event_id, CASE WHEN NOT broken THEN n END AS k, CASE WHEN NOT broken THEN user_id END AS user_id,
       CASE WHEN NOT broken THEN 't' || (event_id % 3) END AS second_tag,
       CASE WHEN NOT broken AND event_id % 5 <> 0 THEN CAST(event_id % 10 AS INTEGER) END AS score,
       CAST(NULL AS VARCHAR) AS absent, CASE WHEN NOT broken THEN 'score,user' END AS others
FROM told"""),
}
