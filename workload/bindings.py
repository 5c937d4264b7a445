"""Event-shaped views of the given tables, in Spark and as SQL for the oracle.

Gaps, dirt, redeliveries and runs are derived from the rows themselves, so every query's work
grows with the tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from millrace.functions.calendar import calendar_parts, wall_millis
from millrace.spec import SILVER_COLUMNS, SOURCE_COLUMNS


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def _payload(events: DataFrame) -> DataFrame:
    """The payload columns plus the event's time, without gaps in the required ones."""
    e = F.col
    k = F.get_json_object("props", "$.k").cast("int")
    return events.withColumn("k", k).select(
        e("event_id").alias("id"),
        F.concat(F.lit("EV"), e("event_id")).alias("case_number"),
        F.concat_ws("_", "event_type", e("k") % 5).alias("primary_type"),
        F.when(e("event_id") % 13 != 0, F.concat_ws(" ", "event_type", e("k") % 3)).alias("description"),
        F.element_at(F.array(*map(F.lit, ("STREET", "HOUSE", "STORE", "PARK"))),
                     (e("user_id") % 4).cast("int") + 1).alias("location_description"),
        (e("value") >= 60).alias("arrest"),
        (e("k") < 30).alias("domestic"),
        (e("user_id") * 10 + e("k") % 10).cast("int").alias("beat"),
        (e("user_id") % 23).cast("int").alias("district"),
        F.when(e("event_id") % 97 != 0, (e("user_id") % 50).cast("int")).alias("ward"),
        F.when(e("event_id") % 89 != 0, e("k") % 77).alias("community_area"),
        F.concat(F.lit("F"), e("k") % 26).alias("fbi_code"),
        F.year("ts").alias("year"),
        e("value").alias("latitude"),
        ((-e("k")).cast("double") / 10).alias("longitude"),
        e("ts").alias("event_time"),
        (e("event_id") + 1_700_000_000_000).alias("ingestedAt"),
    )


_PAYLOAD_SQL = """
SELECT event_id AS id,
       'EV' || event_id AS case_number,
       event_type || '_' || (k % 5) AS primary_type,
       CASE WHEN event_id % 13 <> 0 THEN event_type || ' ' || (k % 3) END AS description,
       (['STREET', 'HOUSE', 'STORE', 'PARK'])[CAST(user_id % 4 AS INTEGER) + 1] AS location_description,
       value >= 60 AS arrest,
       k < 30 AS domestic,
       CAST(user_id * 10 + k % 10 AS INTEGER) AS beat,
       CAST(user_id % 23 AS INTEGER) AS district,
       CASE WHEN event_id % 97 <> 0 THEN CAST(user_id % 50 AS INTEGER) END AS ward,
       CASE WHEN event_id % 89 <> 0 THEN CAST(k % 77 AS INTEGER) END AS community_area,
       'F' || (k % 26) AS fbi_code,
       CAST(year(ts) AS INTEGER) AS year,
       value AS latitude,
       CAST(-k AS DOUBLE) / CAST(10 AS DOUBLE) AS longitude,
       ts AS event_time,
       event_id + 1700000000000 AS ingestedAt
FROM (SELECT *, CAST(regexp_extract(props, '[0-9]+') AS INTEGER) AS k FROM events)
"""

_CALENDAR_SQL = """
       CAST(event_time AS DATE) AS event_date,
       CAST(year(event_time) AS INTEGER) AS event_year,
       CAST(hour(event_time) AS INTEGER) AS hour_of_day,
       CAST(dayofweek(event_time) + 1 AS INTEGER) AS day_of_week,
       CAST(month(event_time) AS INTEGER) AS month
"""


def payload(spark: SparkSession, sf: str) -> DataFrame:
    return _payload(table(spark, sf, "events"))


PAYLOAD = f"payload AS ({_PAYLOAD_SQL})"


def incidents(spark: SparkSession, sf: str) -> DataFrame:
    """The clean event table."""
    rows = payload(spark, sf)
    return rows.withColumns(
        {**calendar_parts(F.col("event_time")), "event_date": F.to_date("event_time")}
    ).select(*SILVER_COLUMNS)


INCIDENTS = f"{PAYLOAD}, incidents AS (SELECT *, {_CALENDAR_SQL} FROM payload)"


def raw_events(spark: SparkSession, sf: str) -> DataFrame:
    """The raw event table: gaps in required columns, and every tenth event sent again an hour
    later with its first flag turned."""
    i = F.col("id")
    version = F.sequence(F.lit(0), F.when(i % 10 == 0, 1).otherwise(0))
    rows = payload(spark, sf).withColumns({
        "latitude": F.when(i % 101 != 0, F.col("latitude")),
        "primary_type": F.when(i % 103 != 0, F.col("primary_type")),
        "district": F.when(i % 107 != 0, F.col("district")),
        "version": F.explode(version),
    })
    again = F.col("version") == 1
    return rows.withColumns({
        "event_time": F.col("event_time") + F.make_dt_interval(hours=F.col("version")),
        "arrest": F.when(again, ~F.col("arrest")).otherwise(F.col("arrest")),
    }).withColumn("event_date", F.to_date("event_time")).drop("version")


RAW_EVENTS = f"""{PAYLOAD}, raw_events AS (
SELECT id, case_number, CASE WHEN id % 103 <> 0 THEN primary_type END AS primary_type, description,
       location_description, CASE WHEN version = 1 THEN NOT arrest ELSE arrest END AS arrest,
       domestic, beat, CASE WHEN id % 107 <> 0 THEN district END AS district, ward, community_area,
       fbi_code, year, CASE WHEN id % 101 <> 0 THEN latitude END AS latitude, longitude,
       event_time + version * INTERVAL 1 HOUR AS event_time, ingestedAt
FROM payload, (VALUES (0), (1)) AS versions(version)
WHERE version = 0 OR id % 10 = 0)"""


def source_text(spark: SparkSession, sf: str) -> DataFrame:
    """The delimited source: 22 text columns, some of them unreadable."""
    i, text = F.col("id"), (lambda name: F.col(name).cast("string"))

    def pick(choices: tuple[str, ...]):
        return F.element_at(F.array(*map(F.lit, choices)), (i % len(choices)).cast("int") + 1)

    def spelled(flag: str):
        return F.when(F.col(flag), pick(("true", "TRUE", " yes ", "1"))).otherwise(
            pick(("false", "0", "", "no")))

    known = {
        "ID": F.when(i % 53 == 0, F.concat(F.lit("x"), i)).when(i % 59 == 0, "")
               .when(i % 61 == 0, F.concat(F.lit("00"), i)).otherwise(text("id")),
        "Case Number": F.when(i % 31 == 0, "").otherwise(F.col("case_number")),
        "Date": F.when(i % 47 == 0, "no date").when(i % 43 == 0, "")
                 .otherwise(F.date_format("event_time", "MM/dd/yyyy hh:mm:ss a")),
        "Primary Type": F.when(i % 41 == 0, "").otherwise(F.col("primary_type")),
        "Description": F.coalesce("description", F.lit("")),
        "Location Description": F.col("location_description"),
        "Arrest": spelled("arrest"),
        "Domestic": spelled("domestic"),
        "Beat": F.when(i % 37 == 0, "12.0").otherwise(text("beat")),
        "District": F.lpad(text("district"), 3, "0"),
        "Ward": F.coalesce(text("ward"), F.lit("")),
        "Community Area": F.coalesce(text("community_area"), F.lit("n/a")),
        "FBI Code": F.col("fbi_code"),
        "Year": text("year"),
        "Latitude": F.when(i % 29 == 0, "").otherwise(text("latitude")),
        "Longitude": text("longitude"),
    }
    return payload(spark, sf).select(
        *[known.get(name, F.lit("unused")).alias(name) for name in SOURCE_COLUMNS])


def _spelled_sql(flag: str) -> str:
    return (f"CASE WHEN {flag} THEN (['true', 'TRUE', ' yes ', '1'])[CAST(id % 4 AS INTEGER) + 1] "
            f"ELSE (['false', '0', '', 'no'])[CAST(id % 4 AS INTEGER) + 1] END")


def _whole(column: str, kind: str) -> str:
    return (f"CASE WHEN regexp_full_match(trim({column}), '[+-]?[0-9]+') "
            f"THEN TRY_CAST(trim({column}) AS {kind}) END")


# The text as above, then read leniently.
SOURCE_PARSED = f"""{PAYLOAD}, source_text AS (
SELECT CASE WHEN id % 53 = 0 THEN 'x' || id WHEN id % 59 = 0 THEN '' WHEN id % 61 = 0 THEN '00' || id
            ELSE CAST(id AS VARCHAR) END AS id,
       CASE WHEN id % 31 = 0 THEN '' ELSE case_number END AS case_number,
       CASE WHEN id % 47 = 0 THEN 'no date' WHEN id % 43 = 0 THEN ''
            ELSE strftime(event_time, '%m/%d/%Y %I:%M:%S %p') END AS date,
       CASE WHEN id % 41 = 0 THEN '' ELSE primary_type END AS primary_type,
       COALESCE(description, '') AS description, location_description,
       {_spelled_sql('arrest')} AS arrest, {_spelled_sql('domestic')} AS domestic,
       CASE WHEN id % 37 = 0 THEN '12.0' ELSE CAST(beat AS VARCHAR) END AS beat,
       lpad(CAST(district AS VARCHAR), 3, '0') AS district,
       COALESCE(CAST(ward AS VARCHAR), '') AS ward,
       COALESCE(CAST(community_area AS VARCHAR), 'n/a') AS community_area,
       fbi_code, CAST(year AS VARCHAR) AS year,
       CASE WHEN id % 29 = 0 THEN '' ELSE CAST(latitude AS VARCHAR) END AS latitude,
       CAST(longitude AS VARCHAR) AS longitude
FROM payload), parsed AS (
SELECT {_whole('id', 'BIGINT')} AS id,
       NULLIF(case_number, '') AS case_number, NULLIF(primary_type, '') AS primary_type,
       NULLIF(description, '') AS description,
       NULLIF(location_description, '') AS location_description,
       lower(trim(arrest)) IN ('true', '1', 'yes') AS arrest,
       lower(trim(domestic)) IN ('true', '1', 'yes') AS domestic,
       {_whole('beat', 'INTEGER')} AS beat, {_whole('district', 'INTEGER')} AS district,
       {_whole('ward', 'INTEGER')} AS ward, {_whole('community_area', 'INTEGER')} AS community_area,
       NULLIF(fbi_code, '') AS fbi_code, {_whole('year', 'INTEGER')} AS year,
       TRY_CAST(NULLIF(latitude, '') AS DOUBLE) AS latitude,
       TRY_CAST(longitude AS DOUBLE) AS longitude,
       epoch_ms(TRY_STRPTIME(date, '%m/%d/%Y %I:%M:%S %p')) AS event_time_ms
FROM source_text)"""


def payload_millis(spark: SparkSession, sf: str) -> DataFrame:
    """The payload as messages carry it: time in milliseconds."""
    return payload(spark, sf).withColumn("event_time_ms", wall_millis(F.col("event_time")))
