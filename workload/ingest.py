"""Reading text and messages, cleaning, deduplication."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.functions.calendar import wall_clock
from millrace.operators.clean import clean_events, newest_per_key
from millrace.operators.ranking import first_rows
from millrace.session import scratch_path
from millrace.sources import messages, text
from workload import Query
from workload.bindings import (
    PAYLOAD, RAW_EVENTS, SOURCE_PARSED, _CALENDAR_SQL, payload_millis, raw_events, source_text,
    table,
)


def lenient_parse(spark, sf):
    return text.parse_source(source_text(spark, sf))


def src_csv(spark, sf):
    """The text written as delimited files, its columns in another order and one more among them,
    read back by the header's names and parsed."""
    path = scratch_path(spark, "source-csv")
    rows = source_text(spark, sf)
    shuffled = [*reversed(rows.columns[5:]), "Remark", *rows.columns[:5]]
    text.write_result(rows.withColumn("Remark", F.lit("none, so far")).select(*shuffled), path)
    return text.parse_source(text.read_source(spark, path))


def admit_rows(spark, sf):
    return text.admit(lenient_parse(spark, sf))


JSON_FIELDS = (
    "id", "case_number", "primary_type", "description", "location_description", "arrest", "domestic", "beat",
    "district", "ward", "community_area", "fbi_code", "year", "latitude", "longitude", "event_time_ms", "ingestedAt")


def src_to_json(spark, sf):
    return messages.to_messages(payload_millis(spark, sf).select(*JSON_FIELDS))


def _json_sql(fields: dict[str, str]) -> str:
    parts = " || ',' || ".join(f"""'"{name}":' || {value}""" for name, value in fields.items())
    return f"'{{' || {parts} || '}}'"


def _quoted(name: str) -> str:
    return f"""COALESCE('"' || {name} || '"', 'null')"""


SRC_TO_JSON = f"""WITH {PAYLOAD}
SELECT CAST(id AS VARCHAR) AS key, {_json_sql({
    "id": "id", "case_number": _quoted("case_number"), "primary_type": _quoted("primary_type"),
    "description": _quoted("description"), "location_description": _quoted("location_description"),
    "arrest": "CAST(arrest AS VARCHAR)", "domestic": "CAST(domestic AS VARCHAR)", "beat": "beat",
    "district": "district", "ward": "COALESCE(CAST(ward AS VARCHAR), 'null')",
    "community_area": "COALESCE(CAST(community_area AS VARCHAR), 'null')", "fbi_code": _quoted("fbi_code"),
    "year": "year", "latitude": "CAST(latitude AS VARCHAR)", "longitude": "CAST(longitude AS VARCHAR)",
    "event_time_ms": "epoch_ms(date_trunc('millisecond', event_time))", "ingestedAt": '"ingestedAt"'})} AS value
FROM payload"""


def topk_cap(spark, sf):
    """The first 1,000 admitted rows in key order."""
    admitted = admit_rows(spark, sf).select("id", "primary_type", "event_time_ms")
    return first_rows(admitted, ["id"], 1_000)


def topk_cap_large(spark, sf):
    """The first 40,000 order lines by shipment: more than one task should hold."""
    lines = table(spark, sf, "lineitem").select("l_shipdate", *LINE_KEY, "l_quantity")
    return first_rows(lines, ["l_shipdate"], 40_000)


def bronze_parse(spark, sf):
    """Messages, some cut short and some with a field of the wrong type."""
    i = F.col("id")
    sent = messages.to_messages(payload_millis(spark, sf))
    broken = sent.withColumn("id", F.col("key").cast("bigint")).withColumn(
        "value",
        F.when(i % 67 == 0, F.substring("value", 1, 25))
         .when(i % 71 == 0, F.regexp_replace("value", '"district":[0-9]+', '"district":"north"'))
         .when(i % 73 == 0, F.lit(None)).otherwise(F.col("value")))
    enveloped = messages.with_envelope(
        broken, "incidents", i % 4, i, F.lit("2024-01-01 00:00:00"))
    return messages.decode_messages(enveloped).drop("kafka_timestamp", "ingestedAt")


BRONZE_PARSE = f"""WITH {PAYLOAD}, sent AS (
SELECT *, id % 67 <> 0 AND (id % 71 = 0 OR id % 73 <> 0) AS readable, id % 71 <> 0 AS numeric
FROM (SELECT *, date_trunc('millisecond', event_time) AS t FROM payload))
SELECT CAST(id AS VARCHAR) AS kafka_key, 'incidents' AS kafka_topic,
       CAST(id % 4 AS INTEGER) AS kafka_partition, id AS kafka_offset,
       CASE WHEN readable THEN id END AS id,
       {', '.join(f"CASE WHEN readable THEN {name} END AS {name}" for name in (
           "case_number", "primary_type", "description", "location_description", "arrest",
           "domestic", "beat", "ward", "community_area", "fbi_code", "year", "latitude", "longitude"))},
       CASE WHEN readable AND numeric THEN district END AS district,
       CASE WHEN readable THEN epoch_ms(t) END AS event_time_ms,
       CASE WHEN readable THEN t END AS event_time,
       CASE WHEN readable THEN CAST(t AS DATE) END AS event_date
FROM sent"""


def epoch_time(spark, sf):
    rows = payload_millis(spark, sf).select("id", "event_time_ms")
    timed = rows.withColumn("event_time", wall_clock(F.col("event_time_ms")))
    return timed.withColumn("event_date", F.to_date("event_time"))


def silver_clean(spark, sf):
    return clean_events(raw_events(spark, sf))


SILVER_CLEAN = f"""WITH {RAW_EVENTS}
SELECT id, case_number, primary_type, description, location_description, arrest, domestic, beat,
       district, ward, community_area, fbi_code, year, latitude, longitude, event_time,
       {_CALENDAR_SQL}, ingestedAt
FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY id ORDER BY event_time DESC) AS rk FROM raw_events
      WHERE id IS NOT NULL AND primary_type IS NOT NULL AND district IS NOT NULL
        AND latitude IS NOT NULL AND longitude IS NOT NULL)
WHERE rk = 1"""

LINE_KEY = ["l_orderkey", "l_linenumber"]


def stamped_rows(spark, sf):
    """Admitted rows with the time of ingestion: one and the same for all rows of a run."""
    stamped = text.stamp_ingest(admit_rows(spark, sf))
    return stamped.groupBy("primary_type").agg(
        F.count("*").alias("n"), F.count_distinct("ingestedAt").alias("times"))


def origin_rows(spark, sf):
    """Delimited files with the file each row came from: how many rows have one, by its ending."""
    path = scratch_path(spark, "source-csv")
    text.write_result(source_text(spark, sf).select("ID", "District"), path)
    rows = text.with_origin(text.read_source(spark, path, ("ID", "District")))
    known = F.substring_index("source_file", ".", -1)
    return rows.groupBy("District", known.alias("ending"), F.col("source_time").isNotNull().alias("timed")).agg(
        F.count("*").alias("n"))


def dedup_latest(spark, sf):
    """The latest shipment of each order line; lines do occur more than once."""
    return newest_per_key(table(spark, sf, "lineitem"), LINE_KEY, ["l_shipdate"])


DEDUP_LATEST = """SELECT * EXCLUDE (rk) FROM (
SELECT *, ROW_NUMBER() OVER (PARTITION BY l_orderkey, l_linenumber
  ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC, l_quantity DESC, l_extendedprice DESC,
           l_discount DESC, l_tax DESC, l_returnflag DESC, l_linestatus DESC) AS rk
FROM lineitem) WHERE rk = 1"""

_ADMITTED = "SELECT * FROM parsed WHERE event_time_ms IS NOT NULL AND id IS NOT NULL AND primary_type IS NOT NULL"

QUERIES = {
    "lenient_parse": Query(lenient_parse, f"WITH {SOURCE_PARSED} SELECT * FROM parsed"),
    "src_csv": Query(src_csv, f"WITH {SOURCE_PARSED} SELECT * FROM parsed"),
    "stamped_rows": Query(stamped_rows, f"""WITH {SOURCE_PARSED}
SELECT primary_type, COUNT(*) AS n, 1 AS times FROM ({_ADMITTED}) GROUP BY primary_type"""),
    "origin_rows": Query(origin_rows, f"""WITH {PAYLOAD}
SELECT lpad(CAST(district AS VARCHAR), 3, '0') AS "District", 'csv' AS ending, true AS timed, COUNT(*) AS n
FROM payload GROUP BY district"""),
    "admit_rows": Query(admit_rows, f"WITH {SOURCE_PARSED} {_ADMITTED}"),
    "src_to_json": Query(src_to_json, SRC_TO_JSON),
    "topk_cap": Query(topk_cap, f"""WITH {SOURCE_PARSED}
SELECT id, primary_type, event_time_ms FROM ({_ADMITTED})
ORDER BY id, primary_type, event_time_ms LIMIT 1000"""),
    "topk_cap_large": Query(topk_cap_large, """
SELECT l_shipdate, l_orderkey, l_linenumber, l_quantity FROM lineitem
ORDER BY l_shipdate, l_orderkey, l_linenumber, l_quantity LIMIT 40000"""),
    "bronze_parse": Query(bronze_parse, BRONZE_PARSE),
    "epoch_time": Query(epoch_time, f"""WITH {PAYLOAD}
SELECT id, epoch_ms(date_trunc('millisecond', event_time)) AS event_time_ms, date_trunc('millisecond', event_time) AS event_time,
       CAST(event_time AS DATE) AS event_date FROM payload"""),
    "silver_clean": Query(silver_clean, SILVER_CLEAN),
    "dedup_latest": Query(dedup_latest, DEDUP_LATEST),
}
