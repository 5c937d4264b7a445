"""Streaming jobs, drained over the whole event table."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.session import scratch_path
from millrace.sources.messages import file_messages, to_messages, with_envelope
from millrace.sources.tables import read_table
from millrace.spec import PAYLOAD_SCHEMA, SILVER_COLUMNS
from millrace.streaming.ingest import ingest_writer
from millrace.streaming.run import backlog_bytes, drain
from millrace.streaming.upsert import raw_table_stream, upsert_writer
from workload import Query
from workload.bindings import PAYLOAD, _CALENDAR_SQL, payload_millis

# Bytes of a micro-batch at least, small enough for several of them here.
BATCH_BYTES = 4 << 20
# Rows of a message file at most: a batch has many files then, and as many tasks.
FILE_ROWS = 100_000


def _sent_messages(spark, sf) -> str:
    """Every event as a message file row; every third one is delivered twice."""
    path = scratch_path(spark, "messages")
    sent = to_messages(payload_millis(spark, sf))
    number = F.col("key").cast("bigint")
    for wave, rows in enumerate((sent, sent.where(number % 3 == 0))):
        offset = number * 2 + wave
        enveloped = with_envelope(rows, "incidents", number % 4, offset,
                                  F.timestamp_millis(F.lit(1_704_067_200_000) + number))
        enveloped.write.mode("append").option("maxRecordsPerFile", FILE_ROWS).parquet(path)
    return path


def _bronze(spark, sf) -> str:
    sent, path = _sent_messages(spark, sf), scratch_path(spark, "bronze")
    stream = file_messages(spark, sent, backlog_bytes(spark, sent, BATCH_BYTES))
    drain(ingest_writer(stream, path, scratch_path(spark, "bronze-checkpoint")))
    return path


def stream_bronze(spark, sf):
    raw = read_table(spark, _bronze(spark, sf))
    return raw.withColumn("kafka_ms", F.unix_millis("kafka_timestamp")).drop("kafka_timestamp")


def stream_silver(spark, sf):
    raw, path = _bronze(spark, sf), scratch_path(spark, "silver")
    stream = raw_table_stream(spark, raw, backlog_bytes(spark, raw, BATCH_BYTES))
    drain(upsert_writer(stream, path, scratch_path(spark, "silver-checkpoint")))
    return read_table(spark, path).select(*SILVER_COLUMNS)


def stream_growth(spark, sf):
    """A column more from the second delivery on: events of a flag are sent first, without it; then all others with it.
    The raw table, the stream that reads it, and the clean table take it in as it comes."""
    raw, clean = scratch_path(spark, "raw"), scratch_path(spark, "clean")
    rows = payload_millis(spark, sf)
    fields = PAYLOAD_SCHEMA.split(", ")
    waves = ((rows.where("arrest").drop("ward"), [f for f in fields if not f.startswith("ward ")]),
             (rows.where("NOT arrest"), fields))
    sent, checkpoints = scratch_path(spark, "growth-messages"), scratch_path(spark, "growth-checkpoint")
    for wave, schema in waves:
        key = F.col("key").cast("bigint")
        enveloped = with_envelope(to_messages(wave), "incidents", key % 4, key, F.lit("2024-01-01"))
        enveloped.write.mode("append").option("maxRecordsPerFile", FILE_ROWS).parquet(sent)
        drain(ingest_writer(file_messages(spark, sent, backlog_bytes(spark, sent, BATCH_BYTES)), raw, f"{checkpoints}/raw",
                            payload_schema=", ".join(schema)))
        drain(upsert_writer(raw_table_stream(spark, raw, backlog_bytes(spark, raw, BATCH_BYTES)), clean, f"{checkpoints}/clean"))
    return read_table(spark, clean).select("id", "primary_type", "arrest", "ward", "event_year")


_MILLIS = f"{PAYLOAD}, sent AS (SELECT * REPLACE (date_trunc('millisecond', event_time) AS event_time) FROM payload)"
_COLUMNS = ", ".join(name for name in SILVER_COLUMNS if name not in (
    "event_date", "event_year", "hour_of_day", "day_of_week", "month"))

QUERIES = {
    "stream_bronze": Query(stream_bronze, f"""WITH {_MILLIS}
SELECT CAST(id AS VARCHAR) AS kafka_key, 'incidents' AS kafka_topic,
       CAST(id % 4 AS INTEGER) AS kafka_partition, id * 2 + wave AS kafka_offset,
       1704067200000 + id AS kafka_ms, {_COLUMNS}, epoch_ms(event_time) AS event_time_ms,
       CAST(event_time AS DATE) AS event_date
FROM sent, (VALUES (0), (1)) AS waves(wave) WHERE wave = 0 OR id % 3 = 0"""),
    "stream_growth": Query(stream_growth, f"""WITH {_MILLIS}
SELECT id, primary_type, arrest, CASE WHEN NOT arrest THEN ward END AS ward,
       CAST(year(event_time) AS INTEGER) AS event_year FROM sent"""),
    "stream_silver": Query(stream_silver, f"WITH {_MILLIS} SELECT {_COLUMNS}, {_CALENDAR_SQL} FROM sent"),
}
