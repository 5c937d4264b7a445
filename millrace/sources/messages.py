"""Keyed JSON messages, from a Kafka topic or from files with the same envelope."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from millrace.functions.calendar import wall_clock
from millrace.spec import (
    INCIDENTS, MESSAGE_SCHEMA, PAYLOAD_SCHEMA, RAW_ENVELOPE, TOPIC_BATCH, TOPIC_OPTIONS, EventSpec,
)

# Bytes of message files in a micro-batch; at least one file is read.
BATCH_BYTES = 1 << 30


def to_messages(payload: DataFrame, spec: EventSpec = INCIDENTS) -> DataFrame:
    """One message per row: the key as text, the whole row as JSON with explicit nulls."""
    return payload.select(
        F.col(spec.key).cast("string").alias("key"),
        F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("value"),
    )


def with_envelope(messages: DataFrame, topic: str, partition: Column, offset: Column,
                  timestamp: Column) -> DataFrame:
    """Adds what a broker would add, so that files can stand in for a topic."""
    return messages.select(
        F.col("key").cast("binary").alias("key"),
        F.col("value").cast("binary").alias("value"),
        F.lit(topic).alias("topic"),
        partition.cast("int").alias("partition"),
        offset.cast("bigint").alias("offset"),
        timestamp.cast("timestamp").alias("timestamp"),
    )


def publish(messages: DataFrame, servers: str, topic: str) -> None:
    """Send messages to a topic; needs the Kafka connector on the classpath."""
    messages.write.format("kafka").options(
        **{"kafka.bootstrap.servers": servers, "topic": topic}).save()


def kafka_messages(spark: SparkSession, servers: str, topic: str,
                   per_trigger: int = TOPIC_BATCH) -> DataFrame:
    """Stream of a topic from its earliest offset, bounded per micro-batch.

    Needs the Kafka connector on the classpath.
    """
    return (
        spark.readStream.format("kafka")
        .options(**{
            **TOPIC_OPTIONS,
            "kafka.bootstrap.servers": servers,
            "subscribe": topic,
            "maxOffsetsPerTrigger": str(per_trigger),
        })
        .load()
    )


def file_messages(spark: SparkSession, path: str, batch_bytes: int = BATCH_BYTES) -> DataFrame:
    """The same stream from message files, bounded by their bytes per micro-batch."""
    return (
        spark.readStream.schema(MESSAGE_SCHEMA)
        .option("maxBytesPerTrigger", batch_bytes)
        .parquet(path)
    )


def decode_messages(messages: DataFrame, payload_schema: str = PAYLOAD_SCHEMA) -> DataFrame:
    """Envelope and payload side by side, with event time and date.

    A message that is no valid JSON keeps its envelope and gets NULL payload fields.
    """
    envelope = [
        (F.col(name).cast("string") if name == "key" else F.col(name)).alias(stored)
        for name, stored in RAW_ENVELOPE.items()
    ]
    body = F.from_json(F.col("value").cast("string"), payload_schema).alias("body")
    flat = messages.select(*envelope, body).select(*RAW_ENVELOPE.values(), "body.*")
    timed = flat.withColumn("event_time", wall_clock(F.col("event_time_ms")))
    return timed.withColumn("event_date", F.to_date("event_time"))
