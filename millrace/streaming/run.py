"""Starting streams: bounded or continuous."""

from __future__ import annotations

from math import ceil

from pyspark.sql import SparkSession
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from millrace.sources.tables import file_inventory

# Seconds between micro-batches of the two continuous jobs.
INGEST_SECONDS = 10
UPSERT_SECONDS = 20


# Micro-batches that a long backlog is drained in, and the largest one's bytes.
BACKLOG_BATCHES, MOST_BYTES = 16, 1 << 30


def backlog_bytes(spark: SparkSession, path: str, least: int) -> int:
    """Bytes of a micro-batch for draining the files below ``path``: ``least``, or more where that would take very many.

    Each batch looks at the table it is merged into, so batches of one size cost the square of a backlog. With a number of
    batches that stays the same, as long as none is over ``MOST_BYTES``, each row of the table is looked at as often however much there is.
    """
    return max(least, min(MOST_BYTES, ceil(file_inventory(spark, path).first()["bytes"] / BACKLOG_BATCHES)))


def drain(writer: DataStreamWriter, timeout: int | None = None) -> None:
    """Process everything there is now, in bounded batches, then stop.

    ``timeout`` is for callers that would rather fail than wait; without it the input decides.
    """
    query = writer.trigger(availableNow=True).start()
    if timeout is None:
        query.awaitTermination()
    elif not query.awaitTermination(timeout):
        query.stop()
        raise TimeoutError(f"stream still running after {timeout} s")


def run_continuously(writer: DataStreamWriter, seconds: int) -> StreamingQuery:
    return writer.trigger(processingTime=f"{seconds} seconds").start()
