"""Messages to the raw event table."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import DataStreamWriter

from millrace.sources.messages import decode_messages
from millrace.sources.tables import note_columns
from millrace.spec import PAYLOAD_SCHEMA


def ingest_writer(messages: DataFrame, path: str, checkpoint: str,
                  writers_per_date: int | None = None,
                  payload_schema: str = PAYLOAD_SCHEMA) -> DataStreamWriter:
    """Parse and append, one folder per event date; the checkpoint makes it exactly-once.

    Every task writes a file of its own for each date it meets. Where batches are small and mix
    many dates, ``writers_per_date`` shuffles them first, so that a date gets that many files. The table's
    columns are noted beside it here.
    """
    rows = decode_messages(messages, payload_schema)
    note_columns(messages.sparkSession, path, rows.schema)
    if writers_per_date:
        writer = F.pmod(F.xxhash64("kafka_key"), F.lit(writers_per_date))
        rows = rows.repartition(F.col("event_date"), writer)
    return (
        rows.writeStream.format("parquet")
        .outputMode("append")
        .partitionBy("event_date")
        .option("checkpointLocation", checkpoint)
        .option("path", path)
    )
