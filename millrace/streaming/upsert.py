"""Raw event table to the clean table, batch by batch."""

from __future__ import annotations

from collections.abc import Callable
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import DataStreamWriter

from millrace.operators.clean import clean_events, complete_rows
from millrace.operators.merge import merge_new_keys
from millrace.sources.tables import read_table
from millrace.spec import INCIDENTS, SILVER_COLUMNS, EventSpec


# Bytes of raw files in a micro-batch; at least one file is read.
BATCH_BYTES = 1 << 30


def raw_table_stream(spark: SparkSession, path: str, batch_bytes: int = BATCH_BYTES) -> DataFrame:
    """New files of the raw table as a stream, with the columns that any of its files has now."""
    schema = read_table(spark, path).schema
    return spark.readStream.schema(schema).option("maxBytesPerTrigger", batch_bytes).parquet(path)


def batch_upsert(path: str, spec: EventSpec = INCIDENTS,
                 columns: tuple[str, ...] = SILVER_COLUMNS,
                 partition_by: tuple[str, ...] = ("event_year",)) -> Callable[[DataFrame, int], None]:
    """Clean a micro-batch and append the keys the table lacks; an empty one does nothing.

    An index of keys beside the table tells which files a batch has to look at. Columns
    that the raw rows do not have yet are left out until they do. A key stays as it first arrived. A repeated batch finds its keys already there.
    """
    def upsert(batch: DataFrame, batch_id: int) -> None:
        # Emptiness and key sizes come from the raw rows' key column, so the cleaned rows are
        # computed once, by the write, and need no cache.
        merge_new_keys(clean_events(batch, spec, columns), path, spec.key, partition_by,
                       keys=complete_rows(batch, spec), indexed=True)

    return upsert


_FILES = "path STRING, modificationTime TIMESTAMP, length BIGINT, content BINARY"


def growing_upsert_writer(spark: SparkSession, raw_path: str, path: str, checkpoint: str, spec: EventSpec = INCIDENTS,
                          batch_bytes: int = BATCH_BYTES) -> DataStreamWriter:
    """``upsert_writer`` for a stream that keeps running while the raw table gains columns.

    The stream carries the names of new files only, so it has no columns to keep: each micro-batch reads its
    files with the columns that the raw table's note has by then. The driver gets as many names as ``batch_bytes`` allow.
    """
    upsert = batch_upsert(path, spec)
    names = spark.readStream.format("binaryFile").schema(_FILES).option("maxBytesPerTrigger", batch_bytes).option(
        "pathGlobFilter", "*.parquet").load(raw_path).select("path")

    def take(batch: DataFrame, batch_id: int) -> None:
        files = [unquote(row["path"]) for row in batch.collect()]
        if files:
            schema = read_table(spark, raw_path).schema
            upsert(spark.read.schema(schema).option("basePath", raw_path).parquet(*files), batch_id)

    return names.writeStream.foreachBatch(take).option("checkpointLocation", checkpoint)


def upsert_writer(raw: DataFrame, path: str, checkpoint: str,
                  spec: EventSpec = INCIDENTS) -> DataStreamWriter:
    return raw.writeStream.foreachBatch(batch_upsert(path, spec)).option(
        "checkpointLocation", checkpoint)
