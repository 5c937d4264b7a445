"""Batch rebuild of the clean table."""

from __future__ import annotations

from pyspark.sql import SparkSession

from millrace.operators.clean import clean_events, complete_rows
from millrace.operators.merge import write_keyed
from millrace.sources.tables import read_table
from millrace.spec import INCIDENTS, EventSpec


def rebuild_silver(spark: SparkSession, raw_path: str, path: str,
                   spec: EventSpec = INCIDENTS) -> int:
    """Clean the whole raw table, newest version per key; returns the rows written. The layout is
    the stream's, so either can go on where the other stopped.

    Without a complete row there is nothing to publish, and the old table stays. That check stops
    at the first complete row; the written rows are counted in the file footers.
    """
    raw = read_table(spark, raw_path)
    if complete_rows(raw, spec).isEmpty():
        raise RuntimeError(f"no complete rows in {raw_path}")
    write_keyed(clean_events(raw, spec), path, spec.key, ("event_year",))
    return read_table(spark, path).count()
