"""Passing rows of texts through Python tasks in pieces of bounded size."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

# Rows and bytes that one call of a row function gets at most (a single longer text passes whole).
PIECE_ROWS, PIECE_BYTES = 2_000, 4 << 20
# Rows that go to and fro between the JVM and Python together, while whole texts are passed.
BATCH_ROWS = 1_000
_BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


@contextmanager
def text_batches(spark: SparkSession) -> Iterator[None]:
    """While it lasts, jobs send ``BATCH_ROWS`` rows to Python at a time at most: Spark's own setting is made for rows of
    figures, and both sides hold whole batches. Only for work that runs before it ends."""
    before = spark.conf.get(_BATCH_ROWS)
    # 0 and less stand for no bound.
    spark.conf.set(_BATCH_ROWS, min(BATCH_ROWS, int(before)) if int(before) > 0 else BATCH_ROWS)
    try:
        yield
    finally:
        spark.conf.set(_BATCH_ROWS, before)


def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The same rows in slices of at most ``PIECE_ROWS`` rows and about ``PIECE_BYTES`` bytes."""
    for batch in batches:
        rows = batch.num_rows
        size = max(1, batch.get_total_buffer_size())
        step = max(1, min(PIECE_ROWS, int(rows * PIECE_BYTES / size) or 1))
        for start in range(0, rows, step):
            yield batch.slice(start, step)


def map_rows(df: DataFrame, columns: Sequence[str], schema: StructType,
             prepare: Callable[[], Callable[[dict[str, list]], dict[str, Sequence]]]) -> DataFrame:
    """Applies a function to lists of values per column; it returns such lists in turn.

    ``prepare`` makes the function, once in each task. Only ``columns`` leave the JVM, and rows stay
    in their task: nothing is shuffled. The number of rows may change.
    """
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        function = prepare()
        for piece in pieces(batches):
            found = function(piece.to_pydict())
            yield pa.RecordBatch.from_arrays(
                [pa.array(found[field.name], type=field.type) for field in arrow], schema=arrow)

    return df.select(*columns).mapInArrow(run, schema)


def keep_rows(df: DataFrame, text: str, prepare: Callable[[], Callable[[list[str]], Sequence[bool]]]) -> DataFrame:
    """The rows whose text a function says yes to, with all their columns; a missing text is passed as empty.

    ``prepare`` makes the function, once in each task. Nothing is shuffled.
    """
    at = df.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        function = prepare()
        for piece in pieces(batches):
            texts = [body or "" for body in piece.column(at).to_pylist()]
            yield piece.filter(pa.array(function(texts), type=pa.bool_()))

    return df.mapInArrow(run, df.schema)


def keyed_texts(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Key and text alone, a missing text as empty: other columns cannot clash with results."""
    return df.select(F.col(key).alias(key), F.coalesce(F.col(text), F.lit("")).alias(text))
