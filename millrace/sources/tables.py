"""Parquet tables: layout on write, existence, size, freshness, compaction."""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator, Mapping, Sequence
from contextlib import contextmanager
from functools import reduce
from math import ceil

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructField, StructType

# Data per shuffle task.
SHUFFLE_TASK_BYTES = 128 * 1024 * 1024
_SHUFFLE_TASKS = "spark.sql.shuffle.partitions"
_NO_TABLE = ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA")


def rebalanced(df: DataFrame, columns: Sequence[str] = ()) -> DataFrame:
    """Even-sized write tasks, rows with equal ``columns`` kept together where that is even.

    The rebalance shuffle splits a partition value that holds much of the table over several
    tasks and merges tiny ones, so neither a hot year nor a rare one decides the file sizes.
    """
    return df.hint("rebalance", *columns)


# Beside a table's data, where readers of the data do not look: its columns, as JSON.
COLUMNS = "_columns"


def _folder(spark: SparkSession, path: str):
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()), folder


def exists(spark: SparkSession, path: str) -> bool:
    files, folder = _folder(spark, path)
    return files.exists(folder)


def stored_columns(spark: SparkSession, path: str) -> StructType | None:
    """The columns that writers of the table have noted, or None for a table of other writers."""
    files, note = _folder(spark, f"{path}/{COLUMNS}")
    if not files.exists(note):
        return None
    stream = files.open(note)
    try:
        text = spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    return StructType.fromJson(json.loads(text))


def note_columns(spark: SparkSession, path: str, schema: StructType, anew: bool = False) -> None:
    """Notes the table's columns: those it had and those that are new; ``anew`` forgets the old ones.

    Written beside and renamed, so that a reader finds the old note or the new one.
    """
    known = None if anew else stored_columns(spark, path)
    names = {field.name for field in known or []}
    united = StructType([*(known or []), *[field for field in schema if field.name not in names]])
    united = StructType([StructField(f.name, f.dataType, True) for f in united])
    if united == known:
        return
    files, note = _folder(spark, f"{path}/{COLUMNS}")
    _, draft = _folder(spark, f"{path}/{COLUMNS}-{uuid.uuid4().hex}")
    stream = files.create(draft, True)
    try:
        stream.write(bytearray(united.json().encode()))
    finally:
        stream.close()
    files.delete(note, False)
    files.rename(draft, note)


def _check_types(known: StructType | None, new: StructType) -> None:
    types = {field.name: field.dataType for field in known or []}
    changed = [field.name for field in new if types.get(field.name, field.dataType) != field.dataType]
    if changed:
        raise ValueError(f"columns of another type than the table's: {', '.join(changed)}")


def write_table(df: DataFrame, path: str, partition_by: Sequence[str] = (),
                mode: str = "overwrite", sort_by: Sequence[str] = (), even: bool = False) -> None:
    """Full rewrite by default; partitioned tables get few, even files per partition.

    ``even`` evens out the files of a table without partitions too, at the price of a shuffle.
    ``sort_by`` orders each file, so that statistics on those columns let readers skip most of it.
    The columns are noted beside the table, so that readers need no footers to know them.
    """
    spark = df.sparkSession
    laid_out = rebalanced(df, partition_by) if partition_by or even else df
    if sort_by:
        laid_out = laid_out.sortWithinPartitions(*partition_by, *sort_by)
    if mode == "append" and exists(spark, path) and stored_columns(spark, path) is None:
        # Files of a writer that noted nothing: a note of these columns alone would hide theirs.
        existing = table_if_exists(spark, path)
        if existing is not None:
            note_columns(spark, path, existing.schema)
    if mode == "append":
        _check_types(stored_columns(spark, path), df.schema)
    laid_out.write.partitionBy(*partition_by).mode(mode).parquet(path)
    ordered = [*[f for f in df.schema if f.name not in partition_by], *[f for f in df.schema if f.name in partition_by]]
    note_columns(spark, path, StructType(ordered), anew=mode == "overwrite")


def read_table(spark: SparkSession, path: str, schema: str | None = None,
               merge_schema: bool = True) -> DataFrame:
    """The columns of all files united, missing ones NULL: a column that a later append brought is
    there for the next reader. They come from the note beside the table, so no footer is opened for them; a table
    without one is united from its footers, or, without ``merge_schema``, has the columns of one file."""
    noted = schema or stored_columns(spark, path)
    if noted:
        return spark.read.schema(noted).parquet(path)
    return spark.read.option("mergeSchema", merge_schema).parquet(path)


def table_if_exists(spark: SparkSession, path: str) -> DataFrame | None:
    """The table at ``path``, or None before its first commit."""
    try:
        return read_table(spark, path)
    except AnalysisException as missing:
        if missing.getCondition() in _NO_TABLE:
            return None
        raise


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Rows per table. A scan without columns is answered from the file footers."""
    counts = [
        df.agg(F.count("*").alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts)


def freshness(tables: Mapping[str, tuple[DataFrame, str]]) -> DataFrame:
    """Latest value of each table's time column: the age of the data, at the price of reading that
    column. ``last_commits`` tells the age of the table from the listing alone."""
    latest = [
        df.agg(F.max(time).alias("latest")).select(F.lit(name).alias("table_name"), "latest")
        for name, (df, time) in tables.items()
    ]
    return reduce(DataFrame.unionByName, latest)


def file_inventory(spark: SparkSession, path: str) -> DataFrame:
    """Files, bytes and time of the last commit, from the listing alone: no data is read."""
    files = (
        spark.read.format("binaryFile")
        .options(recursiveFileLookup=True, pathGlobFilter="*.parquet")
        .load(path)
    )
    return files.agg(
        F.count("*").alias("files"),
        F.coalesce(F.sum("length"), F.lit(0)).alias("bytes"),
        F.max("modificationTime").alias("last_commit"),
    )


def last_commits(spark: SparkSession, paths: Mapping[str, str]) -> DataFrame:
    """Files, bytes and time of the last commit per table, without reading any."""
    found = [file_inventory(spark, path).select(F.lit(name).alias("table_name"), "*")
             for name, path in paths.items()]
    return reduce(DataFrame.unionByName, found)


@contextmanager
def sized_shuffles(spark: SparkSession, path: str, growth: float = 4.0) -> Iterator[int]:
    """While it lasts, as many shuffle partitions as one shuffle of the whole table needs.

    Only for work that shuffles the table's rows: aggregates combine before they shuffle.
    ``growth`` is the size of shuffled rows over that of compressed columns. Adaptive execution
    merges what turns out too many but cannot divide what is too few.
    """
    wanted = ceil(file_inventory(spark, path).first()["bytes"] * growth / SHUFFLE_TASK_BYTES)
    before = spark.conf.get(_SHUFFLE_TASKS)
    spark.conf.set(_SHUFFLE_TASKS, max(wanted, int(before)))
    try:
        yield max(wanted, int(before))
    finally:
        spark.conf.set(_SHUFFLE_TASKS, before)


def compact(spark: SparkSession, path: str, target: str,
            partition_by: Sequence[str] = (), sort_by: Sequence[str] = ()) -> DataFrame:
    """Rewrite the many small files below ``path`` into few even ones below ``target``.

    The old files stay untouched until the caller points readers at the new folder, so a
    failure on the way loses nothing. Both row counts come from file footers.
    """
    source = read_table(spark, path)
    write_table(source, target, partition_by, mode="errorifexists", sort_by=sort_by, even=True)
    compacted = spark.read.schema(source.schema).parquet(target)
    before, after = source.count(), compacted.count()
    if before != after:
        raise RuntimeError(f"compaction of {path} wrote {after} of {before} rows")
    return compacted
