"""Insert-only upsert into a Parquet table."""

from __future__ import annotations

from collections.abc import Sequence
from urllib.parse import unquote

from pyspark.sql import DataFrame, functions as F

from millrace.operators import keyindex
from millrace.sources.tables import table_if_exists, write_table

# Largest key list sent to every executor.
BROADCAST_BYTES = 64 * 1024 * 1024
# Most partition values listed in a filter, and most files listed for a scan.
MOST_PARTITIONS, MOST_FILES = 1000, 10_000
# Rough cost of one entry in a broadcast hash table besides its text.
_ENTRY_BYTES = 64


def unmatched(source: DataFrame, target: DataFrame, key: str,
              sized_keys: DataFrame | None = None) -> DataFrame:
    """Rows of ``source`` whose key is not in ``target``.

    ``target`` is usually the far larger side. ``sized_keys``, which hold at least the source's
    keys and are known to be small, travel to the target: it is only scanned, never shuffled, and
    the keys found there are at most as many. Without them both sides are shuffled on the key.
    """
    # A missing key is a key like any other, so a source that is merged again adds none.
    known = target.select(F.col(key).alias("_known"))
    if sized_keys is not None:
        asked = F.broadcast(sized_keys.select(F.col(key).alias("_asked")).distinct())
        same = F.col("_known").eqNullSafe(F.col("_asked"))
        known = F.broadcast(known.join(asked, same, "left_semi").distinct())
    return source.join(known, F.col(key).eqNullSafe(F.col("_known")), "left_anti")


def same_partitions(source: DataFrame, target: DataFrame, column: str) -> DataFrame:
    """The part of ``target`` in the partitions ``source`` touches, by static pruning.

    With more values than are worth listing the whole target is taken, which is right as well.
    """
    touched = [row[0] for row in
               source.select(column).distinct().limit(MOST_PARTITIONS + 1).collect()]
    if len(touched) > MOST_PARTITIONS:
        return target
    inside = F.col(column).isin([value for value in touched if value is not None])
    return target.where(inside | F.col(column).isNull() if None in touched else inside)


def key_bytes(source: DataFrame, key: str) -> tuple[int, int]:
    """Rows of ``source`` and an upper estimate of its keys' size once broadcast."""
    text = F.octet_length(F.col(key).cast("string")) + _ENTRY_BYTES
    rows, size = source.agg(F.count("*"), F.coalesce(F.sum(text), F.lit(0))).first()
    return rows, size


def table_files(table: DataFrame, path: str) -> list[str]:
    """The files of a table as paths below its folder, from its listing; special characters are percent-encoded."""
    mark = "/" + path.rstrip("/").rsplit("/", 1)[-1] + "/"
    return [name.rpartition(mark)[2] for name in table.inputFiles()]


def files_of_keys(target: DataFrame, path: str, keys: DataFrame, key: str, rows: int) -> DataFrame:
    """The part of a table whose files may hold ``keys``: the others are not opened."""
    spark = target.sparkSession
    listed = table_files(target, path)
    wanted = keyindex.files_with(spark, path, listed, keys, key, rows)
    if len(wanted) == len(listed) or len(wanted) > MOST_FILES:
        return target
    if not wanted:
        return target.limit(0)
    return spark.read.schema(target.schema).option("basePath", path).parquet(*[f"{path}/{unquote(name)}" for name in wanted])


def merge_new_keys(source: DataFrame, path: str, key: str, partition_by: Sequence[str] = (),
                   stable_partitions: bool = False, keys: DataFrame | None = None, indexed: bool = False) -> int:
    """Append the rows of ``source`` whose key the table does not hold; returns the rows asked for.

    ``source`` holds each key once. The first version of a key to arrive stays. Running the same
    source twice adds nothing, so a retried batch is safe. One writer per table.

    ``keys`` is a cheap table with at least the source's keys, for a source that is expensive to
    compute: it is then computed once, by the write.

    ``stable_partitions`` promises that a key never changes its partition; the target scan is then
    pruned to the partitions the source touches. With ``indexed`` each file is sorted by key and noted in an index of
    keys beside the table, and only files that may hold one of the keys are scanned (``keyindex``). A merge writes as many files as
    its rows need, at least one for each partition value it touches.
    """
    keys = source if keys is None else keys
    rows, size = key_bytes(keys, key)
    if rows == 0:
        return 0
    spark = source.sparkSession
    target = table_if_exists(spark, path)
    fresh = source
    if target is not None:
        pruned = target
        if indexed:
            pruned = files_of_keys(target, path, keys, key, rows)
        elif stable_partitions:
            pruned = same_partitions(source, target, partition_by[0])
        fresh = unmatched(source, pruned, key, keys if size <= BROADCAST_BYTES else None)
    write_table(fresh, path, partition_by, "append", sort_by=[key] if indexed else [])
    if indexed:
        index_files(spark, path, key, set() if target is None else set(table_files(target, path)))
    return rows


def index_files(spark: SparkSession, path: str, key: str, known: set[str]) -> None:
    """Notes the keys of files that are not ``known``."""
    table = table_if_exists(spark, path)
    if table is not None:
        keyindex.add_files(spark, path, [name for name in table_files(table, path) if name not in known], key)


def write_keyed(df: DataFrame, path: str, key: str, partition_by: Sequence[str] = ()) -> None:
    """Write a table anew in the layout that merges prune by: sorted files and their index."""
    write_table(df, path, partition_by, "overwrite", sort_by=[key])
    index_files(df.sparkSession, path, key, set())
