"""Which files of a table can hold given keys: an index beside the table, a row for each page of a file.

A page is a stretch of a file with its smallest and largest key and a Bloom filter of its keys, laid out as Spark's bitmap
functions have it. Files are sorted by key, so a key falls into one page of a file, and a batch opens those files only that
have a page which may hold one of its keys. Pages are made as their rows are read, one at a time: no task sorts or keeps
more than a page. A page that two tasks read a part of has a row for each part. Files the index does not know, because a run ended before it wrote
theirs, are always among them: a missing entry costs time and never a row.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from urllib.parse import unquote

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from millrace.sources.tables import exists

FOLDER = "_keys"
# Keys of a page, bits of its filter (fixed by Spark's bitmap functions), positions a key has in it: about one false hit in 5,000.
PAGE, BITS, POSITIONS = 1_600, 32_768, 7
# Most keys that are looked up one by one; larger batches go by their smallest and largest.
LOOKED_UP = 10_000


def _hashes(key: Column) -> tuple[Column, Column]:
    """Two hashes make all positions."""
    return F.pmod(F.xxhash64(key), F.lit(BITS)), F.pmod(F.xxhash64(key, F.lit("step")), F.lit(BITS))


def _positions(key: Column) -> Column:
    one, other = _hashes(key)
    return F.array(*[F.pmod(one + other * i, F.lit(BITS)) for i in range(POSITIONS)])


def _limits(keys: pa.Array) -> tuple:
    """Smallest and largest key in Spark's order, where NaN is the largest."""
    if pa.types.is_floating(keys.type):
        numbers = keys.drop_null().to_numpy(zero_copy_only=False)
        gaps = np.isnan(numbers)
        if gaps.any():
            return (float("nan") if gaps.all() else float(numbers[~gaps].min())), float("nan")
    found = pc.min_max(keys)
    return found["min"], found["max"]


class _Page:
    """A page whose rows are still being read."""

    def __init__(self, file: int, number: int) -> None:
        self.file, self.number, self.parts, self.bits = file, number, [], np.zeros(BITS, dtype=np.uint8)

    def add(self, keys: pa.Array, one: np.ndarray, other: np.ndarray) -> None:
        self.parts.append(keys)
        for i in range(POSITIONS):
            self.bits[(one + other * i) % BITS] = 1

    def row(self) -> list:
        keys = pa.concat_arrays(self.parts)
        return [self.file, self.number, *_limits(keys), keys.null_count, np.packbits(self.bits, bitorder="little").tobytes()]


def pages(files: DataFrame, path: str, key: str) -> DataFrame:
    """Index rows of files just read: only their key column is."""
    from pyspark.sql.pandas.types import to_arrow_schema

    kind = files.schema[key].dataType
    schema = T.StructType([
        T.StructField("_file", T.LongType()), T.StructField("page", T.LongType()), T.StructField("low", kind),
        T.StructField("high", kind), T.StructField("missing", T.LongType()), T.StructField("bits", T.BinaryType())])
    arrow = to_arrow_schema(schema)

    def batch(rows: list[list]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(
            [x.as_py() if isinstance(x, pa.Scalar) else x for x in column], type=field.type)
            for column, field in zip(zip(*rows), arrow)], schema=arrow)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_page = None
        for read in batches:
            if not read.num_rows:
                continue
            file, number, one, other = (read.column(i).to_numpy() for i in range(1, 5))
            cuts = np.flatnonzero((file[1:] != file[:-1]) | (number[1:] != number[:-1])) + 1
            done = []
            for start, end in zip([0, *cuts], [*cuts, read.num_rows]):
                if open_page is None or (open_page.file, open_page.number) != (file[start], number[start]):
                    if open_page is not None:
                        done.append(open_page.row())
                    open_page = _Page(int(file[start]), int(number[start]))
                open_page.add(read.column(0).slice(start, end - start), one[start:end], other[start:end])
            if done:
                yield batch(done)
        if open_page is not None:
            yield batch([open_page.row()])

    # A number stands for the file's path on each row; paths join the finished pages.
    folder = "/" + path.rstrip("/").rsplit("/", 1)[-1] + "/"
    below = F.substring_index(F.input_file_name(), folder, -1)
    rows = files.select(F.col(key).alias("key"), F.xxhash64(below).alias("file"), F.floor(
        F.col("_metadata.row_index") / PAGE).alias("page"), *_hashes(F.col(key)))
    named = files.sparkSession.createDataFrame([(x.rpartition(folder)[2],) for x in files.inputFiles()], "file STRING")
    found = rows.mapInArrow(run, schema).join(F.broadcast(named.withColumn("_file", F.xxhash64("file"))), "_file")
    return found.select("file", "page", "low", "high", "missing", "bits")


def add_files(spark: SparkSession, path: str, files: Sequence[str], key: str) -> None:
    if files:
        read = spark.read.parquet(*[f"{path}/{unquote(name)}" for name in files])
        pages(read, path, key).write.mode("append").parquet(f"{path}/{FOLDER}")


def _index(spark: SparkSession, path: str) -> DataFrame | None:
    return spark.read.parquet(f"{path}/{FOLDER}") if exists(spark, f"{path}/{FOLDER}/_SUCCESS") else None


def _has(bits: Column, position: Column) -> Column:
    byte = F.conv(F.hex(F.substring(bits, F.floor(position / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("bigint")
    return F.getbit(byte, (position % 8).cast("int")) == 1


def files_with(spark: SparkSession, path: str, listed: Sequence[str], keys: DataFrame, key: str, rows: int) -> list[str]:
    """Those of the table's files, ``listed`` with their paths below it, that may hold one of ``keys``, ``rows`` many."""
    index = _index(spark, path)
    if index is None:
        return list(listed)
    asked = keys.select(F.col(key).alias("key"))
    if rows <= LOOKED_UP:
        known = F.broadcast(asked.distinct().withColumn("positions", _positions(F.col("key"))))
        within = F.col("key").between(F.col("low"), F.col("high")) | (F.col("key").isNull() & (F.col("missing") > 0))
        hit = index.join(known, within).where(F.forall("positions", lambda p: _has(F.col("bits"), p)))
    else:
        low, high, missing = asked.agg(F.min("key"), F.max("key"), F.count_if(F.col("key").isNull())).first()
        span = (F.col("low") <= F.lit(high)) & (F.col("high") >= F.lit(low)) if low is not None else F.lit(False)
        hit = index.where(span | (F.col("missing") > 0) if missing else span)
    possible = {row["file"] for row in hit.select("file").distinct().collect()}
    indexed = {row["file"] for row in index.select("file").distinct().collect()}
    return [name for name in listed if name in possible or name not in indexed]
