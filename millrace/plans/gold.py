"""Refresh of all aggregate tables, whole or by what has changed."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from millrace.functions.buckets import FREQUENCY_LEVELS, FREQUENCY_REST, threshold_bucket
from millrace.operators.aggregates import count_true, hourly_stats, rates, region_stats, regions_of_cells, type_stats
from millrace.session import materialize
from millrace.sources.tables import read_table, write_table
from millrace.spec import INCIDENTS, EventSpec

TABLES = {"type_stats": type_stats, "district_stats": region_stats, "hourly_stats": hourly_stats}
# The clean table's partition column, and folders below the one for parts.
PARTITION, CELLS, SEEN = "event_year", "cells", "seen"
# What Spark calls the folder of a missing partition value.
_MISSING = "__HIVE_DEFAULT_PARTITION__"


def refresh_gold(spark: SparkSession, silver: DataFrame, root: str,
                 spec: EventSpec = INCIDENTS) -> dict[str, DataFrame]:
    """Overwrite every aggregate table below ``root`` and return the written tables.

    Each reads only the few columns it needs, so separate column-pruned scans are cheaper than
    caching all of the clean table.
    """
    return _written(spark, {name: build(silver, spec) for name, build in TABLES.items()}, root)


def _written(spark: SparkSession, tables: dict[str, DataFrame], root: str) -> dict[str, DataFrame]:
    written = {}
    for name, df in tables.items():
        path = f"{root}/{name}"
        write_table(df, path)
        written[name] = read_table(spark, path)
    return written


def partition_states(spark: SparkSession, path: str, column: str = PARTITION) -> DataFrame:
    """Per value of the partition column, as text: its ``files`` and their ``state``, a sum over names, sizes and times.

    From the listing alone: no file is opened. Any file that is added, removed or written anew changes the state.
    """
    listed = spark.read.format("binaryFile").options(recursiveFileLookup=True, pathGlobFilter="*.parquet").load(path)
    value = F.regexp_extract("path", f"/{column}=([^/]*)/", 1)
    mark = F.xxhash64("path", "length", "modificationTime").cast("decimal(38,0)")
    return listed.groupBy(value.alias("part")).agg(F.count("*").alias("files"), F.sum(mark).cast("string").alias("state"))


def changed_parts(now: DataFrame, seen: DataFrame | None) -> list[str]:
    """Partition values that are new or whose files are not those seen; as many as the table has partitions at most."""
    if seen is None:
        changed = now
    else:
        known = seen.select("part", F.col("state").alias("_state"))
        changed = now.join(known, "part", "left").where(~F.col("state").eqNullSafe(F.col("_state")))
    return sorted(row["part"] for row in changed.select("part").collect())


def in_parts(df: DataFrame, parts: Sequence[str], column: str = PARTITION) -> DataFrame:
    """The rows in these partitions; the others are pruned from the listing."""
    values = [F.lit(part).cast(df.schema[column].dataType) for part in parts if part != _MISSING]
    inside = F.col(column).isin(*values) if values else F.lit(False)
    return df.where(inside | F.col(column).isNull() if _MISSING in parts else inside)


def gold_cells(silver: DataFrame, spec: EventSpec = INCIDENTS, column: str = PARTITION) -> DataFrame:
    """What all aggregate tables need, per partition, region, type and hour: everything in them adds up or is a smallest or largest."""
    sums = []
    for name in spec.coordinates:
        sums += [F.sum(name).alias(f"_{name}_sum"), F.count(name).alias(f"_{name}_n")]
    return silver.groupBy(column, spec.region, spec.type, "hour_of_day").agg(
        F.count("*").alias(spec.count), *[count_true(F.col(flag)).alias(f"{flag}_count") for flag in spec.flags],
        F.min(spec.time).alias("first_seen"), F.max(spec.time).alias("last_seen"), *sums)


def _added(names: Sequence[str]) -> list[Column]:
    return [F.sum(name).alias(name) for name in names]


def gold_of_cells(cells: DataFrame, spec: EventSpec = INCIDENTS) -> dict[str, DataFrame]:
    """The aggregate tables of ``refresh_gold`` out of cells."""
    flags = [f"{flag}_count" for flag in spec.flags]
    types = cells.groupBy(spec.type).agg(
        *_added([spec.count, *flags]), F.min("first_seen").alias("first_seen"), F.max("last_seen").alias("last_seen"))
    types = rates(types, spec.flags, spec.count).withColumn(
        "frequency_bucket", threshold_bucket(F.col(spec.count), FREQUENCY_LEVELS, FREQUENCY_REST))
    pairs = cells.where(F.col(spec.region).isNotNull()).groupBy(spec.region, spec.type).agg(*_added(
        [spec.count, f"{spec.main_flag}_count", *[f"_{name}_{part}" for name in spec.coordinates for part in ("sum", "n")]]))
    hours = cells.where(F.col("hour_of_day").isNotNull()).groupBy("hour_of_day", spec.type).agg(*_added([spec.count]))
    return {"type_stats": types, "district_stats": regions_of_cells(pairs, spec), "hourly_stats": hours}


def refresh_changed(spark: SparkSession, silver_path: str, root: str, parts_root: str, schema: str,
                    spec: EventSpec = INCIDENTS, column: str = PARTITION) -> tuple[dict[str, DataFrame], list[str]]:
    """The tables of ``refresh_gold``, reading only partitions whose files have changed since the last call; and which those were.

    The cells of each partition are kept below ``parts_root`` under its value and the state of its files. An append, a rewrite or a
    removal changes the state; then cells are made anew under the new one, and those of old states are no longer read. The
    states are written last, so a run that fails makes the same cells again. ``schema`` is the clean table's, so
    that no footer is read for it; partitions whose names are not of its type do not occur. One caller at a time.

    The tables are then made of all cells, whose number follows regions, types and hours, not events. The listing
    is compared in the driver, one row a partition.
    """
    now = materialize(partition_states(spark, silver_path, column), "partition-states")
    seen_path, cells_path = f"{parts_root}/{SEEN}", f"{parts_root}/{CELLS}"
    changed = changed_parts(now, _seen(spark, seen_path))
    silver = spark.read.schema(schema).parquet(silver_path)
    # With something before it, as a folder named like a missing value would be read as one.
    marks = now.select(F.concat(F.lit("of-"), "part").alias("_part"), F.col("state").alias("_state"))
    if changed:
        cells = gold_cells(in_parts(silver, changed, column), spec, column).withColumn(
            "_part", F.concat(F.lit("of-"), F.coalesce(F.col(column).cast("string"), F.lit(_MISSING))))
        cells.join(F.broadcast(marks), "_part").write.mode("overwrite").option(
            "partitionOverwriteMode", "dynamic").partitionBy("_part", "_state").parquet(cells_path)
    kind = gold_cells(silver, spec, column).withColumns({"_part": F.lit(""), "_state": F.lit("")}).schema
    listed = [f"{row['_part']}/{row['_state']}" for row in marks.collect()]
    cells = spark.read.schema(kind).parquet(cells_path) if listed else spark.createDataFrame([], kind)
    current = cells.where(F.concat("_part", F.lit("/"), "_state").isin(listed))
    written = _written(spark, gold_of_cells(current, spec), root)
    now.coalesce(1).write.mode("overwrite").parquet(seen_path)
    return written, changed


def _seen(spark: SparkSession, path: str) -> DataFrame | None:
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    if not folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder):
        return None
    return spark.read.schema("part STRING, files BIGINT, state STRING").parquet(path)
