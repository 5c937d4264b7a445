"""Aggregate tables by type, region and hour."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from millrace.functions.buckets import (
    FREQUENCY_LEVELS, FREQUENCY_REST, SIZE_LEVELS, SIZE_REST, threshold_bucket,
)
from millrace.spec import INCIDENTS, EventSpec


def count_true(flag: Column) -> Column:
    """Rows where the flag is true; NULL counts as false. Zero, not NULL, for no rows."""
    return F.count_if(flag)


def rates(df: DataFrame, flags: tuple[str, ...], total: str) -> DataFrame:
    """Share of true rows per flag, from the counts."""
    return df.withColumns({
        f"{flag}_rate": F.try_divide(F.col(f"{flag}_count"), F.col(total)) for flag in flags
    })


def type_stats(df: DataFrame, spec: EventSpec = INCIDENTS,
               levels=FREQUENCY_LEVELS, rest: str = FREQUENCY_REST) -> DataFrame:
    """Per type: events, true flags, first and last time, rates, frequency class."""
    stats = df.groupBy(spec.type).agg(
        F.count("*").alias(spec.count),
        *[count_true(F.col(flag)).alias(f"{flag}_count") for flag in spec.flags],
        F.min(spec.time).alias("first_seen"),
        F.max(spec.time).alias("last_seen"),
    )
    return rates(stats, spec.flags, spec.count).withColumn(
        "frequency_bucket", threshold_bucket(F.col(spec.count), levels, rest))


def region_type_cells(df: DataFrame, spec: EventSpec = INCIDENTS) -> DataFrame:
    """Everything the region tables need, added up per region and type in one scan."""
    sums = []
    for name in spec.coordinates:
        sums += [F.sum(name).alias(f"_{name}_sum"), F.count(name).alias(f"_{name}_n")]
    return df.where(F.col(spec.region).isNotNull()).groupBy(spec.region, spec.type).agg(
        F.count("*").alias(spec.count),
        count_true(F.col(spec.main_flag)).alias(f"{spec.main_flag}_count"),
        *sums,
    )


def region_stats(df: DataFrame, spec: EventSpec = INCIDENTS,
                 levels=SIZE_LEVELS, rest: str = SIZE_REST) -> DataFrame:
    """Per region: events, rate, centre, number of types, most frequent type, size class.

    One scan: the region/type cells are rolled up to regions, and the winner among the types
    comes out of the same roll-up, so the winner needs neither a second scan nor a join.
    """
    return regions_of_cells(region_type_cells(df, spec), spec, levels, rest)


def regions_of_cells(cells: DataFrame, spec: EventSpec = INCIDENTS,
                     levels=SIZE_LEVELS, rest: str = SIZE_REST) -> DataFrame:
    """The region table out of its cells, one row per region and type."""
    top = f"top_{spec.type}"
    # The smallest (-count, type) is the highest count, then the first name.
    standing = F.struct(-F.col(spec.count), F.col(spec.type))
    rolled = cells.groupBy(spec.region).agg(
        F.sum(spec.count).alias(spec.count),
        F.sum(f"{spec.main_flag}_count").alias(f"{spec.main_flag}_count"),
        *[F.try_divide(F.sum(f"_{name}_sum"), F.sum(f"_{name}_n")).alias(f"avg_{name}")
          for name in spec.coordinates],
        F.count(spec.type).alias("unique_types"),
        F.min_by(F.struct(F.col(spec.type), F.col(spec.count)), standing).alias("_top"),
    )
    rolled = rolled.withColumns({
        top: F.col("_top").getField(spec.type),
        f"{top}_count": F.col("_top").getField(spec.count),
    }).drop("_top")
    return rates(rolled, (spec.main_flag,), spec.count).withColumn(
        "size_bucket", threshold_bucket(F.col(spec.count), levels, rest))


def top_type_per_region(df: DataFrame, spec: EventSpec = INCIDENTS) -> DataFrame:
    """The most frequent type of each region; equal counts go to the first name."""
    counts = df.where(F.col(spec.region).isNotNull()).groupBy(spec.region, spec.type).agg(
        F.count("*").alias("_n"))
    order = Window.partitionBy(spec.region).orderBy(F.desc("_n"), F.asc(spec.type))
    ranked = counts.withColumn("_rank", F.row_number().over(order)).where("_rank = 1")
    top = f"top_{spec.type}"
    return ranked.select(spec.region, F.col(spec.type).alias(top), F.col("_n").alias(f"{top}_count"))


def with_winner(base: DataFrame, winner: DataFrame, key: str) -> DataFrame:
    """Per-group table extended by each group's winner; groups without one keep NULLs.

    Both sides hold a key once, so no key is hot; Spark broadcasts the winner side by itself when
    its size at run time allows.
    """
    return base.join(winner, key, "left")


def hourly_stats(df: DataFrame, spec: EventSpec = INCIDENTS) -> DataFrame:
    """Events per hour of day and type; the filter on the group key reaches the scan."""
    counts = df.groupBy("hour_of_day", spec.type).agg(F.count("*").alias(spec.count))
    return counts.where(F.col("hour_of_day").isNotNull())


def roll_up(cells: DataFrame, key: str, count: str = INCIDENTS.count) -> DataFrame:
    """Counts of a finer aggregate added up per ``key``, without going back to the events."""
    return cells.groupBy(key).agg(F.sum(count).alias(count))
