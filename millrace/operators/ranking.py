"""Running totals over a whole sorted table, without one task holding a whole group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from millrace.session import broadcast_if_small, materialize

# Largest table of slice sums sent to every executor, in rows.
MOST_SUMS = 100_000


def running_totals(df: DataFrame, group: Sequence[str], order: Sequence[str],
                   measures: Sequence[str], below: int | None = None) -> DataFrame:
    """Adds ``before_<measure>``: the sum over the group's rows that sort earlier. Runs jobs while it is planned.

    ``below`` drops the slices that start at that sum of the first measure or later, before
    anything of them is shuffled again; rows of the last slice kept may still reach it.

    ``group`` plus ``order`` must be unique, so that a range shuffle can cut even the largest
    group into slices of equal size. Each slice is summed, the sums of the slices before it are
    added up (a table as small as the number of slices), and only within a slice does a window
    run. The slices are written to the shared folder first: a slice number is only good for one
    shuffle, and both uses must see the same one.
    """
    cut = df.repartitionByRange(*map(F.col, [*group, *order]))
    slices = materialize(cut.withColumn("_slice", F.spark_partition_id()), "slices")
    keys = [*group, "_slice"]
    sums = materialize(
        slices.groupBy(*keys).agg(*[F.sum(name).alias(name) for name in measures]), "slice-sums")
    earlier = Window.partitionBy(*group).orderBy("_slice").rowsBetween(
        Window.unboundedPreceding, -1)
    offsets = sums.select(*[F.col(name).alias(f"_of_{name}") for name in keys], *[
        F.coalesce(F.sum(name).over(earlier), F.lit(0)).alias(f"_offset_{name}")
        for name in measures])
    # A missing group value is a group like any other.
    same = [F.col(name).eqNullSafe(F.col(f"_of_{name}")) for name in keys]
    inside = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    # With few groups the sums are as few as the slices; then only the window shuffles.
    placed = slices.join(broadcast_if_small(offsets, MOST_SUMS), same)
    if below is not None:
        placed = placed.where(F.col(f"_offset_{measures[0]}") < below)
    summed = placed.withColumns({
        f"before_{name}":
            F.col(f"_offset_{name}") + F.coalesce(F.sum(name).over(inside), F.lit(0))
        for name in measures})
    return summed.select(*df.columns, *[f"before_{name}" for name in measures])


def running_maximum(df: DataFrame, order: Sequence[str], value: str, name: str) -> DataFrame:
    """Adds ``name``: the largest ``value`` of all rows that sort earlier by ``order``, none for the first; missing values are passed over.

    ``order`` must be unique. Runs a job while it is planned. As in ``running_totals`` a range shuffle cuts the rows into even
    slices; each begins with the largest value of the slices before it.
    """
    slices = materialize(df.repartitionByRange(*order).withColumn("_slice", F.spark_partition_id()), "slices")
    tops = slices.groupBy("_slice").agg(F.max(value).alias("_top"))
    earlier = Window.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)  # one row a slice
    before = tops.select(F.col("_slice").alias("_of_slice"), F.max("_top").over(earlier).alias("_before"))
    inside = Window.partitionBy("_slice").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    placed = slices.join(broadcast_if_small(before, MOST_SUMS), F.col("_slice") == F.col("_of_slice"))
    return placed.withColumn(name, F.greatest("_before", F.max(value).over(inside))).select(*df.columns, name)


# Number of top lists between the tasks' own ones and the last; size of one written-out chunk.
_LISTS = 256
_CHUNK = 100_000
# Largest limit that goes through top lists; up to this rank Spark keeps each task's own top rows
# before a window's shuffle.
LISTED = 1_000


def first_rows(df: DataFrame, order: Sequence[str], n: int) -> DataFrame:
    """The ``n`` rows that come first by ``order``, then by the remaining columns.

    Which rows these are is the result; in which order they come out is not part of it. All columns
    must be of types that can be ordered, so no maps. Large limits run jobs while they are planned.

    Small limits are a top-k in two steps: the tasks' own first ``n`` rows meet in a fixed number
    of lists before the last step sees them, so that step does not grow with the number of tasks.
    Beyond that, running totals over the leading column's counts give its last value needed, so
    that only this one column of the whole table is shuffled. Of the rows up to that value, equal
    ones are counted, positions come from running totals again, and only the rows below the cut
    are written out: no task ever holds ``n`` rows.
    """
    total_order = [*order, *[name for name in df.columns if name not in order]]
    if n <= LISTED:
        lists = df.withColumn("_list", F.spark_partition_id() % _LISTS)
        place = F.row_number().over(Window.partitionBy("_list").orderBy(*total_order))
        firsts = lists.withColumn("_place", place).where(F.col("_place") <= n)
        return firsts.select(*df.columns).orderBy(*total_order).limit(n)  # one task, n rows per list
    lead = order[0]
    values = df.groupBy(lead).agg(F.count("*").alias("_copies"))
    needed = running_totals(values, [], [lead], ["_copies"], below=n)
    last = needed.where(F.col("before__copies") < n).agg(F.max(lead)).scalar()
    candidates = df.where(F.col(lead).isNull() | (F.col(lead) <= last))
    copies = candidates.groupBy(*total_order).agg(F.count("*").alias("_copies"))
    placed = running_totals(copies, [], total_order, ["_copies"], below=n)
    kept = placed.withColumn("_kept", F.least("_copies", F.lit(n) - F.col("before__copies")))
    # Copies are written out in two steps, so that no array grows with the number of copies.
    chunks = kept.where("_kept > 0").withColumn(
        "_from", F.explode(F.sequence(F.lit(0), F.col("_kept") - 1, F.lit(_CHUNK).cast("bigint"))))
    single = chunks.withColumn("_one", F.explode(F.sequence(
        F.lit(1).cast("bigint"), F.least(F.lit(_CHUNK), F.col("_kept") - F.col("_from")))))
    return single.select(*df.columns)
