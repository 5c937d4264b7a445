"""Joins by time: the last row before another one, and spans that overlap."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from millrace.session import materialize

# Widths of bins grow by this factor from one level of lengths to the next.
LEVEL = 16


def asof_join(left: DataFrame, right: DataFrame, by: Sequence[str], time: str, prefix: str = "last_",
              order: Sequence[str] = (), keep_left: bool = True) -> DataFrame:
    """Each row of ``left`` with the last row of ``right`` of the same ``by`` whose ``time`` is not after its own.

    Columns of ``right`` are named with ``prefix``. Of right rows with one key and time the largest by ``order``, then by its
    remaining columns, counts, so the result does not hang on the partitioning; columns of types without an order cannot take part.
    Left rows without such a row, or without a key or a time, have missing values there, or go if not ``keep_left``.
    Repeated left rows stay repeated. Runs a job while it is planned.

    Both sides are sorted together into even slices by key and time, so that a key of very many rows is cut like any other. Inside a
    slice the last right row is carried along by a window; what it was when the slice began comes from the slices before. Only a
    key that reaches over a border has such a row, so there are no more of them than slices.
    """
    known = F.lit(True)
    for name in (*by, time):
        known = known & F.col(name).isNotNull()
    rest = [name for name in right.columns if name not in (*by, time, *order)]
    found = F.struct(*[F.col(name) for name in (time, *order, *rest, *by)])
    keys = [f"_key_{i}" for i in range(len(by))]

    def events(df: DataFrame, right_row: Column, left_row: Column) -> DataFrame:
        return df.select(*[F.col(name).alias(key) for name, key in zip(by, keys)], F.col(time).alias("_time"),
                         right_row.alias("_right"), left_row.alias("_left"))

    right_type, left_type = right.select(found.alias("s")).schema["s"].dataType, left.select(
        F.struct("*").alias("s")).schema["s"].dataType
    none = F.lit(None)
    both = events(right.where(known), found, none.cast(left_type)).unionByName(
        events(left.where(known), none.cast(right_type), F.struct(*[F.col(name) for name in left.columns])))
    # Right rows come before left ones of the same time.
    both = both.withColumn("_side", F.col("_left").isNotNull())
    slices = materialize(both.repartitionByRange(*keys, "_time", "_side").withColumn("_slice", F.spark_partition_id()), "asof")
    lasts = slices.groupBy("_slice", *keys).agg(F.max("_right").alias("_last"))
    earlier = Window.partitionBy(*keys).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    # At most one key reaches over each border, so these are no more than the slices.
    carried = lasts.withColumn("_carried", F.max("_last").over(earlier)).where("_carried IS NOT NULL").select(
        F.col("_slice").alias("_of_slice"), *[F.col(key).alias(f"_of{key}") for key in keys], "_carried")
    same = [F.col("_slice") == F.col("_of_slice"), *[F.col(key) == F.col(f"_of{key}") for key in keys]]
    # Equal times count whole: a window by range takes in all right rows of a time.
    inside = Window.partitionBy("_slice", *keys).orderBy("_time", "_side")
    placed = slices.withColumn("_inside", F.max("_right").over(inside.rangeBetween(Window.unboundedPreceding, Window.currentRow)))
    whole = placed.where("_side").join(F.broadcast(carried), same, "left").withColumn(
        "_match", F.greatest("_inside", "_carried"))
    names = [F.col(f"_match.{name}").alias(f"{prefix}{name}") for name in right.columns]
    matched = whole.select(*[F.col(f"_left.{name}").alias(name) for name in left.columns], *names, F.col("_match").isNotNull().alias("_found"))
    if not keep_left:
        return matched.where("_found").drop("_found")
    alone = left.where(~known).select(*left.columns, *[
        none.cast(right.schema[name].dataType).alias(f"{prefix}{name}") for name in right.columns])
    return matched.drop("_found").unionByName(alone)


def _levels(side: DataFrame) -> list[int]:
    return sorted(row[0] for row in side.select("_level").distinct().collect())


def interval_join(left: DataFrame, right: DataFrame, left_span: tuple[Column, Column], right_span: tuple[Column, Column],
                  by: Sequence[str] = (), prefix: str = "other_") -> DataFrame:
    """All pairs of a ``left`` and a ``right`` row, of the same ``by``, whose spans have a point in common.

    A span is a pair of whole numbers, first and last point (of times, their microseconds). Columns of ``right`` are named with ``prefix``.
    Rows whose span has a missing or no point, or whose key is missing, are in no pair; repeated rows each make pairs of their own.
    Runs jobs while it is planned, which measure the spans.

    Bins are as wide as the spans in them are long: lengths fall into levels, each ``LEVEL`` times the one below, from the
    shorter side's mean length on; at a level at least as long as itself a span touches two bins at most. Two spans meet at the longer one's level, in
    the bin where the later one begins, and nowhere else, so no pair is found twice, and a few very long spans
    cost a row a level and not a row for each short bin they cover.
    """
    sides = []
    for df, (first, last) in ((left, left_span), (right, right_span)):
        spans = df.withColumns({"_first": first.cast("bigint"), "_end": last.cast("bigint")}).where("_first <= _end")
        for name in by:
            spans = spans.where(F.col(name).isNotNull())
        sides.append(spans)
    means = [side.agg(F.avg(F.col("_end") - F.col("_first"))).first()[0] for side in sides]
    if None in means:
        means = [0.0, 0.0]
    least = max(1, int(min(means)) + 1)

    # A level's width by repeated multiplication, so that no logarithm decides about a border.
    widths = [least * LEVEL ** k for k in range(64) if least * LEVEL ** k < 1 << 62]
    level = F.lit(len(widths) - 1)
    for k in range(len(widths) - 2, -1, -1):
        level = F.when(F.col("_end") - F.col("_first") < widths[k], k).otherwise(level)
    sides = [side.withColumn("_level", level) for side in sides]
    there = [_levels(side) for side in sides]
    width = F.element_at(F.array(*[F.lit(w) for w in widths]), F.col("_at") + 1)

    def binned(side: DataFrame, own: list[int], others: list[int]) -> DataFrame:
        listed = F.array(*[F.lit(k) for k in sorted({*own, *others})]).cast("array<int>")
        at = side.withColumn("_at", F.explode(F.filter(listed, lambda k: k >= F.col("_level"))))
        # Whole numbers throughout: doubles would round large ones.
        wide = at.withColumn("_width", width)
        begins, ends = (F.expr(f"({point} - pmod({point}, _width)) div _width") for point in ("_first", "_end"))
        return wide.withColumn("_bin", F.explode(F.sequence(begins, ends)))

    one, other = binned(sides[0], *there), binned(sides[1], *there[::-1])
    renamed = other.select(*[F.col(name).alias(f"_other_{name}") for name in other.columns])
    same = (F.col("_at") == F.col("_other__at")) & (F.col("_bin") == F.col("_other__bin"))
    for name in by:
        same = same & (F.col(name) == F.col(f"_other_{name}"))
    overlap = (F.col("_first") <= F.col("_other__end")) & (F.col("_other__first") <= F.col("_end"))
    here = (F.greatest("_level", "_other__level") == F.col("_at")) & (
        F.expr("(greatest(_first, _other__first) - pmod(greatest(_first, _other__first), _width)) div _width") == F.col("_bin"))
    return one.join(renamed, same & overlap & here).select(
        *left.columns, *[F.col(f"_other_{name}").alias(f"{prefix}{name}") for name in right.columns])
