"""State that a stream keeps between micro-batches: first versions of keys, open windows, open sessions.

Every operator here states with ``delay`` how much later than the newest row a row may come. The watermark, that much
before the newest time seen, evicts what no row in time can change, so state grows with the rows of a delay and not
with the stream. What a stream has seen is in its checkpoint: started again with it, it goes on where it stopped. The number
of state partitions is fixed there too, by ``spark.sql.shuffle.partitions`` at the first start.

Rows without a time belong to no window: those of the windows and sessions are left out, and no copy is told from them.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

# Names of a window's two ends.
STARTS, ENDS = "window_start", "window_end"


def first_of_key(stream: DataFrame, key: Sequence[str], time: str, delay: str) -> DataFrame:
    """The first row to arrive of each key, ``time`` and ``delay`` deciding how long a key is remembered.

    A copy whose time is within ``delay`` of the first one's is dropped wherever the stream stands, and a restart
    forgets nothing. A copy after that may pass as a new row: whoever needs more looks at the target (``merge_new_keys``).
    Of copies in one micro-batch any may be the first. A missing key is a key like any other.
    """
    return stream.withWatermark(time, delay).dropDuplicatesWithinWatermark(list(key))


def windowed(rows: DataFrame, time: str, width: str, measures: Sequence[Column], by: Sequence[str] = (),
             slide: str | None = None, delay: str | None = None) -> DataFrame:
    """``measures`` per window of event time and ``by``; windows of ``width`` begin every ``slide``, or follow each other.

    The same in batch and, with ``delay``, in a stream. There a window is written once, when the watermark has passed its end;
    a row that comes after that is not in it (``late_rows`` counts those). Both combine in each task before
    they shuffle. Windows without rows do not exist.
    """
    source = rows.withWatermark(time, delay) if delay else rows
    window = F.window(F.col(time), width, slide)
    found = source.where(F.col(time).isNotNull()).groupBy(window.alias("_window"), *by).agg(*measures)
    return found.select(F.col("_window.start").alias(STARTS), F.col("_window.end").alias(ENDS), *[
        name for name in found.columns if name != "_window"])


Measures = Mapping[str, tuple[Column, Callable[[str], Column]]]


def sessions(rows: DataFrame, time: str, gap: int, measures: Measures, by: Sequence[str], delay: str | None = None) -> DataFrame:
    """``measures`` per session: rows of one ``by`` that follow each other by ``gap`` seconds at most; it ends ``gap`` after its last row.

    A measure is an aggregate over rows, and how parts of it are put together: ``{"n": (F.count("*"), F.sum)}``.

    The same in batch and, with ``delay``, in a stream, where a row may join two sessions that were open apart, and a
    session is written once, when the watermark has passed its end. In a stream ``build_session`` has rows merged into
    sessions in each task before the shuffle. In batch rows of the same stretch of time, as long as the gap and so in one
    session whatever else there is, are put together first: a very busy user is spread over its stretches, and then arrives
    as one row for each.
    """
    timed = rows.where(F.col(time).isNotNull())
    length = F.make_dt_interval(secs=F.lit(gap))
    if delay:
        source = timed.withWatermark(time, delay)
        found = source.groupBy(F.session_window(F.col(time), f"{gap} seconds").alias("_window"), *by).agg(
            *[part.alias(name) for name, (part, _) in measures.items()])
        return found.select(*by, F.col("_window.start").alias(STARTS), F.col("_window.end").alias(ENDS), *measures)
    stretch = F.floor(F.unix_micros(F.col(time)) / F.lit(gap * 1_000_000))
    parts = timed.groupBy(*by, stretch.alias("_stretch")).agg(
        F.min(time).alias("_first"), F.max(time).alias("_last"), *[part.alias(name) for name, (part, _) in measures.items()])
    order = Window.partitionBy(*by).orderBy("_stretch")
    opens = F.coalesce(F.col("_first") > F.lag("_last").over(order) + length, F.lit(True))
    numbered = parts.withColumn("_opens", opens.cast("bigint")).withColumn(
        "_session", F.sum("_opens").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    return numbered.groupBy(*by, "_session").agg(
        F.min("_first").alias(STARTS), (F.max("_last") + length).alias(ENDS),
        *[merge(name).alias(name) for name, (_, merge) in measures.items()]).drop("_session")


def late_rows(whole: DataFrame, written: DataFrame, count: str, by: Sequence[str] = (), late: str = "late_rows") -> DataFrame:
    """Windows in batch over all rows beside what a stream wrote of them: ``count`` as written, and how many rows came too late.

    ``whole`` comes from ``windowed`` over the stored rows, ``written`` from the stream; both have the row count ``count``. A window the
    stream has not written at all, because all its rows were late or because it is still open, has the count 0. One
    row a window and group is shuffled.
    """
    keys = [STARTS, ENDS, *by]
    both = whole.select(*keys, F.col(count).alias("_whole"), F.lit(0).cast("bigint").alias("_written")).unionByName(
        written.select(*keys, F.lit(0).cast("bigint").alias("_whole"), F.col(count).alias("_written")))
    return both.groupBy(*keys).agg(F.sum("_written").alias(count), (F.sum("_whole") - F.sum("_written")).alias(late))


def following(left: DataFrame, right: DataFrame, key: str, time: str, within: int, delay: str | None = None,
              when: Column | None = None) -> DataFrame:
    """Each row of ``left`` with the rows of ``right`` of the same ``key`` that come after it, by at most ``within`` seconds.

    Columns of ``right`` are named ``next_...``; ``when`` is a further condition over both. In a stream, with ``delay``, both sides are kept
    only as long as a partner may still come, and pairs are written as they are found. Rows without a key or a time have
    no partners, and in a stream they do not move the time; repeated rows each have theirs.

    Rows meet by key and by slice of time as long as ``within``, so that a key with very many rows is spread over its
    slices. A left row is put into its own slice and the next one, a right row into its own: no pair meets twice.
    """
    sides = [df.withWatermark(time, delay) if delay else df for df in (left, right)]
    seconds = F.floor(F.unix_micros(F.col(time).cast("timestamp")) / F.lit(within * 1_000_000))
    early = sides[0].withColumn("_slice", F.explode(F.array(seconds, seconds + 1)))
    late = sides[1].withColumn("_next_slice", seconds).select(
        *[F.col(name).alias(f"next_{name}") for name in right.columns], "_next_slice")
    near = (F.col(f"next_{time}") > F.col(time)) & (
        F.col(f"next_{time}") <= F.col(time) + F.make_dt_interval(secs=F.lit(within)))
    same = (F.col(key) == F.col(f"next_{key}")) & (F.col("_slice") == F.col("_next_slice"))
    joined = early.join(late, same & near if when is None else same & near & when)
    return joined.drop("_slice", "_next_slice")


def nearest(pairs: DataFrame, row: Sequence[str], time: str, order: Sequence[str]) -> DataFrame:
    """Of each row's partners the one that comes first, by ``order``; in a stream when the watermark has passed the row's ``time``.

    ``row`` identifies the left row, ``time`` included; the result has these columns and those of ``order``.
    """
    first = F.min(F.struct(*order)).alias("_first")
    found = pairs.groupBy(*row).agg(first)
    return found.select(*row, *[F.col(f"_first.{name}").alias(name) for name in order])
