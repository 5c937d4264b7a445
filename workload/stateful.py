"""Streams with state, drained in waves over the whole event table; each wave starts from the checkpoint of the one before."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from millrace.functions.calendar import instant_wall, wall_instant
from millrace.session import scratch_path
from millrace.streaming import state
from millrace.streaming.run import drain
from workload import Query
from workload.bindings import table

# The first wave ends here; one event in so many of its time is held back and comes with the second.
CUT, HELD = "2024-01-16 00:00:00", 20
DELAY, DELAY_SQL = "2 hours", "INTERVAL 2 HOUR"


def timed_events(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").select("event_id", "user_id", "event_type", "value", wall_instant(F.col("ts")).alias("at"))


def in_waves(events: DataFrame) -> list[DataFrame]:
    """Events before the cut, then all others and those held back, then one that only tells the time."""
    early = (F.col("at") < wall_instant(F.lit(CUT).cast("timestamp_ntz"))) & (F.col("event_id") % HELD != 0)
    clock = events.agg(F.max("at").alias("at")).where("at IS NOT NULL").select(*[
        (F.col("at") + F.expr("INTERVAL 400 DAYS") if name == "at" else F.lit(None).cast(kind)).alias(name)
        for name, kind in events.dtypes])
    return [events.where(early), events.where(~early), clock]


def streamed(waves: list[DataFrame], build: Callable[[DataFrame], DataFrame], label: str) -> DataFrame:
    """What a stream over the waves has written once all are drained."""
    spark = waves[0].sparkSession
    source, found, checkpoint = (scratch_path(spark, f"{label}-{part}") for part in ("source", "found", "checkpoint"))
    schema = None
    for wave in waves:
        wave.write.mode("append").parquet(source)
        rows = build(spark.readStream.schema(wave.schema).parquet(source))
        schema = rows.schema
        drain(rows.writeStream.format("parquet").option("path", found).option("checkpointLocation", checkpoint))
    return spark.read.schema(schema).parquet(found)


def _walls(df: DataFrame, *times: str) -> DataFrame:
    return df.withColumns({name: instant_wall(F.col(name)) for name in times})


def stream_dedup(spark, sf):
    """Every third event is sent again with a time 20 minutes later."""
    events = timed_events(spark, sf)
    again = events.where("event_id % 3 = 0").withColumn("at", F.col("at") + F.expr("INTERVAL 20 MINUTES"))
    cut = wall_instant(F.lit(CUT).cast("timestamp_ntz"))
    sent = events.unionByName(again)
    waves = [sent.where(F.col("at") < cut), sent.where(F.col("at") >= cut)]
    return streamed(waves, lambda rows: state.first_of_key(rows, ["event_id"], "at", "1 hour").drop("at"), "dedup")


def _windows(spark, sf, slide):
    events = timed_events(spark, sf)
    written = streamed(in_waves(events), lambda rows: state.windowed(
        rows, "at", "1 hour", [F.count("*").alias("n")], ["event_type"], slide, DELAY), "windows")
    whole = state.windowed(events, "at", "1 hour", [F.count("*").alias("n")], ["event_type"], slide)
    return _walls(state.late_rows(whole, written, "n", ["event_type"]), state.STARTS, state.ENDS)


def stream_tumbling(spark, sf):
    return _windows(spark, sf, None)


def stream_sliding(spark, sf):
    return _windows(spark, sf, "15 minutes")


GAP, GAP_SQL = 90 * 60, "INTERVAL 90 MINUTE"


def _sessions(rows: DataFrame, delay: str | None = None) -> DataFrame:
    return state.sessions(
        rows, "at", GAP, {"n": (F.count("*"), F.sum), "ids": (F.sum("event_id"), F.sum)}, ["user_id"], delay)


def user_sessions(spark, sf):
    return _walls(_sessions(timed_events(spark, sf)), state.STARTS, state.ENDS)


def stream_sessions(spark, sf):
    """In waves in order of time, so that no row is late; sessions that are open between them go on."""
    events = timed_events(spark, sf)
    early = F.col("at") < wall_instant(F.lit(CUT).cast("timestamp_ntz"))
    waves = [events.where(early), events.where(~early), in_waves(events)[2]]
    return _walls(streamed(waves, lambda rows: _sessions(rows, DELAY), "sessions"), state.STARTS, state.ENDS)


WITHIN = 3600


def _following(rows: DataFrame, delay: str | None = None) -> DataFrame:
    events = rows.select("event_id", "user_id", "event_type", "at")
    pairs = state.following(events, events, "user_id", "at", WITHIN, delay, F.col("event_type") != F.col("next_event_type"))
    return state.nearest(pairs, ["event_id", "event_type", "at"], "at", ["next_at", "next_event_id", "next_event_type"])


def next_of_other_type(spark, sf):
    return _walls(_following(timed_events(spark, sf)), "at", "next_at")


def stream_next_of_other_type(spark, sf):
    events = timed_events(spark, sf)
    early = F.col("at") < wall_instant(F.lit(CUT).cast("timestamp_ntz"))
    # Rows without a key are filtered before they are looked at for the time, so the clock needs one.
    clock = in_waves(events)[2].fillna({"user_id": -1, "event_type": ""})
    waves = [events.where(early), events.where(~early), clock]
    return _walls(streamed(waves, lambda rows: _following(rows, DELAY), "following"), "at", "next_at")


def _windows_sql(starts: str) -> str:
    return f"""
WITH waves AS (SELECT *, NOT (ts < TIMESTAMP '{CUT}' AND event_id % {HELD} <> 0) AS second FROM events),
mark AS (SELECT max(ts) - {DELAY_SQL} AS mark FROM waves WHERE NOT second),
placed AS (SELECT *, unnest({starts}) AS window_start FROM waves),
told AS (SELECT *, coalesce(second AND window_start + INTERVAL 1 HOUR <= mark, FALSE) AS late FROM placed, mark)
SELECT window_start, window_start + INTERVAL 1 HOUR AS window_end, event_type, count(*) FILTER (NOT late) AS n,
       count(*) FILTER (late) AS late_rows
FROM told GROUP BY window_start, event_type"""


_SESSIONS_SQL = f"""
WITH marked AS (
    SELECT *, coalesce(ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) > {GAP_SQL}, TRUE) AS opens FROM events),
numbered AS (SELECT *, sum(opens::INT) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS s FROM marked)
SELECT user_id, min(ts) AS window_start, max(ts) + {GAP_SQL} AS window_end, count(*) AS n, CAST(sum(event_id) AS BIGINT) AS ids
FROM numbered GROUP BY user_id, s"""

_FOLLOWING_SQL = f"""
SELECT a.event_id, a.event_type, a.ts AS at, first(b.ts ORDER BY b.ts, b.event_id) AS next_at,
       first(b.event_id ORDER BY b.ts, b.event_id) AS next_event_id,
       first(b.event_type ORDER BY b.ts, b.event_id) AS next_event_type
FROM events a JOIN events b ON a.user_id = b.user_id AND b.ts > a.ts AND b.ts <= a.ts + INTERVAL {WITHIN} SECOND
     AND a.event_type <> b.event_type
GROUP BY a.event_id, a.event_type, a.ts"""

QUERIES = {
    "stream_dedup": Query(stream_dedup, "SELECT event_id, user_id, event_type, value FROM events"),
    "stream_tumbling": Query(stream_tumbling, _windows_sql("[date_trunc('hour', ts)]")),
    "stream_sliding": Query(stream_sliding, _windows_sql(
        "[time_bucket(INTERVAL 15 MINUTE, ts) - k * INTERVAL 15 MINUTE for k in range(4)]")),
    "user_sessions": Query(user_sessions, _SESSIONS_SQL),
    "stream_sessions": Query(stream_sessions, _SESSIONS_SQL),
    "next_of_other_type": Query(next_of_other_type, _FOLLOWING_SQL),
    "stream_next_of_other_type": Query(stream_next_of_other_type, _FOLLOWING_SQL),
}
