"""Dated URL lists against captures: which entries were active when a page was fetched.

An entry's events, added or removed on a date, become validity intervals. A capture is looked up under its host, the domains
above it and its whole URL, in the interval that holds its time of fetching. Both sides meet on the pattern and
the month, so a join task compares a capture with the few intervals of that month only, and a host with very many captures
can be split over tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from millrace.session import materialize

ADDED, REMOVED = "added", "removed"
BLOCK, ALLOW = "block", "allow"
_HOST = r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]+)"


def host(url: Column) -> Column:
    """The host in lower case; empty where there is none."""
    return F.lower(F.coalesce(F.regexp_extract(url, _HOST, 1), F.lit("")))


def patterns(url: Column) -> Column:
    """What entries can match a URL: itself, its host, and every domain above the host, longest first."""
    labels = F.split(host(url), r"\.")
    above = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(
        F.slice(labels, i, F.size(labels)), "."))
    return F.array_distinct(F.filter(F.concat(F.array(url), above), lambda p: p != ""))


def intervals(events: DataFrame) -> DataFrame:
    """``list``, ``pattern``, ``kind``, ``valid_from`` and ``valid_to`` (exclusive, missing if still valid).

    ``events`` has list, pattern, kind (block or allow), event (added or removed) and on (a date). An entry holds from the day it is
    added up to the next event of the same list and pattern; removals of what is not there do nothing. Of events on
    one day the removal comes first. Events without pattern or date, and repeated ones, change nothing.
    """
    known = events.where(F.col("pattern").isNotNull() & F.col("on").isNotNull()).select(
        "list", "pattern", "kind", "event", "on").distinct()
    order = Window.partitionBy("list", "pattern").orderBy("on", F.desc("event"), "kind")
    until = known.withColumn("valid_to", F.lead("on").over(order))
    held = (F.col("event") == ADDED) & (F.col("valid_to").isNull() | (F.col("valid_to") > F.col("on")))
    return until.where(held).select("list", "pattern", "kind", F.col("on").alias("valid_from"), "valid_to")


def evaluate(captures: DataFrame, events: DataFrame, key: str = "page_id", url: str = "url",
             fetched: str = "fetched_on") -> DataFrame:
    """Per capture its key, URL and date, ``blocked``, ``rule`` (the pattern that decides), ``lists`` (of all active
    entries, sorted, comma-joined) and ``n_entries``.

    The longest active pattern decides; where it is both blocked and allowed, allowed. Without an active entry, a URL or a date a
    capture is not blocked. Repeated captures stay repeated; other columns are not returned.
    """
    rows = materialize(captures.select(
        F.col(key).alias("key"), F.col(url).alias("url"), F.col(fetched).alias("day")).withColumn(
            "row", F.monotonically_increasing_id()), "captures")
    last = rows.agg(F.max("day")).first()[0]
    valid = intervals(events)
    if last is not None:
        # Months from the first to the last day of validity, no later than the last capture's.
        ends = F.least(F.coalesce(F.date_sub("valid_to", 1), F.lit(last)), F.lit(last))
        months = F.when(F.col("valid_from") <= ends, F.sequence(
            F.trunc("valid_from", "month"), F.trunc(ends, "month"), F.expr("interval 1 month")))
        valid = valid.withColumn("month", F.explode(months))
    else:
        valid = valid.withColumn("month", F.trunc("valid_from", "month"))
    asked = rows.where(F.col("url").isNotNull() & F.col("day").isNotNull()).select(
        "row", "day", F.trunc("day", "month").alias("_month"), F.explode(patterns(F.col("url"))).alias("_pattern"))
    matched = asked.join(valid, (F.col("_pattern") == F.col("pattern")) & (F.col("_month") == F.col("month"))
                         & (F.col("day") >= F.col("valid_from"))
                         & (F.col("valid_to").isNull() | (F.col("day") < F.col("valid_to"))))
    rank = F.struct(F.length("pattern").alias("length"), (F.col("kind") == ALLOW).alias("allowed"), "pattern")
    decided = matched.groupBy("row").agg(
        F.max(rank).alias("top"), F.collect_set("list").alias("lists"), F.count("*").alias("n"))
    return rows.join(decided, "row", "left").select(
        F.col("key").alias(key), F.col("url").alias(url), F.col("day").alias(fetched),
        F.coalesce(~F.col("top.allowed"), F.lit(False)).alias("blocked"), F.col("top.pattern").alias("rule"),
        F.coalesce(F.array_join(F.array_sort("lists"), ","), F.lit("")).alias("lists"),
        F.coalesce("n", F.lit(0).cast("bigint")).alias("n_entries"))
