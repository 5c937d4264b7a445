"""Event time and its calendar parts.

Event time is a ``timestamp_ntz``: the wall clock written in the source, the same on every
session time zone.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

_EPOCH = "1970-01-01 00:00:00"
# Spark's ``dayofweek`` numbers.
SUNDAY, SATURDAY = 1, 7
# First and last hour of the night.
NIGHT_FROM, NIGHT_TO = 22, 5
DAY_NAMES = (
    "Sunday", "Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday",
)


def wall_clock(millis: Column) -> Column:
    """Epoch milliseconds to wall-clock time."""
    millisecond = F.make_dt_interval(secs=F.lit("0.001").cast("decimal(18,6)"))
    return F.lit(_EPOCH).cast("timestamp_ntz") + millisecond * millis


def calendar_parts(time: Column) -> dict[str, Column]:
    return {
        "event_year": F.year(time),
        "hour_of_day": F.hour(time),
        "day_of_week": F.dayofweek(time),
        "month": F.month(time),
    }


def is_weekend(day_of_week: Column) -> Column:
    return F.when(day_of_week.isin(SUNDAY, SATURDAY), 1).otherwise(0)


def is_night(hour: Column) -> Column:
    """1 from the first hour of the night through its last."""
    return F.when((hour >= NIGHT_FROM) | (hour <= NIGHT_TO), 1).otherwise(0)


def day_name(day_of_week: Column, names: tuple[str, ...] = DAY_NAMES) -> Column:
    return F.element_at(F.array(*map(F.lit, names)), day_of_week)


def wall_millis(time: Column) -> Column:
    """The inverse of ``wall_clock``, cut to whole milliseconds."""
    since = time - F.lit(_EPOCH).cast("timestamp_ntz")

    def part(unit: str) -> Column:
        return F.extract(F.lit(unit), since)

    minutes = (part("DAY").cast("bigint") * 24 + part("HOUR")) * 60 + part("MINUTE")
    return minutes * 60_000 + F.floor(part("SECOND") * 1000).cast("bigint")


def wall_instant(time: Column) -> Column:
    """Wall-clock time as the instant it is in UTC, in whatever zone the session is; watermarks need instants."""
    since = time - F.lit(_EPOCH).cast("timestamp_ntz")
    days, hours, minutes = (F.extract(F.lit(unit), since).cast("bigint") for unit in ("DAY", "HOUR", "MINUTE"))
    seconds = F.extract(F.lit("SECOND"), since)
    return F.timestamp_micros(((days * 24 + hours) * 60 + minutes) * 60_000_000 + (seconds * 1_000_000).cast("bigint"))


def instant_wall(instant: Column) -> Column:
    """The inverse of ``wall_instant``."""
    microsecond = F.make_dt_interval(secs=F.lit("0.000001").cast("decimal(18,6)"))
    return F.lit(_EPOCH).cast("timestamp_ntz") + microsecond * F.unix_micros(instant)
