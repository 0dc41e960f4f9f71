"""Timestamps: device clocks, epoch values, offsets and calendar differences."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from orderloom.functions.text import col, trimmed, whole_number

# Fixed value: the server logs in UTC-8 all year, without daylight saving.
SERVER_OFFSET_HOURS = 8

_MAX_EPOCH_MILLIS = 253402300799999  # 9999-12-31
_MAX_EPOCH_SECONDS = 253402300799


def add_hours(ts: Column | str, hours: Column | int) -> Column:
    hours = F.lit(hours) if isinstance(hours, int) else hours
    return F.timestamp_add("HOUR", hours, col(ts))


def offset_hours(c: Column | str) -> Column:
    """Signed hours of a "GMT+8" style offset; NULL when there is none."""
    return whole_number(F.regexp_extract(col(c), r"GMT([+-][0-9]{1,2})", 1), "int")


def _millis(value: Column) -> Column:
    return F.when(F.abs(value) <= _MAX_EPOCH_MILLIS, F.timestamp_millis(value))


def epoch_millis(c: Column | str) -> Column:
    return _millis(whole_number(c))


def event_time(c: Column | str) -> Column:
    """Epoch seconds, epoch milliseconds (12 digits or more), else whatever casts to a timestamp.

    What does not cast, and an epoch past the year 9999, is NULL; `unparsed_event_times` lists
    those events.
    """
    text = trimmed(c)
    digits = whole_number(text)
    return (
        F.when(text.rlike(r"^[0-9]{12,}$"), _millis(digits))
        .when(
            text.rlike(r"^[0-9]+$"),
            F.when(digits <= _MAX_EPOCH_SECONDS, F.timestamp_seconds(digits)),
        )
        .otherwise(text.try_cast("timestamp"))
    )


def week_start(c: Column | str) -> Column:
    """Monday of the ISO week, as a date."""
    return F.date_trunc("week", col(c)).cast("date")


def day(c: Column | str) -> Column:
    return col(c).cast("date")


def days_between(start: Column | str, end: Column | str) -> Column:
    """Midnights crossed from start to end."""
    return F.datediff(col(end), col(start))


def minute_index(ts: Column | str) -> Column:
    return F.floor(F.unix_seconds(col(ts)) / 60)


def minutes_between(start: Column | str, end: Column | str) -> Column:
    """Minute boundaries crossed, not elapsed minutes: 00:00:59 to 00:01:00 is one.

    Being a difference of floors it adds up over consecutive events, so a burst's length is
    the sum of its steps and needs no second aggregation.
    """
    return minute_index(end) - minute_index(start)
