"""Timestamp expressions. Everything stays TIMESTAMP_NTZ, so results do not depend on the session time zone."""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.sql import Column, functions as F


def local_time(epoch_ms: Column | str, offset_hours: int = 0) -> Column:
    """Epoch milliseconds to naive local time with a fixed offset from UTC."""
    ms = F.col(epoch_ms) if isinstance(epoch_ms, str) else epoch_ms
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    seconds = (ms.cast("decimal(20,3)") / F.lit(1000).cast("decimal(5,0)")).cast("decimal(18,6)")
    return epoch + F.make_dt_interval(F.lit(0), F.lit(offset_hours), F.lit(0), seconds)


def bucket_start(ts: str, width: str) -> Column:
    """Start of the tumbling interval of ``width`` (such as ``1 hour``) that holds ``ts``.

    A row without a time lies in no interval: the plan drops it, also where only its area is asked for. Records that should count for their area
    alone need a time before they get here.
    """
    return F.window(F.col(ts), width).getField("start")


def ntz(value: str | date | datetime | Column) -> Column:
    """A naive timestamp from text, a date or a datetime."""
    if isinstance(value, Column):
        return value
    if isinstance(value, str):
        value = datetime.fromisoformat(value)
    elif not isinstance(value, datetime):
        value = datetime(value.year, value.month, value.day)
    return F.lit(value.isoformat(sep=" ")).cast("timestamp_ntz")


def day_after(value: str) -> datetime:
    """Midnight after the given date: the exclusive end of an inclusive date range."""
    return datetime.fromisoformat(value) + timedelta(days=1)


def within_dates(ts: Column, first_day: str, last_day: str) -> Column:
    """Half-open test ``[first_day, last_day + 1 day)``; both dates are inclusive."""
    return (ts >= ntz(first_day)) & (ts < ntz(day_after(last_day)))


def weekday(ts: Column) -> Column:
    """Day of week with Monday = 0."""
    return F.weekday(ts)


def slot_of_day(ts: Column, step_minutes: int) -> Column:
    """Index of the interval within its day."""
    return F.floor((F.hour(ts) * 60 + F.minute(ts)) / F.lit(step_minutes)).cast("int")
