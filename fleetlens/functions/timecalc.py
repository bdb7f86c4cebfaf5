"""Calendar arithmetic the built-in functions do not cover directly."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_timestamp(value: str | dt.datetime | dt.date | Column) -> Column:
    """A literal clock (``as_of``) as a timestamp column."""
    if isinstance(value, Column):
        return value
    return F.lit(str(value)).cast("timestamp")


def age_day_part(now: Column, then: Column) -> Column:
    """Day component (0-30) of the calendar difference ``now - then``.

    Borrowing takes the length of the month that ``then`` lies in.
    """
    time_of_day = lambda c: F.unix_micros(c) - F.unix_micros(F.date_trunc("day", c))
    days = F.dayofmonth(now) - F.dayofmonth(then) - (time_of_day(now) < time_of_day(then)).cast("int")
    return F.when(days < 0, days + F.dayofmonth(F.last_day(then))).otherwise(days)


def iso_week(col: Column) -> Column:
    """Partition label ``w<ISO year><ISO week>``; the ISO year is that of the week's Thursday."""
    thursday = F.date_add(F.date_trunc("week", col).cast("date"), 3)
    return F.concat(F.lit("w"), F.date_format(thursday, "yyyy"), F.lpad(F.weekofyear(thursday).cast("string"), 2, "0"))


def iso_week_of(value: dt.date) -> str:
    """The same label for a Python date; used to build partition filters."""
    year, week, _ = value.isocalendar()
    return f"w{year:04d}{week:02d}"


def floor_minutes(col: Column, minutes: int = 5) -> Column:
    """Floor to a multiple of ``minutes`` inside the hour."""
    micros = minutes * 60 * 1_000_000
    return F.timestamp_micros(F.unix_micros(col) - F.pmod(F.unix_micros(col), F.lit(micros)))


def minutes_between(start: Column, end: Column) -> Column:
    """Whole minutes, rounded towards minus infinity."""
    return F.floor((F.unix_micros(end) - F.unix_micros(start)) / F.lit(60_000_000)).cast("int")
