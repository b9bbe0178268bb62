"""Date and time expressions with the semantics the marts rely on."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# Dates are stored modulo 65,536 days, day numbers from 39,969 on
# stand for days before 1970.
BIRTHDAY_WRAP_FROM = 39_969
BIRTHDAY_WRAP_DAYS = 65_536


def ntz(value: dt.datetime) -> Column:
    """A wall clock literal; it stays a constant, so filters on it reach the scan."""
    return F.lit(value.isoformat(sep=" ")).cast("timestamp_ntz")


def month_start(c: Column) -> Column:
    return F.trunc(c, "MM")


def hour_start(c: Column) -> Column:
    # date_trunc returns a zoned timestamp; keep the wall clock type
    return F.date_trunc("hour", c).cast("timestamp_ntz")


def shift_hours(c: Column, hours: int) -> Column:
    """Move a wall clock time by a fixed number of hours (local business time)."""
    return c + F.expr(f"INTERVAL {int(hours)} HOUR")


def epoch_seconds(c: Column) -> Column:
    """Whole seconds since 1970, truncated to the second."""
    return F.unix_seconds(F.date_trunc("second", c).cast("timestamp"))


def days_between(a: Column, b: Column) -> Column:
    """Midnights crossed from ``a`` to ``b``."""
    return F.datediff(b, a)


def seconds_between(a: Column, b: Column) -> Column:
    return epoch_seconds(b) - epoch_seconds(a)


def minutes_between(a: Column, b: Column) -> Column:
    """Minute boundaries crossed from ``a`` to ``b``."""
    return F.floor(epoch_seconds(b) / 60) - F.floor(epoch_seconds(a) / 60)


def months_between(a: Column, b: Column) -> Column:
    """Month boundaries crossed from ``a`` to ``b``."""
    return (F.year(b) - F.year(a)) * 12 + (F.month(b) - F.month(a))


def days_in_month(c: Column) -> Column:
    return F.dayofmonth(F.last_day(c))


def repair_birthday(c: Column) -> Column:
    """Undo the 65,536-day wrap of stored birth dates; NULL stays NULL."""
    n = F.unix_date(c)
    return F.when(
        n >= BIRTHDAY_WRAP_FROM, F.date_from_unix_date(n - BIRTHDAY_WRAP_DAYS)
    ).otherwise(c)
