"""Calendar grids and monthly flows."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clubflow.functions.dates import hour_start, month_start


def months_of(days: DataFrame, day: str, start: dt.date | None, as_of: dt.date) -> DataFrame:
    """Distinct month starts of a date dimension between two dates."""
    kept = days.where(F.col(day) <= F.lit(as_of))
    if start is not None:
        kept = kept.where(F.col(day) >= F.lit(start))
    return kept.select(month_start(F.col(day)).alias("date")).distinct()


def month_grid(dim: DataFrame, start: dt.date, as_of: dt.date, name: str = "date") -> DataFrame:
    """Every row of a dimension for every month: an explode, not a cross join."""
    months = F.sequence(
        F.lit(start.replace(day=1)), F.lit(as_of.replace(day=1)), F.expr("INTERVAL 1 MONTH")
    )
    return dim.withColumn(name, F.explode(months))


def explode_hours(df: DataFrame, start: str, end: str, name: str) -> DataFrame:
    """One row per hour the closed span touches; none when it ends before it starts."""
    hours = F.sequence(hour_start(F.col(start)), hour_start(F.col(end)), F.expr("INTERVAL 1 HOUR"))
    span = F.when(hour_start(F.col(start)) <= hour_start(F.col(end)), hours)
    return df.withColumn(name, F.explode(span))


def monthly_sum(df: DataFrame, when: str, keys: dict[str, str], flag: str, name: str) -> DataFrame:
    """Sum a 0/1 flag by month of ``when`` and the given columns (``{new: source}``)."""
    return (
        df.where(F.col(flag) == 1)
        .groupBy(
            month_start(F.col(when)).alias("date"), *[F.col(c).alias(n) for n, c in keys.items()]
        )
        .agg(F.sum(flag).alias(name))
    )


def full_join(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Full outer join with the keys of whichever side is present (NULL keys never match)."""
    return left.join(right, keys, "full")


def zero(c: str) -> Column:
    return F.coalesce(F.col(c), F.lit(0))
