"""Number expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def ratio(a: Column, b: Column) -> Column:
    """Double division, NULL for a zero divisor."""
    return F.try_divide(a.cast("double"), b.cast("double"))


def round_even(c: Column, places: int = 0) -> Column:
    """Round a double, halves to the even digit."""
    return F.bround(c, places)


def exact_quantile(values: Column, p: float) -> Column:
    """Element floor(p * n) of the sorted array, no interpolation; NULLs are not counted."""
    present = F.array_sort(F.filter(values, lambda x: x.isNotNull()))
    n = F.size(present)
    at = F.least(F.floor(F.lit(p) * n).cast("int"), n - 1)
    return F.when(n > 0, F.try_element_at(present, at + 1))


def exact_mean(c: Column, places: int = 9) -> Column:
    """Mean of doubles through decimals: the same result in whatever order rows arrive."""
    return ratio(F.sum(c.cast(f"decimal(28,{places})")), F.count(c))
