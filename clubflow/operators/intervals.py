"""Joins of points to intervals of the same key without forming all pairs."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clubflow.operators.ordered import running
from clubflow.operators.skew import LargeKeys

#: The days of the years 1 to 9999 form a binary tree of this height.
LEVELS = 22
#: Day number of 0001-01-01 and of 9999-12-31, the range of the date type.
_FIRST, _LAST = -719_162, 2_932_896


def inside_any(
    points: DataFrame,
    intervals: DataFrame,
    keys: Sequence[str],
    at: str,
    lo: str,
    hi: str,
    tie: str,
    hot: LargeKeys | None = None,
) -> DataFrame:
    """Keep points that lie in at least one closed interval ``[lo, hi]`` of their key.

    Points and interval starts are put in one order; the running maximum of the
    interval ends seen so far tells whether a point is covered. Linear in both
    inputs, however many intervals a key has.
    """
    starts = intervals.where(F.col(lo).isNotNull() & F.col(hi).isNotNull()).select(
        *keys, F.col(lo).alias("_at"), F.lit(0).alias("_kind"), F.col(hi).alias("_hi")
    )
    marked = points.withColumns({"_at": F.col(at), "_kind": F.lit(1)})
    both = marked.unionByName(starts, allowMissingColumns=True)
    reach = running(both, keys, ["_at", "_kind", tie], {"_reach": ("max", "_hi")}, hot=hot)
    return reach.where((F.col("_kind") == 1) & (F.col(at) <= F.col("_reach"))).select(
        *points.columns
    )


def _leaf(day: Column) -> Column:
    """Tree number of a day; node n has the children 2n and 2n + 1. NULL outside the range of the date type."""
    number = F.unix_date(day)
    return F.when(number.between(_FIRST, _LAST), number - _FIRST + 2**LEVELS)


def _with_nodes(df: DataFrame, start: str, end: str) -> DataFrame:
    """One row per tree node of the closed day range; the nodes are disjoint and cover it."""
    first, last = F.lit(2**LEVELS), F.lit(_LAST - _FIRST + 2**LEVELS)
    spans = df.withColumns(
        {
            # an interval that goes on beyond the range covers the range up to its end
            "_l": F.when(F.unix_date(F.col(start)) < _FIRST, first).otherwise(_leaf(F.col(start))),
            "_r": F.when(F.unix_date(F.col(end)) > _LAST, last).otherwise(_leaf(F.col(end))) + 1,
        }
    ).withColumn(
        "_level", F.explode(F.sequence(F.lit(0), F.lit(LEVELS)))
    )
    ends = spans.withColumns(
        {
            "_left": F.expr("shiftright(_l + shiftleft(1, _level) - 1, _level)"),
            "_right": F.expr("shiftright(_r, _level)"),
        }
    ).where(F.col("_left") < F.col("_right"))
    odd = lambda name: F.col(name) % 2 == 1
    picked = F.array(F.when(odd("_left"), F.col("_left")), F.when(odd("_right"), F.col("_right") - 1))
    return (
        ends.withColumn("_node", F.explode(picked))
        .where(F.col("_node").isNotNull())
        .drop("_l", "_r", "_level", "_left", "_right")
    )


def _with_ancestors(df: DataFrame, day: str) -> DataFrame:
    levels = df.withColumns(
        {"_leaf": _leaf(F.col(day)), "_level": F.explode(F.sequence(F.lit(0), F.lit(LEVELS)))}
    )
    return levels.withColumn("_node", F.expr("shiftright(_leaf, _level)")).drop("_leaf", "_level")


def max_over_covering(
    points: DataFrame,
    intervals: DataFrame,
    keys: Sequence[str],
    day: str,
    start: str,
    end: str,
    values: Mapping[str, str],
) -> DataFrame:
    """For every point, the maximum of each value over the intervals that cover its day.

    ``values`` maps new names to interval columns. Each interval is cut into at
    most ``2 * LEVELS`` tree nodes and reduced to one row per (key, node); each
    distinct (key, day) looks up its ``LEVELS + 1`` nodes. A key contributes
    at most two nodes and one day per day of the calendar, however many rows it has.
    """
    nodes = (
        _with_nodes(intervals.where(F.col(start) <= F.col(end)), start, end)
        .groupBy(*keys, "_node")
        .agg(*[F.max(c).alias(n) for n, c in values.items()])
    )
    days = points.select(*keys, F.col(day).alias("_day")).where(F.col("_day").isNotNull()).distinct()
    best = (
        _with_ancestors(days, "_day")
        .join(nodes, [*keys, "_node"])
        .groupBy(*keys, "_day")
        .agg(*[F.max(n).alias(n) for n in values])
    )
    return points.withColumn("_day", F.col(day)).join(best, [*keys, "_day"], "left").drop("_day")
