"""Row-order operators: neighbours, ranks, running values, sessions.

Every function takes the key columns and a list of ascending ordering columns
(NULLs last) that is unique within a key. With ``hot=None`` it is one plain
window: one shuffle on the key. With ``skew.LargeKeys`` the
large keys are cut into segments and the segments exchange summaries only.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.window import WindowSpec

from clubflow.functions.dates import seconds_between
from clubflow.operators.skew import SEGMENT, LargeKeys, attach, segmented, without_hot
from clubflow.session import stored


def _sorted(order: Sequence[str]) -> list[Column]:
    return [F.col(c).asc_nulls_last() for c in order]


def _rank_key(order: Sequence[str]) -> Column:
    """A struct that compares like the ordering with NULLs last."""
    return F.struct(*[x for c in order for x in (F.col(c).isNull(), F.col(c))])


def window(keys: Sequence[str], order: Sequence[str]) -> WindowSpec:
    return Window.partitionBy(*keys).orderBy(*_sorted(order))


def in_order(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    build: Callable[[DataFrame, bool], DataFrame],
    hot: LargeKeys | None,
) -> DataFrame:
    """Run ordered steps with large keys taken apart once for all of them.

    ``build(rows, cut)`` chains the step functions below. Ordinary keys take the
    plain windows; rows of large keys are cut into segments along the whole
    ordering, and both results are put together. With large keys the input is
    written once, as it is read several times. Running sums of doubles can then
    differ in the last bits; decimals and whole numbers do not.
    """
    if hot is None:
        return build(df, False)
    df = stored(df, "ordered")
    plain = build(without_hot(df, keys, hot), False)
    split = build(segmented(df, keys, order, hot), True).drop(SEGMENT)
    return plain.unionByName(split)


def neighbours_step(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    lag: Mapping[str, str] | None = None,
    lead: Mapping[str, str] | None = None,
    cut: bool = False,
) -> DataFrame:
    lag, lead = lag or {}, lead or {}
    w = window([*keys, SEGMENT] if cut else keys, order)
    near = {n: F.lag(c).over(w) for n, c in lag.items()} | {n: F.lead(c).over(w) for n, c in lead.items()}
    if not cut:
        return df.withColumns(near)
    by = _rank_key(order)
    rows = df.withColumns(
        near
        | {
            "_segment_head": F.lag(F.lit(1)).over(w).isNull(),
            "_segment_tail": F.lead(F.lit(1)).over(w).isNull(),
        }
    )
    picked = lambda names: F.struct(
        F.lit(1).alias("_x"), *[F.col(c).alias(f"e_{n}") for n, c in names.items()]
    )
    edges = df.groupBy(*keys, SEGMENT).agg(
        F.min_by(picked(lead), by).alias("_segment_first"), F.max_by(picked(lag), by).alias("_segment_last")
    )
    across = window(keys, [SEGMENT])
    edges = edges.select(
        *keys,
        SEGMENT,
        F.lag("_segment_last").over(across).alias("_segment_before"),
        F.lead("_segment_first").over(across).alias("_segment_after"),
    )
    fixed = {n: F.when(F.col("_segment_head"), F.col(f"_segment_before.e_{n}")).otherwise(F.col(n)) for n in lag}
    fixed |= {n: F.when(F.col("_segment_tail"), F.col(f"_segment_after.e_{n}")).otherwise(F.col(n)) for n in lead}
    return (
        attach(rows, edges, keys)
        .withColumns(fixed)
        .drop("_segment_head", "_segment_tail", "_segment_before", "_segment_after")
    )


def neighbours(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    lag: Mapping[str, str] | None = None,
    lead: Mapping[str, str] | None = None,
    hot: LargeKeys | None = None,
) -> DataFrame:
    """Add values of the previous (``lag``) and next (``lead``) row: ``{new: source}``."""
    step = lambda rows, cut: neighbours_step(rows, keys, order, lag, lead, cut)
    return in_order(df, keys, order, step, hot)


def row_numbers(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    name: str = "rn",
    hot: LargeKeys | None = None,
) -> DataFrame:
    """Number the rows of each key 1, 2, 3, …"""

    def step(rows: DataFrame, cut: bool) -> DataFrame:
        if not cut:
            return rows.withColumn(name, F.row_number().over(window(keys, order)).cast("long"))
        inside = rows.withColumn(name, F.row_number().over(window([*keys, SEGMENT], order)).cast("long"))
        sizes = rows.groupBy(*keys, SEGMENT).agg(F.count(F.lit(1)).alias("_segment_n"))
        before = window(keys, [SEGMENT]).rowsBetween(Window.unboundedPreceding, -1)
        offsets = sizes.select(*keys, SEGMENT, F.sum("_segment_n").over(before).alias("_segment_offset"))
        return (
            attach(inside, offsets, keys)
            .withColumn(name, F.col(name) + F.coalesce("_segment_offset", F.lit(0)))
            .drop("_segment_offset")
        )

    return in_order(df, keys, order, step, hot)


def _latest(c: str, by: Column) -> Column:
    return F.max_by(F.col(c), F.when(F.col(c).isNotNull(), by))


def _earliest(c: str, by: Column) -> Column:
    return F.min_by(F.col(c), F.when(F.col(c).isNotNull(), by))


# kind -> value inside a frame, summary of one segment, carry over segments, merge
_RUNNING = {
    "sum": (F.sum, lambda c, by: F.sum(c), F.sum, lambda old, new: F.when(old.isNull(), new).when(new.isNull(), old).otherwise(old + new)),
    "count": (F.count, lambda c, by: F.count(c), F.sum, lambda old, new: F.coalesce(old, F.lit(0)) + new),
    "min": (F.min, lambda c, by: F.min(c), F.min, lambda old, new: F.least(old, new)),
    "max": (F.max, lambda c, by: F.max(c), F.max, lambda old, new: F.greatest(old, new)),
    "last": (
        lambda c: F.last(c, ignorenulls=True),
        _latest,
        lambda c: F.last(c, ignorenulls=True),
        lambda old, new: F.coalesce(new, old),
    ),
    "first": (
        lambda c: F.first(c, ignorenulls=True),
        _earliest,
        lambda c: F.first(c, ignorenulls=True),
        lambda old, new: F.coalesce(old, new),
    ),
}


def running_step(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    values: Mapping[str, tuple[str, str]],
    cut: bool = False,
) -> DataFrame:
    w = window([*keys, SEGMENT] if cut else keys, order).rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    rows = df.withColumns({n: _RUNNING[k][0](c).over(w) for n, (k, c) in values.items()})
    if not cut:
        return rows
    by = _rank_key(order)
    sums = df.groupBy(*keys, SEGMENT).agg(
        *[_RUNNING[k][1](c, by).alias(f"_segment_t_{n}") for n, (k, c) in values.items()]
    )
    before = window(keys, [SEGMENT]).rowsBetween(Window.unboundedPreceding, -1)
    carry = sums.select(
        *keys,
        SEGMENT,
        *[_RUNNING[k][2](f"_segment_t_{n}").over(before).alias(f"_segment_c_{n}") for n, (k, _) in values.items()],
    )
    merged = {n: _RUNNING[k][3](F.col(f"_segment_c_{n}"), F.col(n)) for n, (k, _) in values.items()}
    return attach(rows, carry, keys).withColumns(merged).drop(*[f"_segment_c_{n}" for n in values])


def running(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    values: Mapping[str, tuple[str, str]],
    hot: LargeKeys | None = None,
) -> DataFrame:
    """Add values over all rows up to the current one: ``{new: (kind, source)}``.

    Kinds: sum, count, min, max, last and first (both skip NULLs).
    """
    step = lambda rows, cut: running_step(rows, keys, order, values, cut)
    return in_order(df, keys, order, step, hot)


_TOTAL = {"sum": F.sum, "count": F.count, "min": F.min, "max": F.max}


def group_values(
    df: DataFrame, keys: Sequence[str], values: Mapping[str, tuple[str, str]]
) -> DataFrame:
    """Add whole-group sum/count/min/max to every row: ``{new: (kind, source)}``.

    An aggregate joined back, not a window: groups are reduced before their
    shuffle, and the join has one row per key on its right side, so adaptive
    execution can split a large key on its left.
    """
    named = [F.col(k).alias(f"_group_{k}") for k in keys]
    totals = df.groupBy(*named).agg(*[_TOTAL[k](c).alias(n) for n, (k, c) in values.items()])
    same = F.lit(True)
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_group_{k}"))
    return df.join(totals, same, "left").drop(*[f"_group_{k}" for k in keys])


def first_rows(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], last: bool = False
) -> DataFrame:
    """The first (or last) row of each key.

    An aggregate, not a window: rows are reduced before the shuffle, so the
    size of a key does not matter.
    """
    others = [c for c in df.columns if c not in keys]
    pick = F.max_by if last else F.min_by
    return (
        df.groupBy(*keys)
        .agg(pick(F.struct(*others), _rank_key(order)).alias("_row"))
        .select(*[F.col(c) if c in keys else F.col(f"_row.{c}") for c in df.columns])
    )


def lead_in_frame(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], values: Mapping[str, str],
    tie: Sequence[str] = (), hot: LargeKeys | None = None,
) -> DataFrame:
    """A lead whose frame ends at the current row's peers.

    Only a next row with the same ordering values is visible; else NULL.
    ``tie`` fixes the order of peers.
    """
    seen = {f"_n_{n}": c for n, c in values.items()} | {f"_o_{c}": c for c in order}
    out = neighbours(df.withColumn("_here", F.lit(True)), keys, [*order, *tie], lead=seen | {"_next": "_here"}, hot=hot)
    peer = F.col("_next").isNotNull()
    for c in order:
        peer = peer & F.col(f"_o_{c}").eqNullSafe(F.col(c))
    return out.withColumns({n: F.when(peer, F.col(f"_n_{n}")) for n in values}).drop(*seen, "_next", "_here")


def sessions(
    df: DataFrame,
    keys: Sequence[str],
    time: str,
    tie: Sequence[str],
    gap_seconds: int,
    name: str = "session_number",
    hot: LargeKeys | None = None,
) -> DataFrame:
    """Number the sessions of each key; a gap of ``gap_seconds`` or more opens a new one.

    Also adds ``next_time`` and ``is_new_session`` (0/1).
    """
    order = [time, *tie]
    gap = seconds_between(F.col("prev_time"), F.col(time))

    def steps(rows: DataFrame, cut: bool) -> DataFrame:
        near = neighbours_step(rows, keys, order, {"prev_time": time}, {"next_time": time}, cut)
        flagged = near.withColumn("is_new_session", F.when(gap < gap_seconds, 0).otherwise(1))
        return running_step(flagged, keys, order, {name: ("sum", "is_new_session")}, cut)

    return in_order(df, keys, order, steps, hot)


def distinct_ranks(
    df: DataFrame, keys: Sequence[str], by: str, name: str, hot: LargeKeys | None = None
) -> DataFrame:
    """Dense rank of ``by`` inside each key, through its distinct values."""
    ranks = row_numbers(df.select(*keys, by).distinct(), keys, [by], name, hot=hot)
    return df.join(ranks, [*keys, by], "left")
