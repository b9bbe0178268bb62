"""Debt cohorts: subscriptions that fell into payment debt and how they left it."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clubflow import config as c
from clubflow.functions.dates import minutes_between, ntz
from clubflow.operators.ordered import in_order, neighbours_step
from clubflow.operators.skew import NO_STATISTICS, KeyStatistics

_ORDER = ["version_updated_at", "version"]


def _same_day(a: Column, b: Column) -> Column:
    return F.to_date(a).eqNullSafe(F.to_date(b))


def cohorts(history: DataFrame, discount_id: int | None = None, large: KeyStatistics = NO_STATISTICS) -> DataFrame:
    """Cohort start, end, closing status and end type of every debt period.

    A period opens when a plan enters payment debt and closes at the next kept
    status row; a plan that pays on while current is a 'Continue' row. Large keys: ``plan_history.id``.
    """
    kept = history.where(
        F.col("payment_plan_id").isin(*c.DEBT_PLAN_IDS)
        & (F.coalesce("cancel_reason", F.lit("")) != c.EXCLUDED_REASON)
        & (F.col("updated_at") >= ntz(c.DEBT_FROM))
        & (F.coalesce("status", F.lit("")) != "Deleted")
    )
    if discount_id is not None:
        kept = kept.where(F.col("discount_id") == discount_id)
    status, before = F.coalesce("status", F.lit("")), F.coalesce("_before", F.lit(""))
    pays_on = (status == "Current") & (before == "Current")
    opens = status == "PaymentPending"

    def chain(rows: DataFrame, cut: bool) -> DataFrame:
        near = neighbours_step(rows, ["id"], _ORDER, {"_before": "status"}, {"_next_pay": "pay_date"}, cut)
        events = near.where(
            (pays_on & ~_same_day(F.col("pay_date"), F.col("_next_pay")))
            | (opens & before.isin("Current", "Freezed", ""))
            | (status.isin("Current", "Ended", "Freezed", "Refunded") & (before == "PaymentPending"))
        ).withColumn("_kind", F.when(opens, "open").when(pays_on, "continue").otherwise("close"))
        # same key and order as above: no second shuffle
        after = {"_end": "updated_at", "_closing": "status", "_reason": "cancel_reason"}
        return neighbours_step(events, ["id"], _ORDER, lead=after, cut=cut)

    chained = in_order(
        kept.select("id", "club_id", "status", "cancel_reason", "pay_date", "updated_at", *_ORDER),
        ["id"],
        _ORDER,
        chain,
        large.of("plan_history.id"),
    )
    goes_on = F.col("_kind") == "continue"
    closing = (
        F.when(goes_on, "Continue").when(F.col("_closing") == "Refunded", "Ended").otherwise(F.col("_closing"))
    )
    return (
        chained.where((F.col("_kind") != "close") & (F.to_date("pay_date") > F.lit(dt.date(1970, 1, 1))))
        .select(
            "id",
            "club_id",
            F.to_date("pay_date").alias("cohort"),
            F.col("pay_date").alias("cohort_date_time"),
            F.when(goes_on, F.col("pay_date")).otherwise(F.col("_end")).alias("cohort_end_date"),
            closing.alias("cohort_close_status"),
            F.when(F.col("_closing") == "Refunded", "self")
            .when(
                closing == "Ended",
                F.when(F.coalesce("_reason", F.lit("")) == c.AUTO_CANCEL, "auto").otherwise("self"),
            )
            .alias("end_type"),
        )
    )


def debt_cohort_detail(
    history: DataFrame, discount_id: int = c.DEBT_TRIAL_DISCOUNT, large: KeyStatistics = NO_STATISTICS
) -> DataFrame:
    """Debt periods of one discount."""
    return cohorts(history, discount_id, large)


def with_ladder(detail: DataFrame, days: int = c.DEBT_DAYS) -> DataFrame:
    """Add an open flag and a status for each day after the cohort start.

    Day k is open while the end lies after day k-1. Its status is 'Pending'
    while open at the end of day k, the closing status on the day it closes and
    NULL after that.
    """
    start, end = F.col("cohort_date_time"), F.col("cohort_end_date")
    kept = detail.where(
        end.isNull() | (start <= end) | (F.to_date(start) == F.to_date(end))
    ).withColumn(
        "cohort_period_days",
        F.when(start == end, F.lit(0)).otherwise(F.floor(minutes_between(start, end) / 1440) + 1),
    )
    goes_on = F.coalesce(F.col("cohort_close_status") == "Continue", F.lit(False))

    def past(k: int) -> Column:
        return end.isNull() | (start + F.expr(f"INTERVAL {k} DAY") < end)

    # Closed on day k means: still pending through day k-1 but not through k.
    # Pending is monotone in k, so day k needs no look at the days before k-1.
    columns: dict[str, Column] = {}
    for k in range(1, days + 1):
        columns[f"open{k}"] = ~goes_on if k == 1 else past(k - 1)
        alive = ~goes_on if k == 1 else ~goes_on & past(k - 1)
        columns[f"status{k}"] = F.when(
            alive, F.when(past(k), F.lit("Pending")).otherwise(F.col("cohort_close_status"))
        )
    out = kept.withColumns(columns)
    return out.withColumn(
        "cohort_final_status",
        F.when(F.col(f"status{days}") == "Pending", "Pending").otherwise(F.col("cohort_close_status")),
    )


def debt_cohort_ladder(
    history: DataFrame, clubs: DataFrame, days: int = c.DEBT_DAYS, large: KeyStatistics = NO_STATISTICS
) -> DataFrame:
    """Counts per cohort date and club over the day ladder."""
    ladder = with_ladder(cohorts(history, large=large), days)
    counts = [F.count(F.lit(1)).alias("all_subs_due")]
    counts += [F.count_if(f"open{k}").alias(f"day{k}") for k in range(1, days + 1)]
    for k in range(1, days + 1):
        for status in ("Current", "Freezed", "Ended"):
            counts.append(F.count_if(F.col(f"status{k}") == status).alias(f"{status.lower()}{k}"))
    counts.append(F.count_if(F.col(f"status{days}") == "Pending").alias(f"pending{days}"))
    counts += [F.count_if(F.col("end_type") == kind).alias(kind) for kind in ("auto", "self")]
    name = clubs.select(F.col("id").alias("club_id"), F.col("name").alias("club_name"))
    return ladder.groupBy("cohort", "club_id").agg(*counts).join(name, "club_id")
