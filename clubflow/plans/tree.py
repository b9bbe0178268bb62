"""Metric tree: lifetime, load factor, LTV/CAC, month tree and year tree."""

from __future__ import annotations

import datetime as dt
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clubflow import config as c
from clubflow.functions.dates import days_between, month_start, months_between
from clubflow.functions.numbers import exact_mean, ratio, round_even
from clubflow.operators.flows import full_join, month_grid, monthly_sum, zero
from clubflow.operators.ordered import neighbours, running
from clubflow.operators.skew import NO_STATISTICS, KeyStatistics


def lifetime(flows: DataFrame, large: KeyStatistics = NO_STATISTICS) -> DataFrame:
    """Mean membership length by month of the last end and the user's main club.

    Only ended memberships count. A gap above 90 days (or no next membership)
    ends a life; memberships closer together share one. Large keys: ``flows.user``.
    """
    hot = large.of("flows.user")
    spans = (
        neighbours(
            flows.select("user_id", "first_id", "inflow_club", "inflow_club_name", "start_date", "end_date"),
            ["user_id"],
            ["start_date", "first_id"],
            lead={"next_start": "start_date"},
            hot=hot,
        )
        .where(F.col("end_date").isNotNull())
        .select(
            "user_id",
            "inflow_club",
            "inflow_club_name",
            "end_date",
            F.coalesce(days_between(F.col("end_date"), F.col("next_start")), F.lit(c.LAST_GAP)).alias("gap"),
            days_between(F.col("start_date"), F.col("end_date")).alias("days"),
        )
    )
    # Every short gap weighs 1/n with n short gaps per user, so they add up to
    # one life: the sum of weights is the number of long gaps plus one if any
    # gap is short. Partial sums per (user, club) replace the per-user window.
    by_club = spans.groupBy("user_id", "inflow_club", "inflow_club_name").agg(
        F.sum("days").alias("days"),
        F.count_if(F.col("gap") > c.LIFE_GAP_DAYS).alias("long"),
        F.count_if(F.col("gap") <= c.LIFE_GAP_DAYS).alias("short"),
        F.max("end_date").alias("last_end"),
    )
    ranked = F.struct(
        "days", (-F.coalesce("inflow_club", F.lit(-1))).alias("o"), "inflow_club", "inflow_club_name"
    )
    per_user = by_club.groupBy("user_id").agg(
        F.max(ranked).alias("main"),
        F.sum("days").alias("days"),
        F.sum("long").alias("long"),
        F.sum("short").alias("short"),
        F.max("last_end").alias("last_end"),
    )
    several = (F.col("long") + F.col("short") > 1) & (F.col("long") > 1)
    lives = F.when(several, F.col("long")).otherwise(
        F.col("long") + F.when(F.col("short") > 0, 1).otherwise(0)
    )
    return (
        per_user.withColumn("alt", ratio(F.col("days"), lives))
        .where(F.col("alt") > 0)
        .groupBy(
            month_start(F.col("last_end")).alias("date"),
            F.col("main.inflow_club").alias("club_id"),
            F.col("main.inflow_club_name").alias("club_name"),
        )
        .agg(round_even(exact_mean(F.col("alt")), 0).alias("alt"))
    )


def flows_with_migration(active: DataFrame, match_name: bool = True) -> DataFrame:
    """Monthly inflow and outflow of every club, months with only one side included."""
    club = {"club_id": "club_id", "club_name": "club_name"}
    inflow = monthly_sum(active, "start_date", club, "is_inflow", "inflow")
    outflow = monthly_sum(active, "end_date", club, "is_outflow", "outflow")
    if match_name:
        both = full_join(inflow, outflow, ["date", "club_id", "club_name"])
    else:
        both = full_join(
            inflow.withColumnRenamed("club_name", "_in"),
            outflow.withColumnRenamed("club_name", "_out"),
            ["date", "club_id"],
        ).withColumn("club_name", F.coalesce("_out", "_in"))
    return both.groupBy("date", "club_id", "club_name").agg(
        F.sum(zero("inflow")).alias("inflow"), F.sum(zero("outflow")).alias("outflow")
    )


def _stock(flows: DataFrame) -> DataFrame:
    # one row per club and month: a club holds at most a few hundred rows
    so_far = Window.partitionBy("club_id").orderBy("date").rangeBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    return flows.withColumn(
        "active_subscribes",
        F.coalesce(F.sum("inflow").over(so_far), F.lit(0)) - F.coalesce(F.sum("outflow").over(so_far), F.lit(0)),
    )


def load_factor(
    flows: DataFrame,
    active: DataFrame,
    clubs: DataFrame,
    as_of: dt.date,
    start: dt.date = c.LOAD_FACTOR_FROM,
    opened_only: bool = True,
    carry_forward: bool = False,
) -> DataFrame:
    """Flows, running stock and stock per square metre for every month and club.

    ``opened_only`` leaves out clubs that open after ``as_of``. Stock is known
    in months with a flow; ``carry_forward`` fills the months between.
    """
    listed = clubs.where(F.col("open_date") <= F.lit(as_of)) if opened_only else clubs
    grid = month_grid(
        listed.select(F.col("id").alias("club_id"), F.col("name").alias("club_name")), start, as_of
    )
    inflow = monthly_sum(flows, "start_date", {"club_name": "inflow_club_name"}, "is_inflow", "inflow")
    outflow = monthly_sum(flows, "end_date", {"club_name": "outflow_club_name"}, "is_outflow", "outflow")
    area = clubs.select(
        F.col("id").alias("club_id"),
        F.coalesce("rounded_area", "area_in_square_meters").alias("area_in_square_meters"),
    )
    stock = (
        _stock(flows_with_migration(active))
        .join(area, "club_id", "left")
        .select(
            "date",
            "club_name",
            F.col("outflow").alias("outflow_with_migration"),
            F.col("inflow").alias("inflow_with_migration"),
            "active_subscribes",
            "area_in_square_meters",
        )
    )
    out = (
        grid.join(inflow, ["date", "club_name"], "left")
        .join(outflow, ["date", "club_name"], "left")
        .join(stock, ["date", "club_name"], "left")
    )
    if carry_forward:
        filled = running(
            out,
            ["club_id"],
            ["date"],
            {"_s": ("last", "active_subscribes"), "_a": ("last", "area_in_square_meters")},
        )
        out = filled.drop("active_subscribes", "area_in_square_meters").withColumnsRenamed(
            {"_s": "active_subscribes", "_a": "area_in_square_meters"}
        )
    return out.select(
        "date",
        "club_id",
        "club_name",
        "outflow",
        "inflow",
        "outflow_with_migration",
        "inflow_with_migration",
        "active_subscribes",
        "area_in_square_meters",
        round_even(ratio(F.col("active_subscribes"), F.col("area_in_square_meters")), 2).alias("load_factor"),
    )


def ltv_cac(
    flows: DataFrame,
    active: DataFrame,
    clubs: DataFrame,
    expenses: DataFrame,
    start: dt.date,
    as_of: dt.date,
) -> DataFrame:
    """Acquisition cost, lifetime value and their ratio per month and club."""
    grid = month_grid(
        clubs.select(F.col("id").alias("club_id"), F.col("name").alias("club_name"), "open_date"),
        start,
        as_of,
    ).where(F.col("date") >= month_start(F.col("open_date")))
    inflow = (
        flows.groupBy(month_start(F.col("start_date")).alias("date"), F.col("inflow_club").alias("club_id"), "inflow_club_name")
        .agg(F.sum("is_inflow").alias("is_inflow"))
        .drop("inflow_club_name")
    )
    stock = _stock(flows_with_migration(active, match_name=False)).select(
        "date", "club_id", "active_subscribes"
    )
    cost = expenses.select(
        F.col("date_month").cast("date").alias("date"),
        "club_id",
        F.abs("acquisition_cost").alias("acquisition_cost"),
        "club_ebitda",
    )
    key = ["date", "club_id"]
    # a month without any flow has a stock of zero here, not a carried one
    stocked = F.coalesce("active_subscribes", F.lit(0))
    cac = ratio(F.col("acquisition_cost"), F.col("is_inflow"))
    ltv = ratio(F.col("club_ebitda"), stocked)
    return (
        grid.join(stock, key, "left")
        .join(cost, key, "left")
        .join(inflow, key, "left")
        .select(
            "date",
            "club_id",
            "club_name",
            "open_date",
            "acquisition_cost",
            "club_ebitda",
            "is_inflow",
            stocked.alias("active_subscribes"),
            cac.alias("cac"),
            ltv.alias("ltv"),
            ratio(ltv, cac).alias("ratio_ltv_cac"),
        )
    )


def rolling_year(date: Column, as_of: dt.date, years: int = 8) -> Column:
    """Label of the 12-month block, counted back from the month of ``as_of``.

    Block k spans the months ``12k`` to ``12k + 11`` before it and carries the
    year in which it ends. Older months fall into 2018.
    """
    here = F.lit(as_of)
    back = months_between(date, here)
    block = F.floor(back / 12)
    named = F.year(F.add_months(here, (-12 * block).cast("int")))
    return F.when((back >= 0) & (block < years), named).otherwise(F.lit(2018)).cast("string")


def metrics_month(
    clubs: DataFrame,
    lifetimes: DataFrame,
    load_factors: DataFrame,
    ltv: DataFrame,
    revenue: DataFrame,
    start: dt.date,
    as_of: dt.date,
) -> DataFrame:
    """All monthly metrics of every club in one row."""
    key = ["date", "club_name"]
    grid = month_grid(
        clubs.select(F.col("id").alias("club_id"), F.col("name").alias("club_name")), start, as_of
    )
    income = revenue.groupBy(month_start(F.col("date")).alias("date"), "club_name").agg(
        F.sum("total_cost").alias("revenue")
    )
    arpu = ratio(F.col("revenue"), F.col("active_subscribers"))
    return (
        grid.join(lifetimes.select(*key, "alt"), key, "left")
        .join(
            load_factors.select(*key, "outflow", "inflow", "area_in_square_meters", "load_factor"), key, "left"
        )
        .join(income, key, "left")
        .join(
            ltv.select(
                *key,
                "acquisition_cost",
                "club_ebitda",
                F.col("active_subscribes").alias("active_subscribers"),
                "cac",
                "ltv",
            ),
            key,
            "left",
        )
        .select(
            rolling_year(F.col("date"), as_of).alias("year"),
            "date", "club_id", "club_name", "alt", "outflow", "inflow", "area_in_square_meters",
            "load_factor", "revenue", "acquisition_cost", "club_ebitda", "active_subscribers",
            "cac", "ltv",
            arpu.alias("arpu"),
            (F.col("load_factor") * F.col("alt") / 30 * arpu).alias("nsm_metric"),
        )
    )


METRICS = (
    "alt", "outflow", "inflow", "area_in_square_meters", "load_factor", "revenue",
    "acquisition_cost", "club_ebitda", "active_subscribers", "cac", "ltv", "arpu", "nsm_metric",
)


def club_profile(clubs: DataFrame, as_of: dt.date) -> DataFrame:
    """Type, tier and age band of a club."""
    age = months_between(F.col("open_date"), F.lit(as_of))
    return clubs.select(
        F.col("name").alias("club_name"),
        "club_type",
        F.when(F.col("id").isin(*c.TIER_1), "1").when(F.col("id").isin(*c.TIER_2), "2").otherwise("3").alias("tir"),
        F.when(age <= 12, c.AGE_YOUNG).when(age <= 24, c.AGE_JUNIOR).otherwise(c.AGE_MATURE).alias("age"),
    )


def metrics_year(
    month: DataFrame, clubs: DataFrame, start: dt.date, as_of: dt.date, same_club: bool = True
) -> DataFrame:
    """Every month row of a club next to its rows of the same month of each year.

    ``same_club=False`` pairs across clubs as well: (clubs x years) squared rows
    per month of the year, for small grids only.
    """
    grid = month_grid(clubs.select(F.col("name").alias("club_name")), start, as_of)
    one = (
        grid.join(month.drop("year"), ["date", "club_name"], "left")
        .join(club_profile(clubs, as_of), "club_name", "left")
        .select(
            "date",
            F.year("date").cast("string").alias("year"),
            "club_id",
            "club_name",
            "club_type",
            "tir",
            "age",
            *METRICS,
            F.month("date").alias("_month"),
        )
    )
    other = one.select(
        "_month", *[F.col(n).alias(f"{n}_2") for n in one.columns if n not in ("date", "_month")]
    )
    if same_club:
        pair = (one["_month"] == other["_month"]) & one["club_name"].eqNullSafe(other["club_name_2"])
        return one.join(other, pair, "left").drop("_month")
    return one.join(other, "_month", "left").drop("_month")


class MetricTree(NamedTuple):
    lifetime: DataFrame
    load_factor: DataFrame
    ltv_cac: DataFrame
    month: DataFrame
    year: DataFrame


def metric_tree(
    flows: DataFrame,
    active: DataFrame,
    clubs: DataFrame,
    expenses: DataFrame,
    revenue: DataFrame,
    start: dt.date,
    as_of: dt.date,
    large: KeyStatistics = NO_STATISTICS,
) -> MetricTree:
    """The whole dependency chain for one date."""
    life = lifetime(flows, large)
    load = load_factor(flows, active, clubs, as_of)
    value = ltv_cac(flows, active, clubs, expenses, start, as_of)
    month = metrics_month(clubs, life, load, value, revenue, start, as_of)
    return MetricTree(life, load, value, month, metrics_year(month, clubs, start, as_of))
