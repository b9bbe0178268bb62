"""Daily inflow and outflow anomaly flags.

The windows run over one row per day, so a single task orders a few thousand
rows whatever the size of the flow table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clubflow import config as c
from clubflow.functions.dates import days_in_month, month_start
from clubflow.functions.numbers import exact_quantile, ratio


def _recent(by: str):
    return Window.orderBy(by).rowsBetween(-(c.MOVING_ROWS - 1), 0)


def inflow_anomaly(flows: DataFrame) -> DataFrame:
    """Days whose inflow is far above the moving mean or the previous day."""
    daily = (
        flows.where((F.col("is_inflow") == 1) & F.col("user_id").isNotNull())
        .groupBy(F.to_date("start_date").alias("inflow_date"))
        .agg(F.count(F.lit(1)).alias("new_subscribers"))
    )
    n, mean, before = F.col("new_subscribers"), F.col("avg_6_months"), F.col("previous_day_subscribers")
    return daily.select(
        "inflow_date",
        "new_subscribers",
        F.avg("new_subscribers").over(_recent("inflow_date")).alias("avg_6_months"),
        F.lag("new_subscribers").over(Window.orderBy("inflow_date")).alias("previous_day_subscribers"),
    ).withColumn(
        "is_anomaly",
        F.when(n > mean * c.INFLOW_OVER_MEAN, 1).when(n > before * c.INFLOW_OVER_PREVIOUS, 1).otherwise(0),
    )


def outflow_anomaly(flows: DataFrame, month_tree: DataFrame) -> DataFrame:
    """Days whose churn rate is far above the moving quartiles or the previous day."""
    daily = (
        flows.where((F.col("is_outflow") == 1) & F.col("user_id").isNotNull())
        .groupBy(F.to_date("end_date").alias("outflow_date"))
        .agg(F.count(F.lit(1)).alias("churned_subscribers"))
    )
    stock = month_tree.groupBy(F.col("date").alias("_month")).agg(
        F.sum("active_subscribers").alias("active_subs")
    )
    day = F.col("outflow_date")
    rates = (
        daily.withColumn("_month", month_start(day))
        .join(stock, "_month", "left")
        .withColumn(
            "daily_churn_rate",
            ratio(F.col("churned_subscribers"), ratio(F.col("active_subs"), days_in_month(day))),
        )
    )
    seen = F.collect_list("daily_churn_rate").over(_recent("outflow_date"))
    rate, before = F.col("daily_churn_rate"), F.col("prev_day_rate")
    return (
        rates.select(
            "outflow_date",
            "churned_subscribers",
            "daily_churn_rate",
            seen.alias("_seen"),
            F.lag(F.coalesce("daily_churn_rate", F.lit(0.0))).over(Window.orderBy("outflow_date")).alias("prev_day_rate"),
        )
        .withColumns(
            {
                "median_6months": exact_quantile(F.col("_seen"), 0.5),
                "iqr_6months": exact_quantile(F.col("_seen"), 0.75) - exact_quantile(F.col("_seen"), 0.25),
            }
        )
        .drop("_seen")
        .withColumn(
            "is_anomaly",
            F.when(rate > F.col("median_6months") + c.OUTFLOW_IQR * F.col("iqr_6months"), 1)
            .when((before > 0) & (rate > before * c.OUTFLOW_OVER_PREVIOUS), 1)
            .otherwise(0),
        )
    )


def anomaly_count(flags: DataFrame, day_column: str, day) -> DataFrame:
    """Anomalies of one day (the caller names it, usually the day before the run)."""
    return flags.where((F.col("is_anomaly") == 1) & (F.col(day_column) == F.lit(day))).agg(
        F.count(F.lit(1)).alias("cnt")
    )
