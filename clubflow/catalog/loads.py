"""Sources, sinks and load modes: each query loads a table in steps and reads it back."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from clubflow.catalog.registry import Tables, query
from clubflow.functions.dates import month_start
from clubflow.operators.flows import months_of
from clubflow.session import new_table_path
from clubflow.sources import bucketed, load
from clubflow.sources.scan import latest, scan_table


@query("scan_table", sql="SELECT l_orderkey, l_partkey, l_quantity FROM lineitem")
def _scan(t: Tables):
    return scan_table(t.spark, f"{t.sf_dir}/lineitem.parquet", ["l_orderkey", "l_partkey", "l_quantity"])


_LATEST = "SELECT user_id, event_id, ts, event_type FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) = 1"


@query("scan_latest", sql=_LATEST)
def _latest(t: Tables):
    return latest(t.events.select("user_id", "event_id", "ts", "event_type"), ["user_id"], ["event_id"])


#: Buckets of the version tables below; in production as many as tasks should share the whole table.
_BUCKETS = 16


@query("scan_latest_bucketed", sql=_LATEST)
def _latest_bucketed(t: Tables):
    """Versions arrive in three loads and are collapsed bucket by bucket."""
    rows = t.events.select("user_id", "event_id", "ts", "event_type")
    third = F.col("event_id") % 3
    table = bucketed.create_versions(rows.where(third == 1), ["user_id"], _BUCKETS)
    for load_number in (0, 2):
        bucketed.add_versions(rows.where(third == load_number), table)
    return bucketed.latest_versions(t.spark, table, ["event_id"])


@query("write_compact_bucketed", sql=_LATEST)
def _compact_bucketed(t: Tables):
    """Earlier versions are compacted, later ones merged into them, a join of buckets."""
    rows = t.events.select("user_id", "event_id", "ts", "event_type")
    early = F.col("event_id") % 5 < 3
    base = bucketed.compacted(t.spark, bucketed.create_versions(rows.where(early), ["user_id"], _BUCKETS), ["event_id"])
    changes = bucketed.create_versions(rows.where(~early), ["user_id"], _BUCKETS)
    return bucketed.merged_versions(t.spark, base, changes, ["event_id"])


@query(
    "scan_calendar",
    tables=("days",),
    dates=("date",),
    sql="""SELECT DISTINCT CAST(date_trunc('month', day_id_day) AS DATE) AS date FROM days
        WHERE day_id_day BETWEEN DATE '1996-03-01' AND DATE '2001-06-15'""",
)
def _calendar(t: Tables):
    return months_of(t.days, "day_id_day", dt.date(1996, 3, 1), dt.date(2001, 6, 15))


def _orders(t: Tables):
    return t.orders.select("o_orderkey", "o_custkey", "o_orderstatus", F.to_date("o_orderdate").alias("day"))


@query(
    "write_full_replace",
    dates=("day",),
    sql="SELECT o_orderkey, o_custkey, o_orderstatus, CAST(o_orderdate AS DATE) AS day FROM orders WHERE o_orderstatus <> 'O'",
)
def _full_replace(t: Tables):
    path = new_table_path(t.spark, "full_replace")
    load.full_replace(_orders(t), path)
    load.full_replace(_orders(t).where(F.col("o_orderstatus") != "O"), path)
    return load.read_target(t.spark, path)


@query(
    "write_ctas",
    dates=("day",),
    sql="SELECT o_orderkey, o_custkey, o_orderstatus, CAST(o_orderdate AS DATE) AS day FROM orders",
)
def _ctas(t: Tables):
    path = new_table_path(t.spark, "ctas")
    load.create_as(_orders(t).where(F.col("o_orderstatus") == "O"), path, ["o_custkey", "o_orderkey"])
    load.create_as(_orders(t), path, ["o_custkey", "o_orderkey"])
    return load.read_target(t.spark, path)


@query("write_append_above_watermark", sql="SELECT event_id, user_id, event_type FROM events WHERE event_id > 0")
def _append(t: Tables):
    path = new_table_path(t.spark, "append")
    rows = t.events.select("event_id", "user_id", "event_type")
    top = rows.agg(F.max("event_id")).first()[0]
    for upto in (top // 3, 2 * top // 3, top, top):  # the last load finds nothing new
        load.append_above(rows.where(F.col("event_id") <= upto), path, "event_id")
    return load.read_target(t.spark, path)


_LO, _HI = dt.date(1996, 3, 15), dt.date(1997, 6, 10)


@query(
    "write_replace_range",
    dates=("day", "month"),
    sql="""SELECT o_orderkey, o_custkey, o_orderstatus, CAST(o_orderdate AS DATE) AS day,
            CAST(date_trunc('month', o_orderdate) AS DATE) AS month,
            CASE WHEN o_orderdate >= DATE '1996-03-15' AND o_orderdate < DATE '1997-06-10' THEN 'new' ELSE 'old' END AS load
        FROM orders
        WHERE o_orderdate < DATE '1996-03-15' OR o_orderdate >= DATE '1997-06-10' OR o_orderstatus <> 'P'""",
)
def _replace_range(t: Tables):
    path = new_table_path(t.spark, "range")
    rows = _orders(t).withColumn("month", month_start(F.col("day")))
    load.replace_range(rows.withColumn("load", F.lit("old")), path, "day", dt.date(1990, 1, 1), dt.date(2010, 1, 1), "month")
    new = rows.where(F.col("o_orderstatus") != "P").withColumn("load", F.lit("new"))
    for _ in range(2):  # a repeated load changes nothing
        load.replace_range(new, path, "day", _LO, _HI, "month", partitions=(_LO.replace(day=1), _HI.replace(day=1)))
    return load.read_target(t.spark, path)


@query(
    "write_replace_month",
    dates=("date",),
    sql="""
    WITH r AS (SELECT *, CAST(date_trunc('month', o_orderdate) AS DATE) AS date FROM orders),
    v AS (
        SELECT date, o_custkey, o_totalprice, 'first' AS load FROM r WHERE date NOT IN (DATE '2000-04-01', DATE '2000-05-01')
        UNION ALL
        SELECT date, o_custkey, o_totalprice, 'again' FROM r WHERE date = DATE '2000-04-01' OR o_orderdate BETWEEN DATE '2000-05-01' AND DATE '2000-05-02')
    SELECT date, o_custkey % 25 AS club_id, load, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total_cost FROM v GROUP BY ALL""",
)
def _replace_month(t: Tables):
    path = new_table_path(t.spark, "month")

    def build(first: dt.date, last: dt.date, label: str = "again"):
        day = F.to_date("o_orderdate")
        return (
            t.orders.where(day.between(F.lit(first), F.lit(last)))
            .groupBy(month_start(F.col("o_orderdate")).alias("date"), (F.col("o_custkey") % 25).alias("club_id"))
            .agg(F.sum(F.col("o_totalprice").cast("decimal(18,2)")).alias("total_cost"))
            .withColumn("load", F.lit(label))
        )

    load.overwrite_partitions(build(dt.date(1990, 1, 1), dt.date(2010, 1, 1), "first"), path, "date")
    load.replace_months(build, path, dt.date(2000, 5, 2))
    return load.read_target(t.spark, path)


@query(
    "write_compact",
    dates=("month",),
    sql="""
    WITH v AS (
        SELECT event_id // 12 AS id, CAST(date_trunc('month', ts) + (event_id % 3) * INTERVAL 1 MONTH AS DATE) AS month, event_id AS version, event_type FROM events)
    SELECT * FROM v WHERE month = (SELECT max(month) FROM v)
    UNION ALL
    SELECT * FROM v WHERE month < (SELECT max(month) FROM v) QUALIFY row_number() OVER (PARTITION BY id, month ORDER BY version DESC) = 1""",
)
def _compact(t: Tables):
    path = new_table_path(t.spark, "compact")
    rows = t.events.select(
        F.floor(F.col("event_id") / 12).alias("id"),
        F.add_months(month_start(F.col("ts")), (F.col("event_id") % 3).cast("int")).alias("month"),
        F.col("event_id").alias("version"),
        "event_type",
    )
    load.overwrite_partitions(rows, path, "month")
    months = sorted(row[0] for row in rows.select("month").distinct().collect())
    load.compact(t.spark, path, ["id"], ["version"], "month", months[:-1])  # the last one keeps all versions
    return load.read_target(t.spark, path)


@query("load_check_count", sql="SELECT count(*) AS loaded FROM events WHERE event_id > (SELECT max(event_id) // 2 FROM events)")
def _check_count(t: Tables):
    path = new_table_path(t.spark, "count")
    rows = t.events.select("event_id", "user_id")
    middle = rows.agg(F.max("event_id")).first()[0] // 2
    load.append_above(rows.where(F.col("event_id") <= middle), path, "event_id")
    above = load.append_above(rows, path, "event_id")
    return load.loaded_rows(t.spark, path, "event_id", above)
