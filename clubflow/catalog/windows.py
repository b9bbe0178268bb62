"""Window operators. Each goes through the ordered operators, so large keys are split."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from clubflow import config as c
from clubflow.catalog.registry import Tables, query
from clubflow.functions.numbers import exact_quantile
from clubflow.operators.ordered import (
    distinct_ranks,
    first_rows,
    group_values,
    lead_in_frame,
    neighbours,
    row_numbers,
    running,
    sessions,
)

USER, ORDER = ["user_id"], ["ts", "event_id"]
_W = "(PARTITION BY user_id ORDER BY ts, event_id)"


def _events(t: Tables, *more: str):
    rows = t.events.select("event_id", "user_id", "ts", *more)
    return rows, t.large("events").of("events.user")


@query("win_row_number", sql=f"SELECT event_id, user_id, row_number() OVER {_W} AS rn FROM events")
def _row_number(t: Tables):
    rows, hot = _events(t)
    return row_numbers(rows, USER, ORDER, "rn", hot=hot).select("event_id", "user_id", "rn")


@query(
    "win_first_row",
    sql="SELECT event_id, user_id, ts, event_type FROM events QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) = 1",
)
def _first_row(t: Tables):
    return first_rows(t.events.select("event_id", "user_id", "ts", "event_type"), ["user_id", "event_type"], ORDER)


@query(
    "win_dense_rank",
    dates=("day",),
    sql="SELECT event_id, user_id, CAST(ts AS DATE) AS day, dense_rank() OVER (PARTITION BY user_id ORDER BY CAST(ts AS DATE)) AS rnk FROM events",
)
def _dense_rank(t: Tables):
    rows = t.events.select("event_id", "user_id", F.to_date("ts").alias("day"))
    return distinct_ranks(rows, USER, "day", "rnk", hot=t.large("events").of("events.user"))


@query(
    "win_lag",
    sql=f"SELECT event_id, user_id, lag(event_type) OVER {_W} AS prev_type, lag(value) OVER {_W} AS prev_value FROM events",
)
def _lag(t: Tables):
    rows, hot = _events(t, "event_type", "value")
    out = neighbours(rows, USER, ORDER, lag={"prev_type": "event_type", "prev_value": "value"}, hot=hot)
    return out.select("event_id", "user_id", "prev_type", "prev_value")


@query(
    "win_lead",
    sql=f"SELECT event_id, user_id, lead(event_type) OVER {_W} AS next_type, lead(ts) OVER {_W} AS next_ts FROM events",
)
def _lead(t: Tables):
    rows, hot = _events(t, "event_type")
    out = neighbours(rows, USER, ORDER, lead={"next_type": "event_type", "next_ts": "ts"}, hot=hot)
    return out.select("event_id", "user_id", "next_type", "next_ts")


@query(
    "win_lead_in_frame",
    sql="""
    WITH o AS (SELECT o_orderkey, o_custkey, o_orderdate,
        lead(o_orderkey) OVER w AS nk, lead(o_orderdate) OVER w AS nd FROM orders
        WINDOW w AS (PARTITION BY o_custkey % 50 ORDER BY o_orderdate, o_orderkey))
    SELECT o_orderkey, CASE WHEN nd = o_orderdate THEN nk END AS next_peer FROM o""",
)
def _in_frame(t: Tables):
    rows = t.orders.select("o_orderkey", (F.col("o_custkey") % 50).alias("_g"), "o_orderdate")
    out = lead_in_frame(
        rows, ["_g"], ["o_orderdate"], {"next_peer": "o_orderkey"}, tie=["o_orderkey"],
        hot=t.large("orders").of("orders.group"),
    )
    return out.select("o_orderkey", "next_peer")


_RUN = "(PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
_SEEN = "CASE WHEN event_type IN ('view', 'click') THEN event_id END"


@query(
    "win_first_value",
    sql=f"SELECT event_id, user_id, first_value(event_id) OVER {_RUN} AS first_id FROM events",
)
def _first_value(t: Tables):
    rows, hot = _events(t)
    return running(rows, USER, ORDER, {"first_id": ("first", "event_id")}, hot=hot).drop("ts")


@query(
    "win_any",
    sql=f"SELECT event_id, user_id, first_value({_SEEN} IGNORE NULLS) OVER {_RUN} AS first_seen FROM events",
)
def _any(t: Tables):
    rows, hot = _events(t, F.expr(_SEEN).alias("_seen"))
    return running(rows, USER, ORDER, {"first_seen": ("first", "_seen")}, hot=hot).drop("ts", "_seen")


@query(
    "win_last_value_running",
    sql=f"SELECT event_id, user_id, last_value({_SEEN} IGNORE NULLS) OVER {_RUN} AS last_seen FROM events",
)
def _last_value(t: Tables):
    rows, hot = _events(t, F.expr(_SEEN).alias("_seen"))
    return running(rows, USER, ORDER, {"last_seen": ("last", "_seen")}, hot=hot).drop("ts", "_seen")


@query(
    "win_running_sum",
    sql=f"""SELECT event_id, user_id, CAST(sum(CAST(value AS DECIMAL(18,2))) OVER {_RUN} AS DOUBLE) AS total,
        count(*) OVER {_RUN} AS n FROM events""",
)
def _running_sum(t: Tables):
    rows, hot = _events(t, F.col("value").cast("decimal(18,2)").alias("_v"))
    return running(rows, USER, ORDER, {"total": ("sum", "_v"), "n": ("count", "event_id")}, hot=hot).drop("ts", "_v")


@query(
    "win_running_min",
    sql=f"SELECT event_id, user_id, min(value) OVER {_RUN} AS lowest, max(value) OVER {_RUN} AS highest FROM events",
)
def _running_min(t: Tables):
    rows, hot = _events(t, "value")
    return running(rows, USER, ORDER, {"lowest": ("min", "value"), "highest": ("max", "value")}, hot=hot).drop("ts", "value")


@query(
    "win_partition_agg",
    sql="""SELECT event_id, user_id, max(value) OVER p AS top, count(*) OVER p AS n,
        CAST(sum(CAST(value AS DECIMAL(18,2))) OVER p AS DOUBLE) AS total FROM events WINDOW p AS (PARTITION BY user_id)""",
)
def _partition_agg(t: Tables):
    rows = t.events.select("event_id", "user_id", "value", F.col("value").cast("decimal(18,2)").alias("_v"))
    values = {"top": ("max", "value"), "n": ("count", "event_id"), "total": ("sum", "_v")}
    return group_values(rows, USER, values).select("event_id", "user_id", "top", "n", "total")


@query(
    "win_is_last_flag",
    sql="SELECT o_orderkey, CASE WHEN o_orderdate = max(o_orderdate) OVER (PARTITION BY o_custkey) THEN 1 ELSE 0 END AS is_last FROM orders",
)
def _is_last(t: Tables):
    rows = t.orders.select("o_orderkey", "o_custkey", "o_orderdate")
    out = group_values(rows, ["o_custkey"], {"_last": ("max", "o_orderdate")})
    return out.select("o_orderkey", F.when(F.col("o_orderdate") == F.col("_last"), 1).otherwise(0).alias("is_last"))


def _daily(t: Tables):
    # one row per day before any window without a key
    return t.orders.groupBy(F.to_date("o_orderdate").alias("day")).agg(F.count(F.lit(1)).alias("n"))


_RECENT = "(ORDER BY day ROWS BETWEEN 179 PRECEDING AND CURRENT ROW)"
_DAILY = "WITH d AS (SELECT CAST(o_orderdate AS DATE) AS day, count(*) AS n FROM orders GROUP BY ALL)"


def _recent():
    return Window.orderBy("day").rowsBetween(-(c.MOVING_ROWS - 1), 0)


@query("win_moving_avg_rows", dates=("day",), sql=f"{_DAILY} SELECT day, n, avg(n) OVER {_RECENT} AS mean FROM d")
def _moving_avg(t: Tables):
    return _daily(t).withColumn("mean", F.avg("n").over(_recent()))


@query(
    "win_moving_quantile_rows",
    dates=("day",),
    sql=f"""{_DAILY}, l AS (SELECT day, n, list_sort(list(n) OVER {_RECENT}) AS v FROM d)
    SELECT day, n, v[least(len(v) // 2, len(v) - 1) + 1] AS median,
        v[least(CAST(floor(len(v) * 0.75) AS BIGINT), len(v) - 1) + 1] - v[least(CAST(floor(len(v) * 0.25) AS BIGINT), len(v) - 1) + 1] AS iqr FROM l""",
)
def _moving_quantile(t: Tables):
    seen = F.col("_seen")
    return (
        _daily(t)
        .withColumn("_seen", F.collect_list("n").over(_recent()))
        .select(
            "day",
            "n",
            exact_quantile(seen, 0.5).alias("median"),
            (exact_quantile(seen, 0.75) - exact_quantile(seen, 0.25)).alias("iqr"),
        )
    )


@query("win_prev_day_value", dates=("day",), sql=f"{_DAILY} SELECT day, n, lag(n) OVER (ORDER BY day) AS previous FROM d")
def _prev_day(t: Tables):
    return _daily(t).withColumn("previous", F.lag("n").over(Window.orderBy("day")))


@query(
    "win_sessionize_gap",
    sql=f"""
    WITH g AS (SELECT *, CASE WHEN date_diff('second', lag(ts) OVER {_W}, ts) < 10800 THEN 0 ELSE 1 END AS is_new_session FROM events)
    SELECT event_id, user_id, is_new_session, CAST(sum(is_new_session) OVER {_RUN} AS BIGINT) AS session_number FROM g""",
)
def _sessionize(t: Tables):
    rows, hot = _events(t)
    out = sessions(rows, USER, "ts", ["event_id"], c.SESSION_GAP_SECONDS, hot=hot)
    return out.select("event_id", "user_id", "is_new_session", "session_number")
