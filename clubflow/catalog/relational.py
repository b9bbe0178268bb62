"""Projections, filters, joins, aggregates, sorts and set operations."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from clubflow import config as c
from clubflow.catalog.registry import Tables, query
from clubflow.functions.dates import month_start, ntz
from clubflow.functions.numbers import ratio, round_even
from clubflow.functions.text import code_label, like_any
from clubflow.operators.flows import full_join, month_grid, monthly_sum, zero
from clubflow.operators.intervals import inside_any, max_over_covering
from clubflow.operators.ordered import first_rows, neighbours, row_numbers
from clubflow.plans.campaign import staff_users

MONEY = "decimal(18,2)"

# --------------------------------------------------------------------------- projections


@query(
    "project_alias",
    dates=("day",),
    sql="""SELECT o_orderkey AS id, o_custkey AS user_id, upper(o_orderstatus) AS status, CAST(o_orderdate AS DATE) AS day,
        o_totalprice * 2 AS doubled FROM orders""",
)
def _alias(t: Tables):
    return t.orders.select(
        F.col("o_orderkey").alias("id"),
        F.col("o_custkey").alias("user_id"),
        F.upper("o_orderstatus").alias("status"),
        F.to_date("o_orderdate").alias("day"),
        (F.col("o_totalprice") * 2).alias("doubled"),
    )


@query(
    "project_alias_chain",
    sql="""SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, CAST(json_extract_string(props, '$.k') AS BIGINT) % 10 AS step,
        CASE WHEN CAST(json_extract_string(props, '$.k') AS BIGINT) % 10 > 5 THEN 'high' ELSE 'low' END AS band FROM events""",
)
def _alias_chain(t: Tables):
    return (
        t.events.select("event_id", F.get_json_object("props", "$.k").cast("bigint").alias("k"))
        .withColumn("step", F.col("k") % 10)
        .withColumn("band", F.when(F.col("step") > 5, "high").otherwise("low"))
    )


@query("project_star", sql="SELECT c.*, n_name, n_regionkey FROM customer c JOIN nation ON n_nationkey = c_nationkey")
def _star(t: Tables):
    customer = t.customer
    return customer.join(t.nation, customer["c_nationkey"] == F.col("n_nationkey")).select(
        customer["*"], "n_name", "n_regionkey"
    )


@query(
    "cte_pipeline",
    sql="""
    WITH big AS (SELECT * FROM lineitem WHERE l_quantity > 25),
    per AS (SELECT l_orderkey, count(*) AS n, sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS paid FROM big GROUP BY ALL),
    own AS (SELECT o_custkey, n, paid FROM per JOIN orders ON o_orderkey = l_orderkey WHERE o_orderstatus <> 'P'),
    top AS (SELECT o_custkey, CAST(sum(n) AS BIGINT) AS n, sum(paid) AS paid FROM own GROUP BY ALL)
    SELECT c_name, n, CAST(paid AS DOUBLE) AS paid FROM top JOIN customer ON c_custkey = o_custkey""",
)
def _pipeline(t: Tables):
    big = t.lineitem.where(F.col("l_quantity") > 25)
    per = big.groupBy("l_orderkey").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("l_extendedprice").cast(MONEY)).alias("paid")
    )
    own = per.join(t.orders.where(F.col("o_orderstatus") != "P"), F.col("l_orderkey") == F.col("o_orderkey"))
    top = own.groupBy("o_custkey").agg(F.sum("n").alias("n"), F.sum("paid").alias("paid"))
    return top.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).select("c_name", "n", "paid")


# --------------------------------------------------------------------------- filters


@query(
    "filter_conjunct",
    sql="""SELECT event_id, user_id, value FROM events
        WHERE (event_type = 'view' AND value > 5) OR (event_type = 'click' AND NOT (user_id % 2 = 0 OR value < 1))""",
)
def _conjunct(t: Tables):
    kind, value = F.col("event_type"), F.col("value")
    return t.events.where(
        ((kind == "view") & (value > 5)) | ((kind == "click") & ~((F.col("user_id") % 2 == 0) | (value < 1)))
    ).select("event_id", "user_id", "value")


@query("filter_in_list", sql="SELECT o_orderkey, o_orderpriority FROM orders WHERE o_orderpriority IN ('1-URGENT', '5-LOW')")
def _in_list(t: Tables):
    return t.orders.where(F.col("o_orderpriority").isin("1-URGENT", "5-LOW")).select("o_orderkey", "o_orderpriority")


@query("filter_not_in_list", sql="SELECT event_id, event_type FROM events WHERE event_type NOT IN ('error', 'signup')")
def _not_in_list(t: Tables):
    return t.events.where(~F.col("event_type").isin("error", "signup")).select("event_id", "event_type")


@query(
    "filter_between",
    sql="SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice BETWEEN 1000 AND 90000",
)
def _between(t: Tables):
    return t.orders.where(F.col("o_totalprice").between(1000, 90000)).select("o_orderkey", "o_totalprice")


@query(
    "filter_half_open_time",
    sql="SELECT event_id, ts FROM events WHERE ts >= TIMESTAMP '2024-01-05 06:00:00' AND ts < TIMESTAMP '2024-01-20 18:00:00'",
)
def _half_open(t: Tables):
    lo, hi = dt.datetime(2024, 1, 5, 6), dt.datetime(2024, 1, 20, 18)
    return t.events.where((F.col("ts") >= ntz(lo)) & (F.col("ts") < ntz(hi))).select("event_id", "ts")


@query("filter_like", sql="SELECT p_partkey, p_name FROM part WHERE p_name LIKE '%ed%' AND p_name NOT LIKE 'small%'")
def _like(t: Tables):
    return t.part.where(F.col("p_name").like("%ed%") & ~F.col("p_name").like("small%")).select("p_partkey", "p_name")


@query("filter_ilike_any", sql="SELECT page_id, url FROM pages WHERE url ILIKE '%/EN/%' OR url ILIKE 'HTTP://%' OR url ILIKE '%#Top'")
def _ilike_any(t: Tables):
    return t.pages.where(like_any(F.col("url"), ["%/EN/%", "HTTP://%", "%#Top"])).select("page_id", "url")


@query(
    "filter_null_default",
    tables=("plans",),
    sql="SELECT id, coalesce(cancel_reason, '-') AS reason FROM plans WHERE coalesce(cancel_reason, '') <> 'ExcludeFromReport'",
)
def _null_default(t: Tables):
    return t.plans.where(F.coalesce("cancel_reason", F.lit("")) != c.EXCLUDED_REASON).select(
        "id", F.coalesce("cancel_reason", F.lit("-")).alias("reason")
    )


@query(
    "case_first_match",
    tables=("plans",),
    sql="""SELECT id, CASE WHEN discount_id > 100 THEN 'far' WHEN discount_id > 50 THEN 'mid' WHEN status = 'Current' THEN 'live'
        ELSE 'rest' END AS band FROM plans""",
)
def _first_match(t: Tables):
    # a NULL condition counts as false and the next one is tried
    return t.plans.select(
        "id",
        F.when(F.col("discount_id") > 100, "far")
        .when(F.col("discount_id") > 50, "mid")
        .when(F.col("status") == "Current", "live")
        .otherwise("rest")
        .alias("band"),
    )


def _case(column: str, labels: dict) -> str:
    return f"CASE {column} " + " ".join(f"WHEN {k} THEN '{v}'" for k, v in labels.items()) + " END"


@query(
    "case_code_lookup",
    tables=("accounting",),
    sql=f"""SELECT transaction_id, {_case('provider_id', c.OPERATION_NAMES)} AS operation_name,
        {_case('payment_plan_tax', c.TAX_NAMES)} AS vat, {_case('product_tax', c.TAX_NAMES)} AS vat_num FROM accounting""",
)
def _code_lookup(t: Tables):
    return t.accounting.select(
        "transaction_id",
        code_label(F.col("provider_id"), c.OPERATION_NAMES).alias("operation_name"),
        code_label(F.col("payment_plan_tax"), c.TAX_NAMES).alias("vat"),
        code_label(F.col("product_tax"), c.TAX_NAMES).alias("vat_num"),
    )


@query(
    "flag_from_match",
    tables=("employees",),
    sql="""SELECT c_custkey, CASE WHEN e.user_id IS NULL THEN 'Клиент' ELSE 'Сотрудник' END AS if_employee
        FROM customer LEFT JOIN (SELECT DISTINCT user_id FROM employees WHERE is_active = 1) e ON e.user_id = c_custkey""",
)
def _flag(t: Tables):
    active = t.employees.where(F.col("is_active") == 1).select("user_id").distinct()
    return t.customer.join(active, F.col("c_custkey") == F.col("user_id"), "left").select(
        "c_custkey", F.when(F.col("user_id").isNull(), c.CLIENT).otherwise(c.EMPLOYEE).alias("if_employee")
    )


# --------------------------------------------------------------------------- joins


@query(
    "join_inner_equi",
    sql="""SELECT r_name, n_name, o_orderstatus, count(*) AS n, CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS paid
        FROM lineitem JOIN orders ON o_orderkey = l_orderkey JOIN customer ON c_custkey = o_custkey
        JOIN nation ON n_nationkey = c_nationkey JOIN region ON r_regionkey = n_regionkey GROUP BY ALL""",
)
def _inner(t: Tables):
    # lines shrink to one row per order before they meet the dimensions
    per_order = t.lineitem.groupBy("l_orderkey").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("l_extendedprice").cast(MONEY)).alias("paid")
    )
    return (
        per_order.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
        .groupBy("c_nationkey", "o_orderstatus")
        .agg(F.sum("n").alias("n"), F.sum("paid").alias("paid"))
        .join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
        .select("r_name", "n_name", "o_orderstatus", "n", "paid")
    )


@query(
    "join_left_equi",
    sql="""SELECT event_id, c_name, n_name, p_name, s_name FROM events LEFT JOIN customer ON c_custkey = user_id
        LEFT JOIN nation ON n_nationkey = c_nationkey AND n_nationkey < 20 LEFT JOIN part ON p_partkey = event_id
        LEFT JOIN supplier ON s_suppkey = user_id""",
)
def _left(t: Tables):
    return (
        t.events.select("event_id", "user_id")
        .join(t.customer, F.col("user_id") == F.col("c_custkey"), "left")
        .join(t.nation.where(F.col("n_nationkey") < 20), F.col("c_nationkey") == F.col("n_nationkey"), "left")
        .join(t.part, F.col("event_id") == F.col("p_partkey"), "left")
        .join(t.supplier, F.col("user_id") == F.col("s_suppkey"), "left")
        .select("event_id", "c_name", "n_name", "p_name", "s_name")
    )


@query(
    "join_left_multi_key",
    tables=("flows",),
    dates=("date",),
    sql="""
    WITH i AS (SELECT CAST(date_trunc('month', start_date) AS DATE) AS date, inflow_club_name AS club_name, CAST(sum(is_inflow) AS BIGINT) AS inflow
        FROM flows WHERE is_inflow = 1 GROUP BY ALL),
    o AS (SELECT CAST(date_trunc('month', end_date) AS DATE) AS date, outflow_club_name AS club_name, CAST(sum(is_outflow) AS BIGINT) AS outflow
        FROM flows WHERE is_outflow = 1 GROUP BY ALL)
    SELECT i.*, o.outflow FROM i LEFT JOIN o ON o.date = i.date AND o.club_name = i.club_name""",
)
def _multi_key(t: Tables):
    inflow = monthly_sum(t.flows, "start_date", {"club_name": "inflow_club_name"}, "is_inflow", "inflow")
    outflow = monthly_sum(t.flows, "end_date", {"club_name": "outflow_club_name"}, "is_outflow", "outflow")
    return inflow.join(outflow, ["date", "club_name"], "left")


@query(
    "join_left_extra_right_pred",
    sql="""
    WITH o AS (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS rn FROM orders)
    SELECT c_custkey, o.o_orderkey, o.o_totalprice FROM customer LEFT JOIN o ON o.o_custkey = c_custkey AND o.rn = 1""",
)
def _extra_pred(t: Tables):
    first = first_rows(
        t.orders.select("o_custkey", "o_orderkey", "o_totalprice", "o_orderdate"), ["o_custkey"], ["o_orderdate", "o_orderkey"]
    )
    return t.customer.join(first, F.col("c_custkey") == F.col("o_custkey"), "left").select(
        "c_custkey", "o_orderkey", "o_totalprice"
    )


@query(
    "join_left_computed_key",
    sql="""SELECT event_id, p_name, c_name FROM events LEFT JOIN part ON CAST(p_partkey AS VARCHAR) = json_extract_string(props, '$.k')
        LEFT JOIN customer ON CAST(split_part(c_name, '#', 2) AS BIGINT) = user_id * 3""",
)
def _computed_key(t: Tables):
    numbered = t.customer.select(F.split("c_name", "#")[1].cast("bigint").alias("_id"), "c_name")
    return (
        t.events.select(
            "event_id", F.get_json_object("props", "$.k").try_cast("bigint").alias("_k"), (F.col("user_id") * 3).alias("_u")
        )
        .join(t.part, F.col("_k") == F.col("p_partkey"), "left")
        .join(numbered, F.col("_u") == F.col("_id"), "left")
        .select("event_id", "p_name", "c_name")
    )


@query(
    "join_full_outer",
    tables=("active",),
    dates=("date",),
    sql="""
    WITH i AS (SELECT CAST(date_trunc('month', start_date) AS DATE) AS date, club_id, CAST(sum(is_inflow) AS BIGINT) AS inflow FROM active WHERE is_inflow = 1 GROUP BY ALL),
    o AS (SELECT CAST(date_trunc('month', end_date) AS DATE) AS date, club_id, CAST(sum(is_outflow) AS BIGINT) AS outflow FROM active WHERE is_outflow = 1 GROUP BY ALL)
    SELECT coalesce(i.date, o.date) AS date, coalesce(i.club_id, o.club_id) AS club_id, coalesce(inflow, 0) AS inflow, coalesce(outflow, 0) AS outflow
    FROM i FULL JOIN o ON i.date = o.date AND i.club_id = o.club_id""",
)
def _full(t: Tables):
    club = {"club_id": "club_id"}
    both = full_join(
        monthly_sum(t.active, "start_date", club, "is_inflow", "inflow"),
        monthly_sum(t.active, "end_date", club, "is_outflow", "outflow"),
        ["date", "club_id"],
    )
    return both.select("date", "club_id", zero("inflow").alias("inflow"), zero("outflow").alias("outflow"))


@query(
    "join_full_outer_chain",
    sql="""
    WITH a AS (SELECT s_suppkey * 20 AS k, s_name AS name FROM supplier),
    b AS (SELECT s_suppkey * 30 AS k, CASE WHEN s_suppkey % 2 = 0 THEN '' ELSE 'b' || s_name END AS name FROM supplier),
    d AS (SELECT c_custkey AS k, c_name AS name FROM customer)
    SELECT coalesce(d.k, a.k, b.k) AS id, coalesce(nullif(b.name, ''), a.name, d.name) AS name
    FROM d FULL JOIN a ON a.k = d.k FULL JOIN b ON b.k = coalesce(d.k, a.k)""",
)
def _full_chain(t: Tables):
    a = t.supplier.select((F.col("s_suppkey") * 20).alias("id"), F.col("s_name").alias("a"))
    b = t.supplier.select(
        (F.col("s_suppkey") * 30).alias("id"),
        F.when(F.col("s_suppkey") % 2 == 0, "").otherwise(F.concat(F.lit("b"), "s_name")).alias("b"),
    )
    d = t.customer.select(F.col("c_custkey").alias("id"), F.col("c_name").alias("d"))
    return full_join(full_join(d, a, ["id"]), b, ["id"]).select(
        "id", F.coalesce(F.nullif(F.col("b"), F.lit("")), "a", "d").alias("name")
    )


@query(
    "join_cross_grid",
    tables=("clubs", "flows"),
    dates=("date",),
    sql="""
    WITH g AS (SELECT CAST(m AS DATE) AS date, id AS club_id FROM clubs,
        (SELECT unnest(generate_series(DATE '1995-01-01', DATE '2001-12-01', INTERVAL 1 MONTH)) AS m)),
    i AS (SELECT CAST(date_trunc('month', start_date) AS DATE) AS date, inflow_club AS club_id, count(*) AS n FROM flows GROUP BY ALL)
    SELECT g.date, g.club_id, i.n FROM g LEFT JOIN i ON i.date = g.date AND i.club_id = g.club_id""",
)
def _grid(t: Tables):
    grid = month_grid(t.clubs.select(F.col("id").alias("club_id")), dt.date(1995, 1, 1), dt.date(2001, 12, 1))
    monthly = t.flows.groupBy(month_start(F.col("start_date")).alias("date"), F.col("inflow_club").alias("club_id")).agg(
        F.count(F.lit(1)).alias("n")
    )
    return grid.join(monthly, ["date", "club_id"], "left")


@query(
    "join_cross_scalar",
    sql="SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderdate > (SELECT max(o_orderdate) - INTERVAL 400 DAY FROM orders)",
)
def _scalar(t: Tables):
    # one row: read once and used as a literal, so the filter reaches the scan
    top = t.orders.agg(F.max("o_orderdate")).first()[0]
    return t.orders.where(F.col("o_orderdate") > ntz(top - dt.timedelta(days=400))).select("o_orderkey", "o_totalprice")


@query(
    "join_self_next_row",
    sql="""
    WITH r AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn FROM events)
    SELECT a.event_id, a.user_id, b.event_id AS next_id, b.event_type AS next_type FROM r a LEFT JOIN r b ON b.user_id = a.user_id AND b.rn = a.rn + 1""",
)
def _self_next(t: Tables):
    rows = t.events.select("event_id", "user_id", "ts", "event_type")
    hot = t.large("events").of("events.user")
    out = neighbours(rows, ["user_id"], ["ts", "event_id"], lead={"next_id": "event_id", "next_type": "event_type"}, hot=hot)
    return out.select("event_id", "user_id", "next_id", "next_type")


# the periods of the plans end before the events begin; shifted, events fall before, into, between and after them
_RANGE = "plan_from AS (SELECT user_id, signed_date + INTERVAL 9400 DAY AS a, end_date + INTERVAL 9400 DAY AS b FROM plans WHERE end_date IS NOT NULL)"


@query(
    "join_range_interval",
    tables=("plans",),
    sql=f"""WITH {_RANGE} SELECT event_id, user_id, ts FROM events e
        WHERE EXISTS (SELECT 1 FROM plan_from p WHERE p.user_id = e.user_id AND e.ts BETWEEN p.a AND p.b)""",
)
def _range_interval(t: Tables):
    points = t.events.select("event_id", "user_id", "ts")
    spans = t.plans.where(F.col("end_date").isNotNull()).select(
        "user_id",
        (F.col("signed_date") + F.expr("INTERVAL 9400 DAY")).alias("_a"),
        (F.col("end_date") + F.expr("INTERVAL 9400 DAY")).alias("_b"),
    )
    hot = t.large("events", "plans").of("events.user", "plans.user")
    return inside_any(points, spans, ["user_id"], "ts", "_a", "_b", "event_id", hot=hot)


@query(
    "join_as_attribution",
    tables=("plans",),
    dates=("day", "start_date"),
    sql="""
    WITH p AS (SELECT user_id, id, status, CAST(signed_date + INTERVAL 9400 DAY AS DATE) AS a, CAST(end_date + INTERVAL 9600 DAY AS DATE) AS b FROM plans WHERE end_date IS NOT NULL),
    e AS (SELECT event_id, user_id, CAST(ts AS DATE) AS day FROM events)
    SELECT e.event_id, e.user_id, e.day, max(CASE WHEN e.day BETWEEN a AND b THEN p.id END) AS plan_id,
        max(CASE WHEN e.day BETWEEN a AND b THEN p.status END) AS status, max(CASE WHEN e.day BETWEEN a AND b THEN a END) AS start_date
    FROM e LEFT JOIN p ON p.user_id = e.user_id GROUP BY ALL""",
)
def _attribution(t: Tables):
    points = t.events.select("event_id", "user_id", F.to_date("ts").alias("day"))
    spans = t.plans.where(F.col("end_date").isNotNull()).select(
        "user_id",
        F.col("id").alias("plan_id"),
        "status",
        F.to_date(F.col("signed_date") + F.expr("INTERVAL 9400 DAY")).alias("start_date"),
        F.to_date(F.col("end_date") + F.expr("INTERVAL 9600 DAY")).alias("_end"),
    )
    names = {n: n for n in ("plan_id", "status", "start_date")}
    return max_over_covering(points, spans, ["user_id"], "day", "start_date", "_end", names)


@query(
    "join_within_days",
    sql="""
    WITH f AS (SELECT o_custkey, min(o_orderdate) AS first_buy FROM orders GROUP BY ALL),
    k AS (SELECT l_suppkey AS u, max(l_shipdate) AS click FROM lineitem GROUP BY ALL)
    SELECT o_custkey AS user_id, CASE WHEN click <= first_buy + INTERVAL 2000 DAY THEN 'Пришел по трекеру' ELSE '-' END AS is_tracker_user
    FROM f LEFT JOIN k ON k.u = o_custkey""",
)
def _within_days(t: Tables):
    bought = t.orders.groupBy(F.col("o_custkey").alias("user_id")).agg(F.min("o_orderdate").alias("_first"))
    clicks = t.lineitem.groupBy(F.col("l_suppkey").alias("user_id")).agg(F.max("l_shipdate").alias("_click"))
    near = F.col("_click") <= F.col("_first") + F.expr("INTERVAL 2000 DAY")
    return bought.join(clicks, "user_id", "left").select(
        "user_id", F.when(near, c.TRACKER_YES).otherwise("-").alias("is_tracker_user")
    )


@query(
    "join_semi_in_subquery",
    tables=("plans", "inflow_plan_ids"),
    sql="SELECT id, user_id FROM plans WHERE payment_plan_id IN (SELECT id FROM inflow_plan_ids)",
)
def _semi(t: Tables):
    ids = t.inflow_plan_ids.select(F.col("id").alias("payment_plan_id"))
    return t.plans.join(ids, "payment_plan_id", "left_semi").select("id", "user_id")


@query(
    "join_anti_not_in",
    tables=("trainers_region",),
    sql="SELECT c_custkey, c_name FROM customer WHERE NOT EXISTS (SELECT 1 FROM trainers_region WHERE id = c_custkey)",
)
def _anti(t: Tables):
    # the list holds NULLs; an anti join is not emptied by them
    listed = t.trainers_region.select(F.col("id").alias("c_custkey"))
    return t.customer.join(listed, "c_custkey", "left_anti").select("c_custkey", "c_name")


@query(
    "join_left_then_where",
    sql="SELECT event_id, s_name FROM events LEFT JOIN supplier ON s_suppkey = user_id WHERE s_acctbal > 2000",
)
def _left_where(t: Tables):
    # the condition on the right side drops unmatched rows: an inner join
    rich = t.supplier.where(F.col("s_acctbal") > 2000)
    return t.events.join(rich, F.col("user_id") == F.col("s_suppkey")).select("event_id", "s_name")


@query(
    "join_self_refund",
    tables=("transactions",),
    sql="""SELECT t.id, t.user_id, r.id AS return_transaction, r.updated_at AS return_date
        FROM transactions t LEFT JOIN transactions r ON r.payment_transaction_id = t.id AND r.type = 'refund' WHERE t.type <> 'refund'""",
)
def _refund(t: Tables):
    refunds = t.transactions.where(F.col("type") == "refund").select(
        F.col("payment_transaction_id").alias("id"),
        F.col("id").alias("return_transaction"),
        F.col("updated_at").alias("return_date"),
    )
    return t.transactions.where(F.col("type") != "refund").select("id", "user_id").join(refunds, "id", "left")


@query(
    "join_same_month_any_year",
    tables=("revenue",),
    dates=("date", "date_2"),
    sql="""
    WITH m AS (SELECT CAST(date_trunc('month', date) AS DATE) AS date, club_name, CAST(sum(total_cost) AS DOUBLE) AS revenue FROM revenue GROUP BY 1, 2)
    SELECT a.date, a.club_name, a.revenue, b.date AS date_2, b.revenue AS revenue_2
    FROM m a LEFT JOIN m b ON month(a.date) = month(b.date) AND a.club_name = b.club_name""",
)
def _same_month(t: Tables):
    # one row per club and month first; a club pairs with its own years only
    monthly = (
        t.revenue.groupBy(month_start(F.col("date")).alias("date"), "club_name")
        .agg(F.sum("total_cost").alias("revenue"))
        .withColumn("_month", F.month("date"))
    )
    other = monthly.select("_month", "club_name", F.col("date").alias("date_2"), F.col("revenue").alias("revenue_2"))
    return monthly.join(other, ["_month", "club_name"], "left").drop("_month")


# --------------------------------------------------------------------------- aggregates


@query(
    "agg_sum_count_group",
    sql="""SELECT l_returnflag, l_linestatus, count(*) AS n, CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS quantity,
        CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS price FROM lineitem GROUP BY ALL""",
)
def _sum_count(t: Tables):
    return t.lineitem.groupBy("l_returnflag", "l_linestatus").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.col("l_quantity").cast(MONEY)).alias("quantity"),
        F.sum(F.col("l_extendedprice").cast(MONEY)).alias("price"),
    )


@query(
    "agg_min_max_group",
    sql="SELECT user_id, event_type, min(ts) AS first_seen, max(ts) AS last_seen FROM events GROUP BY ALL",
)
def _min_max(t: Tables):
    return t.events.groupBy("user_id", "event_type").agg(F.min("ts").alias("first_seen"), F.max("ts").alias("last_seen"))


@query(
    "agg_avg_round",
    sql="SELECT p_size, round_even(avg(p_partkey), 0) AS mean, count(*) AS n FROM part GROUP BY ALL",
)
def _avg_round(t: Tables):
    return t.part.groupBy("p_size").agg(round_even(F.avg("p_partkey"), 0).alias("mean"), F.count(F.lit(1)).alias("n"))


@query(
    "agg_count_distinct",
    sql="SELECT event_type, count(DISTINCT user_id) AS people, count(DISTINCT CAST(ts AS DATE)) AS days FROM events GROUP BY ALL",
)
def _count_distinct(t: Tables):
    return t.events.groupBy("event_type").agg(
        F.count_distinct("user_id").alias("people"), F.count_distinct(F.to_date("ts")).alias("days")
    )


@query(
    "agg_count_if",
    sql="SELECT o_custkey % 25 AS club_id, "
    + ", ".join(f"count(*) FILTER (WHERE o_totalprice > {k * 25000}) AS over{k}" for k in range(1, 20))
    + " FROM orders GROUP BY ALL",
)
def _count_if(t: Tables):
    steps = [F.count_if(F.col("o_totalprice") > k * 25000).alias(f"over{k}") for k in range(1, 20)]
    return t.orders.groupBy((F.col("o_custkey") % 25).alias("club_id")).agg(*steps)


@query(
    "agg_max_if",
    sql="""SELECT user_id, max(value) FILTER (WHERE event_type <> 'error') AS best,
        max(CASE WHEN event_type = 'click' THEN event_type ELSE '-' END) AS clicked FROM events GROUP BY ALL""",
)
def _max_if(t: Tables):
    return t.events.groupBy("user_id").agg(
        F.max(F.when(F.col("event_type") != "error", F.col("value"))).alias("best"),
        F.max(F.when(F.col("event_type") == "click", F.col("event_type")).otherwise("-")).alias("clicked"),
    )


@query(
    "agg_sum_if_flag",
    sql="SELECT user_id, CAST(sum(CASE WHEN event_type = 'view' THEN 0 ELSE 1 END) * 17 + 30 AS BIGINT) AS seconds FROM events GROUP BY ALL",
)
def _sum_if(t: Tables):
    counted = F.sum(F.when(F.col("event_type") == "view", 0).otherwise(1))
    return t.events.groupBy("user_id").agg((counted * c.SECONDS_PER_ROW + c.SECONDS_BASE).alias("seconds"))


@query(
    "agg_ratio_of_sums",
    sql="""SELECT o_custkey, CASE WHEN count(*) > 10 THEN sum(o_orderkey)::DOUBLE / nullif(sum(o_orderkey % 7), 0)
        ELSE sum(o_orderkey)::DOUBLE / nullif(sum(o_orderkey % 3), 0) END AS alt FROM orders GROUP BY ALL""",
)
def _ratio_sums(t: Tables):
    key = F.col("o_orderkey")
    return t.orders.groupBy("o_custkey").agg(
        F.when(F.count(F.lit(1)) > 10, ratio(F.sum(key), F.sum(key % 7)))
        .otherwise(ratio(F.sum(key), F.sum(key % 3)))
        .alias("alt")
    )


@query("agg_global_max", sql="SELECT max(event_id) AS max_id, max(ts) AS max_ts FROM events")
def _global_max(t: Tables):
    return t.events.agg(F.max("event_id").alias("max_id"), F.max("ts").alias("max_ts"))


@query(
    "agg_distinct_by_groupby",
    dates=("day",),
    sql="SELECT DISTINCT user_id, CAST(ts AS DATE) AS day FROM events",
)
def _distinct(t: Tables):
    return t.events.select("user_id", F.to_date("ts").alias("day")).distinct()


@query(
    "agg_having",
    sql="""SELECT o_custkey, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS paid FROM orders GROUP BY ALL
        HAVING sum(CAST(o_totalprice AS DECIMAL(18,2))) > 2500000""",
)
def _having(t: Tables):
    paid = t.orders.groupBy("o_custkey").agg(F.sum(F.col("o_totalprice").cast(MONEY)).alias("paid"))
    return paid.where(F.col("paid") > 2_500_000)


@query(
    "agg_total_plus_detail",
    tables=("users",),
    dates=("day",),
    sql="""
    WITH q AS (SELECT user_id % 25 AS club_id, CAST(ts AS DATE) AS day, coalesce(sex, 'unknown') AS sex, count(DISTINCT user_id) AS people
        FROM events LEFT JOIN users ON id = user_id GROUP BY ALL)
    SELECT * FROM q UNION ALL SELECT club_id, day, 'total', CAST(sum(people) AS BIGINT) FROM q GROUP BY ALL""",
)
def _total_detail(t: Tables):
    seen = t.events.select((F.col("user_id") % 25).alias("club_id"), F.to_date("ts").alias("day"), "user_id").distinct()
    sex = t.users.select(F.col("id").alias("user_id"), F.col("sex"))
    detail = (
        seen.join(sex, "user_id", "left")
        .groupBy("club_id", "day", F.coalesce("sex", F.lit("unknown")).alias("sex"))
        .agg(F.count(F.lit(1)).alias("people"))
    )
    total = detail.groupBy("club_id", "day").agg(F.sum("people").alias("people")).withColumn("sex", F.lit("total"))
    return detail.unionByName(total)


@query(
    "agg_group_ordinal",
    sql="""SELECT l_returnflag, l_linestatus, l_linenumber, year(l_shipdate) AS year, count(*) AS n FROM lineitem GROUP BY 1, 2, 3, 4""",
)
def _ordinal(t: Tables):
    return t.lineitem.groupBy("l_returnflag", "l_linestatus", "l_linenumber", F.year("l_shipdate").alias("year")).agg(
        F.count(F.lit(1)).alias("n")
    )


@query(
    "agg_groupby_then_window",
    sql="""SELECT o_custkey, club_id, n, row_number() OVER (PARTITION BY o_custkey ORDER BY n DESC, club_id) AS rnk
        FROM (SELECT o_custkey, o_orderkey % 5 AS club_id, count(*) AS n FROM orders GROUP BY ALL)""",
)
def _group_then_window(t: Tables):
    # a customer has at most five groups left, so the window is small by then
    per = (
        t.orders.groupBy("o_custkey", (F.col("o_orderkey") % 5).alias("club_id"))
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn("_down", -F.col("n"))
    )
    return row_numbers(per, ["o_custkey"], ["_down", "club_id"], "rnk").drop("_down")


# --------------------------------------------------------------------------- sorts and sets


@query("sort_output", sql="SELECT event_id, user_id, value FROM events ORDER BY value DESC, event_id")
def _sort(t: Tables):
    return t.events.select("event_id", "user_id", "value").orderBy(F.col("value").desc_nulls_last(), F.col("event_id").asc_nulls_last())


@query(
    "topk_per_key",
    sql="""SELECT o_custkey, club_id, days FROM (
        SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY days DESC, club_id) AS rn
        FROM (SELECT o_custkey, o_orderkey * 7 % 25 AS club_id, CAST(sum(o_orderkey % 100) AS BIGINT) AS days FROM orders GROUP BY ALL)) WHERE rn = 1""",
)
def _topk(t: Tables):
    per = (
        t.orders.groupBy("o_custkey", (F.col("o_orderkey") * 7 % 25).alias("club_id"))
        .agg(F.sum(F.col("o_orderkey") % 100).alias("days"))
        .withColumn("_down", -F.col("days"))
    )
    return first_rows(per, ["o_custkey"], ["_down", "club_id"]).drop("_down")


@query(
    "set_union_all",
    sql="SELECT o_orderkey AS id, o_custkey AS who FROM orders UNION ALL SELECT event_id, user_id FROM events UNION ALL SELECT l_orderkey, l_suppkey FROM lineitem",
)
def _union_all(t: Tables):
    a = t.orders.select(F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("who"))
    b = t.events.select(F.col("user_id").alias("who"), F.col("event_id").alias("id"))
    d = t.lineitem.select(F.col("l_orderkey").alias("id"), F.col("l_suppkey").alias("who"))
    return a.unionByName(b).unionByName(d)


@query(
    "set_union_distinct",
    tables=("plans", "employees"),
    sql=f"""SELECT user_id FROM plans WHERE payment_plan_id IN {c.STAFF_PLAN_IDS} AND status = 'Current'
        UNION SELECT user_id FROM employees WHERE is_active = 1""",
)
def _union_distinct(t: Tables):
    return staff_users(t.plans, t.employees)
