"""The marts on the given tables, each next to plain SQL that computes the same rows."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from clubflow import config as c
from clubflow.catalog.registry import Tables, query
from clubflow.catalog.standins import KEY_SETS
from clubflow.functions.dates import month_start
from clubflow.functions.text import split_number
from clubflow.operators.skew import measure
from clubflow.plans import anomalies, campaign, cohorts, mobile, money, trainers, tree, visits
from clubflow.session import materialize, new_table_path
from clubflow.sources import load, receipts, watching

START = dt.date(1995, 1, 1)
AS_OF = dt.date(2001, 12, 1)
NOW = dt.datetime(2024, 1, 31)
EVENTS_FROM, EVENTS_TO = dt.datetime(2024, 1, 1), dt.datetime(2024, 3, 1)
CAMPAIGN_FROM = dt.date(1996, 1, 1)
PAY_FROM = dt.datetime(1996, 1, 1)


def _in(values) -> str:
    return "(" + ", ".join(f"'{v}'" if isinstance(v, str) else str(v) for v in values) + ")"


def _label(column: str, rules) -> str:
    arms = " ".join(f"WHEN {column} LIKE '{p}' THEN '{v}'" for p, v in rules)
    return f"CASE {arms} ELSE {column} END"


def _codes(column: str, labels) -> str:
    return f"CASE {column} " + " ".join(f"WHEN {k} THEN '{v}'" for k, v in labels.items()) + " END"


def _birthday(column: str) -> str:
    n = f"({column} - DATE '1970-01-01')"
    return f"CASE WHEN {n} >= 39969 THEN DATE '1970-01-01' + CAST({n} - 65536 AS INTEGER) ELSE {column} END"


# --------------------------------------------------------------------------- visits


def _occupancy_sql(first: dt.datetime, last: dt.datetime) -> str:
    return f"""
    WITH ev AS (
        SELECT DISTINCT user_id, club_id, club_name, event_type, event_date FROM visit_history
        WHERE event_type IN ('club_in', 'club_out')
          AND event_date >= TIMESTAMP '{first}' - INTERVAL 2 HOUR AND event_date < TIMESTAMP '{last}' + INTERVAL 2 HOUR
          AND user_id NOT IN (SELECT user_id FROM employees WHERE is_deleted = 0 AND is_active = 1)
          AND club_id IN (SELECT id FROM clubs WHERE json_extract_string(open_hours, '$.is_open_all_day') = 'true')),
    nx AS (
        SELECT *, lead(event_type) OVER w AS nt, lead(event_date) OVER w AS nd FROM ev
        WINDOW w AS (PARTITION BY user_id, club_id ORDER BY event_date, event_type)),
    sp AS (
        SELECT *, CASE nt WHEN 'club_out' THEN nd WHEN 'club_in' THEN nd - INTERVAL 1 SECOND
            ELSE event_date + INTERVAL 2 HOUR END AS till
        FROM nx WHERE event_type = 'club_in'),
    hr AS (
        SELECT user_id, club_id, club_name,
            unnest(generate_series(date_trunc('hour', event_date), date_trunc('hour', till), INTERVAL 1 HOUR)) AS check_time
        FROM sp),
    q AS (
        SELECT check_time, club_id, club_name, coalesce(sex, 'unknown') AS sex, count(DISTINCT user_id) AS people_in_club
        FROM hr LEFT JOIN users ON users.id = hr.user_id
        WHERE check_time >= TIMESTAMP '{first}' AND check_time < TIMESTAMP '{last}' GROUP BY ALL)
    SELECT * FROM q UNION ALL
    SELECT check_time, club_id, club_name, 'total', CAST(sum(people_in_club) AS BIGINT) FROM q GROUP BY ALL"""


_OCCUPANCY_TABLES = ("visit_history", "users", "clubs", "employees")


@query("mart_occupancy_hourly", tables=_OCCUPANCY_TABLES, sql=_occupancy_sql(EVENTS_FROM, EVENTS_TO))
def _occupancy(t: Tables):
    return visits.occupancy_hourly(t.visit_history, t.users, t.clubs, t.employees, EVENTS_FROM, EVENTS_TO, large=t.large("visit_history"))


#: A day and a half that is loaded again.
_AGAIN = dt.datetime(2024, 1, 9, 18), dt.datetime(2024, 1, 11, 6)


@query(
    "mart_occupancy_reload",
    tables=_OCCUPANCY_TABLES,
    sql=f"""
    SELECT * FROM ({_occupancy_sql(EVENTS_FROM, EVENTS_TO)}) WHERE check_time < TIMESTAMP '{_AGAIN[0]}' OR check_time >= TIMESTAMP '{_AGAIN[1]}'
    UNION ALL SELECT * FROM ({_occupancy_sql(*_AGAIN)})""",
)
def _occupancy_reload(t: Tables):
    """A range of hours loaded again, from the events two hours around it; the days at its edges keep their other hours."""
    path = new_table_path(t.spark, "occupancy")

    def hours(first: dt.datetime, last: dt.datetime):
        rows = visits.occupancy_hourly(t.visit_history, t.users, t.clubs, t.employees, first, last, large=t.large("visit_history"))
        return rows.withColumn("day", F.to_date("check_time"))

    load.overwrite_partitions(hours(EVENTS_FROM, EVENTS_TO), path, "day")
    for _ in range(2):  # a repeated load changes nothing
        load.replace_range(hours(*_AGAIN), path, "check_time", *_AGAIN, "day", partitions=(_AGAIN[0].date(), _AGAIN[1].date()))
    return load.read_target(t.spark, path).drop("day")


_VISITS = f"""
    SELECT s.id, s.user_id, u.name AS user_name, coalesce(u.last_name, '') AS last_name, u.email,
        coalesce(u.sex, '') AS sex, {_birthday('u.birthday')} AS birthday, s.club_id, k.name AS club_name,
        s.club_event_date AS event_date, s.event_type
    FROM swipes s LEFT JOIN users u ON u.id = s.user_id LEFT JOIN clubs k ON k.id = s.club_id WHERE s.id > 10"""


@query("mart_visit_history", tables=("swipes", "users", "clubs"), dates=("birthday",), sql=_VISITS)
def _visit_history(t: Tables):
    return visits.visit_history(t.swipes, t.users, t.clubs, above=10)


@query("mart_visit_history_batches", tables=("swipes", "users", "clubs"), dates=("birthday",), sql=_VISITS)
def _visit_history_batches(t: Tables):
    """Hourly appends above the watermark that the table keeps."""
    path = new_table_path(t.spark, "visits")
    top = t.swipes.agg(F.max("id")).first()[0] or 0
    for upto in (top // 3, top // 2, top, top):  # the last one finds nothing new
        arrived = t.swipes.where(F.col("id") <= upto)
        load.append_computed(t.spark, path, "id", lambda above, rows=arrived: visits.visit_history(rows, t.users, t.clubs, max(above, 10)))
    return load.read_target(t.spark, path)


_IN_OUT = f"""
    raw AS (
        SELECT v.id, v.user_id, u.name AS user_name, coalesce(u.last_name, '') AS last_name, u.email,
            coalesce(u.sex, '') AS sex, {_birthday('u.birthday')} AS birthday, v.club_id, k.name AS club_name,
            v.club_event_date AS d, v.event_type,
            lead(v.club_event_date) OVER w AS nd, lag(v.club_event_date) OVER w AS pd,
            lead(v.event_type) OVER w AS nt, lag(v.event_type) OVER w AS pt
        FROM visits_histories v LEFT JOIN users u ON u.id = v.user_id LEFT JOIN clubs k ON k.id = v.club_id
        WHERE v.event_type IN ('club_in', 'club_out')
        WINDOW w AS (PARTITION BY v.user_id ORDER BY v.club_event_date, v.id)),
    both_sides AS (
        SELECT id, user_id, user_name, last_name, email, sex, birthday, club_id, club_name, d AS in_date, event_type,
            CASE WHEN nd IS NULL OR date_diff('day', d, nd) >= 1 OR nt = 'club_in' THEN d + INTERVAL 90 MINUTE ELSE nd END AS out_date
        FROM raw WHERE event_type = 'club_in'
        UNION ALL
        SELECT id, user_id, user_name, last_name, email, sex, birthday, club_id, club_name,
            CASE WHEN pd IS NULL OR date_diff('day', pd, d) >= 1 OR pt = 'club_out' THEN d - INTERVAL 90 MINUTE ELSE pd END,
            event_type, d
        FROM raw WHERE event_type = 'club_out')"""


def _raw(t: Tables):
    return visits.in_out_raw(
        t.visits_histories, t.users, t.clubs, dt.date(2024, 1, 1), dt.date(2024, 3, 1), large=t.large("visits_histories")
    )


@query(
    "mart_in_out_visits",
    tables=("visits_histories", "users", "clubs"),
    dates=("birthday",),
    sql=f"WITH {_IN_OUT} SELECT * FROM both_sides",
)
def _in_out(t: Tables):
    return visits.in_out_visits(_raw(t)).visits


@query(
    "mart_in_out_raw",
    tables=("visits_histories", "users", "clubs"),
    dates=("birthday",),
    sql=f"""WITH {_IN_OUT} SELECT id, user_id, user_name, last_name, email, sex, birthday, club_id, club_name,
        d AS event_date, event_type, nd AS next_event_date, pd AS prev_event_date, nt AS next_event, pt AS prev_event FROM raw""",
)
def _in_out_raw(t: Tables):
    return _raw(t)


@query(
    "mart_in_out_entries",
    tables=("visits_histories", "users", "clubs"),
    dates=("birthday",),
    sql=f"WITH {_IN_OUT} SELECT * FROM both_sides WHERE event_type = 'club_in'",
)
def _entries(t: Tables):
    return visits.in_out_visits(_raw(t)).entries


@query(
    "mart_in_out_exits",
    tables=("visits_histories", "users", "clubs"),
    dates=("birthday",),
    sql=f"WITH {_IN_OUT} SELECT * FROM both_sides WHERE event_type = 'club_out'",
)
def _exits(t: Tables):
    return visits.in_out_visits(_raw(t)).exits


_GAPFILL = """
    WITH s AS (
        SELECT s.*, k.id AS known FROM swipes s LEFT JOIN clubs k ON k.id = s.club_id WHERE event_type = 'qr_check'),
    w AS (
        SELECT *, coalesce(lag(known) OVER x, lead(known) OVER x,
            first_value(club_id IGNORE NULLS) OVER (PARTITION BY user_id, CAST(event_date AS DATE) ORDER BY id
                ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)) AS pick
        FROM s WINDOW x AS (PARTITION BY user_id, CAST(event_date AS DATE) ORDER BY id))
    SELECT w.id, event_date + INTERVAL 3 HOUR AS event_date, event_type, sys_response, k.id AS club_id,
        k.name AS club_name, user_id, is_success
    FROM w LEFT JOIN clubs k ON k.id = w.pick"""


@query("mart_swipe_gapfill", tables=("swipes", "clubs"), sql=_GAPFILL)
def _gapfill(t: Tables):
    return visits.swipe_gapfill(t.swipes, t.clubs, above=-1, large=t.large("swipes"))


@query("mart_swipe_gapfill_batches", tables=("swipes", "clubs"), sql=_GAPFILL)
def _gapfill_batches(t: Tables):
    path = new_table_path(t.spark, "swipes")
    top = t.swipes.agg(F.max("id")).first()[0] or 0
    above = -1
    for batch, upto in enumerate((top // 3, top // 2, top)):
        arrived = t.swipes.where(F.col("id") <= upto)
        rows = visits.swipe_gapfill(
            arrived, t.clubs, above, reopen=True, since=visits.first_day_above(arrived, above), large=t.large("swipes")
        ).withColumns({"batch": F.lit(batch), "month": month_start(F.col("event_date"))})
        load.append(rows, path, "month")
        above = upto
    table = load.read_target(t.spark, path)
    months = [row[0] for row in table.select("month").distinct().collect()]
    load.compact(t.spark, path, ["id"], ["batch"], "month", months)
    return load.read_target(t.spark, path).drop("batch", "month")


@query(
    "mart_class_attendance",
    tables=("visits_histories", "users", "clubs", "plans", "bookings"),
    sql=f"""
    WITH {_IN_OUT},
    p AS (
        SELECT user_id, signed_date + INTERVAL 6 HOUR AS a,
            CASE WHEN end_date IS NULL AND status IN {_in(c.LIVE_STATUSES)} THEN TIMESTAMP '2099-12-31'
                ELSE end_date + INTERVAL 6 HOUR END AS b
        FROM plans WHERE payment_plan_id NOT IN {_in(c.NO_ATTENDANCE_PLAN_IDS)} AND status <> 'Deleted'),
    v AS (
        SELECT * FROM both_sides AS x
        WHERE CAST(in_date AS DATE) = CAST(out_date - INTERVAL 3 HOUR AS DATE)
          AND EXISTS (SELECT 1 FROM p WHERE p.user_id = x.user_id AND x.in_date BETWEEN p.a AND p.b)),
    came AS (
        SELECT DISTINCT b.booking_id FROM bookings b JOIN v ON v.user_id = b.user_id
          AND CAST(b.start_time AS DATE) = CAST(v.in_date AS DATE)
          AND b.start_time >= v.in_date + INTERVAL 1 MINUTE AND b.end_time <= v.out_date + INTERVAL 1 MINUTE)
    SELECT b.*, CASE WHEN came.booking_id IS NOT NULL THEN 'Yes' END AS is_visit,
        CASE WHEN came.booking_id IS NULL AND booking_status = 'booked' THEN 1 ELSE 0 END AS is_visit_no,
        CASE WHEN booking_status = 'wait_list' THEN 1 ELSE 0 END AS is_visit_waiting,
        CASE WHEN booking_status = 'cancelled' THEN 1 ELSE 0 END AS is_visit_cancel,
        CASE WHEN came.booking_id IS NOT NULL AND booking_status = 'booked' THEN 1 ELSE 0 END AS is_visit_yes,
        CASE WHEN came.booking_id IS NOT NULL AND booking_status = 'booked' THEN 'Yes'
            WHEN booking_status IN ('waiting_list', 'cancelled') THEN booking_status ELSE 'No' END AS is_visit_calc
    FROM bookings b LEFT JOIN came ON came.booking_id = b.booking_id""",
)
def _attendance(t: Tables):
    return visits.class_attendance(
        visits.in_out_visits(_raw(t)).visits, t.plans, t.bookings, large=t.large("visits_histories", "plans", "bookings")
    )


# --------------------------------------------------------------------------- money


def _revenue_sql(until: str) -> str:
    return f"""
    WITH own AS (SELECT * FROM plans WHERE payment_plan_id NOT IN (111, 1)),
    mv AS (
        SELECT m.user_payment_plan_id AS id, m.created_at + INTERVAL 3 HOUR AS at_, m.old_club_id
        FROM club_moves m JOIN own ON own.id = m.user_payment_plan_id
        WHERE m.created_at + INTERVAL 3 HOUR >= own.start_date),
    pts AS (
        SELECT id, start_date AS d, 0 AS k, club_id FROM own
        UNION ALL SELECT id, at_, 1, old_club_id FROM mv
        UNION ALL SELECT id, end_date, 2, club_id FROM own),
    second AS (
        SELECT id, club_id FROM (
            SELECT *, row_number() OVER (PARTITION BY id ORDER BY d NULLS LAST, k, club_id) AS n FROM pts) WHERE n = 2),
    tx AS (
        SELECT t.*, CAST(date_trunc('month', t.updated_at) AS DATE) AS date, coalesce(p.payment_plan_id, 0) AS plan_id,
            l.club_id AS legal, second.club_id AS first_club,
            CASE WHEN provider_id IN {_in(c.REVENUE_PLUS)} THEN total_amount
                WHEN provider_id IN {_in(c.REVENUE_MINUS)} THEN -total_amount ELSE 0 END AS revenue
        FROM transactions t LEFT JOIN plans p ON p.id = t.user_payment_plan_id
        LEFT JOIN legal_infos l ON l.id = t.club_legal_info_id
        LEFT JOIN second ON second.id = t.user_payment_plan_id
        WHERE coalesce(p.payment_plan_id, 0) NOT IN (111, 1) AND t.updated_at < TIMESTAMP '{until}')
    SELECT tx.date, plan_id AS payment_plan_id, pp.name AS payment_name,
        CASE WHEN legal > 0 THEN legal ELSE first_club END AS club_id, k.name AS club_name, k.city_id, k.club_type,
        k.open_date, sum(revenue) AS total_cost
    FROM tx LEFT JOIN clubs k ON k.id = CASE WHEN legal > 0 THEN legal ELSE first_club END
    LEFT JOIN payment_plans pp ON pp.id = plan_id
    GROUP BY ALL"""


@query(
    "mart_revenue_monthly",
    tables=("transactions", "plans", "club_moves", "legal_infos", "clubs", "payment_plans"),
    dates=("date", "open_date"),
    money=("total_cost",),
    sql=_revenue_sql("2003-01-01"),
)
def _revenue(t: Tables):
    return money.revenue_monthly(
        t.transactions, t.plans, t.club_moves, t.legal_infos, t.clubs, t.payment_plans, START, dt.date(2002, 12, 31)
    )


@query(
    "mart_revenue_monthly_reload",
    tables=("transactions", "plans", "club_moves", "legal_infos", "clubs", "payment_plans"),
    dates=("date", "open_date"),
    money=("total_cost",),
    sql=_revenue_sql("2000-05-03"),
)
def _revenue_reload(t: Tables):
    path = new_table_path(t.spark, "revenue")

    def build(first: dt.date, last: dt.date, known=t.transactions):
        return money.revenue_monthly(known, t.plans, t.club_moves, t.legal_infos, t.clubs, t.payment_plans, first, last)

    # loaded when the last third of April was not there yet; the reload of 2 May completes it
    early = t.transactions.where(F.col("updated_at") < F.lit("2000-04-20").cast("timestamp_ntz"))
    load.overwrite_partitions(build(START, AS_OF, early), path, "date")
    load.replace_months(build, path, dt.date(2000, 5, 2))
    return load.read_target(t.spark, path)


_LEDGER_TABLES = ("accounting", "ledger_transactions", "receipts", "users", "legal_infos", "clubs")
_LEDGER_MONEY = (
    "join_fee", "join_fee_net", "membership_fee", "membership_fee_net", "product_price", "total_amount", "total_net", "balance",
)
_LEDGER = f"""
    WITH rc AS (
        SELECT TRY_CAST(split_part(number, '_', 2) AS BIGINT) AS tid, fiscal_status, count(*) AS n FROM receipts
        WHERE fiscal_status IN {_in(c.COUNTED_FISCAL_STATUSES)} GROUP BY ALL)
    SELECT a.transaction_id, k.name AS club_name, a.created_at + INTERVAL 6 HOUR AS date,
        {_codes('a.provider_id', c.OPERATION_NAMES)} AS operation_name, a.type AS transaction_type, a.user_id,
        u.name || ' ' || u.last_name AS name, a.payment_plan_name AS subscription_name, a.join_fee, a.join_fee_net,
        a.membership_fee, a.membership_fee_net, {_codes('a.payment_plan_tax', c.TAX_NAMES)} AS vat, a.product_name,
        a.product_quantity AS product_qty, a.product_price, a.product_total_amount AS total_amount,
        a.product_total_amount_net AS total_net, {_codes('a.product_tax', c.TAX_NAMES)} AS vat_num,
        a.deposit_amount AS balance, tr.receipt_id AS receipt,
        CASE WHEN ss.tid > 0 THEN 1 ELSE re.n END AS cnt_receips,
        coalesce(ss.fiscal_status, re.fiscal_status) AS fiscal_status
    FROM accounting a LEFT JOIN users u ON u.id = a.user_id
    LEFT JOIN ledger_transactions tr ON tr.id = a.transaction_id AND tr.id > 25
    LEFT JOIN legal_infos l ON l.id = tr.club_legal_info_id LEFT JOIN clubs k ON k.id = l.club_id
    LEFT JOIN rc re ON re.tid = a.transaction_id LEFT JOIN rc ss ON ss.tid = tr.parent_id
    WHERE NOT a.is_deleted AND a.transaction_id > 25"""


@query("mart_accounting_ledger", tables=_LEDGER_TABLES, money=_LEDGER_MONEY, sql=_LEDGER)
def _ledger(t: Tables):
    return money.accounting_ledger(
        t.accounting, t.ledger_transactions, money.receipt_counts(t.receipts), t.users, t.legal_infos, t.clubs, above=25
    )


@query("mart_accounting_ledger_batches", tables=_LEDGER_TABLES, money=_LEDGER_MONEY, sql=_LEDGER)
def _ledger_batches(t: Tables):
    """Three hourly appends, each with the receipts that have arrived since the one before."""
    index, path = new_table_path(t.spark, "receipts"), new_table_path(t.spark, "ledger")
    width = 1 + (t.accounting.agg(F.max("transaction_id")).first()[0] or 0) // 6
    number = split_number(F.col("number"), "_", 2)
    for hour in range(3):
        arrived = (F.col("transaction_id") < 2 * width * (hour + 1)), number.between(2 * width * hour, 2 * width * (hour + 1) - 1)
        receipts.add_receipts(t.spark, index, t.receipts.where(arrived[1]), width)

        def build(above: int, rows=t.accounting.where(arrived[0])):
            above = max(above, 25)
            tx = t.ledger_transactions.where(F.col("id") < 2 * width * (hour + 1))
            counts = receipts.receipts_of(t.spark, index, money.ledger_receipts(rows, tx, above), width)
            return money.accounting_ledger(rows, tx, counts, t.users, t.legal_infos, t.clubs, above)

        load.append_computed(t.spark, path, "transaction_id", build)
    return load.read_target(t.spark, path)


@query(
    "mart_left_completed",
    tables=("transaction_history",),
    sql="""
    SELECT id, status, ns, ns_version_updated_at FROM (
        SELECT *, lead(status) OVER w AS ns, lead(version_updated_at) OVER w AS ns_version_updated_at
        FROM transaction_history WINDOW w AS (PARTITION BY id ORDER BY version_updated_at, version))
    WHERE status = 'completed' AND ns NOT IN ('completed', '')""",
)
def _left_completed(t: Tables):
    return money.left_completed(t.transaction_history, above=-1, large=t.large("transaction_history"))


_SALES = f"""
    e AS (
        SELECT p.*, p.id AS sub_id, pp.name AS plan_name,
            CASE WHEN d.id > 0 THEN 'main' WHEN lower(pp.name) LIKE '%бартер%' THEN 'barter'
                WHEN lower(pp.name) LIKE '%trial%' THEN 'trial' ELSE 'sub' END AS subscription_type
        FROM plans p LEFT JOIN inflow_plan_ids d ON d.id = p.payment_plan_id
        LEFT JOIN payment_plans pp ON pp.id = p.payment_plan_id
        WHERE coalesce(p.cancel_reason, '-') <> 'ExcludeFromReport' AND p.status <> 'Deleted'),
    ch AS (
        SELECT sub_id, row_number() OVER w AS n, lag(payment_plan_id) OVER w AS prev_plan, lag(sub_id) OVER w AS prev_sub,
            date_diff('day', coalesce(lag(end_date + INTERVAL 6 HOUR) OVER w, signed_date + INTERVAL 6 HOUR),
                signed_date + INTERVAL 6 HOUR) AS gap
        FROM e WHERE subscription_type IN ('barter', 'main', 'trial') WINDOW w AS (PARTITION BY user_id ORDER BY sub_id)),
    ft AS (
        SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY user_payment_plan_id ORDER BY id) AS n FROM transactions
            WHERE provider_id IN {_in(c.FIRST_PAYMENT_PROVIDERS)}) WHERE n = 1),
    sales AS (
        SELECT e.user_id, e.sub_id, e.payment_plan_id, e.plan_name AS subscription_name, e.subscription_type,
            CASE WHEN ch.n = 1 THEN 'НЧК' WHEN subscription_type = 'sub' THEN '-' WHEN gap <= 365 THEN 'БЧК < 1 года'
                WHEN gap > 365 THEN 'БЧК > 1 года' ELSE '-' END AS is_new,
            CASE WHEN ch.n > 1 AND gap <= 0 THEN 1 ELSE 0 END AS is_resubbed,
            f.is_new AS is_new_per_inflow, f.is_inflow, ch.prev_sub AS prev_sub_id, ch.prev_plan AS prev_payment_plan_id,
            pp2.name AS prev_payment_plan_name, u.phone, u.email, {_birthday('u.birthday')} AS birthday, u.sex,
            u.sport_experience AS fitness_experience, e.signed_date + INTERVAL 6 HOUR AS signed_date,
            e.start_date + INTERVAL 6 HOUR AS start_date, ft.updated_at AS payment_date,
            e.end_date + INTERVAL 6 HOUR AS end_date, k.name AS club_name, e.discount_code_id, dc.code,
            ds.name AS discount_name, e.card_token_id IS NOT NULL AS card_token_id, e.status, ft.join_fee, ft.membership_fee,
            CASE WHEN e.sub_id < 1000000 THEN ft.total_amount + ft.membership_fee ELSE ft.total_amount END AS total_amount,
            coalesce(e.cancel_reason, '-') AS cancel_reason, ft.gate_id, ft.employee_id, u2.name AS employee_name,
            u2.last_name, g.name AS gate_name, ft.discount_amount, {_label('ds.name', c.CAMPAIGN_RULES)} AS discount_name_new,
            ft.discount_code_id AS discount_code_id_tr, ds2.name AS discount_name_tr, ft.discount_id AS discount_id_tr,
            dc2.code AS code_tr, ci.name AS city_name, TIMESTAMP '2024-01-31' AS updated_at
        FROM e LEFT JOIN ch ON ch.sub_id = e.sub_id LEFT JOIN ft ON ft.user_payment_plan_id = e.sub_id
        LEFT JOIN flows f ON f.first_id = e.sub_id LEFT JOIN users u ON u.id = e.user_id
        LEFT JOIN employees em ON em.id = ft.employee_id LEFT JOIN users u2 ON u2.id = em.user_id
        LEFT JOIN payment_plans pp2 ON pp2.id = ch.prev_plan LEFT JOIN discounts ds ON ds.id = e.discount_id
        LEFT JOIN discounts ds2 ON ds2.id = ft.discount_id LEFT JOIN discount_codes dc ON dc.id = e.discount_code_id
        LEFT JOIN discount_codes dc2 ON dc2.id = ft.discount_code_id LEFT JOIN gates g ON g.id = ft.gate_id
        LEFT JOIN clubs k ON k.id = e.club_id LEFT JOIN cities ci ON ci.id = k.city_id)"""
_SALES_TABLES = (
    "plans", "inflow_plan_ids", "payment_plans", "transactions", "flows", "users", "employees",
    "discounts", "discount_codes", "gates", "clubs", "cities",
)


def _sales(t: Tables):
    """The stored sales mart."""

    def build():
        return money.subscription_sales(*[getattr(t, n) for n in _SALES_TABLES], as_of=NOW, large=t.large("plans"))

    return t.derived("subscription_sales", _SALES_TABLES, build)


@query(
    "mart_subscription_sales",
    tables=_SALES_TABLES,
    dates=("birthday",),
    money=("join_fee", "membership_fee", "total_amount", "discount_amount"),
    sql=f"WITH {_SALES} SELECT * FROM sales",
)
def _subscription_sales(t: Tables):
    return _sales(t)


@query(
    "mart_inflow_outflow_marketing",
    tables=_SALES_TABLES,
    dates=("birthday", "start_date", "start_training_date", "end_date", "end_date_value"),
    money=("discount_amount", "membership_fee"),
    sql=f"""
    WITH {_SALES},
    mp AS (SELECT p.*, pp.name AS plan_name, k.name AS club_name FROM plans p
        LEFT JOIN payment_plans pp ON pp.id = p.payment_plan_id LEFT JOIN clubs k ON k.id = p.club_id
        WHERE p.payment_plan_id IN (SELECT id FROM inflow_plan_ids)),
    op AS (SELECT * FROM mp WHERE status NOT IN {_in(c.OPEN_PLAN_EXCLUDED)}
        QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY id DESC) = 1),
    en AS (SELECT * FROM mp WHERE status IN ('Ended', 'Refunded')
        QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY id DESC) = 1),
    m AS (
        SELECT f.user_id, f.name, u.last_name, f.phone, f.email, f.birthday, f.sex, f.first_id,
            CASE WHEN f.last_id = -1 THEN op.id ELSE f.last_id END AS last_id, f.sport_experience, f.first_payment_plan_name,
            CASE WHEN f.last_id = -1 THEN op.plan_name ELSE f.last_payment_plan_name END AS last_payment_plan_name,
            f.discount_name, {_label('f.discount_name', c.CAMPAIGN_RULES)} AS discount_name_new, dc.code, f.inflow_club_name,
            CASE WHEN f.last_id = -1 THEN op.club_name ELSE f.outflow_club_name END AS outflow_club_name,
            CASE WHEN op.id IS NULL AND f.end_date IS NULL THEN en.status ELSE f.status END AS status,
            CASE WHEN f.last_id = -1 THEN '-' ELSE f.cancel_reason END AS cancel_reason, f.is_new AS new_,
            f.start_date, f.start_training_date,
            CASE WHEN op.id IS NULL AND f.end_date IS NULL THEN DATE '2001-12-01' ELSE f.end_date END AS end_date,
            s.discount_amount, s.membership_fee, f.qty_plans, f.user_status,
            CASE WHEN f.start_date = max(f.start_date) OVER (PARTITION BY f.user_id) THEN 1 ELSE 0 END AS pp_attribute,
            s.gate_name, s.employee_name, s.last_name AS last_employee_name,
            CAST(date_trunc('month', f.end_date) AS DATE) AS end_date_value
        FROM flows f LEFT JOIN users u ON u.id = f.user_id LEFT JOIN sales s ON s.sub_id = f.first_id
        LEFT JOIN op ON op.user_id = f.user_id LEFT JOIN en ON en.user_id = f.user_id
        LEFT JOIN plans p ON p.id = f.first_id LEFT JOIN discount_codes dc ON dc.id = p.discount_code_id)
    SELECT * EXCLUDE (new_), CASE WHEN new_ = 1 THEN 'НЧК'
        WHEN date_diff('day', coalesce(lag(end_date) OVER w, DATE '1970-01-01'), start_date) <= 365
        THEN 'БЧК < 1 года' ELSE 'БЧК > 1 года' END AS is_new
    FROM m WINDOW w AS (PARTITION BY user_id ORDER BY start_date, first_id)""",
)
def _marketing(t: Tables):
    terms = money.sale_terms(t.plans, t.transactions, t.users, t.employees, t.gates)
    return money.inflow_outflow_marketing(
        t.flows, t.users, terms, t.plans, t.payment_plans, t.clubs, t.inflow_plan_ids, t.discount_codes, AS_OF,
        large=t.large("flows"),
    )


# --------------------------------------------------------------------------- metric tree

_LIFE = """
    ne AS (
        SELECT *, lead(start_date) OVER (PARTITION BY user_id ORDER BY start_date, first_id) AS nxt FROM flows),
    lt AS (
        SELECT user_id, inflow_club, inflow_club_name, end_date, date_diff('day', start_date, end_date) AS life,
            coalesce(date_diff('day', end_date, nxt), 999) AS gap FROM ne WHERE end_date IS NOT NULL),
    wt AS (
        SELECT *, CASE WHEN gap > 90 THEN 1.0::DOUBLE ELSE 1.0::DOUBLE / count(*) FILTER (gap <= 90) OVER (PARTITION BY user_id) END AS w,
            sum(CASE WHEN gap > 90 THEN 1 ELSE 0 END) OVER (PARTITION BY user_id) AS longs,
            count(*) OVER (PARTITION BY user_id) AS n FROM lt),
    top AS (
        SELECT user_id, inflow_club, inflow_club_name, row_number() OVER (PARTITION BY user_id ORDER BY sum(life) DESC, inflow_club) AS r
        FROM lt GROUP BY user_id, inflow_club, inflow_club_name),
    ua AS (
        SELECT wt.user_id, top.inflow_club AS club_id, top.inflow_club_name AS club_name, max(end_date) AS last_end,
            sum(life)::DOUBLE / CASE WHEN n > 1 AND longs > 1 THEN longs ELSE round(sum(w)) END AS alt
        FROM wt JOIN top ON top.user_id = wt.user_id AND top.r = 1
        GROUP BY wt.user_id, top.inflow_club, top.inflow_club_name, n, longs),
    life AS (
        SELECT CAST(date_trunc('month', last_end) AS DATE) AS date, club_id, club_name, round_even(CAST(sum(CAST(ua.alt AS DECIMAL(28,9))) AS DOUBLE) / count(*), 0) AS alt
        FROM ua WHERE ua.alt > 0 GROUP BY 1, 2, 3)"""

_MONTHS = "SELECT CAST(unnest(generate_series(DATE '1995-01-01', DATE '2001-12-01', INTERVAL 1 MONTH)) AS DATE) AS date"


def _load(opened_only: bool) -> str:
    where = "WHERE open_date <= DATE '2001-12-01'" if opened_only else ""
    return f"""
    grid AS (SELECT date, k.id AS club_id, k.name AS club_name FROM ({_MONTHS}) CROSS JOIN (SELECT * FROM clubs {where}) k),
    i1 AS (SELECT CAST(date_trunc('month', start_date) AS DATE) AS date, inflow_club_name AS club_name, CAST(sum(is_inflow) AS BIGINT) AS inflow
        FROM flows WHERE is_inflow = 1 GROUP BY ALL),
    o1 AS (SELECT CAST(date_trunc('month', end_date) AS DATE) AS date, outflow_club_name AS club_name, CAST(sum(is_outflow) AS BIGINT) AS outflow
        FROM flows WHERE is_outflow = 1 GROUP BY ALL),
    mig AS (
        SELECT date, club_id, club_name, CAST(sum(i) AS BIGINT) AS i, CAST(sum(o) AS BIGINT) AS o FROM (
            SELECT CAST(date_trunc('month', start_date) AS DATE) AS date, club_id, club_name, 1 AS i, 0 AS o FROM active WHERE is_inflow = 1
            UNION ALL
            SELECT CAST(date_trunc('month', end_date) AS DATE), club_id, club_name, 0, 1 FROM active WHERE is_outflow = 1) GROUP BY ALL),
    st AS (
        SELECT mig.*, coalesce(k.rounded_area, k.area_in_square_meters) AS area,
            CAST(sum(i - o) OVER (PARTITION BY club_id ORDER BY date) AS BIGINT) AS stock FROM mig LEFT JOIN clubs k ON k.id = mig.club_id),
    load AS (
        SELECT grid.date, grid.club_id, grid.club_name, o1.outflow, i1.inflow, st.o AS outflow_with_migration, st.i AS inflow_with_migration,
            st.stock AS active_subscribes, st.area AS area_in_square_meters, round_even(st.stock / nullif(st.area, 0), 2) AS load_factor
        FROM grid LEFT JOIN i1 USING (date, club_name) LEFT JOIN o1 USING (date, club_name) LEFT JOIN st USING (date, club_name))"""


_LTV = """
    infl AS (SELECT CAST(date_trunc('month', start_date) AS DATE) AS date, inflow_club AS club_id, CAST(sum(is_inflow) AS BIGINT) AS is_inflow
        FROM flows GROUP BY ALL),
    ltv AS (
        SELECT g.date, k.id AS club_id, k.name AS club_name, k.open_date, abs(e.acquisition_cost) AS acquisition_cost, e.club_ebitda,
            infl.is_inflow, coalesce(st.stock, 0) AS active_subscribes, abs(e.acquisition_cost) / nullif(infl.is_inflow, 0) AS cac,
            e.club_ebitda / nullif(coalesce(st.stock, 0), 0) AS ltv,
            (e.club_ebitda / nullif(coalesce(st.stock, 0), 0)) / nullif(abs(e.acquisition_cost) / nullif(infl.is_inflow, 0), 0) AS ratio_ltv_cac
        FROM (%s) g CROSS JOIN clubs k LEFT JOIN st ON st.date = g.date AND st.club_id = k.id
        LEFT JOIN expenses e ON e.date_month = g.date AND e.club_id = k.id LEFT JOIN infl ON infl.date = g.date AND infl.club_id = k.id
        WHERE g.date >= date_trunc('month', k.open_date))""" % _MONTHS

_MONTH = """
    rev AS (SELECT CAST(date_trunc('month', date) AS DATE) AS date, club_name, sum(total_cost) AS revenue FROM revenue GROUP BY ALL),
    blocks AS (
        SELECT grid_all.date, grid_all.club_id, grid_all.club_name,
            CAST(floor(date_diff('month', grid_all.date, DATE '2001-12-01') / 12) AS INTEGER) AS b
        FROM (SELECT date, k.id AS club_id, k.name AS club_name FROM (%s) CROSS JOIN clubs k) grid_all),
    month AS (
        SELECT CASE WHEN b BETWEEN 0 AND 7 THEN CAST(2001 - b AS VARCHAR) ELSE '2018' END AS year, x.date, x.club_id, x.club_name,
            life.alt, load.outflow, load.inflow, load.area_in_square_meters, load.load_factor, CAST(rev.revenue AS DOUBLE) AS revenue,
            ltv.acquisition_cost, ltv.club_ebitda, ltv.active_subscribes AS active_subscribers, ltv.cac, ltv.ltv,
            CAST(rev.revenue AS DOUBLE) / nullif(ltv.active_subscribes, 0) AS arpu,
            load.load_factor * life.alt / 30 * (CAST(rev.revenue AS DOUBLE) / nullif(ltv.active_subscribes, 0)) AS nsm_metric
        FROM blocks x LEFT JOIN life ON life.date = x.date AND life.club_name = x.club_name
        LEFT JOIN load ON load.date = x.date AND load.club_name = x.club_name
        LEFT JOIN rev ON rev.date = x.date AND rev.club_name = x.club_name
        LEFT JOIN ltv ON ltv.date = x.date AND ltv.club_name = x.club_name)""" % _MONTHS

_TREE_TABLES = ("flows", "active", "clubs", "expenses", "revenue")


def _month_tree(t: Tables):
    """The stored month table, which the year table and the outflow anomalies read too."""

    def build():
        factor = tree.load_factor(t.flows, t.active, t.clubs, AS_OF, START)
        value = tree.ltv_cac(t.flows, t.active, t.clubs, t.expenses, START, AS_OF)
        return tree.metrics_month(t.clubs, tree.lifetime(t.flows, t.large("flows")), factor, value, t.revenue, START, AS_OF)

    return t.derived("metrics_month", _TREE_TABLES, build)


@query("mart_lifetime", tables=("flows",), dates=("date",), sql=f"WITH {_LIFE} SELECT * FROM life")
def _lifetime(t: Tables):
    return tree.lifetime(t.flows, t.large("flows"))


@query(
    "mart_load_factor",
    tables=("flows", "active", "clubs"),
    dates=("date",),
    sql=f"WITH {_load(True)} SELECT * FROM load",
)
def _load_factor(t: Tables):
    return tree.load_factor(t.flows, t.active, t.clubs, AS_OF, START)


@query(
    "mart_load_factor_all_clubs",
    tables=("flows", "active", "clubs"),
    dates=("date",),
    sql=f"WITH {_load(False)} SELECT * FROM load",
)
def _load_factor_all(t: Tables):
    return tree.load_factor(t.flows, t.active, t.clubs, AS_OF, START, opened_only=False)


@query(
    "mart_ltv_cac",
    tables=("flows", "active", "clubs", "expenses"),
    dates=("date", "open_date"),
    sql=f"WITH {_load(False)}, {_LTV} SELECT * FROM ltv",
)
def _ltv(t: Tables):
    return tree.ltv_cac(t.flows, t.active, t.clubs, t.expenses, START, AS_OF)


@query(
    "mart_metrics_month",
    tables=_TREE_TABLES,
    dates=("date",),
    sql=f"WITH {_LIFE}, {_load(True)}, {_LTV}, {_MONTH} SELECT * FROM month",
)
def _metrics_month(t: Tables):
    return _month_tree(t)


_PAIRED = ", ".join(f'b."{n}" AS "{n}_2"' for n in ("year", "club_id", "club_name", "club_type", "tir", "age", *tree.METRICS))


@query(
    "mart_metrics_year",
    tables=_TREE_TABLES,
    dates=("date",),
    sql=f"""
    WITH {_LIFE}, {_load(True)}, {_LTV}, {_MONTH},
    one AS (
        SELECT m.date, CAST(year(m.date) AS VARCHAR) AS year, m.club_id, m.club_name, k.club_type,
            CASE WHEN k.id IN {_in(c.TIER_1)} THEN '1' WHEN k.id IN {_in(c.TIER_2)} THEN '2' ELSE '3' END AS tir,
            CASE WHEN date_diff('month', k.open_date, DATE '2001-12-01') <= 12 THEN 'молодые'
                WHEN date_diff('month', k.open_date, DATE '2001-12-01') <= 24 THEN 'юниоры' ELSE 'зрелые' END AS age,
            {", ".join(f'm."{n}"' for n in tree.METRICS)}
        FROM month m LEFT JOIN clubs k ON k.name = m.club_name)
    SELECT a.*, {_PAIRED} FROM one a LEFT JOIN one b ON month(a.date) = month(b.date) AND a.club_name = b.club_name""",
)
def _metrics_year(t: Tables):
    return tree.metrics_year(_month_tree(t), t.clubs, START, AS_OF)


# --------------------------------------------------------------------------- anomalies


_INFLOW = """
    WITH d AS (SELECT start_date AS inflow_date, count(*) AS n FROM flows WHERE is_inflow = 1 GROUP BY ALL),
    w AS (SELECT inflow_date, n AS new_subscribers,
            avg(n) OVER (ORDER BY inflow_date ROWS BETWEEN 179 PRECEDING AND CURRENT ROW) AS avg_6_months,
            lag(n) OVER (ORDER BY inflow_date) AS previous_day_subscribers FROM d)
    SELECT *, CASE WHEN new_subscribers > avg_6_months * 1.8::DOUBLE THEN 1
        WHEN new_subscribers > previous_day_subscribers * 2.5::DOUBLE THEN 1 ELSE 0 END AS is_anomaly FROM w"""


@query("mart_inflow_anomaly", tables=("flows",), dates=("inflow_date",), sql=_INFLOW)
def _inflow_anomaly(t: Tables):
    return anomalies.inflow_anomaly(t.flows)


@query(
    "mart_anomaly_count",
    tables=("flows",),
    sql=f"""
    WITH f AS ({_INFLOW})
    SELECT count(*) AS cnt FROM f WHERE is_anomaly = 1 AND inflow_date = (SELECT max(inflow_date) FROM f WHERE is_anomaly = 1)""",
)
def _anomaly_count(t: Tables):
    flags = materialize(anomalies.inflow_anomaly(t.flows))
    last = flags.where("is_anomaly = 1").agg(F.max("inflow_date")).first()[0]
    return anomalies.anomaly_count(flags, "inflow_date", last)


_OUTFLOW = f"""
    WITH {_LIFE}, {_load(True)}, {_LTV}, {_MONTH},
    d AS (SELECT end_date AS outflow_date, count(*) AS churned_subscribers FROM flows WHERE is_outflow = 1 GROUP BY ALL),
    stock AS (SELECT date, CAST(sum(active_subscribers) AS DOUBLE) AS n FROM month GROUP BY ALL),
    r AS (SELECT outflow_date, churned_subscribers,
            churned_subscribers / nullif(n / nullif(day(last_day(outflow_date)), 0), 0) AS rate
        FROM d LEFT JOIN stock ON stock.date = date_trunc('month', outflow_date)),
    l AS (SELECT *, list_sort(list_filter(list(rate) OVER (ORDER BY outflow_date ROWS BETWEEN 179 PRECEDING AND CURRENT ROW), lambda x: x IS NOT NULL)) AS v,
            lag(coalesce(rate, 0.0)) OVER (ORDER BY outflow_date) AS prev_day_rate FROM r),
    q AS (SELECT outflow_date, churned_subscribers, rate AS daily_churn_rate, prev_day_rate,
            v[least(CAST(floor(0.5 * len(v)) AS BIGINT), len(v) - 1) + 1] AS median_6months,
            v[least(CAST(floor(0.75 * len(v)) AS BIGINT), len(v) - 1) + 1] - v[least(CAST(floor(0.25 * len(v)) AS BIGINT), len(v) - 1) + 1] AS iqr_6months
        FROM l)
    SELECT *, CASE WHEN daily_churn_rate > median_6months + 1.5::DOUBLE * iqr_6months THEN 1
        WHEN prev_day_rate > 0 AND daily_churn_rate > prev_day_rate * 2 THEN 1 ELSE 0 END AS is_anomaly FROM q"""


@query("mart_outflow_anomaly", tables=_TREE_TABLES, dates=("outflow_date",), sql=_OUTFLOW)
def _outflow_anomaly(t: Tables):
    return anomalies.outflow_anomaly(t.flows, _month_tree(t))


@query(
    "mart_outflow_anomaly_count",
    tables=_TREE_TABLES,
    sql=f"""
    SELECT count(*) AS cnt FROM ({_OUTFLOW}) WHERE is_anomaly = 1
        AND outflow_date = (SELECT max(outflow_date) FROM ({_OUTFLOW}) WHERE is_anomaly = 1)""",
)
def _outflow_count(t: Tables):
    flags = materialize(anomalies.outflow_anomaly(t.flows, _month_tree(t)))
    last = flags.where("is_anomaly = 1").agg(F.max("outflow_date")).first()[0]
    return anomalies.anomaly_count(flags, "outflow_date", last)


# --------------------------------------------------------------------------- debt cohorts


def _cohorts(extra: str = "") -> str:
    return f"""
    h AS (
        SELECT * , lag(status) OVER w AS before, lead(pay_date) OVER w AS next_pay FROM plan_history
        WHERE payment_plan_id IN {_in(c.DEBT_PLAN_IDS)} AND coalesce(cancel_reason, '') <> 'ExcludeFromReport'
          AND updated_at >= TIMESTAMP '2023-12-01' AND coalesce(status, '') <> 'Deleted' {extra}
        WINDOW w AS (PARTITION BY id ORDER BY version_updated_at, version)),
    k AS (
        SELECT *, CASE WHEN status = 'PaymentPending' THEN 'open' WHEN status = 'Current' AND before = 'Current' THEN 'continue'
            ELSE 'close' END AS kind
        FROM h WHERE (status = 'Current' AND before = 'Current' AND CAST(pay_date AS DATE) IS DISTINCT FROM CAST(next_pay AS DATE))
          OR (status = 'PaymentPending' AND coalesce(before, '') IN ('Current', 'Freezed', ''))
          OR (status IN ('Current', 'Ended', 'Freezed', 'Refunded') AND before = 'PaymentPending')),
    l AS (
        SELECT *, lead(updated_at) OVER w AS e, lead(status) OVER w AS cs, lead(cancel_reason) OVER w AS cr FROM k
        WINDOW w AS (PARTITION BY id ORDER BY version_updated_at, version)),
    co AS (
        SELECT id, club_id, CAST(pay_date AS DATE) AS cohort, pay_date AS cohort_date_time,
            CASE WHEN kind = 'continue' THEN pay_date ELSE e END AS cohort_end_date,
            CASE WHEN kind = 'continue' THEN 'Continue' WHEN cs = 'Refunded' THEN 'Ended' ELSE cs END AS cohort_close_status,
            CASE WHEN cs = 'Refunded' THEN 'self' WHEN kind <> 'continue' AND cs = 'Ended'
                THEN CASE WHEN cr = 'AutoCanceledByDebt' THEN 'auto' ELSE 'self' END END AS end_type
        FROM l WHERE kind <> 'close' AND pay_date IS NOT NULL)"""


@query(
    "mart_debt_cohort_detail",
    tables=("plan_history",),
    dates=("cohort",),
    sql=f"WITH {_cohorts('AND discount_id = 11538')} SELECT * FROM co",
)
def _cohort_detail(t: Tables):
    return cohorts.debt_cohort_detail(t.plan_history, large=t.large("plan_history"))


def _ladder_sql() -> str:
    steps, previous = [], "c0"
    for k in range(1, c.DEBT_DAYS + 1):
        until = f"cohort_date_time + INTERVAL {k} DAY < cohort_end_date"
        if k == 1:
            flag = "cohort_close_status IS DISTINCT FROM 'Continue'"
            dead = "cohort_close_status = 'Continue'"
        else:
            flag = f"cohort_end_date IS NULL OR cohort_date_time + INTERVAL {k - 1} DAY < cohort_end_date"
            dead = f"s{k - 1} IS NULL OR s{k - 1} <> 'Pending'"
        steps.append(
            f"c{k} AS (SELECT *, {flag} AS f{k}, CASE WHEN {dead} THEN NULL WHEN cohort_end_date IS NULL OR {until} "
            f"THEN 'Pending' ELSE cohort_close_status END AS s{k} FROM {previous})"
        )
        previous = f"c{k}"
    days = range(1, c.DEBT_DAYS + 1)
    counts = [f"count(*) FILTER (f{k}) AS day{k}" for k in days]
    counts += [f"count(*) FILTER (s{k} = '{s}') AS {s.lower()}{k}" for k in days for s in ("Current", "Freezed", "Ended")]
    counts += [f"count(*) FILTER (s{c.DEBT_DAYS} = 'Pending') AS pending{c.DEBT_DAYS}"]
    counts += [f"count(*) FILTER (end_type = '{x}') AS \"{x}\"" for x in ("auto", "self")]
    return f"""WITH {_cohorts()},
    c0 AS (SELECT * FROM co WHERE cohort_end_date IS NULL OR cohort_date_time <= cohort_end_date
        OR CAST(cohort_date_time AS DATE) = CAST(cohort_end_date AS DATE)),
    {", ".join(steps)}
    SELECT cohort, club_id, count(*) AS all_subs_due, {", ".join(counts)}, k.name AS club_name
    FROM {previous} JOIN clubs k ON k.id = club_id GROUP BY cohort, club_id, k.name"""


@query("mart_debt_cohort_ladder", tables=("plan_history", "clubs"), dates=("cohort",), sql=_ladder_sql())
def _cohort_ladder(t: Tables):
    return cohorts.debt_cohort_ladder(t.plan_history, t.clubs, large=t.large("plan_history"))


# --------------------------------------------------------------------------- mobile

_MOBILE = f"""
    ev AS (
        SELECT *, coalesce(TRY_CAST(coalesce(nullif(json_extract_string(json_extract_string(EventParameters, '$.user'), '$.id'), ''),
            nullif(json_extract_string(EventParameters, '$.user_id'), ''), '0') AS BIGINT), 0) AS seen
        FROM app_events WHERE ReceiveDate >= DATE '2024-01-01' AND ReceiveDate < DATE '2024-03-01'),
    mp AS (
        SELECT user_id, max(id) AS pid, min(CAST(signed_date AS DATE)) AS a, max(coalesce(CAST(end_date AS DATE), DATE '2049-01-01')) AS b
        FROM plans WHERE payment_plan_id IN (SELECT id FROM inflow_plan_ids) AND payment_plan_id IN (SELECT id FROM payment_plans)
          AND status NOT IN ('Created', 'Deleted') AND coalesce(cancel_reason, '') <> 'ExcludeFromReport' GROUP BY user_id),
    mob AS (
        SELECT DeviceID AS device_id, x.user_id, EventDate AS event_date, EventDateTime AS event_datetime, ReceiveDate AS receive_date,
            OSName AS os_name, EventName AS event_name, EventParameters AS event_params, u.sex, u.name, u.last_name, u.phone, u.email,
            u.birthday, u.sport_experience, u.home_club_id, k.name AS club_name, pp.name AS payment_plan_name, p.status,
            mp.a AS start_date, mp.b AS end_date, mp.pid AS user_payment_plan_id, TIMESTAMP '2024-01-31' AS updated_at
        FROM (SELECT *, max(seen) OVER (PARTITION BY DeviceID) AS user_id FROM ev) x
        LEFT JOIN users u ON u.id = x.user_id LEFT JOIN clubs k ON k.id = u.home_club_id LEFT JOIN mp ON mp.user_id = x.user_id
        LEFT JOIN plans p ON p.id = mp.pid LEFT JOIN payment_plans pp ON pp.id = p.payment_plan_id)"""
_MOBILE_TABLES = ("app_events", "users", "clubs", "plans", "inflow_plan_ids", "payment_plans")


def _mobile(t: Tables, **given):
    tables = [given.get(n, getattr(t, n)) for n in _MOBILE_TABLES]
    return mobile.mobile_events(*tables, date_from=EVENTS_FROM.date(), date_to=EVENTS_TO.date(), as_of=NOW)


@query(
    "mart_mobile_events",
    tables=_MOBILE_TABLES,
    dates=("event_date", "receive_date", "birthday", "start_date", "end_date"),
    sql=f"WITH {_MOBILE} SELECT * FROM mob",
)
def _mobile_events(t: Tables):
    return _mobile(t)


@query(
    "mart_mobile_stories",
    tables=(*_MOBILE_TABLES, "slides"),
    dates=("event_date", "receive_date", "birthday"),
    sql=f"""
    WITH {_MOBILE},
    st AS (SELECT *, coalesce(json_extract_string(event_params, '$.story_id'), '') AS story_id,
            coalesce(json_extract_string(event_params, '$.slide_id'), '') AS slide_id,
            coalesce(json_extract_string(event_params, '$.showtime'), '') AS showtime
        FROM mob WHERE event_name IN {_in(c.STORY_EVENTS)})
    SELECT device_id, event_date, event_datetime, receive_date, os_name, event_name, story_id, slide_id, s.header, showtime,
        user_id, sex, name, last_name, phone, email, birthday, sport_experience, club_name, payment_plan_name, status,
        user_payment_plan_id, updated_at
    FROM st LEFT JOIN slides s ON CAST(s.id AS VARCHAR) = st.slide_id""",
)
def _stories(t: Tables):
    return mobile.mobile_stories(_mobile(t), t.slides, EVENTS_FROM.date(), EVENTS_TO.date(), NOW)


_DEVICES = """
    du AS (SELECT device_id, user_id, min(event_date) AS min_event_date, max(event_date) AS max_event_date FROM mob
        WHERE user_id <> 0 GROUP BY ALL)"""


@query(
    "mart_device_users",
    tables=_MOBILE_TABLES,
    dates=("min_event_date", "max_event_date"),
    sql=f"WITH {_MOBILE}, {_DEVICES} SELECT * FROM du",
)
def _device_users(t: Tables):
    return mobile.device_users(_mobile(t))


_TRACKER = f"""
    ck AS (SELECT ClickDate AS click_date, regexp_extract(PostbackUrlParameters, 'tracker_device_id=(.*?)&', 1) AS device_id
        FROM postbacks WHERE TrackerName IN {_in(c.TRACKERS)}),
    tu AS (SELECT ck.click_date, ck.device_id, du.user_id FROM ck JOIN du ON du.device_id = ck.device_id WHERE ck.device_id <> '')"""


def _tracker(t: Tables):
    clicks = materialize(mobile.tracker_clicks(t.postbacks))
    events = mobile.clicked_events(t.app_events, clicks)
    return mobile.users_of_clicks(clicks, mobile.device_users(_mobile(t, app_events=events)))


@query(
    "mart_tracker_users",
    tables=(*_MOBILE_TABLES, "postbacks"),
    dates=("click_date",),
    sql=f"WITH {_MOBILE}, {_DEVICES}, {_TRACKER} SELECT * FROM tu",
)
def _tracker_users(t: Tables):
    return _tracker(t)


# --------------------------------------------------------------------------- campaign

_CAMPAIGN = f"""
    staff AS (SELECT user_id FROM plans WHERE payment_plan_id IN {_in(c.STAFF_PLAN_IDS)} AND status = 'Current'
        UNION SELECT user_id FROM employees WHERE is_active = 1),
    ct AS (
        SELECT t.*, p.payment_plan_id, p.user_id AS owner, p.club_id, p.status AS current_status, p.signed_date, p.end_date,
            p.cancel_date, p.cancel_reason, pp.name AS payment_plan, pp.payment_plan_type, k.name AS club_name, g.name AS gate_name,
            row_number() OVER (PARTITION BY t.user_payment_plan_id ORDER BY t.created_at, t.id) AS rnk
        FROM transactions t JOIN plans p ON p.id = t.user_payment_plan_id JOIN clubs k ON k.id = p.club_id
        JOIN payment_plans pp ON pp.id = p.payment_plan_id JOIN gates g ON g.id = t.gate_id
        WHERE p.payment_plan_id IN {_in(c.CAMPAIGN_PLAN_IDS)} AND t.provider_id IN {_in(c.CAMPAIGN_PROVIDERS)}),
    cd AS (SELECT *, min(updated_at) OVER (PARTITION BY user_id ORDER BY id) AS first_buy FROM ct
        WHERE CAST(updated_at AS DATE) >= DATE '1996-01-01'),
    mpd AS (
        SELECT p.user_id, CAST(t.updated_at AS DATE) AS d, max(p.id) AS pid, max(p.payment_plan_id) AS plan, max(p.discount_id) AS disc
        FROM plans p JOIN transactions t ON t.user_payment_plan_id = p.id AND t.provider_id IN {_in(c.FIRST_PAYMENT_PROVIDERS)}
        WHERE p.payment_plan_id IN (SELECT id FROM inflow_plan_ids) AND p.status NOT IN ('Created', 'Deleted')
          AND coalesce(p.cancel_reason, '') <> 'ExcludeFromReport' GROUP BY ALL),
    nw AS (
        SELECT cd.user_payment_plan_id AS k, mpd.pid, pp.name AS plan_name, coalesce(nullif(d0.name, ''), '-') AS discount_name,
            CASE WHEN d1.name IN {_in(c.KEPT_MAIN_DISCOUNTS)} THEN d1.name ELSE '-' END AS main_discount, mpd.user_id AS mu
        FROM cd LEFT JOIN mpd ON mpd.user_id = cd.user_id AND mpd.d = CAST(cd.updated_at AS DATE)
        LEFT JOIN payment_plans pp ON pp.id = mpd.plan LEFT JOIN discounts d1 ON d1.id = mpd.disc
        LEFT JOIN discounts d0 ON d0.id = cd.discount_id WHERE cd.rnk = 1),
    bn AS (SELECT json_extract_string(EventParameters, '$.user_id') AS u, max(EventDate) AS last_banner_date FROM app_events
        WHERE EventName LIKE '%banner%' AND EventParameters LIKE '%"banner_id":78%' GROUP BY ALL),
    fv AS (SELECT * FROM (SELECT vp.*, row_number() OVER (PARTITION BY user_id ORDER BY created_at, vp.id) AS n
        FROM video_progress vp JOIN videos v ON v.id = vp.video_id WHERE v.is_free = 1 AND v.is_deleted = 0 AND vp.duration > 60) WHERE n = 1),
    tk AS (SELECT user_id, max(click_date) AS click FROM tu GROUP BY ALL),
    camp AS (
        SELECT CASE WHEN staff.user_id IS NULL THEN 'Клиент' ELSE 'Сотрудник' END AS if_employee, cd.updated_at AS transaction_date,
            cd.id AS transaction_id, cd.signed_date + INTERVAL 3 HOUR AS signed_date, cd.end_date + INTERVAL 3 HOUR AS end_date,
            cd.cancel_date + INTERVAL 3 HOUR AS cancel_date, cd.cancel_reason, r.id AS return_transaction,
            r.updated_at + INTERVAL 3 HOUR AS return_transaction_date, cd.type, cd.user_id, cd.provider_id, cd.payment_plan_id,
            cd.payment_plan, cd.user_payment_plan_id, cd.club_name, cd.total_amount, cd.discount_id, nw.discount_name,
            cd.current_status, cd.gate_name, u.sex, {_birthday('u.birthday')} AS birthday, cd.payment_plan_type,
            CASE WHEN rnk = 1 THEN 'new' ELSE 'repeat' END AS payment_type, fv.id AS video_progress_id, fv.created_at,
            CASE WHEN cd.updated_at > fv.created_at THEN 1 ELSE 0 END AS buy_flag,
            CAST(date_diff('day', fv.created_at, cd.updated_at) AS INTEGER) AS diff_days, nw.pid AS user_payment_plan_id_main,
            nw.plan_name AS user_payment_plan_name_main, CASE WHEN nw.mu IS NULL AND nw.k IS NOT NULL THEN NULL ELSE nw.main_discount END AS discount_name_main,
            CASE WHEN bn.u IS NULL THEN 'Не переходил' ELSE 'Перешел по баннеру' END AS is_banner_user, bn.last_banner_date,
            CASE WHEN EXISTS (SELECT 1 FROM plans z WHERE z.payment_plan_id = {c.TRIAL_PLAN_ID} AND z.user_id = cd.user_id)
                THEN 'Был триал' ELSE 'Не было триала' END AS is_trial_user,
            CASE WHEN tk.click <= CAST(first_buy AS DATE) + 30 THEN 'Пришел по трекеру' ELSE '-' END AS is_tracker_user
        FROM cd LEFT JOIN staff ON staff.user_id = cd.owner LEFT JOIN users u ON u.id = cd.user_id
        LEFT JOIN (SELECT * FROM transactions WHERE type = 'refund') r ON r.payment_transaction_id = cd.id
        LEFT JOIN nw ON nw.k = cd.user_payment_plan_id LEFT JOIN bn ON bn.u = CAST(cd.user_id AS VARCHAR)
        LEFT JOIN fv ON fv.user_id = cd.user_id LEFT JOIN tk ON tk.user_id = cd.user_id)"""
_CAMPAIGN_TABLES = (
    *_MOBILE_TABLES, "postbacks", "transactions", "gates", "employees", "discounts", "video_progress", "videos",
)


def _purchases(t: Tables):
    payments = campaign.campaign_payments(t.transactions)
    paid = materialize(campaign.campaign_plan_payments(payments, t.plans))
    return campaign.campaign_purchases(
        payments, t.plans, t.clubs, t.payment_plans, t.gates, t.users, t.employees, t.discounts,
        t.inflow_plan_ids, t.app_events, t.video_progress, t.videos, _tracker(t), start=CAMPAIGN_FROM,
        large=measure(paid, KEY_SETS["transactions"]), paid=paid,
    )


@query(
    "mart_campaign_purchases",
    tables=_CAMPAIGN_TABLES,
    dates=("birthday", "last_banner_date"),
    money=("total_amount",),
    sql=f"WITH {_MOBILE}, {_DEVICES}, {_TRACKER}, {_CAMPAIGN} SELECT * FROM camp",
)
def _campaign_purchases(t: Tables):
    return _purchases(t)


_COVER = ("payment_plan", "gate_name", "if_employee", "discount_name", "discount_name_main", "is_banner_user", "current_status", "is_trial_user")


_REWATCH_TABLES = (*_CAMPAIGN_TABLES, "video_history")
_REWATCH = f"""
    WITH {_MOBILE}, {_DEVICES}, {_TRACKER}, {_CAMPAIGN},
    cl AS (SELECT id, video_id, user_id, duration, is_completed, stars, difficulty, comment, updated_at + INTERVAL 3 HOUR AS u,
            max(version) AS version FROM video_history GROUP BY ALL),
    rid AS (SELECT *, max(id) OVER (PARTITION BY user_id, video_id) AS rid, lead(u) OVER w AS nu, lag(u) OVER w AS pu FROM cl
        WINDOW w AS (PARTITION BY user_id, video_id ORDER BY u, version, id)),
    fl AS (SELECT *, CASE WHEN date_diff('second', pu, u) < 10800 THEN 0 ELSE 1 END AS isnew FROM rid),
    sn AS (SELECT *, sum(isnew) OVER (PARTITION BY user_id, video_id ORDER BY u, version, id) AS s FROM fl),
    se AS (
        SELECT user_id, video_id, s, any_value(rid) AS id, count(*) AS qty_rows, max(CAST(u AS DATE)) AS updated_at,
            CAST(sum(CASE WHEN date_diff('second', u, nu) = 0 THEN 0 ELSE 1 END) * 17 + 30 AS BIGINT) AS duration_by_qty_rows,
            max(duration) FILTER (isnew <> 1) AS max_duration, max(is_completed) AS is_completed,
            max(nullif(stars, 0)) AS stars, max(nullif(difficulty, 0)) AS difficulty, max(comment) AS comment
        FROM sn GROUP BY user_id, video_id, s HAVING count(*) >= 3),
    nn AS (SELECT *, dense_rank() OVER (PARTITION BY user_id, video_id ORDER BY s) AS session_number FROM se),
    rw AS (SELECT user_id, video_id, count(*) - 1 AS again FROM nn GROUP BY ALL),
    vid AS (SELECT video_id, max(again) AS max_rewatch, nullif(count(*) FILTER (again > 1), 0) AS more FROM rw GROUP BY ALL),
    pl AS (SELECT *, CAST(signed_date AS DATE) AS a, coalesce(CAST(end_date AS DATE), DATE '2049-01-01') AS b FROM camp WHERE payment_type = 'new')
    SELECT nn.session_number, nn.id, v.title, v.type, v.is_free, v.duration, nn.video_id, nn.user_id, nn.qty_rows,
        CASE WHEN nn.session_number > 1 THEN 1 ELSE 0 END AS if_rewatch, nn.updated_at, nn.duration_by_qty_rows, nn.max_duration,
        nn.is_completed, nn.stars, nn.difficulty, nn.comment, vid.max_rewatch, vid.more AS qty_rewatch_more_1,
        max(CASE WHEN nn.updated_at BETWEEN a AND b THEN pl.user_payment_plan_id ELSE 0 END) AS user_payment_plan_id,
        max(CASE WHEN nn.updated_at BETWEEN a AND b THEN a ELSE DATE '1970-01-01' END) AS start_date,
        max(CASE WHEN nn.updated_at BETWEEN a AND b THEN b ELSE DATE '1970-01-01' END) AS end_date,
        {", ".join(f"coalesce(max(CASE WHEN nn.updated_at BETWEEN a AND b THEN pl.{n} END), '-') AS {n}" for n in _COVER)},
        max(pl.is_tracker_user) AS is_tracker_user
    FROM nn LEFT JOIN videos v ON v.id = nn.video_id LEFT JOIN vid ON vid.video_id = nn.video_id
    LEFT JOIN pl ON pl.user_id = nn.user_id
    GROUP BY nn.session_number, nn.id, v.title, v.type, v.is_free, v.duration, nn.video_id, nn.user_id, nn.qty_rows, nn.updated_at,
        nn.duration_by_qty_rows, nn.max_duration, nn.is_completed, nn.stars, nn.difficulty, nn.comment, vid.max_rewatch, vid.more"""


@query("mart_video_rewatch", tables=_REWATCH_TABLES, dates=("updated_at", "start_date", "end_date"), sql=_REWATCH)
def _video_rewatch(t: Tables):
    # purchases and sessions are stored tables to this mart, as in production
    watched = materialize(campaign.watch_sessions(t.video_history, large=t.large("video_history")))
    return campaign.video_rewatch(watched, t.videos, materialize(_purchases(t)))


@query("mart_video_rewatch_batches", tables=_REWATCH_TABLES, dates=("updated_at", "start_date", "end_date"), sql=_REWATCH)
def _video_rewatch_batches(t: Tables):
    """Sessions grown in three appends; the last one brings some rows late."""
    path = new_table_path(t.spark, "sessions")
    at, late = F.col("updated_at"), F.col("user_id") % 5 == 0
    cuts = ["2024-01-11", "2024-01-21"]
    first, second = (at < F.lit(c).cast("timestamp_ntz") for c in cuts)
    batches = [first & ~late, (~first & second) | (first & late & (F.col("video_id") % 2 == 0)), ~second | (first & late & (F.col("video_id") % 2 == 1))]
    arrived = F.lit(False)
    for batch in batches:
        arrived = arrived | batch
        watching.add_progress(t.spark, path, t.video_history.where(batch), t.video_history.where(arrived), large=t.large("video_history"))
    watched = materialize(campaign.kept_sessions(watching.read_sessions(t.spark, path)))
    return campaign.video_rewatch(watched, t.videos, materialize(_purchases(t)))


# --------------------------------------------------------------------------- trainers


def _phone(column: str, spaces: bool) -> str:
    bare = f"regexp_replace({column}, '^\\++|\\++$', '', 'g')"
    seven = f"replace({bare}, ' ', '')" if spaces else f"trim({bare})"
    return f"CASE WHEN left(trim({bare}), 1) <> '7' THEN '+7' || trim({bare}) ELSE '+' || {seven} END"


_TYPES = f"""
    m AS (SELECT id, {_phone('phone', True)} AS phone, name, category FROM trainers_metro WHERE name <> '' AND phone <> '' AND id IS NOT NULL),
    r AS (SELECT id, {_phone('phone', False)} AS phone, name, category FROM trainers_region WHERE name <> '' AND phone <> '' AND id IS NOT NULL),
    gp AS (
        SELECT coalesce(u.id, m.id, r.id) AS id, coalesce(nullif(m.phone, ''), r.phone) AS phone,
            coalesce(nullif(m.name, ''), r.name) AS name, coalesce(nullif(m.category, ''), r.category) AS type
        FROM users u FULL JOIN m ON u.phone = m.phone FULL JOIN r ON u.phone = r.phone),
    types AS (
        SELECT DISTINCT coalesce(gp.id, m.id, r.id) AS id, coalesce(nullif(nullif(gp.phone, ''), '+7'), m.phone) AS phone,
            coalesce(nullif(gp.name, ''), m.name) AS name, coalesce(nullif(gp.type, ''), nullif(m.category, '')) AS type
        FROM gp FULL JOIN m ON gp.id = m.id FULL JOIN r ON gp.id = r.id
        WHERE coalesce(nullif(nullif(gp.phone, ''), '+7'), m.phone) <> '' AND coalesce(nullif(gp.name, ''), m.name) <> ''
          AND coalesce(nullif(gp.type, ''), nullif(m.category, '')) <> '')"""


@query(
    "mart_trainer_pay",
    tables=(
        "timetables", "trainings", "categories", "class_employees", "clubs", "cities", "employees", "users",
        "trainers_metro", "trainers_region", "rates",
    ),
    money=("salary",),
    sql=f"""
    WITH {_TYPES},
    pd AS (
        SELECT tt.id AS timetable_id, tr.name AS training_name, k.name AS club_name, ci.name AS city_name, ca.name AS category_name,
            tr.group_training_category_id AS cat, u.id AS trainer_id, u.last_name AS trainer_last_name, u.name AS trainer_name,
            tt.start_time, date_diff('minute', tt.start_time, tt.end_time) AS duration
        FROM timetables tt JOIN trainings tr ON tr.id = tt.group_training_id JOIN clubs k ON k.id = tt.club_id
        JOIN cities ci ON ci.id = k.city_id JOIN categories ca ON ca.id = tr.group_training_category_id
        JOIN class_employees ce ON ce.group_training_time_table_id = tt.id JOIN employees em ON em.id = ce.employee_id
        JOIN users u ON u.id = em.user_id
        WHERE NOT tt.is_deleted AND tt.start_time >= TIMESTAMP '1996-01-01' AND ca.name NOT IN {_in(c.UNPAID_CATEGORIES)})
    SELECT DISTINCT timetable_id, training_name, club_name, city_name, category_name, types.type AS trainer_type, trainer_id,
        trainer_last_name, trainer_name, start_time, duration,
        coalesce(CASE WHEN cat = 40 AND duration IN (30, 55) AND (training_name ILIKE '%HIIT%' OR training_name ILIKE '%GRIT%' OR training_name ILIKE '%CYCLE SPRINT@') THEN mk_55
            WHEN cat = 40 AND duration = 30 THEN mk_30 WHEN cat = 40 AND duration = 55 THEN mk_55 WHEN cat = 40 AND duration = 90 THEN mk_90
            WHEN training_name ILIKE '%YOGA%' OR training_name ILIKE '%йога%' THEN yoga
            WHEN training_name ILIKE '%CYCLE SPRINT@' AND types.type = 'Звездный тренер сайкл' THEN cycle
            WHEN training_name ILIKE '%HIIT%' OR training_name ILIKE '%GRIT%' OR training_name ILIKE '%CYCLE SPRINT@' THEN grit
            WHEN training_name ILIKE '%Cycle%' AND types.type = 'Звездный тренер сайкл' THEN cycle
            WHEN duration = 30 THEN "30" WHEN duration = 45 THEN "45" WHEN duration = 55 THEN "55" END, 0) AS salary
    FROM pd LEFT JOIN types ON types.id = pd.trainer_id
    LEFT JOIN rates ON rates.trainer_type = types.type AND rates.city = pd.city_name""",
)
def _trainer_pay(t: Tables):
    return trainers.trainer_pay(
        t.timetables, t.trainings, t.categories, t.class_employees, t.clubs, t.cities, t.employees, t.users,
        t.trainers_metro, t.trainers_region, t.rates, start=PAY_FROM,
    )
