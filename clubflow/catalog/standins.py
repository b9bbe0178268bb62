"""Business tables derived from the given tables.

Each text runs in both engines: as a Spark view over the Parquet files and as a
common table expression of the oracle. Every table is a projection, filter or
union of a given one, so its size follows the data. ``[q]`` is the quote for
names that are numbers.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession

from clubflow.operators.skew import NO_STATISTICS, KeyStatistics, add_sketches, read_statistics
from clubflow.session import new_table_path, prepare, rows_per_segment
from clubflow.sources import load
from clubflow.sources.published import version_of
from clubflow.sources.scan import scan_table

BASE = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "pages",
)

TABLES: dict[str, str] = {
    "users": """
        SELECT c_custkey AS id, c_name AS name,
            CASE WHEN c_custkey % 11 = 0 THEN NULL ELSE 'L' || CAST(c_custkey % 97 AS STRING) END AS last_name,
            '+7' || CAST(9000000000 + c_custkey AS STRING) AS phone,
            lower(c_name) || '@mail.test' AS email,
            CASE c_custkey % 3 WHEN 0 THEN 'male' WHEN 1 THEN 'female' END AS sex,
            CASE WHEN c_custkey % 13 = 0 THEN NULL
                ELSE CAST(DATE '1970-01-01' + INTERVAL '1' DAY * (c_custkey * 37 % 65000) AS DATE) END AS birthday,
            c_mktsegment AS sport_experience,
            CAST(c_nationkey AS BIGINT) AS home_club_id
        FROM {customer}""",
    "clubs": """
        SELECT CAST(n_nationkey AS BIGINT) AS id, n_name AS name, CAST(n_regionkey AS BIGINT) AS city_id,
            CASE WHEN n_nationkey % 2 = 0 THEN 'large' ELSE 'small' END AS club_type,
            CAST(DATE '1994-06-01' + INTERVAL '1' DAY * (n_nationkey * 110) AS DATE) AS open_date,
            '{{"is_open_all_day":' || CASE WHEN n_nationkey % 2 = 0 THEN 'true' ELSE 'false' END || '}}' AS open_hours,
            CAST(400 + n_nationkey * 25 AS DOUBLE) AS area_in_square_meters,
            CASE WHEN n_nationkey % 3 = 0 THEN CAST(n_nationkey * 100 AS DOUBLE) END AS rounded_area
        FROM {nation}""",
    "cities": "SELECT CAST(r_regionkey AS BIGINT) AS id, r_name AS name FROM {region}",
    "gates": "SELECT CAST(r_regionkey AS BIGINT) AS id, r_name AS name FROM {region}",
    "payment_plans": """
        SELECT p_partkey AS id,
            CASE WHEN p_partkey % 17 = 0 THEN 'Бартер ' || p_name WHEN p_partkey % 19 = 0 THEN 'Trial ' || p_name
                ELSE p_name END AS name,
            p_type AS payment_plan_type
        FROM {part}""",
    "inflow_plan_ids": "SELECT p_partkey AS id FROM {part} WHERE p_partkey % 3 = 0",
    "discounts": """
        SELECT p_partkey AS id,
            CASE p_partkey % 12 WHEN 0 THEN 'x Getblogger 04.2024 y' WHEN 1 THEN 'Getblogger 12.2024'
                WHEN 2 THEN 'GB именные 09.2024 a' WHEN 3 THEN 'b Perfluence 11.2024' WHEN 4 THEN 'c MEGABD'
                WHEN 5 THEN 'День рождения' WHEN 6 THEN '' WHEN 7 THEN 'Трейд-ин 0 руб' ELSE p_brand END AS name
        FROM {part}""",
    "discount_codes": "SELECT p_partkey AS id, p_brand AS code FROM {part}",
    "employees": """
        SELECT s_suppkey AS id, s_suppkey * 3 AS user_id,
            CAST(s_suppkey % 2 AS INT) AS is_active,
            CASE WHEN s_suppkey % 5 = 0 THEN 1 ELSE 0 END AS is_deleted
        FROM {supplier}""",
    "legal_infos": "SELECT s_suppkey AS id, CAST(s_nationkey AS BIGINT) AS club_id FROM {supplier}",
    "plans": """
        SELECT o_orderkey AS id, o_custkey AS user_id, o_orderkey % 250 AS payment_plan_id,
            o_orderkey * 7 % 25 AS club_id,
            CASE o_orderkey % 8 WHEN 0 THEN 'Current' WHEN 1 THEN 'Ended' WHEN 2 THEN 'Freezed'
                WHEN 3 THEN 'Refunded' WHEN 4 THEN 'PaymentPending' WHEN 5 THEN 'NotStarted'
                WHEN 6 THEN 'Created' ELSE 'Deleted' END AS status,
            o_orderdate AS signed_date,
            o_orderdate + INTERVAL '1' DAY AS start_date,
            CASE WHEN o_orderkey % 5 <> 0 THEN o_orderdate + INTERVAL '1' DAY * (o_orderkey * 13 % 700) END AS end_date,
            CASE WHEN o_orderkey % 9 = 0 THEN o_orderdate + INTERVAL '1' DAY * 20 END AS cancel_date,
            CASE o_orderkey % 6 WHEN 0 THEN 'ExcludeFromReport' WHEN 1 THEN 'AutoCanceledByDebt'
                WHEN 2 THEN 'Other' END AS cancel_reason,
            CASE WHEN o_orderkey % 4 <> 0 THEN o_orderkey % 160 END AS discount_id,
            CASE WHEN o_orderkey % 7 <> 0 THEN o_orderkey % 150 END AS discount_code_id,
            CASE WHEN o_orderkey % 2 = 0 THEN o_orderkey END AS card_token_id
        FROM {orders}
        UNION ALL
        SELECT o_orderkey + 1000000000, o_custkey, o_orderkey % 80 * 3, o_orderkey * 7 % 25, 'Current', o_orderdate,
            o_orderdate + INTERVAL '1' DAY, CASE WHEN o_orderkey < 0 THEN o_orderdate END,
            CASE WHEN o_orderkey < 0 THEN o_orderdate END, CAST(NULL AS STRING),
            o_orderkey * 7 % 13, CAST(NULL AS BIGINT), o_orderkey
        FROM {orders} WHERE o_orderkey % 250 IN (205, 206, 208) AND o_orderkey % 4 <> 1""",
    "transactions": """
        SELECT o_orderkey * 4 AS id, o_custkey AS user_id, o_orderkey AS user_payment_plan_id,
            o_orderkey % 6 AS gate_id, o_orderkey % 12 AS employee_id,
            o_orderkey % 160 AS discount_id, o_orderkey % 150 AS discount_code_id,
            CASE WHEN o_orderkey % 3 = 0 THEN o_orderkey % 12 END AS club_legal_info_id,
            CAST(NULL AS BIGINT) AS payment_transaction_id,
            CASE WHEN o_orderkey % 2 = 0 THEN 6 ELSE o_orderkey % 40 END AS provider_id, 'payment' AS type,
            CAST(o_totalprice AS DECIMAL(18,2)) AS total_amount,
            CAST(o_orderkey % 90 AS DECIMAL(18,2)) AS membership_fee,
            CAST(o_orderkey % 30 AS DECIMAL(18,2)) AS join_fee,
            CAST(o_orderkey % 20 AS DECIMAL(18,2)) AS discount_amount,
            o_orderdate AS created_at, o_orderdate + INTERVAL '10' MINUTE * (o_orderkey % 100) AS updated_at
        FROM {orders}
        UNION ALL
        SELECT o_orderkey * 4 + 1, o_custkey, o_orderkey, o_orderkey % 6, o_orderkey % 12, o_orderkey % 160,
            o_orderkey % 150, CASE WHEN o_orderkey % 4 = 0 THEN o_orderkey % 12 END, CAST(NULL AS BIGINT), 1, 'payment',
            CAST(o_totalprice AS DECIMAL(18,2)), CAST(0 AS DECIMAL(18,2)), CAST(0 AS DECIMAL(18,2)),
            CAST(0 AS DECIMAL(18,2)), o_orderdate + INTERVAL '30' DAY, o_orderdate + INTERVAL '30' DAY
        FROM {orders} WHERE o_orderkey % 3 = 1
        UNION ALL
        SELECT o_orderkey * 4 + 2, o_custkey, o_orderkey, o_orderkey % 6, o_orderkey % 12, o_orderkey % 160,
            o_orderkey % 150, CAST(NULL AS BIGINT), o_orderkey * 4, 8, 'refund',
            CAST(o_totalprice AS DECIMAL(18,2)), CAST(0 AS DECIMAL(18,2)), CAST(0 AS DECIMAL(18,2)),
            CAST(0 AS DECIMAL(18,2)), o_orderdate + INTERVAL '40' DAY, o_orderdate + INTERVAL '40' DAY
        FROM {orders} WHERE o_orderkey % 7 = 2
        UNION ALL
        SELECT o_orderkey * 4 + 3, o_custkey, o_orderkey + 1000000000, o_orderkey % 6, o_orderkey % 12, o_orderkey % 160,
            o_orderkey % 150, CAST(NULL AS BIGINT), CAST(NULL AS BIGINT), 6, 'payment',
            CAST(o_totalprice AS DECIMAL(18,2)), CAST(0 AS DECIMAL(18,2)), CAST(0 AS DECIMAL(18,2)),
            CAST(0 AS DECIMAL(18,2)), o_orderdate, o_orderdate + INTERVAL '10' MINUTE * (o_orderkey % 100)
        FROM {orders} WHERE o_orderkey % 250 IN (205, 206, 208) AND o_orderkey % 4 <> 1""",
    "club_moves": """
        SELECT o_orderkey AS user_payment_plan_id, o_custkey AS user_id, o_orderkey * 3 % 25 AS old_club_id,
            o_orderdate + INTERVAL '1' DAY * (o_orderkey % 60 - 10) AS created_at
        FROM {orders} WHERE o_orderkey % 6 = 1
        UNION ALL
        SELECT o_orderkey, o_custkey, o_orderkey * 9 % 25, o_orderdate + INTERVAL '1' DAY * (o_orderkey % 40 + 2)
        FROM {orders} WHERE o_orderkey % 12 = 1""",
    "flows": """
        SELECT o_custkey AS user_id, o_orderkey AS first_id,
            CASE WHEN o_orderkey % 4 = 0 THEN -1 ELSE o_orderkey + 1 END AS last_id,
            'N' || CAST(o_custkey AS STRING) AS name, 'x' AS last_name,
            '+7' || CAST(o_custkey AS STRING) AS phone, 'm' || CAST(o_custkey AS STRING) AS email,
            CASE o_custkey % 3 WHEN 0 THEN 'male' WHEN 1 THEN 'female' END AS sex,
            CAST(DATE '1970-01-01' + INTERVAL '1' DAY * (o_custkey % 9000) AS DATE) AS birthday,
            o_orderpriority AS sport_experience,
            o_orderkey * 3 % 25 AS inflow_club, o_orderkey * 7 % 25 AS outflow_club,
            'NATION_' || CAST(o_orderkey * 3 % 25 AS STRING) AS inflow_club_name,
            'NATION_' || CAST(o_orderkey * 7 % 25 AS STRING) AS outflow_club_name,
            'plan ' || CAST(o_orderkey % 9 AS STRING) AS first_payment_plan_name,
            'plan ' || CAST(o_orderkey % 8 AS STRING) AS last_payment_plan_name,
            CASE o_orderkey % 10 WHEN 0 THEN 'x Getblogger 06.2024 y' WHEN 1 THEN 'Perfluence 06.2024'
                WHEN 2 THEN 'MEGABD' WHEN 3 THEN 'PF именные 12.2024' WHEN 4 THEN NULL ELSE 'other' END AS discount_name,
            CASE WHEN o_orderkey % 7 = 0 THEN 'Current' ELSE 'Ended' END AS status,
            CASE WHEN o_orderkey % 6 = 1 THEN 'AutoCanceledByDebt' END AS cancel_reason,
            CASE WHEN o_orderkey % 2 = 0 THEN 'active' ELSE 'left' END AS user_status,
            CAST(o_orderdate AS DATE) AS start_date,
            CAST(o_orderdate + INTERVAL '3' DAY AS DATE) AS start_training_date,
            CASE WHEN o_orderkey % 7 <> 0
                THEN CAST(o_orderdate + INTERVAL '1' DAY * (o_orderkey * 13 % 500) AS DATE) END AS end_date,
            CASE WHEN o_orderkey % 3 = 0 THEN 1 ELSE 0 END AS is_new,
            CASE WHEN o_orderkey % 5 <> 0 THEN 1 ELSE 0 END AS is_inflow,
            CASE WHEN o_orderkey % 7 <> 0 AND o_orderkey % 4 <> 1 THEN 1 ELSE 0 END AS is_outflow,
            CAST(o_orderkey % 4 + 1 AS INT) AS qty_plans
        FROM {orders}""",
    "active": """
        SELECT o_orderkey * 11 % 23 AS club_id, 'NATION_' || CAST(o_orderkey * 11 % 23 AS STRING) AS club_name,
            CAST(o_orderdate AS DATE) AS start_date,
            CAST(o_orderdate + INTERVAL '1' DAY * (o_orderkey * 17 % 400) AS DATE) AS end_date,
            CASE WHEN o_orderkey % 6 <> 0 THEN 1 ELSE 0 END AS is_inflow,
            CASE WHEN o_orderkey % 3 <> 1 THEN 1 ELSE 0 END AS is_outflow
        FROM {orders}""",
    "expenses": """
        SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS date_month, o_orderkey * 3 % 25 AS club_id,
            CAST(-sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS acquisition_cost,
            CAST(count(*) * 1000 AS DOUBLE) AS club_ebitda
        FROM {orders} WHERE o_orderkey % 6 = 0
        GROUP BY CAST(date_trunc('month', o_orderdate) AS DATE), o_orderkey * 3 % 25""",
    "revenue": """
        SELECT CAST(o_orderdate AS DATE) AS date, 'NATION_' || CAST(o_orderkey * 7 % 25 AS STRING) AS club_name,
            CAST(o_totalprice AS DECIMAL(18,2)) AS total_cost
        FROM {orders}""",
    "days": "SELECT DISTINCT CAST(o_orderdate AS DATE) AS day_id_day FROM {orders}",
    "visits_histories": """
        SELECT event_id AS id, user_id, user_id % 25 AS club_id,
            CASE event_type WHEN 'view' THEN 'club_in' WHEN 'click' THEN 'club_out' ELSE event_type END AS event_type,
            ts AS club_event_date
        FROM {events}""",
    "visit_history": """
        SELECT event_id AS id, user_id, user_id % 25 AS club_id,
            'NATION_' || CAST(user_id % 25 AS STRING) AS club_name,
            CASE event_type WHEN 'view' THEN 'club_in' WHEN 'click' THEN 'club_out' ELSE event_type END AS event_type,
            ts AS event_date
        FROM {events}""",
    "swipes": """
        SELECT event_id AS id, user_id, CASE WHEN event_id % 3 <> 0 THEN event_id % 30 END AS club_id,
            CASE WHEN event_type IN ('view', 'click', 'error') THEN 'qr_check' ELSE event_type END AS event_type,
            event_type AS sys_response, value > 10 AS is_success, ts AS event_date, ts AS club_event_date
        FROM {events}""",
    "plan_history": """
        SELECT user_id AS id, user_id % 25 AS club_id,
            CASE WHEN user_id % 4 = 0 THEN 18 WHEN user_id % 4 = 1 THEN 243 WHEN user_id % 4 = 2 THEN 103 ELSE 5 END AS payment_plan_id,
            CASE WHEN user_id % 8 < 3 THEN 11538 ELSE 7 END AS discount_id,
            CASE event_type WHEN 'view' THEN 'Current' WHEN 'click' THEN 'PaymentPending' WHEN 'purchase' THEN 'Current'
                WHEN 'signup' THEN CASE WHEN event_id % 4 = 0 THEN 'Refunded' ELSE 'Ended' END
                ELSE CASE WHEN event_id % 5 = 0 THEN 'Deleted' ELSE 'Freezed' END END AS status,
            CASE event_id % 7 WHEN 0 THEN 'AutoCanceledByDebt' WHEN 1 THEN 'ExcludeFromReport' END AS cancel_reason,
            CASE WHEN event_id % 9 <> 0 THEN ts - INTERVAL '1' HOUR * (event_id % 300) END AS pay_date,
            ts AS updated_at, ts AS version_updated_at, event_id AS version
        FROM {events}""",
    "transaction_history": """
        SELECT user_id AS id,
            CASE event_type WHEN 'purchase' THEN 'completed' WHEN 'error' THEN '' ELSE event_type END AS status,
            ts AS version_updated_at, event_id AS version
        FROM {events}""",
    "accounting": """
        SELECT o_orderkey AS transaction_id, o_custkey AS user_id, o_orderkey % 22 AS provider_id,
            CASE o_orderkey % 4 WHEN 0 THEN 0 WHEN 1 THEN 1 WHEN 2 THEN 6 ELSE 9 END AS payment_plan_tax,
            CASE o_orderkey % 5 WHEN 0 THEN 0 WHEN 1 THEN 1 WHEN 2 THEN 6 END AS product_tax,
            CAST(o_orderkey % 3 AS INT) AS product_quantity, o_orderstatus AS type,
            'plan ' || CAST(o_orderkey % 9 AS STRING) AS payment_plan_name, o_orderpriority AS product_name,
            CAST(o_orderkey % 50 AS DECIMAL(18,2)) AS join_fee, CAST(o_orderkey % 40 AS DECIMAL(18,2)) AS join_fee_net,
            CAST(o_orderkey % 70 AS DECIMAL(18,2)) AS membership_fee,
            CAST(o_orderkey % 60 AS DECIMAL(18,2)) AS membership_fee_net,
            CAST(o_totalprice AS DECIMAL(18,2)) AS product_price,
            CAST(o_totalprice AS DECIMAL(18,2)) AS product_total_amount,
            CAST(o_totalprice AS DECIMAL(18,2)) AS product_total_amount_net,
            CAST(0 AS DECIMAL(18,2)) AS deposit_amount, o_orderdate AS created_at, o_orderkey % 10 = 0 AS is_deleted
        FROM {orders}""",
    "ledger_transactions": """
        SELECT o_orderkey AS id, o_orderkey * 2 AS receipt_id,
            CASE WHEN o_orderkey % 3 = 0 THEN o_orderkey - 1 ELSE 0 END AS parent_id,
            o_orderkey % 12 AS club_legal_info_id
        FROM {orders}""",
    "receipts": """
        SELECT CASE WHEN l_linenumber = 7 THEN 'none' WHEN l_linenumber = 6 THEN 'r_x' || CAST(l_orderkey AS STRING)
                ELSE 'r_' || CAST(l_orderkey AS STRING) END AS number,
            CASE l_returnflag WHEN 'A' THEN 'Commit' WHEN 'N' THEN 'Awaiting success transact' ELSE 'Failed' END AS fiscal_status
        FROM {lineitem}""",
    "timetables": """
        SELECT o_orderkey AS id, o_orderkey % 180 AS group_training_id, o_custkey % 25 AS club_id,
            o_orderdate + INTERVAL '1' HOUR * (o_orderkey % 12) AS start_time,
            o_orderdate + INTERVAL '1' HOUR * (o_orderkey % 12) + INTERVAL '1' MINUTE *
                (CASE o_custkey % 5 WHEN 0 THEN 30 WHEN 1 THEN 45 WHEN 2 THEN 55 WHEN 3 THEN 90 ELSE 60 END) AS end_time,
            o_orderkey % 10 = 0 AS is_deleted
        FROM {orders}""",
    "trainings": """
        SELECT p_partkey AS id,
            CASE p_partkey % 7 WHEN 0 THEN 'hiit ' || p_name WHEN 1 THEN 'Yoga' WHEN 2 THEN 'cycle'
                WHEN 3 THEN 'cycle sprint@' ELSE p_name END AS name,
            30 + p_partkey % 20 AS group_training_category_id
        FROM {part}""",
    "categories": """
        SELECT p_partkey AS id, CASE p_partkey WHEN 33 THEN 'Smart Start' ELSE p_type || CAST(p_partkey AS STRING) END AS name
        FROM {part}""",
    "class_employees": """
        SELECT o_orderkey AS group_training_time_table_id, o_custkey % 15 AS employee_id FROM {orders}""",
    "trainers_metro": """
        SELECT s_suppkey * 3 AS id,
            CASE s_suppkey % 3 WHEN 0 THEN '+7' || CAST(9000000000 + s_suppkey * 3 AS STRING)
                WHEN 1 THEN '7 900' || CAST(s_suppkey AS STRING) ELSE '+' || CAST(9000000000 + s_suppkey * 3 AS STRING) END AS phone,
            s_name AS name,
            CASE s_suppkey % 4 WHEN 0 THEN 'A' WHEN 1 THEN 'B' WHEN 2 THEN '' ELSE 'Звездный тренер сайкл' END AS category
        FROM {supplier}""",
    "trainers_region": """
        SELECT CASE WHEN s_suppkey % 7 <> 0 THEN s_suppkey * 3 + 1 END AS id,
            ' ' || CAST(79000000000 + s_suppkey * 3 AS STRING) || '+' AS phone, s_name AS name,
            CASE WHEN s_suppkey % 2 = 0 THEN 'A' ELSE 'B' END AS category
        FROM {supplier} WHERE s_suppkey % 2 = 0""",
    "rates": """
        SELECT k.trainer_type, r_name AS city,
            CAST(r_regionkey + 30 AS DECIMAL(18,2)) AS mk_30, CAST(r_regionkey + 155 AS DECIMAL(18,2)) AS mk_55,
            CAST(r_regionkey + 190 AS DECIMAL(18,2)) AS mk_90, CAST(r_regionkey + 1000 AS DECIMAL(18,2)) AS yoga,
            CAST(r_regionkey + 2000 AS DECIMAL(18,2)) AS cycle, CAST(r_regionkey + 3000 AS DECIMAL(18,2)) AS grit,
            CAST(r_regionkey + 330 AS DECIMAL(18,2)) AS [q]30[q], CAST(r_regionkey + 345 AS DECIMAL(18,2)) AS [q]45[q],
            CAST(r_regionkey + 355 AS DECIMAL(18,2)) AS [q]55[q]
        FROM (SELECT DISTINCT CASE s_suppkey % 3 WHEN 0 THEN 'A' WHEN 1 THEN 'B' ELSE 'Звездный тренер сайкл' END
                AS trainer_type, n_regionkey FROM {supplier} JOIN {nation} ON n_nationkey = s_nationkey) AS k
        JOIN {region} ON r_regionkey = k.n_regionkey
        WHERE r_regionkey < 4""",
    "bookings": """
        SELECT event_id AS booking_id, event_id * 2 AS timetable_id, user_id, user_id % 9 AS employee_id,
            event_id % 180 AS group_training_id, CAST(event_id % 30 AS INT) AS count_seats, 'zone' AS club_zone,
            'group ' || CAST(event_id % 5 AS STRING) AS group_name, event_type AS category_name,
            'NATION_' || CAST(user_id % 25 AS STRING) AS club_name, 'L' AS last_name, 'N' AS name, '+7' AS phone,
            CASE event_id % 6 WHEN 0 THEN 'cancelled' WHEN 1 THEN 'wait_list' WHEN 2 THEN 'waiting_list'
                ELSE 'booked' END AS booking_status,
            ts AS start_time, ts + INTERVAL '20' MINUTE AS end_time, ts - INTERVAL '1' DAY AS booking_date,
            ts AS updating_date
        FROM {events} WHERE event_type IN ('purchase', 'error', 'signup')""",
    "videos": """
        SELECT p_partkey AS id, p_name AS title, p_type AS type, p_brand AS short_description,
            p_size * 60 AS duration, CASE WHEN p_partkey % 9 = 0 THEN 1 ELSE 0 END AS is_deleted,
            CASE WHEN p_partkey % 2 = 0 THEN 1 ELSE 0 END AS is_free
        FROM {part}""",
    "video_progress": """
        SELECT event_id AS id, event_id % 20 AS video_id, user_id, CAST(event_id * 7 % 200 AS INT) AS duration,
            ts - INTERVAL '9400' DAY AS created_at
        FROM {events}""",
    "video_history": """
        SELECT event_id AS id, user_id % 7 AS video_id, user_id, CAST(event_id % 300 AS INT) AS duration,
            CAST(event_id % 4 AS INT) AS stars, CAST(event_id % 3 AS INT) AS difficulty,
            CASE WHEN event_id % 5 = 0 THEN 1 ELSE 0 END AS is_completed, event_type AS comment,
            ts AS updated_at, ts AS version_updated_at, event_id AS version
        FROM {events}
        UNION ALL
        SELECT event_id, user_id % 7, user_id, CAST(event_id % 300 AS INT), CAST(event_id % 4 AS INT),
            CAST(event_id % 3 AS INT), CASE WHEN event_id % 5 = 0 THEN 1 ELSE 0 END, event_type,
            ts, ts + INTERVAL '1' HOUR, event_id + 1
        FROM {events} WHERE event_id % 3 = 0""",
    "app_events": """
        SELECT 'dev_' || CAST(user_id * 2 + event_id % 2 AS STRING) AS DeviceID, CAST(ts AS DATE) AS EventDate,
            ts AS EventDateTime, CAST(ts + INTERVAL '1' DAY AS DATE) AS ReceiveDate,
            CASE WHEN event_id % 2 = 0 THEN 'android' ELSE 'ios' END AS OSName,
            CASE event_id % 6 WHEN 0 THEN 'stories_open' WHEN 1 THEN 'stories_closed' WHEN 2 THEN 'main_banner_click'
                WHEN 3 THEN 'stories_hold' WHEN 4 THEN 'app_open' ELSE 'screen' END AS EventName,
            CASE event_id % 5 WHEN 0 THEN '{{"user_id": ' || CAST(user_id AS STRING) || ', "slide_id": "' || CAST(event_id % 90 AS STRING) || '"}}'
                WHEN 1 THEN '{{"user": {{"id": "' || CAST(user_id AS STRING) || '"}}, "story_id": "s' || CAST(event_id % 8 AS STRING) || '"}}'
                WHEN 2 THEN '{{"story_id": "s' || CAST(event_id % 8 AS STRING) || '", "slide_id": "' || CAST(event_id % 90 AS STRING) || '", "showtime": "3.5"}}'
                WHEN 3 THEN '{{"user_id": ' || CAST(user_id AS STRING) || ', "banner_id":78}}'
                ELSE props END AS EventParameters
        FROM {events}""",
    "slides": "SELECT p_partkey AS id, p_name AS header FROM {part} WHERE p_partkey % 2 = 0",
    "postbacks": """
        SELECT CAST(DATE '1995-06-01' + INTERVAL '1' DAY * (page_id * 11 % 2000) AS DATE) AS ClickDate,
            CASE WHEN page_id % 4 = 0 THEN url ELSE url || '&tracker_device_id=dev_' || CAST(page_id AS STRING) || '&b=2' END
                AS PostbackUrlParameters,
            CASE page_id % 6 WHEN 0 THEN 'action_from_main_banner_aos' WHEN 1 THEN 'action_from_action__aos'
                WHEN 2 THEN 'action_new_from_action__aos' WHEN 3 THEN 'action_new_from_main_banner_aos' ELSE 'other' END AS TrackerName
        FROM {pages}""",
}


#: Sets of keys that large keys are looked for in, by table: name -> expressions.
KEY_SETS: dict[str, dict[str, list[str]]] = {
    "events": {"events.user": ["user_id"]},
    "orders": {"orders.group": ["o_custkey % 50"]},
    "visit_history": {"visits.user_club": ["user_id", "club_id"]},
    "visits_histories": {
        "visits.user": ["user_id"],
        "visits.user_day": ["user_id", "to_date(club_event_date)"],
        "visits.user_day_before": ["user_id", "date_sub(to_date(club_event_date), 1)"],
    },
    "swipes": {"swipes.user_day": ["user_id", "to_date(event_date)"]},
    "bookings": {"bookings.user_day": ["user_id", "to_date(start_time)"]},
    "plans": {"plans.user": ["user_id"]},
    "flows": {"flows.user": ["user_id"]},
    "transactions": {"payments.user": ["user_id"]},
    "transaction_history": {"history.id": ["id"]},
    "plan_history": {"plan_history.id": ["id"]},
    "video_history": {"progress.user_video": ["user_id", "video_id"]},
}
_sketches: dict[tuple[str, str, str], str] = {}
_derived: dict[tuple[str, str, str], str] = {}
_known: dict[tuple[str, str, str, int], KeyStatistics] = {}


def _base_names(text: str) -> list[str]:
    return sorted(set(re.findall(r"(?<!\{)\{(\w+)\}", text)))


class Tables:
    """Given tables and stand-ins of one folder by attribute: ``t.orders``, ``t.plans``, …

    Each is opened once, so one query reads every file footer once.
    """

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = prepare(spark), sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        if name in BASE:
            found = scan_table(self.spark, f"{self.sf_dir}/{name}.parquet")
        elif name in TABLES:
            text = TABLES[name]
            sources = {n: getattr(self, n) for n in _base_names(text)}
            found = self.spark.sql(text.replace("[q]", "`"), **sources)
        else:
            raise AttributeError(name)
        self.__dict__[name] = found
        return found

    def derived(self, name: str, tables: Sequence[str], build: Callable[[], DataFrame]) -> DataFrame:
        """A mart that other marts read, built again only when a given table under it has changed."""
        base, open_names = set(), list(tables)
        while open_names:
            table = open_names.pop()
            if table in BASE:
                base.add(table)
            else:
                open_names += _base_names(TABLES[table])
        inputs = {b: version_of(self.spark, f"{self.sf_dir}/{b}.parquet") for b in sorted(base)}
        of = (self.spark.sparkContext.applicationId, self.sf_dir, name)
        if of not in _derived:
            _derived[of] = new_table_path(self.spark, name)
        return load.derived(self.spark, _derived[of], inputs, build)

    def large(self, *tables: str) -> KeyStatistics:
        """Statistics of the keys of some tables; each table is measured once and its sketch kept."""
        out = NO_STATISTICS
        for table in tables:
            of = (self.spark.sparkContext.applicationId, self.sf_dir, table)
            known = (*of, rows_per_segment(self.spark))
            if of not in _sketches:
                path = new_table_path(self.spark, f"statistics-{table}")
                add_sketches(getattr(self, table), KEY_SETS[table], path)
                _sketches[of] = path
            if known not in _known:
                _known[known] = read_statistics(self.spark, _sketches[of])
            out = out | _known[known]
        return out


def with_tables(sql: str, *names: str) -> str:
    """The oracle text with the stand-ins it needs in front."""
    if not names:
        return sql
    parts = []
    for n in names:
        text = TABLES[n].replace("[q]", '"')
        parts.append(f"{n} AS ({text.format(**{b: b for b in BASE})})")
    return "WITH " + ",\n".join(parts) + f"\nSELECT * FROM ({sql}) AS answer"
