"""Scalar, array and higher-order functions."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Window
from pyspark.sql import functions as F

from clubflow import config as c
from clubflow.catalog.registry import Tables, query
from clubflow.functions import dates as d
from clubflow.functions import text as x
from clubflow.functions.numbers import ratio, round_even
from clubflow.operators.flows import explode_hours
from clubflow.plans.mobile import event_user
from clubflow.plans.trainers import club_city, fold_city
from clubflow.plans.tree import club_profile, rolling_year


@query(
    "fn_date_trunc",
    dates=("month", "month2"),
    sql="""SELECT event_id, CAST(date_trunc('month', ts) AS DATE) AS month, date_trunc('hour', ts) AS hour,
        CAST(date_trunc('month', ts + INTERVAL 20 DAY) AS DATE) AS month2 FROM events""",
)
def _date_trunc(t: Tables):
    return t.events.select(
        "event_id",
        d.month_start(F.col("ts")).alias("month"),
        d.hour_start(F.col("ts")).alias("hour"),
        d.month_start(F.col("ts") + F.expr("INTERVAL 20 DAY")).alias("month2"),
    )


def _rolling_sql() -> str:
    arms = " ".join(f"WHEN b BETWEEN {12 * k} AND {12 * k + 11} THEN '{2001 - k}'" for k in range(8))
    return f"CASE {arms} ELSE '2018' END"


@query(
    "fn_date_parts",
    sql=f"""SELECT o_orderkey, year(o_orderdate) AS y, month(o_orderdate) AS m, {_rolling_sql()} AS block
        FROM (SELECT *, date_diff('month', CAST(o_orderdate AS DATE), DATE '2001-12-01') AS b FROM orders)""",
)
def _date_parts(t: Tables):
    day = F.to_date("o_orderdate")
    return t.orders.select(
        "o_orderkey", F.year(day).alias("y"), F.month(day).alias("m"), rolling_year(day, dt.date(2001, 12, 1)).alias("block")
    )


@query(
    "fn_date_cast",
    dates=("day", "opened"),
    sql="""SELECT event_id, CAST(ts AS DATE) AS day, coalesce(CAST(NULL AS DATE), DATE '2049-01-01') AS opened,
        CAST(strftime(ts, '%Y-%m-%d %H:%M:%S') AS TIMESTAMP) AS second,
        CAST(CAST(ts AS DATE) AS TIMESTAMP) - INTERVAL 3 HOUR AS midnight_utc FROM events""",
)
def _date_cast(t: Tables):
    midnight = F.to_date("ts").cast("timestamp_ntz")
    return t.events.select(
        "event_id",
        F.to_date("ts").alias("day"),
        F.coalesce(F.lit(None).cast("date"), F.lit(c.OPEN_END)).alias("opened"),
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss").cast("timestamp_ntz").alias("second"),
        # wall clock of a zone to UTC
        F.to_utc_timestamp(midnight.cast("timestamp"), "Europe/Moscow").cast("timestamp_ntz").alias("midnight_utc"),
    )


_GAPS = "FROM (SELECT o_orderkey, o_orderdate + INTERVAL '1' MINUTE * (o_orderkey * 37 % 5000) AS a, o_orderdate + INTERVAL '1' SECOND * (o_orderkey * 91 % 9000000) AS b FROM orders)"


@query(
    "fn_date_diff",
    sql=f"""SELECT o_orderkey, date_diff('day', a, b) AS days, date_diff('month', a, b) AS months,
        date_diff('minute', a, b) AS minutes, date_diff('second', a, b) AS seconds {_GAPS}""",
)
def _date_diff(t: Tables):
    spans = t.spark.sql(f"SELECT * {_GAPS.replace('orders)', '{orders})')}", orders=t.orders)
    a, b = F.col("a"), F.col("b")
    return spans.select(
        "o_orderkey",
        d.days_between(a, b).alias("days"),
        d.months_between(a, b).alias("months"),
        d.minutes_between(a, b).alias("minutes"),
        d.seconds_between(a, b).alias("seconds"),
    )


@query(
    "fn_date_add",
    dates=("next_month", "later"),
    sql="""SELECT o_orderkey, CAST(CAST(o_orderdate AS DATE) + INTERVAL 1 MONTH AS DATE) AS next_month, o_orderdate + INTERVAL 3 HOUR AS shifted,
        o_orderdate - INTERVAL 90 MINUTE AS earlier, o_orderdate + INTERVAL 1 SECOND AS tick, CAST(o_orderdate + INTERVAL 30 DAY AS DATE) AS later FROM orders""",
)
def _date_add(t: Tables):
    at = F.col("o_orderdate")
    return t.orders.select(
        "o_orderkey",
        F.add_months(at, 1).alias("next_month"),
        d.shift_hours(at, 3).alias("shifted"),
        (at - F.expr("INTERVAL 90 MINUTE")).alias("earlier"),
        (at + F.expr("INTERVAL 1 SECOND")).alias("tick"),
        F.date_add(at, 30).alias("later"),
    )


@query("fn_days_in_month", sql="SELECT o_orderkey, CAST(day(last_day(o_orderdate)) AS INTEGER) AS days FROM orders")
def _days_in_month(t: Tables):
    return t.orders.select("o_orderkey", d.days_in_month(F.col("o_orderdate")).alias("days"))


@query(
    "fn_now",
    dates=("yesterday",),
    sql="""SELECT event_id, TIMESTAMP '2024-01-31' AS loaded_at, DATE '2024-01-30' AS yesterday,
        CAST(date_diff('day', ts, TIMESTAMP '2024-01-31') AS INTEGER) AS age_days FROM events WHERE ts <= TIMESTAMP '2024-01-31'""",
)
def _now(t: Tables):
    # the run time is a parameter, so a rerun gives the same rows
    as_of = dt.datetime(2024, 1, 31)
    return t.events.where(F.col("ts") <= d.ntz(as_of)).select(
        "event_id",
        d.ntz(as_of).alias("loaded_at"),
        F.lit(as_of.date() - dt.timedelta(days=1)).alias("yesterday"),
        d.days_between(F.col("ts"), d.ntz(as_of)).alias("age_days"),
    )


@query("fn_timezone_shift", sql="SELECT event_id, ts + INTERVAL 3 HOUR AS local_time, ts + INTERVAL 6 HOUR AS shifted FROM events")
def _timezone(t: Tables):
    return t.events.select(
        "event_id", d.shift_hours(F.col("ts"), 3).alias("local_time"), d.shift_hours(F.col("ts"), 6).alias("shifted")
    )


@query("fn_unix_hours", sql="SELECT event_id, CAST(epoch(date_trunc('hour', ts)) AS BIGINT) // 3600 AS hour_number FROM events")
def _unix_hours(t: Tables):
    return t.events.select("event_id", F.floor(d.epoch_seconds(d.hour_start(F.col("ts"))) / 3600).alias("hour_number"))


@query(
    "fn_repair_birthday",
    tables=("users",),
    dates=("birthday",),
    sql="""SELECT id, CASE WHEN birthday - DATE '1970-01-01' >= 39969 THEN DATE '1970-01-01' + CAST(birthday - DATE '1970-01-01' - 65536 AS INTEGER)
        ELSE birthday END AS birthday FROM users""",
)
def _birthday(t: Tables):
    return t.users.select("id", d.repair_birthday(F.col("birthday")).alias("birthday"))


@query(
    "fn_string_basic",
    tables=("users",),
    sql="""SELECT id, name || ' ' || last_name AS full_name, lower(name) AS low, left(phone, 2) AS prefix, trim('  ' || name || ' ') AS trimmed,
        replace(name, '#', '-') AS dashed, CAST(id AS VARCHAR) AS id_text FROM users""",
)
def _strings(t: Tables):
    name = F.col("name")
    return t.users.select(
        "id",
        F.concat("name", F.lit(" "), "last_name").alias("full_name"),
        F.lower(name).alias("low"),
        F.left("phone", F.lit(2)).alias("prefix"),
        F.trim(F.concat(F.lit("  "), name, F.lit(" "))).alias("trimmed"),
        F.replace(name, F.lit("#"), F.lit("-")).alias("dashed"),
        F.col("id").cast("string").alias("id_text"),
    )


@query(
    "fn_split_pick",
    tables=("receipts",),
    sql="SELECT number, fiscal_status, TRY_CAST(nullif(split_part(number, '_', 2), '') AS BIGINT) AS id_transaction FROM receipts",
)
def _split(t: Tables):
    return t.receipts.select("number", "fiscal_status", x.split_number(F.col("number"), "_", 2).alias("id_transaction"))


@query(
    "fn_regex_extract",
    sql=r"""SELECT page_id, regexp_extract(url, 'page=(.*?)&', 1) AS page, regexp_extract(url, '^https?://([\p{L}-]+)', 1) AS host FROM pages""",
)
def _regex_extract(t: Tables):
    url = F.col("url")
    return t.pages.select(
        "page_id",
        F.regexp_extract(url, "page=(.*?)&", 1).alias("page"),
        F.regexp_extract(url, r"^https?://([\p{L}-]+)", 1).alias("host"),
    )


@query(
    "fn_club_city",
    sql=r"""SELECT s_suppkey, regexp_extract('Club Город-' || CASE WHEN s_suppkey % 2 = 0 THEN 'а' ELSE 'XL' END || ' ' || s_name, '^Club ([\p{L}-]+)', 1) AS city FROM supplier""",
)
def _club_city(t: Tables):
    club = F.concat(
        F.lit("Club Город-"), F.when(F.col("s_suppkey") % 2 == 0, "а").otherwise("ХL"), F.lit(" "), F.col("s_name")
    )
    return t.supplier.select("s_suppkey", club_city(club, "Club").alias("city"))


@query(
    "fn_regex_replace",
    tables=("trainers_metro",),
    sql=r"SELECT id, regexp_replace(phone, '^\++|\++$', '', 'g') AS bare FROM trainers_metro",
)
def _regex_replace(t: Tables):
    return t.trainers_metro.select("id", x.strip_plus(F.col("phone")).alias("bare"))


@query(
    "fn_normalize_phone",
    sql=r"""
    WITH p AS (SELECT c_custkey, CASE c_custkey % 5 WHEN 0 THEN '+7900' WHEN 1 THEN ' 8 900 ' WHEN 2 THEN '7 90' WHEN 3 THEN '9++' ELSE '++7 1' END
        || CAST(c_custkey AS VARCHAR) || CASE WHEN c_custkey % 3 = 0 THEN '+' ELSE ' ' END AS phone FROM customer),
    b AS (SELECT c_custkey, regexp_replace(phone, '^\++|\++$', '', 'g') AS bare FROM p)
    SELECT c_custkey, CASE WHEN left(trim(bare), 1) <> '7' THEN '+7' || trim(bare) ELSE '+' || trim(bare) END AS region,
        CASE WHEN left(trim(bare), 1) <> '7' THEN '+7' || trim(bare) ELSE '+' || replace(bare, ' ', '') END AS metro FROM b""",
)
def _phones(t: Tables):
    key = F.col("c_custkey")
    head = F.when(key % 5 == 0, "+7900").when(key % 5 == 1, " 8 900 ").when(key % 5 == 2, "7 90").when(key % 5 == 3, "9++").otherwise("++7 1")
    phone = F.concat(head, key.cast("string"), F.when(key % 3 == 0, "+").otherwise(" "))
    return t.customer.select("c_custkey", x.phone_plus7(phone).alias("region"), x.phone_plus7(phone, True).alias("metro"))


@query(
    "fn_json_path",
    tables=("app_events", "clubs"),
    sql="""SELECT DeviceID AS device_id, EventDateTime AS at, coalesce(json_extract_string(EventParameters, '$.story_id'), '') AS story_id,
        coalesce(TRY_CAST(coalesce(nullif(json_extract_string(json_extract_string(EventParameters, '$.user'), '$.id'), ''),
            nullif(json_extract_string(EventParameters, '$.user_id'), '')) AS BIGINT), 0) AS user_id FROM app_events""",
)
def _json(t: Tables):
    p = F.col("_parsed")
    return t.app_events.withColumn("_parsed", x.parsed_json(F.col("EventParameters"))).select(
        F.col("DeviceID").alias("device_id"),
        F.col("EventDateTime").alias("at"),
        x.field_text(p, "$.story_id").alias("story_id"),
        event_user(p).alias("user_id"),
    )


@query(
    "fn_math",
    sql="""SELECT c_custkey, abs(c_acctbal) AS size, CAST(floor(c_acctbal / 100) AS BIGINT) AS hundreds,
        round_even(c_custkey / 2, 0) AS even, round_even(c_custkey / 8, 2) AS even2 FROM customer""",
)
def _math(t: Tables):
    key = F.col("c_custkey")
    return t.customer.select(
        "c_custkey",
        F.abs("c_acctbal").alias("size"),
        F.floor(F.col("c_acctbal") / 100).alias("hundreds"),
        round_even(key / 2, 0).alias("even"),
        round_even(key / 8, 2).alias("even2"),
    )


@query(
    "fn_null",
    tables=("plans",),
    sql="""SELECT id, coalesce(discount_id, 0) AS discount, nullif(club_id, 0) AS club, end_date IS NULL AS is_open,
        cancel_reason IS NOT NULL AS canceled FROM plans""",
)
def _null(t: Tables):
    return t.plans.select(
        "id",
        F.ifnull(F.col("discount_id"), F.lit(0)).alias("discount"),
        F.nullif(F.col("club_id"), F.lit(0)).alias("club"),
        F.col("end_date").isNull().alias("is_open"),
        F.col("cancel_reason").isNotNull().alias("canceled"),
    )


@query("fn_safe_ratio", sql="SELECT event_id, event_id / nullif(user_id % 7, 0) AS share FROM events")
def _safe_ratio(t: Tables):
    return t.events.select("event_id", ratio(F.col("event_id"), F.col("user_id") % 7).alias("share"))


@query(
    "fn_cast",
    sql="""SELECT p_partkey, CAST(p_size AS BIGINT) AS size, CAST(p_partkey AS VARCHAR) AS key_text, TRY_CAST(split_part(p_brand, '#', 2) AS BIGINT) AS brand,
        TRY_CAST(p_name AS BIGINT) AS nothing, CAST(p_retailprice AS DECIMAL(18,2))::DOUBLE AS price FROM part""",
)
def _cast(t: Tables):
    return t.part.select(
        "p_partkey",
        F.col("p_size").cast("bigint").alias("size"),
        F.col("p_partkey").cast("string").alias("key_text"),
        F.split("p_brand", "#")[1].try_cast("bigint").alias("brand"),
        F.col("p_name").try_cast("bigint").alias("nothing"),
        F.col("p_retailprice").cast("decimal(18,2)").alias("price"),
    )


def _in(values) -> str:
    return "(" + ", ".join(f"'{v}'" if isinstance(v, str) else str(v) for v in values) + ")"


@query(
    "fn_tier_lookup",
    tables=("clubs",),
    sql=f"""SELECT c_custkey, CASE WHEN k.id IN {_in(c.TIER_1)} THEN '1' WHEN k.id IN {_in(c.TIER_2)} THEN '2' ELSE '3' END AS tir,
        CASE WHEN date_diff('month', k.open_date, DATE '1999-12-01') <= 12 THEN 'молодые'
            WHEN date_diff('month', k.open_date, DATE '1999-12-01') <= 24 THEN 'юниоры' ELSE 'зрелые' END AS age,
        CASE WHEN c_mktsegment IN {_in(c.METRO_SATELLITES)} THEN 'Москва' ELSE c_mktsegment END AS city
        FROM customer JOIN clubs k ON k.id = c_nationkey""",
)
def _tier(t: Tables):
    named = t.clubs.select(F.col("id").alias("c_nationkey"), F.col("name").alias("club_name"))
    profile = club_profile(t.clubs, dt.date(1999, 12, 1))
    return (
        t.customer.join(named, "c_nationkey")
        .join(profile, "club_name")
        .select("c_custkey", "tir", "age", fold_city(F.col("c_mktsegment")).alias("city"))
    )


@query(
    "fn_campaign_label",
    tables=("flows",),
    sql="SELECT first_id, CASE "
    + " ".join(f"WHEN discount_name LIKE '{p}' THEN '{v}'" for p, v in c.CAMPAIGN_RULES)
    + " ELSE discount_name END AS label FROM flows",
)
def _campaign_label(t: Tables):
    return t.flows.select("first_id", x.first_label(F.col("discount_name"), c.CAMPAIGN_RULES).alias("label"))


# --------------------------------------------------------------------------- arrays


@query(
    "arr_explode_hours",
    sql="""SELECT event_id, unnest(generate_series(date_trunc('hour', ts), date_trunc('hour', ts + INTERVAL '1' MINUTE * (event_id * 7 % 400)), INTERVAL 1 HOUR)) AS hour
        FROM events""",
)
def _explode_hours(t: Tables):
    spans = t.events.select(
        "event_id", "ts", (F.col("ts") + F.expr("INTERVAL '1' MINUTE * (event_id * 7 % 400)")).alias("_end")
    )
    return explode_hours(spans, "ts", "_end", "hour").select("event_id", "hour")


@query(
    "arr_exists_pattern",
    tables=("trainings",),
    sql="SELECT id, name ILIKE '%HIIT%' OR name ILIKE '%GRIT%' OR name ILIKE '%CYCLE SPRINT@' AS intensive, name ILIKE '%YOGA%' AS yoga FROM trainings",
)
def _exists_pattern(t: Tables):
    name = F.col("name")
    listed = F.array(*[F.lit(p) for p in c.INTENSIVE_PATTERNS])
    return t.trainings.select(
        "id",
        F.exists(listed, lambda p: F.ilike(name, p)).alias("intensive"),
        x.like_any(name, c.YOGA_PATTERNS).alias("yoga"),
    )


@query(
    "arr_collect_slice",
    dates=("day",),
    sql="""
    WITH d AS (SELECT CAST(ts AS DATE) AS day, count(*) AS n FROM events GROUP BY ALL)
    SELECT day, n, lag(n, 2) OVER w AS two_back, coalesce(lag(n, 2) OVER w, 0) + coalesce(lag(n, 1) OVER w, 0) + n AS last_three
    FROM d WINDOW w AS (ORDER BY day)""",
)
def _collect_slice(t: Tables):
    daily = t.events.groupBy(F.to_date("ts").alias("day")).agg(F.count(F.lit(1)).alias("n"))
    near = F.collect_list("n").over(Window.orderBy("day").rowsBetween(-2, 0))
    tail = F.slice(F.col("_near"), F.greatest(F.size("_near") - 2, F.lit(1)), F.lit(3))
    return daily.withColumn("_near", near).select(
        "day",
        "n",
        F.when(F.size("_near") == 3, F.element_at("_near", 1)).alias("two_back"),
        F.aggregate(tail, F.lit(0).cast("bigint"), lambda acc, v: acc + v).alias("last_three"),
    )
