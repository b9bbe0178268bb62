"""Plans of the payment marts: what a task has to sort, and what is read for it."""

import datetime as dt

from pyspark.sql import functions as F

from clubflow import config as c
from clubflow.plans import money
from clubflow.sources import load

TS = "TIMESTAMP_NTZ'2024-01-02 00:00:00'"


def leaves(df) -> int:
    return df._jdf.queryExecution().optimizedPlan().collectLeaves().size()


def test_ledger_sorts_no_wide_rows(spark):
    accounting = spark.createDataFrame([(n, n % 3, n) for n in range(1, 7)], "transaction_id long, user_id long, provider_id int").selectExpr(
        "*", "1 payment_plan_tax", "1 product_tax", "false is_deleted", "1 product_quantity", "'t' type", "'p' payment_plan_name",
        "'n' product_name", "1D join_fee", "1D join_fee_net", "1D membership_fee", "1D membership_fee_net", "1D product_price",
        "1D product_total_amount", "1D product_total_amount_net", "0D deposit_amount", f"{TS} created_at",
    )
    # transaction 3 is there twice, its parent has receipts of two kinds: four rows
    tx = spark.createDataFrame([(1, 10, 0, 7), (2, 20, 1, 7), (3, 30, 2, 8), (3, 31, 2, 7)], "id long, receipt_id long, parent_id long, club_legal_info_id long")
    counts = spark.createDataFrame([(1, "Commit", 3), (2, "a", 1), (2, "b", 1)], "id_transaction long, fiscal_status string, cnt_receips long")
    users = spark.createDataFrame([(1, "A", "B")], "id long, name string, last_name string")
    legal = spark.createDataFrame([(7, 3)], "id long, club_id long")
    clubs = spark.createDataFrame([(3, "C")], "id long, name string")
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = money.accounting_ledger(accounting, tx, counts, users, legal, clubs)
        plan = out._jdf.queryExecution().executedPlan().toString()
        found = sorted((tuple(r) for r in out.select("transaction_id", "receipt", "club_name", "name", "cnt_receips", "fiscal_status").collect()), key=repr)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    assert "SortMergeJoin [transaction_id" not in plan and "SortMergeJoin [user_id" not in plan
    assert found == sorted(
        [
            (1, 10, "C", "A B", 3, "Commit"), (2, 20, "C", None, 1, "Commit"), (2, 20, "C", None, 1, "Commit"),
            (3, 30, None, None, 1, "a"), (3, 30, None, None, 1, "b"), (3, 31, "C", None, 1, "a"), (3, 31, "C", None, 1, "b"),
            (4, None, None, "A B", None, None), (5, None, None, None, None, None), (6, None, None, None, None, None),
        ],
        key=repr,
    )


def _revenue(spark, first: dt.date, last: dt.date):
    plans = spark.createDataFrame([(1, 1, 7, 20), (2, 1, 7, 20), (None, 1, 7, 20)], "id long, user_id long, payment_plan_id long, club_id long").selectExpr(
        "*", f"{TS} start_date", "CAST(NULL AS TIMESTAMP_NTZ) end_date"
    )
    moves = spark.createDataFrame([(1, 30), (2, 30), (3, 30)], "user_payment_plan_id long, old_club_id long").selectExpr("*", f"{TS} created_at")
    tx = spark.createDataFrame([(1, 1, 5.0), (1, 3, 6.0), (1, None, 7.0)], "user_id long, user_payment_plan_id long, total_amount double").selectExpr(
        "*", "1 provider_id", "nullif(user_id, 1) club_legal_info_id", f"{TS} updated_at"
    )
    legal = spark.createDataFrame([(9, 50)], "id long, club_id long")
    clubs = spark.createDataFrame([(30, "C", 1, "t", first)], "id long, name string, city_id long, club_type string, open_date date")
    names = spark.createDataFrame([(7, "plan")], "id long, name string")
    return money.revenue_monthly(tx, plans, moves, legal, clubs, names, first, last)


def test_revenue_reads_the_payments_once(spark):
    out = _revenue(spark, dt.date(2024, 1, 1), dt.date(2024, 12, 31))
    # payments once; plans for the product, the first move and the first club; moves, legal entities, clubs, names
    assert leaves(out) == 1 + 3 + 4
    assert sorted((r["payment_plan_id"], r["club_id"], r["total_cost"]) for r in out.collect() if r["club_id"]) == [(7, 30, 5.0)]
    assert [(r["payment_plan_id"], r["total_cost"]) for r in out.collect() if not r["club_id"]] == [(0, 6.0)]


def test_reload_of_a_month_reads_its_payments_once(spark, tmp_path):
    path, builds = str(tmp_path / "revenue"), []

    def build(first: dt.date, last: dt.date):
        builds.append(_revenue(spark, first, last))
        return builds[-1]

    load.overwrite_partitions(build(dt.date(2024, 1, 1), dt.date(2024, 12, 31)), path, "date")
    load.replace_months(build, path, dt.date(2024, 2, 1))  # January again, and February, which has nothing
    assert [leaves(b) for b in builds[:2]] == [8, 8]
    got = load.read_target(spark, path).collect()
    assert sorted((r["payment_plan_id"], r["total_cost"]) for r in got) == [(0, 6.0), (7, 5.0)]


def test_sale_terms_are_those_of_the_sales_list(spark):
    plans = spark.createDataFrame(
        [(1, 1, 3, "Current", None), (1, 1, 3, "Current", None), (2, 2, 3, "Ended", "ExcludeFromReport"), (3, 2, 3, "Deleted", None), (4, None, None, "Ended", "Other"), (None, 1, 3, "Ended", None)],
        "id long, user_id long, payment_plan_id long, status string, cancel_reason string",
    ).selectExpr("*", f"{TS} signed_date", f"{TS} start_date", f"{TS} end_date", "1L club_id", "1L discount_id", "1L discount_code_id", "1L card_token_id")
    provider = c.FIRST_PAYMENT_PROVIDERS[0]
    tx = spark.createDataFrame(
        [(10, 1, provider, 5, 8), (9, 1, provider, 6, 8), (11, 4, provider, None, 7), (12, 2, provider, 5, 8), (13, None, provider, 5, 8)],
        "id long, user_payment_plan_id long, provider_id int, gate_id long, employee_id long",
    ).selectExpr("*", "id * 2 discount_amount", "id * 3 membership_fee", "1 join_fee", "1 total_amount", "1L discount_code_id", "1L discount_id", f"{TS} updated_at")
    users = spark.createDataFrame([(1, "A", "B"), (1, "C", "D"), (2, "E", None)], "id long, name string, last_name string").selectExpr(
        "*", "'p' phone", "'e' email", "DATE'2000-01-01' birthday", "'s' sex", "'x' sport_experience"
    )
    employees = spark.createDataFrame([(8, 1), (7, 2), (7, None)], "id long, user_id long")
    gates = spark.createDataFrame([(6, "six"), (6, "six b"), (5, "five")], "id long, name string")
    named = spark.createDataFrame([(1, "n", "c", 1), (3, "n", "c", 1)], "id long, name string, code string, city_id long").withColumn("payment_plan_type", F.lit("t"))
    flows = spark.createDataFrame([(1, 1, 1), (1, 0, 1)], "first_id long, is_new int, is_inflow int")
    sales = money.subscription_sales(plans, named, named, tx, flows, users, employees, named, named, gates, named, named, as_of=dt.datetime(2024, 1, 1))
    terms = money.sale_terms(plans, tx, users, employees, gates)
    want = sales.select(*terms.columns).distinct()
    assert terms.dtypes == want.dtypes
    got = {tuple(r) for r in terms.collect()}
    assert got == {tuple(r) for r in want.collect()} and (1, 18, 27, "six b", "C", "D") in got
