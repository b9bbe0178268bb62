"""Plans are built without running anything, and batches read only what they need."""

import datetime as dt

import pytest
from plans import jobs, scans
from pyspark.sql import functions as F

from clubflow.catalog import QUERIES
from clubflow.catalog.standins import KEY_SETS, Tables
from clubflow.operators.skew import NO_STATISTICS, measure
from clubflow.plans import campaign, cohorts, money, tree, visits
from clubflow.sources import receipts

FOLDER = "/root/testdata/sf0.001"


def test_building_a_mart_starts_no_job(spark):
    t = Tables(spark, FOLDER)
    tables = {n: getattr(t, n) for n in (
        "visit_history", "users", "clubs", "employees", "visits_histories", "swipes", "plans", "bookings", "flows", "transactions",
        "transaction_history", "plan_history", "video_history", "videos", "gates", "payment_plans", "discounts", "inflow_plan_ids",
        "app_events", "video_progress", "accounting", "ledger_transactions", "receipts", "legal_infos",
    )}
    large = t.large(*KEY_SETS)
    tracker = spark.createDataFrame([(1, dt.date(2024, 1, 1))], "user_id long, click_date date")
    day = dt.date(2024, 1, 1)
    with jobs(spark) as started:
        x = type("", (), tables)
        raw = visits.in_out_raw(x.visits_histories, x.users, x.clubs, day, day, large=large)
        built = [
            visits.occupancy_hourly(x.visit_history, x.users, x.clubs, x.employees, dt.datetime(2024, 1, 1), dt.datetime(2024, 2, 1), large=large),
            visits.swipe_gapfill(x.swipes, x.clubs, above=3, since=day, large=large),
            visits.class_attendance(visits.in_out_visits(raw).visits, x.plans, x.bookings, large=large),
            tree.lifetime(x.flows, large),
            money.left_completed(x.transaction_history, large=large),
            money.accounting_ledger(x.accounting, x.ledger_transactions, money.receipt_counts(x.receipts), x.users, x.legal_infos, x.clubs),
            cohorts.debt_cohort_ladder(x.plan_history, x.clubs, large=large),
            campaign.watch_sessions(x.video_history, large=large),
            campaign.campaign_purchases(
                campaign.campaign_payments(x.transactions), x.plans, x.clubs, x.payment_plans, x.gates, x.users, x.employees, x.discounts,
                x.inflow_plan_ids, x.app_events, x.video_progress, x.videos, tracker, large=large,
            ),
        ]
    assert started == [] and all(df.columns for df in built)
    with jobs(spark) as started:
        built[1].collect()
    assert started


def test_a_table_is_measured_once(spark):
    first = Tables(spark, FOLDER).large("swipes")
    with jobs(spark) as started:
        assert Tables(spark, FOLDER).large("swipes") == NO_STATISTICS | first
    assert started == []


@pytest.fixture
def swipes(spark, tmp_path):
    """Thirty days of scans, partitioned by day, ids in order of time; some without a time."""
    rows = spark.range(3000).selectExpr(
        "id", "id % 17 AS user_id", "CASE WHEN id % 3 <> 0 THEN id % 9 END AS club_id", "'qr_check' AS event_type", "'ok' AS sys_response",
        "true AS is_success", "CASE WHEN id % 97 <> 5 THEN TIMESTAMP_NTZ'2024-01-01 00:00:00' + INTERVAL 14 MINUTE * id END AS event_date",
    ).withColumn("day", F.to_date("event_date"))
    path = str(tmp_path / "swipes")
    rows.repartition("day").write.partitionBy("day").parquet(path)
    return spark.read.parquet(path)


def test_gapfill_reads_the_days_of_its_batch_only(spark, swipes):
    clubs = spark.createDataFrame([(i, f"C{i}") for i in range(7)], "id long, name string")
    above = 2750  # on the 27th
    since = visits.first_day_above(swipes, above)
    assert since == dt.date(2024, 1, 27)
    bounded = visits.swipe_gapfill(swipes, clubs, above, reopen=True, since=since, day="day")
    whole = visits.swipe_gapfill(swipes, clubs, above, reopen=True)
    # four days and the scans without a time
    assert {s["numFiles"] for s in scans(bounded)} <= {0, 5} and max(s["numFiles"] for s in scans(whole)) == 31
    assert sorted(map(str, bounded.collect())) == sorted(map(str, whole.collect()))


def test_gapfill_with_a_bound_keeps_scans_without_a_time(spark):
    rows = [(1, 1, 5, None), (2, 1, None, None), (3, 1, 6, dt.datetime(2024, 1, 3))]
    df = spark.createDataFrame(rows, "id long, user_id long, club_id long, event_date timestamp_ntz").selectExpr("*", "'qr_check' event_type", "'ok' sys_response", "true is_success")
    clubs = spark.createDataFrame([(5, "C"), (6, "D")], "id long, name string")
    for above in (0, 1, 2):
        since = visits.first_day_above(df, above)
        got = visits.swipe_gapfill(df, clubs, above, since=since).collect()
        assert sorted(map(str, got)) == sorted(map(str, visits.swipe_gapfill(df, clubs, above).collect()))


def test_receipt_index_holds_all_counts_and_opens_wanted_ranges_only(spark, tmp_path):
    path = str(tmp_path / "receipts")
    rows = spark.range(900).selectExpr(
        "concat('r_', CASE WHEN id % 50 = 7 THEN 'x' ELSE string(id % 300) END) AS number",
        "CASE id % 3 WHEN 0 THEN 'Commit' WHEN 1 THEN 'Waiting commit' ELSE 'Failed' END AS fiscal_status", "id",
    )
    for lo, hi in ((0, 500), (500, 500), (500, 620), (620, 900)):
        receipts.add_receipts(spark, path, rows.where(F.col("id").between(lo, hi - 1)), width=10)
    every = spark.range(-5, 400).select("id")
    want = money.receipt_counts(rows).where("id_transaction IS NOT NULL")
    got = receipts.receipts_of(spark, path, every, width=10)
    assert sorted(map(tuple, got.select(*want.columns).collect())) == sorted(map(tuple, want.collect()))
    few = spark.createDataFrame([(17,), (18,), (None,), (251,)], "t long")
    part = receipts.receipts_of(spark, path, few, width=10)
    assert {r["id_transaction"] // 10 for r in part.collect()} == {1, 25}
    assert [s["numFiles"] for s in scans(part)] == [2] and scans(got)[0]["numFiles"] >= 30


def test_payments_of_the_campaign_are_read_in_one_pass(spark):
    t = Tables(spark, FOLDER)
    payments = campaign.campaign_payments(t.transactions)
    roles = {r: payments.where(r).count() for r in ("is_campaign", "is_main", "is_refund")}
    assert all(roles.values()) and payments.count() < sum(roles.values())
    assert payments.count() == t.transactions.where("provider_id IN (1, 2, 6, 9, 10, 17, 20, 21, 26, 27) OR type = 'refund'").count()


def test_campaign_mart_compares_something_in_every_column(spark):
    df = QUERIES["mart_campaign_purchases"](spark, "/root/testdata/sf0.01")
    got = df.agg(*[F.count_distinct(c).alias(c) for c in df.columns], F.count("return_transaction").alias("refunds")).first().asDict()
    one_value = {c for c, n in got.items() if n < 2} - {"type"}  # all are payments
    assert one_value == set() and got["refunds"] > 3
