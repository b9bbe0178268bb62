"""Plans behind the rewatch marts: shuffles of progress rows and sessions, and what is read of payments and app events."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from clubflow.plans import campaign, mobile
from clubflow.sources import load, watching

_PROGRESS = (
    "id long, video_id long, user_id long, duration int, is_completed int, stars int, difficulty int, comment string, "
    "updated_at timestamp_ntz, version long"
)
_BASE = dt.datetime(2024, 1, 1)


@pytest.fixture
def no_broadcast(spark):
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


def _progress(spark, *rows):
    """Rows (id, user, hours after the base)."""
    return spark.createDataFrame([(n, 1, user, n, 0, 0, 0, "c", _BASE + dt.timedelta(hours=h), n) for n, user, h in rows], _PROGRESS)


def _shuffles(df) -> int:
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")


def test_one_shuffle_for_versions_windows_and_sessions(spark):
    assert _shuffles(campaign.watch_sessions(_progress(spark, (1, 1, 0), (2, 1, 1)))) == 1


def test_appends_mark_the_last_session_and_readers_shuffle_once(spark, tmp_path):
    path = str(tmp_path / "sessions")
    first = _progress(spark, (1, 1, 0), (2, 1, 10), (3, 2, 0), (4, 3, 0))
    # user 1 goes on with the last session, user 2 opens one, user 3 gets nothing, user 4 is new
    second = _progress(spark, (5, 1, 11), (6, 1, 20), (7, 2, 30), (8, 4, 0))
    third = _progress(spark, (9, 1, 5), (10, 2, 31))  # user 1 is late
    rows = [first, first.union(second), first.union(second).union(third)]
    late = [watching.add_progress(spark, path, new, so_far, shift=0) for new, so_far in zip((first, second, third), rows, strict=True)]
    assert late == [0, 0, 1]
    marked = load.read_target(spark, path).where("is_last").select("batch", "user_id", "session_number", "base")
    assert sorted(map(tuple, marked.collect())) == [
        (1, 1, 2, 1), (1, 2, 1, 1), (1, 3, 1, 1), (2, 1, 3, 1), (2, 2, 2, 1), (2, 4, 1, 2), (3, 1, 4, 3), (3, 2, 2, 1),
    ]
    read = watching.read_sessions(spark, path)
    want = campaign.session_spans(rows[2], shift=0)
    assert sorted(map(str, read.select(*want.columns).collect())) == sorted(map(str, want.collect()))
    assert set(read.columns) == set(want.columns)
    assert _shuffles(campaign.kept_sessions(read)) == 1


def test_payments_of_campaign_plans_are_not_sorted_or_multiplied(spark, no_broadcast):
    at = "TIMESTAMP_NTZ'2024-06-01 00:00:00'"
    tx = spark.createDataFrame(
        [(1, 10, 6), (2, 10, 3), (3, 11, 6), (4, None, 6), (5, 12, 1), (6, 12, 1)], "id long, user_payment_plan_id long, provider_id int"
    ).selectExpr(
        "*", "id * 2 user_id", "CAST(NULL AS BIGINT) payment_transaction_id", "'payment' type", "1.0D total_amount", "1L discount_id", "1L gate_id",
        f"{at} created_at", f"{at} updated_at",
    )
    plans = spark.createDataFrame([(10, 205), (10, 206), (11, 5), (12, 208)], "id long, payment_plan_id long")
    paid = campaign.campaign_plan_payments(campaign.campaign_payments(tx), plans)
    assert sorted(r.transaction_id for r in paid.collect()) == [1, 5, 6]
    plan = paid._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and "Sort [" not in plan


def test_only_events_of_clicked_devices_are_parsed(spark):
    posts = spark.createDataFrame(
        [(dt.date(2024, 1, 1), "u&tracker_device_id=d1&b=2", "action_from_main_banner_aos"), (dt.date(2024, 1, 2), "u", "other")],
        "ClickDate date, PostbackUrlParameters string, TrackerName string",
    )
    events = spark.createDataFrame([("d1", 1), ("d1", 2), ("d2", 3), (None, 4)], "DeviceID string, n long")
    clicks = mobile.tracker_clicks(posts)
    assert [tuple(r) for r in clicks.collect()] == [(dt.date(2024, 1, 1), "d1")]
    kept = mobile.clicked_events(events, clicks.union(clicks))
    assert sorted(r.n for r in kept.collect()) == [1, 2]
    devices = kept.select(F.col("DeviceID").alias("device_id"), (F.col("n") * 0 + 7).alias("user_id"))
    assert [tuple(r) for r in mobile.users_of_clicks(clicks, devices).collect()] == [(dt.date(2024, 1, 1), "d1", 7)]
