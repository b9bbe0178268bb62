"""Marts on hand-made rows with answers worked out by hand."""

import datetime as dt

import pytest

from clubflow.catalog.standins import KEY_SETS
from clubflow.operators.skew import measure
from clubflow.plans import anomalies, cohorts, mobile, money, tree, visits


def T(text):
    return dt.datetime.fromisoformat(text)


def D(text):
    return dt.date.fromisoformat(text)


@pytest.fixture(params=[False, True], ids=["plain", "split"])
def any_size(request, spark):
    """Run with and without splitting of keys."""
    from clubflow.session import ROWS_PER_SEGMENT

    if request.param:
        spark.conf.set(ROWS_PER_SEGMENT, "1")
    yield
    spark.conf.unset(ROWS_PER_SEGMENT)


def rows(df, *names):
    return sorted((tuple(r[n] for n in names) for r in df.collect()), key=repr)


def test_occupancy(spark, any_size):
    visits_ = spark.createDataFrame(
        [
            (1, 10, "A", "club_in", T("2024-01-01 10:50:00")),
            (1, 10, "A", "club_out", T("2024-01-01 12:10:00")),  # hours 10, 11, 12
            (1, 10, "A", "club_out", T("2024-01-01 12:10:00")),  # the same event twice
            (2, 10, "A", "club_in", T("2024-01-01 10:00:00")),
            (2, 10, "A", "club_in", T("2024-01-01 11:00:00")),  # first ends 10:59:59, second has no end: 11, 12, 13
            (3, 10, "A", "club_in", T("2024-01-01 10:10:00")),  # staff
            (4, 11, "B", "club_in", T("2024-01-01 10:10:00")),  # club closes at night
            (5, 10, "A", "club_in", T("2024-01-01 08:30:00")),  # starts before the range: 10 only
        ],
        "user_id long, club_id long, club_name string, event_type string, event_date timestamp_ntz",
    )
    users = spark.createDataFrame([(1, "male"), (2, None)], "id long, sex string")
    clubs = spark.createDataFrame([(10, '{"is_open_all_day":true}'), (11, '{"is_open_all_day":false}')], "id long, open_hours string")
    staff = spark.createDataFrame([(3, 0, 1), (1, 1, 1), (None, 0, 1)], "user_id long, is_deleted int, is_active int")
    out = visits.occupancy_hourly(visits_, users, clubs, staff, T("2024-01-01 10:00:00"), T("2024-01-01 13:00:00"), large=measure(visits_, KEY_SETS["visit_history"]))
    got = {(r["check_time"].hour, r["sex"]): r["people_in_club"] for r in out.collect()}
    assert got == {
        (10, "male"): 1, (10, "unknown"): 2, (10, "total"): 3,
        (11, "male"): 1, (11, "unknown"): 1, (11, "total"): 2,
        (12, "male"): 1, (12, "unknown"): 1, (12, "total"): 2,
    }


def test_in_out_visits(spark, any_size):
    events = spark.createDataFrame(
        [
            (1, 1, 5, "club_in", T("2024-01-01 23:30:00")),
            (2, 1, 5, "club_out", T("2024-01-02 00:10:00")),  # next day: both sides guessed
            (3, 1, 5, "club_in", T("2024-01-02 09:00:00")),
            (4, 1, 5, "club_out", T("2024-01-02 10:00:00")),  # a normal visit, seen twice
            (5, 1, 5, "club_out", T("2024-01-02 11:00:00")),  # no entry
            (6, 1, 5, "club_in", T("2024-01-02 12:00:00")),  # last event
            (7, 1, 5, "other", T("2024-01-02 12:30:00")),
            (8, 1, 5, "club_in", T("2024-01-03 12:30:00")),  # outside the range, inside the buffer
        ],
        "id long, user_id long, club_id long, event_type string, club_event_date timestamp_ntz",
    )
    users = spark.createDataFrame([(1, "N", None, "e", None, None)], "id long, name string, last_name string, email string, sex string, birthday date")
    clubs = spark.createDataFrame([(5, "C")], "id long, name string")
    raw = visits.in_out_raw(events, users, clubs, D("2024-01-01"), D("2024-01-02"), large=measure(events, KEY_SETS["visits_histories"]))
    out = visits.in_out_visits(raw)
    assert rows(out.visits, "id", "in_date", "out_date") == [
        (1, T("2024-01-01 23:30:00"), T("2024-01-02 01:00:00")),
        (2, T("2024-01-01 22:40:00"), T("2024-01-02 00:10:00")),
        (3, T("2024-01-02 09:00:00"), T("2024-01-02 10:00:00")),
        (4, T("2024-01-02 09:00:00"), T("2024-01-02 10:00:00")),
        (5, T("2024-01-02 09:30:00"), T("2024-01-02 11:00:00")),
        (6, T("2024-01-02 12:00:00"), T("2024-01-02 13:30:00")),
    ]
    assert visits.in_out_visits(raw, dedupe=True).visits.count() == 5
    assert rows(raw, "last_name", "sex")[0] == ("", "")


def test_swipe_gapfill(spark, any_size):
    swipes = spark.createDataFrame(
        [
            (1, 1, None, T("2024-01-01 10:00:00")),  # next
            (2, 1, 5, T("2024-01-01 10:01:00")),  # previous has none, next has none: first seen, itself
            (3, 1, None, T("2024-01-01 10:02:00")),  # previous
            (4, 1, 99, T("2024-01-01 10:03:00")),  # neighbours unknown: first of the day
            (5, 1, None, T("2024-01-01 10:04:00")),  # previous club does not exist: first of the day
            (6, 1, None, T("2024-01-02 10:00:00")),  # nothing that day
        ],
        "id long, user_id long, club_id long, event_date timestamp_ntz",
    ).selectExpr("*", "'qr_check' event_type", "'ok' sys_response", "true is_success")
    clubs = spark.createDataFrame([(5, "C")], "id long, name string")
    large = measure(swipes, KEY_SETS["swipes"])
    out = visits.swipe_gapfill(swipes, clubs, large=large)
    assert rows(out, "id", "club_id", "club_name") == [(1, 5, "C"), (2, 5, "C"), (3, 5, "C"), (4, 5, "C"), (5, 5, "C"), (6, None, None)]
    assert out.where("id = 1").first()["event_date"] == T("2024-01-01 13:00:00")
    assert rows(visits.swipe_gapfill(swipes, clubs, above=5, large=large), "id") == [(6,)]
    # a day cut by the watermark: swipe 3 still sees swipe 2
    assert rows(visits.swipe_gapfill(swipes, clubs, above=2, large=large), "id", "club_id") == [(3, 5), (4, 5), (5, 5), (6, None)]


def test_swipe_gapfill_in_batches(spark, any_size):
    data = [
        (1, 1, None, T("2024-01-01 10:00:00")), (2, 1, 5, T("2024-01-01 10:01:00")), (3, None, None, T("2024-01-01 10:02:00")),
        (4, None, 7, T("2024-01-01 10:03:00")), (5, 1, 7, T("2024-01-01 11:00:00")), (6, 1, None, T("2024-01-02 00:00:00")),
    ]
    swipes = spark.createDataFrame(data, "id long, user_id long, club_id long, event_date timestamp_ntz").selectExpr(
        "*", "'qr_check' event_type", "'ok' sys_response", "true is_success"
    )
    clubs = spark.createDataFrame([(5, "C"), (7, "D")], "id long, name string")
    whole = {r["id"]: r for r in visits.swipe_gapfill(swipes, clubs).collect()}
    for cuts in ((1, 6), (3, 6), (1, 2, 4, 5, 6)):
        table, above = {}, 0
        for upto in cuts:
            arrived = swipes.where(f"id <= {upto}")
            since = visits.first_day_above(arrived, above)
            large = measure(arrived, KEY_SETS["swipes"])
            filled = visits.swipe_gapfill(arrived, clubs, above, reopen=True, since=since, large=large)
            table |= {r["id"]: r for r in filled.collect()}
            above = upto
        assert table == whole


def test_class_attendance(spark, any_size):
    visits_ = spark.createDataFrame(
        [
            (1, 1, T("2024-01-05 10:00:00"), T("2024-01-05 12:00:00")),
            (2, 1, T("2024-01-05 10:00:00"), T("2024-01-05 12:00:00")),  # the same visit from its exit
            (3, 2, T("2024-01-05 10:00:00"), T("2024-01-05 12:00:00")),  # no live plan
            (4, 3, T("2024-01-05 10:00:00"), T("2024-01-05 12:00:00")),
        ],
        "id long, user_id long, in_date timestamp_ntz, out_date timestamp_ntz",
    )
    plans = spark.createDataFrame(
        [
            (1, 7, "Current", T("2024-01-01 00:00:00"), None),
            (2, 7, "Ended", T("2024-01-01 00:00:00"), None),
            (2, 111, "Current", T("2024-01-01 00:00:00"), None),
            (3, 7, "Ended", T("2024-01-01 00:00:00"), T("2024-01-05 04:00:00")),  # ends exactly at the entry
        ],
        "user_id long, payment_plan_id long, status string, signed_date timestamp_ntz, end_date timestamp_ntz",
    )
    slot = lambda i, u, a, b, s: (i, u, T(f"2024-01-05 {a}"), T(f"2024-01-05 {b}"), s)
    bookings = spark.createDataFrame(
        [
            slot(1, 1, "10:01:00", "12:01:00", "booked"),  # fits to the minute
            slot(2, 1, "10:00:59", "11:00:00", "booked"),  # starts too early
            slot(3, 1, "11:00:00", "12:01:01", "booked"),  # ends too late
            slot(4, 2, "10:30:00", "11:00:00", "booked"),
            slot(5, 3, "10:30:00", "11:00:00", "cancelled"),
            slot(6, 1, "10:30:00", "11:00:00", "waiting_list"),
            slot(7, 1, "10:30:00", "11:00:00", "wait_list"),
        ],
        "booking_id long, user_id long, start_time timestamp_ntz, end_time timestamp_ntz, booking_status string",
    )
    days = {"visits.user": ["user_id"], "visits.user_day": ["user_id", "to_date(in_date)"]}
    large = measure(visits_, days) | measure(plans, KEY_SETS["plans"]) | measure(bookings, KEY_SETS["bookings"])
    out = visits.class_attendance(visits_, plans, bookings, large=large)
    assert rows(out, "booking_id", "is_visit", "is_visit_no", "is_visit_waiting", "is_visit_cancel", "is_visit_yes", "is_visit_calc") == [
        (1, "Yes", 0, 0, 0, 1, "Yes"),
        (2, None, 1, 0, 0, 0, "No"),
        (3, None, 1, 0, 0, 0, "No"),
        (4, None, 1, 0, 0, 0, "No"),
        (5, "Yes", 0, 0, 1, 0, "cancelled"),
        (6, "Yes", 0, 0, 0, 0, "waiting_list"),
        (7, "Yes", 0, 1, 0, 0, "No"),
    ]


def test_left_completed(spark, any_size):
    history = spark.createDataFrame(
        [
            (1, "completed", T("2024-01-01 00:00:00"), 1), (1, "refunded", T("2024-01-01 00:00:00"), 2),  # same time, by version
            (2, "completed", T("2024-01-01 00:00:00"), 1), (2, "completed", T("2024-01-02 00:00:00"), 2),
            (3, "completed", T("2024-01-01 00:00:00"), 1), (3, "", T("2024-01-02 00:00:00"), 2),
            (4, "completed", T("2024-01-01 00:00:00"), 1),
        ],
        "id long, status string, version_updated_at timestamp_ntz, version long",
    )
    assert rows(money.left_completed(history, large=measure(history, KEY_SETS["transaction_history"])), "id", "ns") == [(1, "refunded")]
    assert rows(money.left_completed(history, above=1), "id") == []


def test_lifetime(spark, any_size):
    flow = lambda u, i, a, b, club: (u, i, club, f"C{club}", D(a), b and D(b))
    flows = spark.createDataFrame(
        [
            flow(1, 1, "2023-01-01", "2023-01-31", 1),  # gap 90: same life
            flow(1, 2, "2023-05-01", "2023-05-21", 2),  # 30 + 20 days; the last gap ends the life
            flow(2, 3, "2023-01-01", "2023-02-10", 1),  # gap 91: new life
            flow(2, 4, "2023-05-12", "2023-05-22", 1),  # (40 + 10) / 2
            flow(3, 5, "2023-05-01", "2023-05-31", 1),  # one membership
            flow(4, 6, "2023-05-01", None, 1),  # still running
            flow(5, 7, "2023-05-01", "2023-05-01", 1),  # zero days
        ],
        "user_id long, first_id long, inflow_club long, inflow_club_name string, start_date date, end_date date",
    )
    # 1: 50 days in two lives (a gap of 90 and the last gap) -> 25; 2: 50 days in two lives -> 25;
    # 3: 30 days -> 30. Club 1 is the main club of all three: the mean 26.67 rounds to 27.
    assert rows(tree.lifetime(flows, measure(flows, KEY_SETS["flows"])), "date", "club_id", "club_name", "alt") == [(D("2023-05-01"), 1, "C1", 27.0)]


def test_load_factor_and_ltv(spark):
    clubs = spark.createDataFrame(
        [(1, "A", D("2023-01-01"), 100.0, None), (2, "B", D("2023-01-01"), 0.0, 0.0), (3, "C", D("2030-01-01"), 50.0, None)],
        "id long, name string, open_date date, area_in_square_meters double, rounded_area double",
    )
    active = spark.createDataFrame(
        [(1, "A", D("2023-01-05"), D("2023-03-05"), 1, 1), (1, "A", D("2023-01-06"), None, 1, 0), (2, "B", D("2023-02-01"), None, 1, 0)],
        "club_id long, club_name string, start_date date, end_date date, is_inflow int, is_outflow int",
    )
    flows = spark.createDataFrame(
        [("A", 1, None, D("2023-01-05"), None, 1, 0), ("A", 1, "B", D("2023-02-05"), D("2023-03-01"), 1, 1)],
        "inflow_club_name string, inflow_club long, outflow_club_name string, start_date date, end_date date, is_inflow int, is_outflow int",
    )
    load = tree.load_factor(flows, active, clubs, D("2023-03-10"), D("2023-01-01"))
    got = {(r["date"].month, r["club_name"]): tuple(r)[3:] for r in load.collect()}
    assert set(got) == {(m, k) for m in (1, 2, 3) for k in "AB"}  # C opens later
    assert got[1, "A"] == (None, 1, 0, 2, 2, 100.0, 0.02)
    assert got[2, "A"] == (None, 1, None, None, None, None, None)  # no flow, no stock
    assert got[3, "A"] == (None, None, 1, 0, 1, 100.0, 0.01)
    assert got[2, "B"] == (None, None, 0, 1, 1, 0.0, None)  # no area
    assert got[3, "B"][:2] == (1, None)
    carried = tree.load_factor(flows, active, clubs, D("2023-03-10"), D("2023-01-01"), carry_forward=True)
    assert {(r["date"].month): r["active_subscribes"] for r in carried.where("club_name = 'A'").collect()} == {1: 2, 2: 2, 3: 1}
    assert tree.load_factor(flows, active, clubs, D("2023-03-10"), D("2023-01-01"), opened_only=False).count() == 9

    costs = spark.createDataFrame([(D("2023-01-01"), 1, -50.0, 8.0), (D("2023-03-01"), 1, -9.0, 5.0)], "date_month date, club_id long, acquisition_cost double, club_ebitda double")
    value = tree.ltv_cac(flows, active, clubs, costs, D("2022-12-01"), D("2023-03-10"))
    got = {(r["date"].month, r["club_name"]): (r["active_subscribes"], r["cac"], r["ltv"], r["ratio_ltv_cac"]) for r in value.collect()}
    assert set(got) == {(m, k) for m in (1, 2, 3) for k in "AB"}  # from the opening month on
    assert got[1, "A"] == (2, 50.0, 4.0, 0.08)
    assert got[2, "A"] == (0, None, None, None)
    assert got[3, "A"] == (1, None, 5.0, None)  # no inflow that month


def test_metrics_year_pairs(spark):
    clubs = spark.createDataFrame([(5, "A", "big", D("2023-01-15"), 10.0, None), (64, "B", "small", D("2021-01-01"), 10.0, None)],
        "id long, name string, club_type string, open_date date, area_in_square_meters double, rounded_area double")
    flows = spark.createDataFrame([], "user_id long, first_id long, inflow_club long, inflow_club_name string, outflow_club_name string, start_date date, end_date date, is_inflow int, is_outflow int")
    active = spark.createDataFrame([], "club_id long, club_name string, start_date date, end_date date, is_inflow int, is_outflow int")
    costs = spark.createDataFrame([], "date_month date, club_id long, acquisition_cost double, club_ebitda double")
    revenue = spark.createDataFrame([(D("2024-01-09"), "A", 5), (D("2024-01-10"), "A", 6)], "date date, club_name string, total_cost long")
    built = tree.metric_tree(flows, active, clubs, costs, revenue, D("2023-01-01"), D("2024-01-20"))
    assert built.year.where("month(date) = 1").count() == 8 and built.year.where("club_name <> club_name_2").count() == 0
    every = tree.metrics_year(built.month, clubs, D("2023-01-01"), D("2024-01-20"), same_club=False)
    january = every.where("month(date) = 1")
    assert january.count() == 4 * 4 and every.where("month(date) = 5").count() == 2 * 2
    mine = january.where("club_name = 'A' and date = DATE'2024-01-01'")
    assert mine.count() == 4
    one = mine.where("club_name_2 = 'B' and year_2 = '2023'").first()
    assert (one["revenue"], one["revenue_2"], one["tir"], one["tir_2"], one["age"], one["age_2"]) == (11, None, "1", "3", "молодые", "зрелые")


def _days(spark, counts, column, flag):
    start = D("2024-01-01")
    data = [(i, start + dt.timedelta(days=k)) for k, n in enumerate(counts) for i in range(n)]
    return spark.createDataFrame(data, f"user_id long, {column} date").selectExpr("*", f"1 {flag}")


def test_inflow_anomaly(spark):
    flags = anomalies.inflow_anomaly(_days(spark, [2, 2, 6, 6, 16], "start_date", "is_inflow"))
    # day 3: 6 > 2.5 * 2; day 4: 6 is neither above 1.8 * 4 nor 2.5 * 6; day 5: 16 > 1.8 * 6.4
    assert [r["is_anomaly"] for r in flags.orderBy("inflow_date").collect()] == [0, 0, 1, 0, 1]
    assert anomalies.anomaly_count(flags, "inflow_date", D("2024-01-05")).first()["cnt"] == 1
    assert anomalies.anomaly_count(flags, "inflow_date", D("2024-01-04")).first()["cnt"] == 0


def test_moving_rows_hold_180_days(spark):
    flags = anomalies.inflow_anomaly(_days(spark, [180] + [1] * 181, "start_date", "is_inflow"))
    means = [r["avg_6_months"] for r in flags.orderBy("inflow_date").collect()]
    assert means[0] == 180.0 and means[1] == 90.5
    assert means[179] == (180 + 179) / 180 and means[180] == 1.0


def test_outflow_anomaly(spark):
    month = spark.createDataFrame([(D("2024-01-01"), 31), (D("2024-02-01"), 0)], "date date, active_subscribers long")
    flags = anomalies.outflow_anomaly(_days(spark, [1] * 5 + [4, 4] + [1] * 25, "end_date", "is_outflow"), month)
    got = flags.orderBy("outflow_date").collect()
    # day 6: median 1, no spread yet; day 7: the upper quartile is now 4, so the bar is 1 + 1.5 * 3
    assert [r["is_anomaly"] for r in got[:8]] == [0, 0, 0, 0, 0, 1, 0, 0]
    assert got[0]["daily_churn_rate"] == 1.0
    assert got[31]["daily_churn_rate"] is None and got[31]["is_anomaly"] == 0  # a month without stock


def _history(spark, entries):
    """(id, status, hours, pay day or None, reason) -> status history."""
    base = T("2024-01-01 00:00:00")
    data = [
        (i, 3, 18, 11538, s, reason, pay and T(pay), base + dt.timedelta(hours=h), base + dt.timedelta(hours=h), n)
        for n, (i, s, h, pay, reason) in enumerate(entries)
    ]
    return spark.createDataFrame(
        data,
        "id long, club_id long, payment_plan_id long, discount_id long, status string, cancel_reason string, "
        "pay_date timestamp_ntz, updated_at timestamp_ntz, version_updated_at timestamp_ntz, version long",
    )


def test_debt_cohorts(spark, any_size):
    pay = "2024-01-01 00:00:00"
    history = _history(
        spark,
        [
            (1, "PaymentPending", 1, pay, None), (1, "Current", 12, pay, None),  # closed on day 1
            (2, "PaymentPending", 1, pay, None), (2, "Ended", 24 * 10 + 5, pay, "AutoCanceledByDebt"),  # closed on day 11
            (3, "PaymentPending", 1, pay, None),  # never closed
            (4, "PaymentPending", 0, pay, None), (4, "Refunded", 0, pay, None),  # closed in the same minute
            (5, "Current", 1, pay, None), (5, "Current", 2, pay, None), (5, "Current", 3, "2024-02-01 00:00:00", None),  # pays on
            (6, "PaymentPending", 1, pay, "ExcludeFromReport"),
        ],
    )
    detail = {r["id"]: (r["cohort_close_status"], r["end_type"]) for r in cohorts.debt_cohort_detail(history, large=measure(history, KEY_SETS["plan_history"])).collect()}
    # 5: one row whose next payment lies on another day, one last row with no next payment
    assert {k: v for k, v in detail.items() if k != 5} == {1: ("Current", None), 2: ("Ended", "auto"), 3: (None, None), 4: ("Ended", "self")}
    assert detail[5] == ("Continue", None)
    ladder = {r["id"]: r for r in cohorts.with_ladder(cohorts.cohorts(history, large=measure(history, KEY_SETS["plan_history"]))).where("id <> 5").collect()}
    states = {i: [r[f"status{k}"] for k in range(1, 12)] for i, r in ladder.items()}
    assert states[1] == ["Current"] + [None] * 10
    assert states[2] == ["Pending"] * 10 + ["Ended"]
    assert states[3] == ["Pending"] * 11
    assert states[4] == ["Ended"] + [None] * 10
    assert [ladder[2][f"open{k}"] for k in range(1, 12)] == [True] * 11
    assert [ladder[1][f"open{k}"] for k in range(1, 12)] == [True] + [False] * 10
    assert {i: r["cohort_period_days"] for i, r in ladder.items()} == {1: 1, 2: 11, 3: None, 4: 0}
    assert ladder[3]["cohort_final_status"] == "Pending"
    clubs = spark.createDataFrame([(3, "C")], "id long, name string")
    total = cohorts.debt_cohort_ladder(history, clubs).where("cohort = DATE'2024-01-01'").first()
    assert (total["day2"], total["current1"], total["ended1"], total["ended11"], total["pending11"], total["auto"], total["self"]) == (2, 1, 1, 1, 1, 1, 1)


def test_sales_classes(spark, any_size):
    plan = lambda i, u, signed, end, status="Current", reason=None, plan_id=3: (
        i, u, plan_id, 1, status, T(signed), T(signed), end and T(end), reason, None, None, None)
    plans = spark.createDataFrame(
        [
            plan(1, 1, "2022-01-01 00:00:00", "2022-02-01 00:00:00"),  # first
            plan(2, 1, "2022-02-01 00:00:00", "2022-03-01 00:00:00"),  # the same day: renewed
            plan(3, 1, "2023-03-01 00:00:00", "2023-04-01 00:00:00"),  # 365 days later
            plan(4, 1, "2024-04-01 00:00:00", None),  # 366 days later (leap year)
            plan(5, 1, "2024-05-01 00:00:00", None, plan_id=4),  # not a main plan
            plan(6, 1, "2024-05-01 00:00:00", None, status="Deleted"),
            plan(7, 1, "2024-05-01 00:00:00", None, reason="ExcludeFromReport"),
        ],
        "id long, user_id long, payment_plan_id long, club_id long, status string, signed_date timestamp_ntz, start_date timestamp_ntz, "
        "end_date timestamp_ntz, cancel_reason string, discount_id long, discount_code_id long, card_token_id long",
    )
    tx = spark.createDataFrame(
        [(2, 1, 6, 10.0, 3.0), (1, 1, 6, 7.0, 2.0), (3, 2, 5, 9.0, 9.0)],
        "id long, user_payment_plan_id long, provider_id int, total_amount double, membership_fee double",
    ).selectExpr("*", "1D join_fee", "TIMESTAMP_NTZ'2024-01-01' updated_at", "1L gate_id", "1L employee_id", "0D discount_amount", "1L discount_code_id", "1L discount_id")
    names = lambda *r: spark.createDataFrame(list(r), "id long, name string")
    users = names((1, "U")).selectExpr("*", "'l' last_name", "'p' phone", "'e' email", "DATE'2000-01-01' birthday", "'m' sex", "'s' sport_experience", "1L home_club_id")
    out = money.subscription_sales(
        plans,
        spark.createDataFrame([(3,)], "id long"),
        names((3, "main"), (4, "other")),
        tx,
        spark.createDataFrame([(1, 1, 1)], "first_id long, is_new int, is_inflow int"),
        users,
        spark.createDataFrame([(1, 1)], "id long, user_id long"),
        names((1, "d")),
        spark.createDataFrame([(1, "code")], "id long, code string"),
        names((1, "gate")),
        names((1, "club")).selectExpr("*", "1L city_id"),
        names((1, "city")),
        T("2024-06-01 00:00:00"),
        large=measure(plans, KEY_SETS["plans"]),
    )
    assert rows(out, "sub_id", "subscription_type", "is_new", "is_resubbed", "prev_sub_id", "total_amount", "is_inflow") == [
        (1, "main", "НЧК", 0, None, 9.0, 1),  # first payment is the lowest id, legacy fee added
        (2, "main", "БЧК < 1 года", 1, 1, None, None),
        (3, "main", "БЧК < 1 года", 0, 2, None, None),
        (4, "main", "БЧК > 1 года", 0, 3, None, None),
        (5, "sub", "-", 0, None, None, None),
    ]


def test_revenue_club_rules(spark):
    plans = spark.createDataFrame(
        [(1, 1, 7, 10, T("2024-01-01 00:00:00"), T("2024-12-01 00:00:00")), (2, 1, 111, 10, T("2024-01-01 00:00:00"), None)],
        "id long, user_id long, payment_plan_id long, club_id long, start_date timestamp_ntz, end_date timestamp_ntz",
    )
    moves = spark.createDataFrame(
        [(1, 1, 20, T("2024-03-01 00:00:00")), (1, 1, 30, T("2024-02-01 00:00:00")), (1, 1, 40, T("2023-02-01 00:00:00"))],
        "user_payment_plan_id long, user_id long, old_club_id long, created_at timestamp_ntz",
    )
    tx = spark.createDataFrame(
        [
            (1, 1, 1, 100.0, None, T("2024-01-31 23:59:59")),  # first move wins: club 30
            (1, 1, 8, 40.0, None, T("2024-01-02 00:00:00")),  # refund
            (1, 1, 1, 5.0, 9, T("2024-01-02 00:00:00")),  # legal entity's club
            (1, 2, 1, 7.0, None, T("2024-01-02 00:00:00")),  # excluded plan
            (1, None, 1, 7.0, None, T("2024-01-02 00:00:00")),  # neither plan nor legal entity
            (1, None, 1, 8.0, 9, T("2024-01-02 00:00:00")),
            (1, 1, 3, 7.0, None, T("2024-01-02 00:00:00")),  # counts as zero
            (1, 1, 1, 7.0, None, T("2024-02-01 00:00:00")),  # next month
        ],
        "user_id long, user_payment_plan_id long, provider_id int, total_amount double, club_legal_info_id long, updated_at timestamp_ntz",
    )
    legal = spark.createDataFrame([(9, 50)], "id long, club_id long")
    clubs = spark.createDataFrame([(30, "C30", 1, "t", D("2020-01-01"))], "id long, name string, city_id long, club_type string, open_date date")
    names = spark.createDataFrame([(7, "plan")], "id long, name string")
    out = money.revenue_monthly(tx, plans, moves, legal, clubs, names, D("2024-01-01"), D("2024-01-31"))
    assert rows(out, "date", "payment_plan_id", "club_id", "club_name", "total_cost") == [
        (D("2024-01-01"), 0, 50, None, 8.0),
        (D("2024-01-01"), 7, 30, "C30", 60.0),
        (D("2024-01-01"), 7, 50, None, 5.0),
    ]


def test_tracker_users(spark):
    posts = spark.createDataFrame(
        [
            (D("2024-01-01"), "a=1&tracker_device_id=d1&b=2", "action_from_action__aos"),
            (D("2024-01-02"), "a=1&tracker_device_id=d1", "action_from_action__aos"),  # not closed by &
            (D("2024-01-03"), "tracker_device_id=&", "action_from_action__aos"),
            (D("2024-01-04"), "tracker_device_id=d1&", "unknown"),
            (D("2024-01-05"), "tracker_device_id=d2&", "action_from_action__aos"),  # device without a user
        ],
        "ClickDate date, PostbackUrlParameters string, TrackerName string",
    )
    devices = spark.createDataFrame([("d1", 7), ("d1", 7), ("d2", 0)], "device_id string, user_id long")
    assert rows(mobile.tracker_users(posts, devices), "click_date", "device_id", "user_id") == [(D("2024-01-01"), "d1", 7)]
