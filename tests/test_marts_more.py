"""More marts on hand-made rows: ledger, visit history, mobile, watch sessions, trainer pay, flow marketing."""

import datetime as dt

import pytest

from clubflow import config as c
from clubflow.catalog.standins import KEY_SETS
from clubflow.operators.skew import measure
from clubflow.plans import campaign, mobile, money, trainers, visits


def T(text):
    return dt.datetime.fromisoformat(text)


def D(text):
    return dt.date.fromisoformat(text)


def rows(df, *names):
    return sorted((tuple(r[n] for n in names) for r in df.collect()), key=repr)


def test_accounting_ledger(spark):
    accounting = spark.createDataFrame(
        [(1, 1, 6, 1, 0, False), (2, 1, 4, 5, None, False), (3, 9, 8, 6, 6, False), (4, 1, 8, 6, 6, True), (5, 1, 1, 0, 1, False)],
        "transaction_id long, user_id long, provider_id int, payment_plan_tax int, product_tax int, is_deleted boolean",
    ).selectExpr(
        "*", "1 product_quantity", "'t' type", "'p' payment_plan_name", "'n' product_name", "1D join_fee", "1D join_fee_net", "1D membership_fee",
        "1D membership_fee_net", "1D product_price", "1D product_total_amount", "1D product_total_amount_net", "0D deposit_amount",
        "TIMESTAMP_NTZ'2024-01-01 20:00:00' created_at",
    )
    tx = spark.createDataFrame([(1, 10, 0, 7), (2, 20, 1, 7), (3, 30, 77, None), (5, 50, 0, 7)], "id long, receipt_id long, parent_id long, club_legal_info_id long")
    receipts = spark.createDataFrame(
        [("r_1", "Commit"), ("r_1_x", "Commit"), ("r_3", "Waiting commit"), ("r", "Commit"), ("r_3x", "Commit"), ("r_2", "Failed")],
        "number string, fiscal_status string",
    )
    users = spark.createDataFrame([(1, "A", "B")], "id long, name string, last_name string")
    legal = spark.createDataFrame([(7, 3)], "id long, club_id long")
    clubs = spark.createDataFrame([(3, "C")], "id long, name string")
    build = lambda above: money.accounting_ledger(accounting, tx, money.receipt_counts(receipts), users, legal, clubs, above)
    out = build(0)
    assert rows(out, "transaction_id", "operation_name", "vat", "vat_num", "name", "club_name", "receipt", "cnt_receips", "fiscal_status") == [
        (1, "Регистрация подписки", "ставка НДС 20%", "0", "A B", "C", 10, 2, "Commit"),
        (2, None, None, None, "A B", "C", 20, 1, "Commit"),  # through its parent, counted once
        (3, "Возврат подписки", "НДС не облагается", "НДС не облагается", None, None, 30, 1, "Waiting commit"),
        (5, "Рекуррентная оплата подписки", "0", "ставка НДС 20%", "A B", "C", 50, None, None),
    ]
    assert out.first()["date"] == T("2024-01-02 02:00:00")
    assert rows(build(3), "transaction_id") == [(5,)]


def test_visit_history(spark):
    swipes = spark.createDataFrame([(1, 1, 5, T("2024-01-01 10:00:00"), "club_in"), (2, 9, 6, T("2024-01-01 11:00:00"), "club_out")],
        "id long, user_id long, club_id long, club_event_date timestamp_ntz, event_type string")
    users = spark.createDataFrame([(1, "N", None, "e", None, D("2079-06-07"))], "id long, name string, last_name string, email string, sex string, birthday date")
    clubs = spark.createDataFrame([(5, "C")], "id long, name string")
    out = visits.visit_history(swipes, users, clubs, above=0)
    assert rows(out, "id", "user_name", "last_name", "sex", "birthday", "club_name") == [
        (1, "N", "", "", D("1970-01-01") - dt.timedelta(days=65_536 - (D("2079-06-07") - D("1970-01-01")).days), "C"),
        (2, None, "", "", None, None),
    ]
    assert rows(visits.visit_history(swipes, users, clubs, above=1), "id") == [(2,)]


def test_mobile_events_and_stories(spark):
    event = lambda dev, day, name, params: (dev, D(day), T(day + " 10:00:00"), D(day), "os", name, params)
    events = spark.createDataFrame(
        [
            event("d1", "2024-01-02", "stories_open", '{"user_id": 5, "slide_id": "7", "story_id": 3}'),
            event("d1", "2024-01-03", "screen", "{}"),  # gets the device's user
            event("d2", "2024-01-03", "stories_open", "broken"),
            event("d1", "2024-01-09", "screen", '{"user_id": 6}'),  # outside the range: not seen
        ],
        "DeviceID string, EventDate date, EventDateTime timestamp_ntz, ReceiveDate date, OSName string, EventName string, EventParameters string",
    )
    users = spark.createDataFrame([(5, 1)], "id long, home_club_id long").selectExpr(
        "*", "'m' sex", "'n' name", "'l' last_name", "'p' phone", "'e' email", "DATE'2000-01-01' birthday", "'s' sport_experience")
    clubs = spark.createDataFrame([(1, "C")], "id long, name string")
    plans = spark.createDataFrame(
        [
            (1, 5, 3, "Ended", T("2023-01-01 00:00:00"), T("2023-02-01 00:00:00"), None),
            (2, 5, 3, "Current", T("2023-03-01 00:00:00"), None, None),
            (3, 5, 4, "Current", T("2022-03-01 00:00:00"), None, None),  # not a main plan
            (4, 5, 3, "Created", T("2021-03-01 00:00:00"), None, None),
        ],
        "id long, user_id long, payment_plan_id long, status string, signed_date timestamp_ntz, end_date timestamp_ntz, cancel_reason string",
    )
    main = spark.createDataFrame([(3,)], "id long")
    names = spark.createDataFrame([(3, "main"), (4, "other")], "id long, name string")
    out = mobile.mobile_events(events, users, clubs, plans, main, names, D("2024-01-01"), D("2024-01-05"), T("2024-01-05 00:00:00"))
    assert rows(out, "device_id", "event_name", "user_id", "club_name", "user_payment_plan_id", "payment_plan_name", "status", "start_date", "end_date") == [
        ("d1", "screen", 5, "C", 2, "main", "Current", D("2023-01-01"), D("2049-01-01")),
        ("d1", "stories_open", 5, "C", 2, "main", "Current", D("2023-01-01"), D("2049-01-01")),
        ("d2", "stories_open", 0, None, None, None, None, None, None),
    ]
    slides = spark.createDataFrame([(7, "head")], "id long, header string")
    stories = mobile.mobile_stories(out, slides, D("2024-01-01"), D("2024-01-05"), T("2024-01-05 00:00:00"))
    assert rows(stories, "device_id", "story_id", "slide_id", "header", "showtime") == [("d1", "3", "7", "head", ""), ("d2", "", "", None, "")]
    assert rows(mobile.device_users(out), "device_id", "user_id", "min_event_date", "max_event_date") == [("d1", 5, D("2024-01-02"), D("2024-01-03"))]


@pytest.mark.parametrize("limit", ["1", "1000000"])
def test_watch_sessions_and_rewatch(spark, limit):
    from clubflow.session import ROWS_PER_SEGMENT

    spark.conf.set(ROWS_PER_SEGMENT, limit)
    base = T("2024-01-01 00:00:00")
    data, n = [], 0

    def watch(user, video, *seconds):
        nonlocal n
        for s in seconds:
            n += 1
            data.append((n, video, user, 50 + n, 0, 0, 0, "c", base + dt.timedelta(seconds=s), base, n))

    watch(1, 1, 0, 100, 100)  # three rows, one pair in the same second
    watch(1, 1, 20_000, 20_100)  # two rows: dropped
    watch(1, 1, 40_000, 40_100, 40_200, 50_999)  # the next session, 10,799 s inside it
    watch(2, 1, 0, 10_800, 21_600)  # three sessions of one row
    data.append(data[0][:9] + (base, 99))  # a second version of the first row
    history = spark.createDataFrame(
        data,
        "id long, video_id long, user_id long, duration int, is_completed int, stars int, difficulty int, comment string, "
        "updated_at timestamp_ntz, version_updated_at timestamp_ntz, version long",
    )
    watched = out = campaign.watch_sessions(history, shift=0, large=measure(history, KEY_SETS["video_history"]))
    assert rows(out, "user_id", "video_id", "session_number", "id", "qty_rows", "duration_by_qty_rows", "stars") == [
        (1, 1, 1, 9, 3, 17 * 2 + 30, None),
        (1, 1, 2, 9, 4, 17 * 4 + 30, None),
    ]
    purchases = spark.createDataFrame(
        [
            (1, 10, "p", T("2024-01-01 08:00:00"), T("2024-01-31 00:00:00"), "new"),
            (1, 11, "q", T("2024-01-01 09:00:00"), None, "new"),
            (1, 12, "z", T("2024-01-02 09:00:00"), None, "new"),  # starts later
            (1, 99, "zz", T("2023-01-02 09:00:00"), None, "repeat"),
        ],
        "user_id long, user_payment_plan_id long, payment_plan string, signed_date timestamp_ntz, end_date timestamp_ntz, payment_type string",
    ).selectExpr("*", "'g' gate_name", "'i' if_employee", "'d' discount_name", "'m' discount_name_main", "'b' is_banner_user",
        "'s' current_status", "'t' is_trial_user", "'k' is_tracker_user")
    videos = spark.createDataFrame([(1, "title", "type", 1, 600)], "id long, title string, type string, is_free int, duration int")
    out = campaign.video_rewatch(watched, videos, purchases)
    assert rows(out, "session_number", "if_rewatch", "max_rewatch", "qty_rewatch_more_1", "user_payment_plan_id", "payment_plan", "start_date", "end_date") == [
        (1, 0, 1, None, 11, "q", D("2024-01-01"), D("2049-01-01")),
        (2, 1, 1, None, 11, "q", D("2024-01-01"), D("2049-01-01")),
    ]
    spark.conf.unset(ROWS_PER_SEGMENT)


def test_trainer_types(spark):
    users = spark.createDataFrame([(1, "+7901"), (2, "+7902"), (3, "+7903"), (4, None)], "id long, phone string")
    schema = "id long, phone string, name string, category string, club string"
    metro = spark.createDataFrame([(10, "7 9 01", "M1", "A", ""), (3, "7999", "M3", "", ""), (11, "", "no phone", "A", "")], schema)
    region = spark.createDataFrame([(20, "902", "R2", "B", ""), (None, "903", "no id", "B", ""), (3, "7998", "R3", "B", ""), (21, "7777", "R21", "B", "")], schema)
    assert rows(trainers.trainer_types(users, metro, region), "id", "phone", "name", "type") == [
        (1, "+7901", "M1", "A"),  # metro list by phone, spaces removed
        (10, "+7901", "M1", "A"),  # the same list entry under its own id
        (2, "+7902", "R2", "B"),  # region list by phone
        (21, "+7777", "R21", "B"),  # in no other table
        (3, "+7998", "R3", "B"),  # the metro entry of 3 has no type
    ]


def test_pay_rate(spark):
    star = c.STAR_CYCLE_TRAINER
    cases = [
        (40, 30, "hiit", "A", "mk_55"), (40, 55, "plain", "A", "mk_55"), (40, 30, "plain", "A", "mk_30"), (40, 90, "hiit", "A", "mk_90"),
        (41, 30, "Morning Yoga", "A", "yoga"), (41, 30, "x cycle sprint@", star, "cycle"), (41, 30, "x cycle sprint@", "A", "grit"),
        (41, 30, "GRIT", star, "grit"), (41, 30, "cycle", star, "cycle"), (41, 30, "cycle", "A", "30"), (41, 45, "x", None, "45"),
        (41, 55, "x", "A", "55"), (41, 60, "x", "A", None), (40, 45, "x", "A", "45"),
    ]
    names = ("mk_30", "mk_55", "mk_90", "yoga", "cycle", "grit", "30", "45", "55")
    df = spark.createDataFrame([x[:4] for x in cases], "cat int, minutes int, training string, kind string")
    df = df.selectExpr("*", *[f"'{n}' AS `{n}`" for n in names])
    from pyspark.sql import functions as F

    rate = trainers.pay_rate(F.col("cat"), F.col("minutes"), F.col("training"), F.col("kind"))
    assert [r["r"] for r in df.select(rate.alias("r")).collect()] == [x[4] for x in cases]


@pytest.mark.parametrize("seed", [1, 2])
def test_sessions_in_batches_equal_one_run(spark, tmp_path, seed):
    """Appends in order, late rows, versions in another batch, equal seconds: always the sessions of one run."""
    import random

    from clubflow.sources import watching

    rng = random.Random(seed)
    base = T("2024-01-01 00:00:00")
    data = []
    for n in range(400):
        at = base + dt.timedelta(seconds=rng.choice([0, 1, 1, 60, 4000, 11_000]) + 3000 * n)
        data.append((n, rng.randrange(3), rng.randrange(4), rng.randrange(300), n % 2, n % 4, n % 3, f"c{n % 5}", at, at, n))
    data += [(*d[:9], d[9] + dt.timedelta(hours=1), d[10] + 1000) for d in rng.sample(data, 40)]  # second versions
    schema = (
        "id long, video_id long, user_id long, duration int, is_completed int, stars int, difficulty int, comment string, "
        "updated_at timestamp_ntz, version_updated_at timestamp_ntz, version long"
    )
    everything = spark.createDataFrame(data, schema)
    # most rows arrive in order, some in any batch
    batch_of = [min(3, d[0] // 100) if rng.random() < 0.9 else rng.randrange(4) for d in data]
    path = str(tmp_path / "sessions")
    late = 0
    for b in range(4):
        new = spark.createDataFrame([d for d, k in zip(data, batch_of) if k == b], schema)
        so_far = spark.createDataFrame([d for d, k in zip(data, batch_of) if k <= b], schema)
        late += watching.add_progress(spark, path, new, so_far)
        got = watching.read_sessions(spark, path)
        want = campaign.session_spans(so_far)
        assert sorted(map(str, got.select(*want.columns).collect())) == sorted(map(str, want.collect()))
    assert late
    assert rows(campaign.kept_sessions(watching.read_sessions(spark, path)), "user_id", "video_id", "session_number", "id", "qty_rows") == rows(
        campaign.watch_sessions(everything), "user_id", "video_id", "session_number", "id", "qty_rows"
    )
