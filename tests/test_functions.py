"""Scalar semantics at their boundaries."""

import datetime as dt

from pyspark.sql import functions as F

from clubflow import config as c
from clubflow.functions import dates as d
from clubflow.functions import text as x
from clubflow.functions.numbers import exact_quantile, ratio, round_even
from clubflow.catalog import QUERIES
from clubflow.plans.mobile import event_user
from clubflow.plans.tree import rolling_year
from clubflow.plans.trainers import club_city, fold_city


def one(spark, **columns):
    row = spark.range(1).select(*[v.alias(k) for k, v in columns.items()]).first()
    return tuple(row)


def at(text):
    return d.ntz(dt.datetime.fromisoformat(text))


def test_boundaries_are_counted_not_elapsed_time(spark):
    late, early = at("2024-01-01 23:59:59"), at("2024-01-02 00:00:00")
    assert one(
        spark,
        day=d.days_between(late, early),
        minute=d.minutes_between(late, early),
        second=d.seconds_between(late, early),
        month=d.months_between(at("2024-01-31 00:00:00"), at("2024-02-01 00:00:00")),
        back=d.months_between(at("2024-02-01 00:00:00"), at("2023-12-31 00:00:00")),
    ) == (1, 1, 1, 1, -2)
    # fractions of a second do not make a second
    assert one(spark, s=d.seconds_between(at("2024-01-01 00:00:00.900000"), at("2024-01-01 00:00:01.100000"))) == (1,)


def test_birthday_wrap(spark):
    day = lambda n: F.date_from_unix_date(F.lit(n))
    kept, wrapped, none = one(
        spark,
        a=d.repair_birthday(day(39_968)),
        b=d.repair_birthday(day(39_969)),
        n=d.repair_birthday(F.lit(None).cast("date")),
    )
    assert kept == dt.date(1970, 1, 1) + dt.timedelta(days=39_968)
    assert wrapped == dt.date(1970, 1, 1) - dt.timedelta(days=65_536 - 39_969)
    assert none is None


def test_wall_clock_types_stay(spark):
    df = spark.range(1).select(d.hour_start(at("2024-01-01 10:59:59")).alias("h"), d.shift_hours(at("2024-01-01 22:00:00"), 3).alias("s"))
    assert [f.dataType.simpleString() for f in df.schema] == ["timestamp_ntz", "timestamp_ntz"]
    assert tuple(df.first()) == (dt.datetime(2024, 1, 1, 10), dt.datetime(2024, 1, 2, 1))


def test_days_in_month(spark):
    assert one(spark, a=d.days_in_month(F.lit(dt.date(2024, 2, 5))), b=d.days_in_month(F.lit(dt.date(2023, 12, 31)))) == (29, 31)


def test_numbers(spark):
    assert one(spark, a=ratio(F.lit(1), F.lit(0)), b=ratio(F.lit(1), F.lit(4)), e=round_even(F.lit(2.5)), o=round_even(F.lit(3.5))) == (None, 0.25, 2.0, 4.0)
    values = F.array(*[F.lit(v) for v in (4.0, 1.0, 3.0, 2.0)])
    empty = F.array().cast("array<double>")
    assert one(spark, h=exact_quantile(values, 0.5), q=exact_quantile(values, 0.75), n=exact_quantile(empty, 0.5)) == (3.0, 4.0, None)
    single = F.array(F.lit(7.0), F.lit(None))
    assert one(spark, q=exact_quantile(single, 0.75)) == (7.0,)


def test_split_number(spark):
    parts = [x.split_number(F.lit(v), "_", 2) for v in ("a_12", "a", "a_12x", "a_12_9", "_", None)]
    assert one(spark, **{f"p{i}": p for i, p in enumerate(parts)}) == (12, None, None, 12, None, None)


def test_phone_forms(spark):
    region = [x.phone_plus7(F.lit(v)) for v in ("+7900", "7900", "8900", " 7 9 00 ", "900++")]
    assert one(spark, **{f"p{i}": p for i, p in enumerate(region)}) == ("+7900", "+7900", "+78900", "+7 9 00", "+7900")
    metro = [x.phone_plus7(F.lit(v), True) for v in ("7 9 00", "8 9 00")]
    assert one(spark, **{f"p{i}": p for i, p in enumerate(metro)}) == ("+7900", "+78 9 00")


def test_event_user_from_json(spark):
    texts = ['{"user_id": 5}', '{"user_id": "6"}', '{"user": {"id": 7}, "user_id": 5}', '{"user": "{\\"id\\": \\"8\\"}"}', "{}", "{broken", None]
    out = [event_user(x.parsed_json(F.lit(v))) for v in texts]
    assert one(spark, **{f"u{i}": u for i, u in enumerate(out)}) == (5, 6, 7, 8, 0, 0, 0)


def test_json_fields_as_text(spark):
    parsed = x.parsed_json(F.lit('{"a": 3.5, "b": "t\\u00e9", "c": null, "d": {"e": [1]}, "f": true, "g": 7}'))
    out = {f"f{i}": x.field_text(parsed, p) for i, p in enumerate(("$.a", "$.b", "$.c", "$.d.e[0]", "$.f", "$.g", "$.none"))}
    assert one(spark, **out) == ("3.5", "té", "", "1", "true", "7", "")


def test_app_events_are_parsed_once(spark):
    for name in ("mart_mobile_events", "fn_json_path"):
        plan = QUERIES[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count(") AS _parsed#") == 1, name
    plan = QUERIES["mart_mobile_stories"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    # once for the user of every event, once for the fields of the stories kept
    assert plan.count(") AS _parsed#") == 2


def test_labels(spark):
    label = lambda v: x.first_label(F.lit(v), c.CAMPAIGN_RULES)
    assert one(spark, a=label("x MEGABD y"), b=label("plain"), n=label(None)) == ("MEGABD 12.2024", "plain", None)
    assert one(spark, a=x.code_label(F.lit(8), c.OPERATION_NAMES), b=x.code_label(F.lit(4), c.OPERATION_NAMES)) == ("Возврат подписки", None)
    assert one(spark, a=x.like_any(F.lit("Утро ЙОГА"), c.YOGA_PATTERNS), b=x.like_any(F.lit(None), c.YOGA_PATTERNS)) == (True, False)
    # this pattern ends in a literal sign
    assert one(spark, a=x.like_any(F.lit("Cycle Sprint"), c.SPRINT_PATTERNS), b=x.like_any(F.lit("my cycle sprint@"), c.SPRINT_PATTERNS)) == (False, True)


def test_city(spark):
    assert one(spark, a=club_city(F.lit("Gym Нижний-Новгород 2"), "Gym"), b=club_city(F.lit("Other Казань"), "Gym"), m=fold_city(F.lit("Химки")), k=fold_city(F.lit("Казань"))) == (
        "Нижний-Новгород", "", "Москва", "Казань",
    )


def test_rolling_year(spark):
    as_of = dt.date(2024, 5, 31)
    label = lambda y, m: rolling_year(F.lit(dt.date(y, m, 1)), as_of)
    assert one(spark, a=label(2024, 5), b=label(2023, 6), c_=label(2023, 5), d_=label(2022, 6), e=label(2016, 6), f=label(2016, 5), g=label(2024, 6)) == (
        "2024", "2024", "2023", "2023", "2017", "2018", "2018",
    )
