"""Visit marts: occupancy, visit history, in/out visits, swipe gap-fill, attendance."""

from __future__ import annotations

import datetime as dt
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clubflow import config as c
from clubflow.functions.dates import days_between, ntz, repair_birthday, shift_hours
from clubflow.operators.flows import explode_hours
from clubflow.operators.intervals import inside_any
from clubflow.operators.ordered import in_order, neighbours, neighbours_step, running, running_step
from clubflow.operators.skew import NO_STATISTICS, KeyStatistics


def occupancy_hourly(
    visits: DataFrame,
    users: DataFrame,
    clubs: DataFrame,
    employees: DataFrame,
    date_from: dt.datetime,
    date_to: dt.datetime,
    buffer_hours: int = c.OCCUPANCY_BUFFER_HOURS,
    large: KeyStatistics = NO_STATISTICS,
) -> DataFrame:
    """People per round-the-clock club, hour and sex, with a 'total' row per hour.

    A session runs from an entry to the next event of the user in the club: an
    exit closes it, another entry closes it one second earlier, no event after
    two hours. Events ``buffer_hours`` around the range are read so sessions
    that cross its edges count. Large keys: ``visits.user_club``.
    """
    pad = dt.timedelta(hours=buffer_hours)
    staff = employees.where((F.col("is_deleted") == 0) & (F.col("is_active") == 1)).select("user_id")
    round_clock = clubs.where(
        F.get_json_object("open_hours", "$.is_open_all_day") == "true"
    ).select(F.col("id").alias("club_id"))
    ranged = visits.where(
        F.col("event_type").isin(c.EVENT_IN, c.EVENT_OUT)
        & (F.col("event_date") >= ntz(date_from - pad))
        & (F.col("event_date") < ntz(date_to + pad))
    )
    keys = ["user_id", "club_id"]
    hot = large.of("visits.user_club")
    kept = (
        ranged.join(staff, "user_id", "left_anti")
        .join(round_clock, "club_id", "left_semi")
        .select("user_id", "club_id", "club_name", "event_type", "event_date")
    )
    # without large keys one shuffle serves both the distinct and the window below
    events = (kept.repartition(*keys) if hot is None else kept).distinct()
    spans = (
        neighbours(
            events,
            keys,
            ["event_date", "event_type"],
            lead={"next_type": "event_type", "next_time": "event_date"},
            hot=hot,
        )
        .where(F.col("event_type") == c.EVENT_IN)
        .withColumn(
            "end_time",
            F.when(F.col("next_type") == c.EVENT_OUT, F.col("next_time"))
            .when(F.col("next_type") == c.EVENT_IN, F.col("next_time") - F.expr("INTERVAL 1 SECOND"))
            .otherwise(F.col("event_date") + F.expr("INTERVAL 2 HOURS")),
        )
    )
    hours = explode_hours(spans, "event_date", "end_time", "check_time").where(
        (F.col("check_time") >= ntz(date_from)) & (F.col("check_time") < ntz(date_to))
    )
    # one row per person and hour before the users table is touched
    people = hours.select("club_id", "club_name", "check_time", "user_id").distinct()
    sex = users.select(F.col("id").alias("user_id"), "sex")
    by_sex = (
        people.join(sex, "user_id", "left")
        .groupBy("club_id", "club_name", "check_time", F.coalesce("sex", F.lit("unknown")).alias("sex"))
        .agg(F.count(F.lit(1)).alias("people_in_club"))
    )
    # every row counts for its sex and for the total: one pass over the grouped rows
    return (
        by_sex.withColumn("sex", F.explode(F.array("sex", F.lit("total"))))
        .groupBy("check_time", "club_id", "club_name", "sex")
        .agg(F.sum("people_in_club").alias("people_in_club"))
    )


def visit_history(
    swipes: DataFrame, users: DataFrame, clubs: DataFrame, above: int = 0, tz_hours: int = 0
) -> DataFrame:
    """Swipes above a watermark with user and club attributes."""
    who = users.select(
        F.col("id").alias("user_id"),
        F.col("name").alias("user_name"),
        "last_name",
        "email",
        "sex",
        "birthday",
    )
    where = clubs.select(F.col("id").alias("club_id"), F.col("name").alias("club_name"))
    return (
        swipes.where(F.col("id") > above)
        .join(who, "user_id", "left")
        .join(where, "club_id", "left")
        .select(
            "id",
            "user_id",
            "user_name",
            F.coalesce("last_name", F.lit("")).alias("last_name"),
            "email",
            F.coalesce("sex", F.lit("")).alias("sex"),
            repair_birthday(F.col("birthday")).alias("birthday"),
            "club_id",
            "club_name",
            shift_hours(F.col("club_event_date"), tz_hours).alias("event_date"),
            "event_type",
        )
    )


class InOutVisits(NamedTuple):
    raw: DataFrame
    entries: DataFrame
    exits: DataFrame
    visits: DataFrame


def in_out_raw(
    events: DataFrame,
    users: DataFrame,
    clubs: DataFrame,
    day_from: dt.date,
    day_to: dt.date,
    buffer_days: int = 1,
    large: KeyStatistics = NO_STATISTICS,
) -> DataFrame:
    """Entry and exit events of a day range with the user's previous and next event.

    ``buffer_days`` more days are read on both sides, so rows at the edges keep
    their neighbours; only the range itself is returned. Large keys: ``visits.user``.
    """
    pad = dt.timedelta(days=buffer_days)
    day = F.to_date("club_event_date")
    kept = events.where(
        F.col("event_type").isin(c.EVENT_IN, c.EVENT_OUT)
        & day.between(F.lit(day_from - pad), F.lit(day_to + pad))
    ).select("id", "user_id", "club_id", "event_type", F.col("club_event_date").alias("event_date"))
    hot = large.of("visits.user")
    paired = neighbours(
        kept,
        ["user_id"],
        ["event_date", "id"],
        lag={"prev_event_date": "event_date", "prev_event": "event_type"},
        lead={"next_event_date": "event_date", "next_event": "event_type"},
        hot=hot,
    ).where(F.to_date("event_date").between(F.lit(day_from), F.lit(day_to)))
    who = users.select(
        F.col("id").alias("user_id"),
        F.col("name").alias("user_name"),
        F.coalesce("last_name", F.lit("")).alias("last_name"),
        "email",
        F.coalesce("sex", F.lit("")).alias("sex"),
        repair_birthday(F.col("birthday")).alias("birthday"),
    )
    where = clubs.select(F.col("id").alias("club_id"), F.col("name").alias("club_name"))
    return (
        paired.join(who, "user_id", "left")
        .join(where, "club_id", "left")
        .select(
            "id", "user_id", "user_name", "last_name", "email", "sex", "birthday",
            "club_id", "club_name", "event_date", "event_type",
            "next_event_date", "prev_event_date", "next_event", "prev_event",
        )
    )


def in_out_visits(raw: DataFrame, dedupe: bool = False) -> InOutVisits:
    """Visits seen from entries and from exits, and both together.

    An entry whose next event is missing, a day or more away or another entry
    is closed after 90 minutes; an exit without a usable entry starts 90
    minutes before. A normal visit appears once per side; ``dedupe`` keeps one.
    """
    person = ["id", "user_id", "user_name", "last_name", "email", "sex", "birthday", "club_id", "club_name"]
    span = F.expr(f"INTERVAL {c.VISIT_MINUTES} MINUTE")

    def guessed(other: str, kind: str, gap):
        return F.col(f"{other}_event_date").isNull() | (gap >= 1) | (F.col(f"{other}_event") == kind)

    to_next = days_between(F.col("event_date"), F.col("next_event_date"))
    from_prev = days_between(F.col("prev_event_date"), F.col("event_date"))
    entry = F.col("event_type") == c.EVENT_IN
    # a row is an entry or an exit, so one projection serves both sides
    both = raw.where(F.col("event_type").isin(c.EVENT_IN, c.EVENT_OUT)).select(
        *person,
        F.when(entry, F.col("event_date"))
        .when(guessed("prev", c.EVENT_OUT, from_prev), F.col("event_date") - span)
        .otherwise(F.col("prev_event_date"))
        .alias("in_date"),
        "event_type",
        F.when(~entry, F.col("event_date"))
        .when(guessed("next", c.EVENT_IN, to_next), F.col("event_date") + span)
        .otherwise(F.col("next_event_date"))
        .alias("out_date"),
    )
    entries, exits = both.where(entry), both.where(~entry)
    if dedupe:
        both = both.dropDuplicates(["user_id", "in_date", "out_date"])
    return InOutVisits(raw, entries, exits, both)


def first_day_above(swipes: DataFrame, above: int) -> dt.date | None:
    """The earliest day of the scans above a watermark; reads two columns of the files with such ids."""
    fresh = swipes.where((F.col("id") > above) & (F.col("event_type") == "qr_check"))
    return fresh.agg(F.to_date(F.min("event_date"))).first()[0]


def swipe_gapfill(
    swipes: DataFrame,
    clubs: DataFrame,
    above: int = 0,
    tz_hours: int = 3,
    reopen: bool = False,
    since: dt.date | None = None,
    day: str | None = None,
    large: KeyStatistics = NO_STATISTICS,
) -> DataFrame:
    """Entry scans above a watermark with a club taken from the previous, else next, else first swipe of the day.

    Older swipes of a user's day that got new ones are read along, so the first new swipe knows the one before it.
    ``reopen`` returns them again: a new swipe can give its club to the one before, so a load that keeps the latest
    version of an id ends with the same rows however it was cut into batches. ``since`` is the earliest day of the
    swipes above the watermark (``first_day_above``): nothing older is read. ``day`` names a column with the day of a
    swipe, if the table is partitioned by one, so that older files are not opened. Large keys: ``swipes.user_day``.
    """
    if since is not None:  # literals, which reach the scan; swipes without a time stay with the user's others
        swipes = swipes.where((F.col("event_date") >= ntz(dt.datetime.combine(since, dt.time()))) | F.col("event_date").isNull())
        if day is not None:
            swipes = swipes.where((F.col(day) >= F.lit(since)) | F.col(day).isNull())
    checks = (
        swipes.where(F.col("event_type") == "qr_check")
        .select("id", "event_date", "event_type", "sys_response", "club_id", "user_id", "is_success")
        .withColumn("_day", F.to_date("event_date"))
    )
    fresh = (
        checks.where(F.col("id") > above)
        .select(F.col("user_id").alias("_user"), F.col("_day").alias("_on"))
        .distinct()
    )
    same = F.col("user_id").eqNullSafe(F.col("_user")) & F.col("_day").eqNullSafe(F.col("_on"))
    scans = checks.join(fresh, same, "left_semi")
    known = clubs.select(F.col("id").alias("_club"), F.col("name").alias("club_name"))
    # neighbours count only when their club exists; the first swipe is taken as it is
    scans = scans.join(
        known.select(F.col("_club").alias("_known")), F.col("club_id") == F.col("_known"), "left"
    )
    keys = ["user_id", "_day"]
    hot = large.of("swipes.user_day")

    def fill(rows: DataFrame, cut: bool) -> DataFrame:
        near = neighbours_step(rows, keys, ["id"], {"_prev": "_known"}, {"_next": "_known"}, cut)
        return running_step(near, keys, ["id"], {"_first": ("first", "club_id")}, cut)

    filled = in_order(scans, keys, ["id"], fill, hot)
    if not reopen:
        filled = filled.where(F.col("id") > above)
    picked = filled.withColumn("_club", F.coalesce("_prev", "_next", "_first"))
    return picked.join(known, "_club", "left").select(
        "id",
        shift_hours(F.col("event_date"), tz_hours).alias("event_date"),
        "event_type",
        "sys_response",
        F.when(F.col("club_name").isNotNull(), F.col("_club")).alias("club_id"),
        "club_name",
        "user_id",
        "is_success",
    )


def class_attendance(
    visits: DataFrame,
    plans: DataFrame,
    bookings: DataFrame,
    shift: int = 6,
    local_hours: int = 3,
    large: KeyStatistics = NO_STATISTICS,
) -> DataFrame:
    """Bookings with the outcome found from visits inside a live plan period.

    Large keys: ``visits.user``, ``plans.user``, and ``visits.user_day``, ``visits.user_day_before``, ``bookings.user_day``
    (a visit can begin on the day before the event it comes from).
    """
    open_ended = F.col("end_date").isNull() & F.col("status").isin(*c.LIVE_STATUSES)
    periods = plans.where(
        ~F.col("payment_plan_id").isin(*c.NO_ATTENDANCE_PLAN_IDS) & (F.col("status") != "Deleted")
    ).select(
        "user_id",
        shift_hours(F.col("signed_date"), shift).alias("_from"),
        F.when(open_ended, ntz(dt.datetime(2099, 12, 31)))
        .otherwise(shift_hours(F.col("end_date"), shift))
        .alias("_to"),
    )
    same_day = (
        visits.select("id", "user_id", "in_date", "out_date")
        .where(
            (F.to_date("in_date") >= F.lit(c.ATTENDANCE_FROM))
            & (F.to_date("in_date") == F.to_date(shift_hours(F.col("out_date"), -local_hours)))
        )
    )
    hot = large.of("visits.user", "plans.user")
    live = inside_any(same_day, periods, ["user_id"], "in_date", "_from", "_to", "id", hot=hot)
    minute = F.expr("INTERVAL 1 MINUTE")
    # A booking needs one visit of its day that starts early enough and ends late
    # enough: the running maximum of visit ends answers it without pairing rows.
    reach = live.select(
        "user_id",
        F.to_date("in_date").alias("_day"),
        (F.col("in_date") + minute).alias("_in"),
        (F.col("out_date") + minute).alias("_out"),
    )
    slots = bookings.select("booking_id", "user_id", "start_time", "end_time").withColumn(
        "_day", F.to_date("start_time")
    )
    marked = slots.select(
        "booking_id", "user_id", "_day", "end_time", F.col("start_time").alias("_at"), F.lit(1).alias("_kind")
    ).unionByName(
        reach.select(
            "user_id", "_day", F.col("_in").alias("_at"), F.lit(0).alias("_kind"), "_out"
        ),
        allowMissingColumns=True,
    )
    keys = ["user_id", "_day"]
    day_hot = large.of("visits.user_day", "visits.user_day_before", "bookings.user_day")
    seen = running(marked, keys, ["_at", "_kind", "booking_id"], {"_reach": ("max", "_out")}, hot=day_hot)
    # a booking with several visits that fit is still one booking
    visited = (
        seen.where((F.col("_kind") == 1) & (F.col("end_time") <= F.col("_reach")))
        .select("booking_id")
        .distinct()
        .withColumn("is_visit", F.lit("Yes"))
    )
    came = F.col("is_visit") == "Yes"
    flag = lambda cond: F.when(cond, 1).otherwise(0)
    status = F.col("booking_status")
    return bookings.join(visited, "booking_id", "left").withColumns(
        {
            "is_visit_no": flag(F.col("is_visit").isNull() & (status == "booked")),
            "is_visit_waiting": flag(status == "wait_list"),
            "is_visit_cancel": flag(status == "cancelled"),
            "is_visit_yes": flag(came & (status == "booked")),
            "is_visit_calc": F.when(came & (status == "booked"), "Yes")
            .when(status == "waiting_list", "waiting_list")
            .when(status == "cancelled", "cancelled")
            .otherwise("No"),
        }
    )
