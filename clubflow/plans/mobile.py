"""App and advertising marts: mobile events, stories, device users, tracker users."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clubflow import config as c
from clubflow.functions.dates import ntz
from clubflow.functions.text import field_text, parsed_json
from clubflow.operators.ordered import group_values


def event_user(parameters: Column) -> Column:
    """User id of an app event from its parsed parameters: the nested one, else the plain one, else 0."""
    nested = field_text(parameters, "$.user.id")
    # some apps write the nested object as a text of its own
    wrapped = F.schema_of_variant(F.try_variant_get(parameters, "$.user", "variant")) == "STRING"
    inner = F.when(wrapped, field_text(parsed_json(field_text(parameters, "$.user")), "$.id")).otherwise("")
    plain = field_text(parameters, "$.user_id")
    text = F.when(nested != "", nested).when(inner != "", inner).when(plain != "", plain).otherwise("0")
    return F.coalesce(text.try_cast("bigint"), F.lit(0).cast("bigint"))


def plan_spans(plans: DataFrame, inflow_plan_ids: DataFrame, payment_plans: DataFrame) -> DataFrame:
    """One row per user: newest plan id, first start and last end of the main plans."""
    ids = inflow_plan_ids.select(F.col("id").alias("payment_plan_id"))
    named = payment_plans.select(F.col("id").alias("payment_plan_id"))
    return (
        plans.where(
            ~F.col("status").isin("Created", "Deleted")
            & (F.coalesce("cancel_reason", F.lit("")) != c.EXCLUDED_REASON)
        )
        .join(ids, "payment_plan_id", "left_semi")
        .join(named, "payment_plan_id", "left_semi")
        .groupBy("user_id")
        .agg(
            F.max("id").alias("user_payment_plan_id"),
            F.min(F.to_date("signed_date")).alias("start_date"),
            F.max(F.coalesce(F.to_date("end_date"), F.lit(c.OPEN_END))).alias("end_date"),
        )
    )


def mobile_events(
    events: DataFrame,
    users: DataFrame,
    clubs: DataFrame,
    plans: DataFrame,
    inflow_plan_ids: DataFrame,
    payment_plans: DataFrame,
    date_from: dt.date,
    date_to: dt.date,
    as_of: dt.datetime,
) -> DataFrame:
    """App events of a receive-date range with user, club and plan span.

    The highest user id seen on a device in the range is given to all its events.
    """
    ranged = events.where(
        (F.col("ReceiveDate") >= F.lit(date_from)) & (F.col("ReceiveDate") < F.lit(date_to))
    ).withColumn("_parsed", parsed_json(F.col("EventParameters"))).select(
        F.col("DeviceID").alias("device_id"),
        F.col("EventDate").alias("event_date"),
        F.col("EventDateTime").alias("event_datetime"),
        F.col("ReceiveDate").alias("receive_date"),
        F.col("OSName").alias("os_name"),
        F.col("EventName").alias("event_name"),
        F.col("EventParameters").alias("event_params"),
        event_user(F.col("_parsed")).alias("_seen"),
    )
    known = group_values(ranged, ["device_id"], {"user_id": ("max", "_seen")}).drop("_seen")
    # dimensions are assembled per user first, so events meet one table
    club = clubs.select(F.col("id").alias("home_club_id"), F.col("name").alias("club_name"))
    person = users.select(
        F.col("id").alias("user_id"), "sex", "name", "last_name", "phone", "email", "birthday",
        "sport_experience", "home_club_id",
    ).join(club, "home_club_id", "left")
    spans = plan_spans(plans, inflow_plan_ids, payment_plans)
    current = plans.select(F.col("id").alias("user_payment_plan_id"), "payment_plan_id", "status").join(
        payment_plans.select(F.col("id").alias("payment_plan_id"), F.col("name").alias("payment_plan_name")),
        "payment_plan_id",
        "left",
    )
    profile = person.join(spans, "user_id", "full").join(current, "user_payment_plan_id", "left")
    return known.join(profile, "user_id", "left").select(
        "device_id", "user_id", "event_date", "event_datetime", "receive_date", "os_name",
        "event_name", "event_params", "sex", "name", "last_name", "phone", "email", "birthday",
        "sport_experience", "home_club_id", "club_name", "payment_plan_name", "status",
        "start_date", "end_date", "user_payment_plan_id",
        ntz(as_of).alias("updated_at"),
    )


def mobile_stories(
    events: DataFrame, slides: DataFrame, date_from: dt.date, date_to: dt.date, as_of: dt.datetime
) -> DataFrame:
    """Story events with story, slide and show time fields and the slide's header."""
    header = slides.select(F.col("id").cast("string").alias("slide_id"), "header")
    return (
        events.where(
            F.col("event_name").isin(*c.STORY_EVENTS)
            & (F.col("receive_date") >= F.lit(date_from))
            & (F.col("receive_date") < F.lit(date_to))
        )
        .withColumn("_parsed", parsed_json(F.col("event_params")))
        .withColumns({n: field_text(F.col("_parsed"), f"$.{n}") for n in ("story_id", "slide_id", "showtime")})
        .join(header, "slide_id", "left")
        .select(
            "device_id", "event_date", "event_datetime", "receive_date", "os_name", "event_name",
            "story_id", "slide_id", "header", "showtime", "user_id", "sex", "name", "last_name",
            "phone", "email", "birthday", "sport_experience", "club_name", "payment_plan_name",
            "status", "user_payment_plan_id",
            ntz(as_of).alias("updated_at"),
        )
    )


def device_users(events: DataFrame) -> DataFrame:
    """First and last event date per device and user."""
    return (
        events.where(F.col("user_id") != 0)
        .groupBy("device_id", "user_id")
        .agg(F.min("event_date").alias("min_event_date"), F.max("event_date").alias("max_event_date"))
    )


def tracker_clicks(postbacks: DataFrame) -> DataFrame:
    """Clicks of the campaign trackers with their device."""
    return (
        postbacks.where(F.col("TrackerName").isin(*c.TRACKERS))
        .select(
            F.col("ClickDate").alias("click_date"),
            F.regexp_extract("PostbackUrlParameters", c.TRACKER_DEVICE_PATTERN, 1).alias("device_id"),
        )
        .where(F.col("device_id") != "")
    )


def clicked_events(events: DataFrame, clicks: DataFrame) -> DataFrame:
    """All app events of the devices behind the clicks, so that no other event is parsed to find their users.

    With stored ``clicks``, the rows of ``tracker_clicks``, Spark knows their size and sends few of them to the events.
    """
    return events.join(clicks.select(F.col("device_id").alias("DeviceID")), "DeviceID", "left_semi")


def users_of_clicks(clicks: DataFrame, devices: DataFrame) -> DataFrame:
    owners = devices.where(F.col("user_id") != 0).select("device_id", "user_id").distinct()
    # rows without a user are not wanted, so the join is an inner one
    return clicks.join(owners, "device_id").select("click_date", "device_id", "user_id")


def tracker_users(postbacks: DataFrame, devices: DataFrame) -> DataFrame:
    """Users behind the clicks of the campaign trackers."""
    return users_of_clicks(tracker_clicks(postbacks), devices)
