"""Campaign marts: purchases of campaign plans and repeated video watching."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clubflow import config as c
from clubflow.functions.dates import days_between, repair_birthday, seconds_between, shift_hours
from clubflow.operators.intervals import max_over_covering
from clubflow.operators.ordered import first_rows, in_order, neighbours_step, running, running_step
from clubflow.operators.skew import NO_STATISTICS, KeyStatistics


def staff_users(plans: DataFrame, employees: DataFrame) -> DataFrame:
    """Users on a current staff plan or in the list of active employees."""
    on_plan = plans.where(F.col("payment_plan_id").isin(*c.STAFF_PLAN_IDS) & (F.col("status") == "Current"))
    listed = employees.where(F.col("is_active") == 1)
    return on_plan.select("user_id").union(listed.select("user_id")).distinct()


def campaign_payments(transactions: DataFrame) -> DataFrame:
    """The transactions that the campaign mart looks at, in one pass, with the roles they play.

    ``campaign_purchases`` reads them for each role: the two larger roles need two or three columns.
    """
    roles = {
        "is_campaign": F.col("provider_id").isin(*c.CAMPAIGN_PROVIDERS),
        "is_main": F.col("provider_id").isin(*c.FIRST_PAYMENT_PROVIDERS),
        "is_refund": F.col("type") == "refund",
    }
    return (
        transactions.select(
            "id", "user_id", "user_payment_plan_id", "payment_transaction_id", "provider_id", "type", "total_amount",
            "discount_id", "gate_id", "created_at", "updated_at",
            *[F.coalesce(is_so, F.lit(False)).alias(role) for role, is_so in roles.items()],
        )
        .where(" OR ".join(roles))
    )


def campaign_plan_payments(payments: DataFrame, plans: DataFrame) -> DataFrame:
    """Payments of campaign plans among the rows of ``campaign_payments``.

    Few of many: store them and give them to ``campaign_purchases``, which needs them twice. The plans are the narrow side of
    a hash join, so no task sorts all payments for them.
    """
    of_campaign = plans.where(F.col("payment_plan_id").isin(*c.CAMPAIGN_PLAN_IDS)).select(F.col("id").alias("user_payment_plan_id"))
    return (
        payments.where("is_campaign")
        .select(
            F.col("id").alias("transaction_id"),
            F.col("updated_at").alias("transaction_date"),
            F.col("created_at").alias("_created"),
            "user_id", "user_payment_plan_id", "provider_id", "type", "total_amount", "discount_id", "gate_id",
        )
        .join(of_campaign.hint("shuffle_hash"), "user_payment_plan_id", "left_semi")
    )


def main_plan_by_day(
    plans: DataFrame,
    payments: DataFrame,
    inflow_plan_ids: DataFrame,
    payment_plans: DataFrame,
    discounts: DataFrame,
    buyers: DataFrame,
) -> DataFrame:
    """The main plan each of the ``buyers`` paid for on a day."""
    paid = payments.where("is_main").select(
        F.col("user_payment_plan_id").alias("id"), F.to_date("updated_at").alias("main_pp_date")
    )
    wanted = inflow_plan_ids.select(F.col("id").alias("payment_plan_id"))
    by_day = (
        plans.where(
            ~F.col("status").isin("Created", "Deleted")
            & (F.coalesce("cancel_reason", F.lit("")) != c.EXCLUDED_REASON)
        )
        .select("id", "user_id", "payment_plan_id", "discount_id")
        .join(wanted, "payment_plan_id", "left_semi")
        .join(buyers.select("user_id"), "user_id", "left_semi")
        .join(paid, "id")
        .groupBy("user_id", "main_pp_date")
        .agg(
            F.max("id").alias("user_payment_plan_id_main"),
            F.max("payment_plan_id").alias("_plan"),
            F.max("discount_id").alias("_discount"),
        )
    )
    plan = payment_plans.select(F.col("id").alias("_plan"), F.col("name").alias("user_payment_plan_name_main"))
    discount = discounts.select(F.col("id").alias("_discount"), F.col("name").alias("_name"))
    return (
        by_day.join(plan, "_plan", "left")
        .join(discount, "_discount", "left")
        .select(
            "user_id",
            "main_pp_date",
            "user_payment_plan_id_main",
            "user_payment_plan_name_main",
            F.when(F.col("_name").isin(*c.KEPT_MAIN_DISCOUNTS), F.col("_name")).otherwise("-").alias("discount_name_main"),
        )
    )


def campaign_purchases(
    payments: DataFrame,
    plans: DataFrame,
    clubs: DataFrame,
    payment_plans: DataFrame,
    gates: DataFrame,
    users: DataFrame,
    employees: DataFrame,
    discounts: DataFrame,
    inflow_plan_ids: DataFrame,
    app_events: DataFrame,
    video_progress: DataFrame,
    videos: DataFrame,
    tracker: DataFrame,
    start: dt.date = c.CAMPAIGN_START,
    shift: int = 3,
    large: KeyStatistics = NO_STATISTICS,
    paid: DataFrame | None = None,
) -> DataFrame:
    """Purchases of campaign plans with everything known about the buyer.

    ``payments`` are the rows of ``campaign_payments``, ``paid`` those of ``campaign_plan_payments`` if they are stored.
    Large keys: ``payments.user``.
    """
    plan = payment_plans.select(
        F.col("id").alias("payment_plan_id"), F.col("name").alias("payment_plan"), "payment_plan_type"
    )
    local = lambda name: shift_hours(F.col(name), shift).alias(name)
    campaign = (
        plans.where(F.col("payment_plan_id").isin(*c.CAMPAIGN_PLAN_IDS))
        .select(
            F.col("id").alias("user_payment_plan_id"),
            F.col("user_id").alias("_owner"),
            "payment_plan_id",
            "club_id",
            F.col("status").alias("current_status"),
            local("signed_date"),
            local("end_date"),
            local("cancel_date"),
            "cancel_reason",
        )
        .join(plan, "payment_plan_id")
        .join(clubs.select(F.col("id").alias("club_id"), F.col("name").alias("club_name")), "club_id")
        .drop("club_id")
    )
    gate = gates.select(F.col("id").alias("gate_id"), F.col("name").alias("gate_name"))
    paid = (campaign_plan_payments(payments, plans) if paid is None else paid).join(gate, "gate_id")
    # the first payment of every campaign plan, with what is attributed to the plan through it
    first = (
        paid.join(campaign.select("user_payment_plan_id"), "user_payment_plan_id", "left_semi")
        .groupBy("user_payment_plan_id")
        .agg(
            F.min_by(
                F.struct("transaction_id", "user_id", "discount_id", F.to_date("transaction_date").alias("day")),
                F.struct("_created", "transaction_id"),
            ).alias("_row")
        )
        .select(
            "user_payment_plan_id",
            F.col("_row.transaction_id").alias("_first_of_plan"),
            F.col("_row.user_id").alias("user_id"),
            F.col("_row.discount_id").alias("discount_id"),
            F.col("_row.day").alias("main_pp_date"),
        )
    )
    discount = discounts.select(F.col("id").alias("discount_id"), F.col("name").alias("_discount"))
    main = main_plan_by_day(plans, payments, inflow_plan_ids, payment_plans, discounts, first)
    counted = F.col("main_pp_date") >= F.lit(start)
    of_plan = (
        first.join(main, ["user_id", "main_pp_date"], "left")
        .join(discount, "discount_id", "left")
        .select(
            "user_payment_plan_id",
            "_first_of_plan",
            # a plan whose first payment lies before the campaign gets no attributes
            *[
                F.when(counted, F.col(n)).alias(n)
                for n in ("user_payment_plan_id_main", "user_payment_plan_name_main", "discount_name_main")
            ],
            F.when(counted, F.coalesce(F.nullif(F.col("_discount"), F.lit("")), F.lit("-"))).alias("discount_name"),
        )
    )
    dated = (
        paid.where(F.to_date("transaction_date") >= F.lit(start))
        .join(campaign, "user_payment_plan_id")
        .join(of_plan, "user_payment_plan_id")
        .withColumn(
            "payment_type",
            F.when(F.col("transaction_id") == F.col("_first_of_plan"), "new").otherwise("repeat"),
        )
    )
    bought = running(
        dated, ["user_id"], ["transaction_id"], {"min_transaction_date": ("min", "transaction_date")}, hot=large.of("payments.user")
    )
    staff = staff_users(plans, employees).select(F.col("user_id").alias("_owner"), F.lit(True).alias("_staff"))
    refund = payments.where("is_refund").select(
        F.col("payment_transaction_id").alias("transaction_id"),
        F.col("id").alias("return_transaction"),
        shift_hours(F.col("updated_at"), shift).alias("return_transaction_date"),
    )
    person = users.select(F.col("id").alias("user_id"), "sex", repair_birthday(F.col("birthday")).alias("birthday"))
    banner = (
        app_events.where(F.col("EventName").like(c.BANNER_EVENT) & F.col("EventParameters").like(c.BANNER_PARAMETERS))
        .groupBy(F.get_json_object("EventParameters", "$.user_id").try_cast("bigint").alias("user_id"))
        .agg(F.max("EventDate").alias("last_banner_date"))
        .where(F.col("user_id").isNotNull())
    )
    free = videos.where((F.col("is_free") == 1) & (F.col("is_deleted") == 0)).select(F.col("id").alias("video_id"))
    first_video = first_rows(
        video_progress.where(F.col("duration") > c.MIN_VIDEO_SECONDS)
        .join(free, "video_id", "left_semi")
        .select("user_id", "created_at", F.col("id").alias("video_progress_id")),
        ["user_id"],
        ["created_at", "video_progress_id"],
    )
    trial = plans.where(F.col("payment_plan_id") == c.TRIAL_PLAN_ID).select("user_id").distinct()
    clicked = tracker.groupBy("user_id").agg(F.max("click_date").alias("_click"))
    # the running minimum left the purchases partitioned by user: the five joins
    # on the user shuffle only their right sides
    known = (
        bought.join(person, "user_id", "left")
        .join(first_video, "user_id", "left")
        .join(banner, "user_id", "left")
        .join(trial.withColumn("_trial", F.lit(True)), "user_id", "left")
        .join(clicked, "user_id", "left")
    )
    return (
        known.join(staff, "_owner", "left")
        .join(refund, "transaction_id", "left")
        .select(
            F.when(F.col("_staff"), c.EMPLOYEE).otherwise(c.CLIENT).alias("if_employee"),
            "transaction_date", "transaction_id", "signed_date", "end_date", "cancel_date",
            "cancel_reason", "return_transaction", "return_transaction_date", "type", "user_id",
            "provider_id", "payment_plan_id", "payment_plan", "user_payment_plan_id", "club_name",
            "total_amount", "discount_id", "discount_name", "current_status", "gate_name", "sex",
            "birthday", "payment_plan_type", "payment_type", "video_progress_id", "created_at",
            F.when(F.col("transaction_date") > F.col("created_at"), 1).otherwise(0).alias("buy_flag"),
            days_between(F.col("created_at"), F.col("transaction_date")).alias("diff_days"),
            "user_payment_plan_id_main", "user_payment_plan_name_main", "discount_name_main",
            F.when(F.col("last_banner_date").isNull(), c.BANNER_NO).otherwise(c.BANNER_YES).alias("is_banner_user"),
            "last_banner_date",
            F.when(F.col("_trial"), c.TRIAL_YES).otherwise(c.TRIAL_NO).alias("is_trial_user"),
            F.when(
                F.col("_click") <= F.date_add(F.to_date("min_transaction_date"), c.TRACKER_DAYS), c.TRACKER_YES
            )
            .otherwise("-")
            .alias("is_tracker_user"),
        )
    )


_KEYS = ["user_id", "video_id"]
_ORDER = ["updated_at", "version", "id"]


def _progress(history: DataFrame, shift: int) -> DataFrame:
    """Progress rows with local times, versions of one row collapsed."""
    facts = ["id", "video_id", "user_id", "duration", "is_completed", "stars", "difficulty", "comment"]
    return history.groupBy(*facts, shift_hours(F.col("updated_at"), shift).alias("updated_at")).agg(F.max("version").alias("version"))


def by_user_video(history: DataFrame, large: KeyStatistics = NO_STATISTICS) -> DataFrame:
    """Progress rows dealt by user and video: one shuffle for versions, windows and sessions, unless a key is too large for a task."""
    return history if large.of("progress.user_video") else history.repartition(*_KEYS)


def session_spans(
    history: DataFrame, shift: int = 3, tails: DataFrame | None = None, large: KeyStatistics = NO_STATISTICS
) -> DataFrame:
    """All sessions of each user and video, numbered 1, 2, …, with what it takes to go on from them.

    ``tails`` are the last sessions so far of users and videos in ``history``. With them, ``history`` need only hold the
    progress rows that have come since (each after its tail), and the result is those last sessions, continued, and the ones
    after them. A tail takes part as one row that stands for its session. Large keys: ``progress.user_video``.
    """
    clean = _progress(history, shift)
    rated = lambda name: F.when(F.col(name) != 0, F.col(name)).alias(name)
    rows = clean.select(
        *_KEYS, *_ORDER, F.lit(1).cast("long").alias("rows"), F.col("id").alias("top_id"), F.lit(1).cast("long").alias("seconds"),
        F.to_date("updated_at").alias("day"), "duration", "is_completed", rated("stars"), rated("difficulty"), "comment",
        F.lit(None).cast("long").alias("number"),
    )
    if tails is not None:
        rows = rows.unionByName(
            tails.select(
                *_KEYS, F.col("last_at").alias("updated_at"), F.col("last_version").alias("version"), F.col("last_id").alias("id"),
                F.col("qty_rows").alias("rows"), "top_id", "seconds", "day", F.col("max_duration").alias("duration"),
                "is_completed", "stars", "difficulty", "comment", F.col("session_number").alias("number"),
            )
        )
    gap = seconds_between(F.col("_before"), F.col("updated_at"))

    def steps(rows: DataFrame, cut: bool) -> DataFrame:
        near = neighbours_step(rows, _KEYS, _ORDER, {"_before": "updated_at"}, {"_after": "updated_at"}, cut)
        opens = F.when(gap < c.SESSION_GAP_SECONDS, 0).otherwise(1)
        flagged = near.withColumn("_step", F.coalesce("number", opens.cast("long")))
        return running_step(flagged, _KEYS, _ORDER, {"session_number": ("sum", "_step")}, cut)

    numbered = in_order(rows, _KEYS, _ORDER, steps, large.of("progress.user_video"))
    # the same second twice in a row is not watching time
    repeated = F.date_trunc("second", "_after") == F.date_trunc("second", "updated_at")
    # the first row of a session does not tell how long it was watched; a tail carries that of its session
    watched = F.when(F.col("number").isNotNull() | (F.col("_step") != 1), F.col("duration"))
    spans = numbered.groupBy(*_KEYS, "session_number").agg(
        F.sum("rows").alias("qty_rows"),
        F.max("top_id").alias("top_id"),
        F.sum(F.when(repeated, F.col("seconds") - 1).otherwise(F.col("seconds"))).alias("seconds"),
        F.max(F.coalesce("day", F.lit(c.OPEN_END))).alias("day"),
        F.max(watched).alias("max_duration"),
        F.max("is_completed").alias("is_completed"),
        F.max("stars").alias("stars"),
        F.max("difficulty").alias("difficulty"),
        F.max("comment").alias("comment"),
        F.max(F.struct(*_ORDER)).alias("_last"),
    )
    last = {"last_at": "updated_at", "last_version": "version", "last_id": "id"}
    return spans.withColumns({n: F.col(f"_last.{at}") for n, at in last.items()}).drop("_last")


def kept_sessions(spans: DataFrame) -> DataFrame:
    """Sessions with at least three progress rows, numbered 1, 2, … anew.

    The id of the newest progress row stands for the user's progress of the video. Sessions lie three hours apart, so a
    key has at most eight a day and these windows stay small.
    """
    whole = Window.partitionBy(*_KEYS)
    return (
        spans.withColumn("id", F.max("top_id").over(whole))
        .where(F.col("qty_rows") >= c.MIN_SESSION_ROWS)
        .withColumn("session_number", F.row_number().over(whole.orderBy("session_number")))
        .select(
            *_KEYS, "session_number", "qty_rows", F.col("day").alias("updated_at"),
            (F.col("seconds") * c.SECONDS_PER_ROW + c.SECONDS_BASE).alias("duration_by_qty_rows"),
            "max_duration", "is_completed", "stars", "difficulty", "comment", "id",
        )
    )


def watch_sessions(history: DataFrame, shift: int = 3, large: KeyStatistics = NO_STATISTICS) -> DataFrame:
    """Sessions of each user and video with at least three progress rows, numbered 1, 2, …

    Large keys: ``progress.user_video``.
    """
    return kept_sessions(session_spans(by_user_video(history, large), shift, large=large))


def video_rewatch(watched: DataFrame, videos: DataFrame, purchases: DataFrame) -> DataFrame:
    """Watch sessions with rewatch counts and the campaign plan that covered each.

    ``watched`` are the rows of ``watch_sessions``, far fewer than the history; they are read three times, so store them.
    """
    watched = watched.withColumn("if_rewatch", F.when(F.col("session_number") > 1, 1).otherwise(0))
    per_user = watched.groupBy("user_id", "video_id").agg(F.sum("if_rewatch").alias("_again"))
    per_video = per_user.groupBy("video_id").agg(
        F.max("_again").alias("max_rewatch"),
        F.nullif(F.count_if(F.col("_again") > 1), F.lit(0)).alias("qty_rewatch_more_1"),
    )
    title = videos.select(F.col("id").alias("video_id"), "title", "type", "is_free", "duration")
    plans = purchases.where(F.col("payment_type") == "new").select(
        "user_id",
        "user_payment_plan_id",
        "payment_plan",
        F.to_date("signed_date").alias("start_date"),
        F.coalesce(F.to_date("end_date"), F.lit(c.OPEN_END)).alias("end_date"),
        "gate_name", "if_employee", "discount_name", "discount_name_main", "is_banner_user",
        "current_status", "is_trial_user", "is_tracker_user",
    )
    texts = [
        "payment_plan", "gate_name", "if_employee", "discount_name", "discount_name_main",
        "is_banner_user", "current_status", "is_trial_user",
    ]
    taken = ["user_payment_plan_id", "start_date", "end_date", *texts]
    covered = max_over_covering(
        watched, plans, ["user_id"], "updated_at", "start_date", "end_date", {n: n for n in taken}
    )
    tracked = plans.groupBy("user_id").agg(F.max("is_tracker_user").alias("is_tracker_user"))
    never = F.lit(dt.date(1970, 1, 1))
    return (
        covered.join(per_video, "video_id", "left")
        .join(title, "video_id", "left")
        .join(tracked, "user_id", "left")
        .select(
            "session_number", "id", "title", "type", "is_free", "duration", "video_id", "user_id",
            "qty_rows", "if_rewatch", "updated_at", "duration_by_qty_rows", "max_duration",
            "is_completed", "stars", "difficulty", "comment", "max_rewatch", "qty_rewatch_more_1",
            F.coalesce("user_payment_plan_id", F.lit(0)).alias("user_payment_plan_id"),
            F.coalesce("start_date", never).alias("start_date"),
            F.coalesce("end_date", never).alias("end_date"),
            *[F.coalesce(n, F.lit("-")).alias(n) for n in texts],
            "is_tracker_user",
        )
    )
