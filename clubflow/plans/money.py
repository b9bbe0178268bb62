"""Payment marts: revenue, accounting ledger, left-completed, sales list, flow marketing."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clubflow import config as c
from clubflow.functions.dates import days_between, month_start, ntz, repair_birthday, shift_hours
from clubflow.functions.text import code_label, first_label, split_number
from clubflow.operators.ordered import first_rows, neighbours
from clubflow.operators.skew import NO_STATISTICS, KeyStatistics


def revenue_monthly(
    transactions: DataFrame,
    plans: DataFrame,
    club_moves: DataFrame,
    legal_infos: DataFrame,
    clubs: DataFrame,
    payment_plans: DataFrame,
    first_day: dt.date,
    last_day: dt.date,
    shift: int = 3,
) -> DataFrame:
    """Signed revenue by month, plan and club.

    The club is the legal entity's, else the first club of the plan: the one
    left by the earliest move on or after the start, else the plan's own.
    """
    signed = (
        F.when(F.col("provider_id").isin(*c.REVENUE_PLUS), F.col("total_amount"))
        .when(F.col("provider_id").isin(*c.REVENUE_MINUS), -F.col("total_amount"))
        .otherwise(F.lit(0))
    )
    stop = dt.datetime.combine(last_day, dt.time(23, 59, 59))
    paid = transactions.where(
        F.col("updated_at").between(ntz(dt.datetime.combine(first_day, dt.time())), ntz(stop))
    ).select(
        "user_id",
        "user_payment_plan_id",
        "club_legal_info_id",
        month_start(F.col("updated_at")).alias("date"),
        signed.alias("revenue"),
    )
    own = plans.where(~F.col("payment_plan_id").isin(*c.REVENUE_EXCLUDED_PLANS)).select(
        "id", "user_id", "club_id", "start_date", "end_date"
    )
    moved_at = shift_hours(F.col("created_at"), shift)
    # plans are not reduced to the paid ones first: that sorts and groups the payments beside the plans and their moves in
    # the same tasks, twice, for rows that the join with the payments leaves out anyway
    first_move = (
        club_moves.select(F.col("user_payment_plan_id").alias("id"), "old_club_id", moved_at.alias("_at"))
        .join(own.select("id", "start_date"), "id")
        .where(F.col("_at") >= F.col("start_date"))
        .groupBy("id")
        .agg(F.min(F.struct("_at", "old_club_id")).alias("_move"))
    )
    moved = F.col("_move").isNotNull() & (
        F.col("end_date").isNull() | (F.col("_move._at") <= F.col("end_date"))
    )
    first_club = (
        own.where(F.col("start_date").isNotNull() | F.col("end_date").isNotNull())
        .join(first_move, "id", "left")
        .select(
            "user_id",
            F.col("id").alias("user_payment_plan_id"),
            F.when(moved, F.col("_move.old_club_id")).otherwise(F.col("club_id")).alias("_first"),
        )
    )
    plan_of = plans.select(F.col("id").alias("user_payment_plan_id"), "payment_plan_id")
    legal = legal_infos.select(F.col("id").alias("club_legal_info_id"), F.col("club_id").alias("_legal"))
    by_club = (
        paid.join(plan_of, "user_payment_plan_id", "left")
        .withColumn("payment_plan_id", F.coalesce("payment_plan_id", F.lit(0)))
        .where(~F.col("payment_plan_id").isin(*c.REVENUE_EXCLUDED_PLANS))
        .join(legal, "club_legal_info_id", "left")
        .where(
            ~(F.col("user_payment_plan_id").isNull() & (F.coalesce("_legal", F.lit(0)) == 0))
            & F.col("revenue").isNotNull()
        )
        .join(first_club, ["user_id", "user_payment_plan_id"], "left")
        .groupBy(
            "date",
            "payment_plan_id",
            F.when(F.col("_legal") > 0, F.col("_legal")).otherwise(F.col("_first")).alias("club_id"),
        )
        .agg(F.sum("revenue").alias("total_cost"))
    )
    # names are joined to the few grouped rows, not to the transactions
    club = clubs.select(F.col("id").alias("club_id"), F.col("name").alias("club_name"), "city_id", "club_type", "open_date")
    plan = payment_plans.select(F.col("id").alias("payment_plan_id"), F.col("name").alias("payment_name"))
    return (
        by_club.join(club, "club_id", "left")
        .join(plan, "payment_plan_id", "left")
        .select(
            "date", "payment_plan_id", "payment_name", "club_id", "club_name", "city_id",
            "club_type", "open_date", "total_cost",
        )
    )


def receipt_counts(receipts: DataFrame) -> DataFrame:
    """Receipts per transaction id (parsed from the number) and fiscal status."""
    counted = receipts.where(F.col("fiscal_status").isin(*c.COUNTED_FISCAL_STATUSES)).select(
        split_number(F.col("number"), "_", 2).alias("id_transaction"), "fiscal_status"
    )
    return counted.groupBy("id_transaction", "fiscal_status").agg(F.count(F.lit(1)).alias("cnt_receips"))


def ledger_receipts(accounting: DataFrame, transactions: DataFrame, above: int = 0) -> DataFrame:
    """Transaction ids whose receipts the ledger rows above a watermark look up: their own and their parents'."""
    own = accounting.where(~F.col("is_deleted") & (F.col("transaction_id") > above)).select("transaction_id")
    return own.unionAll(transactions.where(F.col("id") > above).select("parent_id"))


def accounting_ledger(
    accounting: DataFrame,
    transactions: DataFrame,
    counts: DataFrame,
    users: DataFrame,
    legal_infos: DataFrame,
    clubs: DataFrame,
    above: int = 0,
) -> DataFrame:
    """Accounting rows above a watermark with labels and receipt status.

    The parent transaction's receipt comes first, then the row's own. ``counts`` are the rows of ``receipt_counts``, or
    those of an index of receipts (``sources.receipts``).
    """
    fresh = accounting.where(~F.col("is_deleted") & (F.col("transaction_id") > above))
    tx = transactions.where(F.col("id") > above).select(
        F.col("id").alias("transaction_id"), "receipt_id", "parent_id", "club_legal_info_id"
    )
    own = counts.select(
        F.col("id_transaction").alias("transaction_id"),
        F.col("fiscal_status").alias("_own_status"),
        F.col("cnt_receips").alias("_own_count"),
    )
    parent = counts.select(
        F.col("id_transaction").alias("parent_id"), F.col("fiscal_status").alias("_parent_status")
    )
    legal = legal_infos.select(F.col("id").alias("club_legal_info_id"), F.col("club_id").alias("_club"))
    club = clubs.select(F.col("id").alias("_club"), F.col("name").alias("club_name"))
    who = users.select(
        F.col("id").alias("user_id"), F.concat("name", F.lit(" "), "last_name").alias("name")
    )
    # what a transaction adds is looked up for its few columns; the wide rows meet it, the receipts and the users as the
    # streamed side of hash joins, so no task sorts wide rows
    added = tx.join(parent, "parent_id", "left").join(legal, "club_legal_info_id", "left").join(club, "_club", "left")
    return (
        fresh.join(added.hint("shuffle_hash"), "transaction_id", "left")
        .join(own.hint("shuffle_hash"), "transaction_id", "left")
        .join(who.hint("shuffle_hash"), "user_id", "left")
        .select(
            "transaction_id",
            "club_name",
            shift_hours(F.col("created_at"), c.LEDGER_SHIFT_HOURS).alias("date"),
            code_label(F.col("provider_id"), c.OPERATION_NAMES).alias("operation_name"),
            F.col("type").alias("transaction_type"),
            "user_id",
            "name",
            F.col("payment_plan_name").alias("subscription_name"),
            "join_fee",
            "join_fee_net",
            "membership_fee",
            "membership_fee_net",
            code_label(F.col("payment_plan_tax"), c.TAX_NAMES).alias("vat"),
            "product_name",
            F.col("product_quantity").alias("product_qty"),
            "product_price",
            F.col("product_total_amount").alias("total_amount"),
            F.col("product_total_amount_net").alias("total_net"),
            code_label(F.col("product_tax"), c.TAX_NAMES).alias("vat_num"),
            F.col("deposit_amount").alias("balance"),
            F.col("receipt_id").alias("receipt"),
            # a parent receipt counts as one
            F.when(F.col("_parent_status").isNotNull() & (F.col("parent_id") > 0), F.lit(1).cast("long"))
            .otherwise(F.col("_own_count"))
            .alias("cnt_receips"),
            F.coalesce(
                F.nullif(F.col("_parent_status"), F.lit("")), F.nullif(F.col("_own_status"), F.lit(""))
            ).alias("fiscal_status"),
        )
    )


def left_completed(history: DataFrame, above: int = 0, large: KeyStatistics = NO_STATISTICS) -> DataFrame:
    """Transactions whose status moved away from 'completed'. Large keys: ``history.id``."""
    recent = history.where(F.col("id") > above).select("id", "status", "version_updated_at", "version")
    hot = large.of("history.id")
    return (
        neighbours(
            recent,
            ["id"],
            ["version_updated_at", "version"],
            lead={"ns": "status", "ns_version_updated_at": "version_updated_at"},
            hot=hot,
        )
        .where((F.col("status") == "completed") & ~F.col("ns").isin("completed", ""))
        .select("id", "status", "ns", "ns_version_updated_at")
    )


def first_payments(transactions: DataFrame) -> DataFrame:
    """The first subscription payment (lowest id) of each plan."""
    kept = transactions.where(F.col("provider_id").isin(*c.FIRST_PAYMENT_PROVIDERS)).select(
        "user_payment_plan_id", "id", "total_amount", "membership_fee", "join_fee", "updated_at",
        "gate_id", "employee_id", "discount_amount", "discount_code_id", "discount_id",
    )
    return first_rows(kept, ["user_payment_plan_id"], ["id"])


def _reported(plans: DataFrame) -> DataFrame:
    """The subscriptions that the sales list shows."""
    return plans.where(
        (F.coalesce("cancel_reason", F.lit("-")) != c.EXCLUDED_REASON) & (F.col("status") != "Deleted")
    )


def _staff(employees: DataFrame, users: DataFrame) -> DataFrame:
    """Names of employees, who are users too."""
    return employees.select(F.col("id").alias("employee_id"), F.col("user_id").alias("_staff")).join(
        users.select(F.col("id").alias("_staff"), F.col("name").alias("employee_name"), "last_name"),
        "_staff",
        "left",
    ).drop("_staff")


def subscription_sales(
    plans: DataFrame,
    inflow_plan_ids: DataFrame,
    payment_plans: DataFrame,
    transactions: DataFrame,
    flows: DataFrame,
    users: DataFrame,
    employees: DataFrame,
    discounts: DataFrame,
    discount_codes: DataFrame,
    gates: DataFrame,
    clubs: DataFrame,
    cities: DataFrame,
    as_of: dt.datetime,
    shift: int = 6,
    large: KeyStatistics = NO_STATISTICS,
) -> DataFrame:
    """One row per subscription with its first payment, previous plan and client class. Large keys: ``plans.user``."""
    plan_name = F.lower("_plan_name")
    subs = (
        _reported(plans)
        .join(inflow_plan_ids.select(F.col("id").alias("_main")), F.col("payment_plan_id") == F.col("_main"), "left")
        .join(
            payment_plans.select(F.col("id").alias("payment_plan_id"), F.col("name").alias("_plan_name")),
            "payment_plan_id",
            "left",
        )
        .select(
            "user_id",
            F.col("id").alias("sub_id"),
            "payment_plan_id",
            F.col("_plan_name").alias("subscription_name"),
            F.when(F.col("_main") > 0, "main")
            .when(plan_name.like(c.BARTER_PATTERN), "barter")
            .when(plan_name.like(c.TRIAL_PATTERN), "trial")
            .otherwise("sub")
            .alias("subscription_type"),
            shift_hours(F.col("signed_date"), shift).alias("signed_date"),
            shift_hours(F.col("start_date"), shift).alias("start_date"),
            shift_hours(F.col("end_date"), shift).alias("end_date"),
            "club_id",
            "discount_id",
            "discount_code_id",
            "status",
            F.col("card_token_id").isNotNull().alias("card_token_id"),
            F.coalesce("cancel_reason", F.lit("-")).alias("cancel_reason"),
        )
    )
    ranked_only = subs.where(F.col("subscription_type").isin(*c.RANKED_TYPES)).select(
        "user_id", "sub_id", "payment_plan_id", "signed_date", "end_date"
    )
    hot = large.of("plans.user")
    chain = neighbours(
        ranked_only,
        ["user_id"],
        ["sub_id"],
        lag={"prev_sub_id": "sub_id", "prev_payment_plan_id": "payment_plan_id", "_prev_end": "end_date"},
        hot=hot,
    )
    chain = chain.select(
        "sub_id",
        "prev_sub_id",
        "prev_payment_plan_id",
        F.col("prev_sub_id").isNull().alias("_is_first"),
        days_between(F.coalesce("_prev_end", "signed_date"), F.col("signed_date")).alias("_gap"),
    )
    paid = first_payments(transactions).select(
        F.col("user_payment_plan_id").alias("sub_id"),
        "join_fee",
        "membership_fee",
        F.col("total_amount").alias("_paid"),
        F.col("updated_at").alias("payment_date"),
        "gate_id",
        "employee_id",
        "discount_amount",
        F.col("discount_code_id").alias("discount_code_id_tr"),
        F.col("discount_id").alias("discount_id_tr"),
    )
    flow = flows.select(
        F.col("first_id").alias("sub_id"), F.col("is_new").alias("is_new_per_inflow"), "is_inflow"
    )
    who = users.select(
        F.col("id").alias("user_id"),
        "phone",
        "email",
        repair_birthday(F.col("birthday")).alias("birthday"),
        "sex",
        F.col("sport_experience").alias("fitness_experience"),
    )
    staff = _staff(employees, users)
    name = lambda df, key, label, source="name": df.select(
        F.col("id").alias(key), F.col(source).alias(label)
    )
    place = clubs.select(F.col("id").alias("club_id"), F.col("name").alias("club_name"), F.col("city_id").alias("_city"))
    first, sub = F.col("_is_first"), F.col("subscription_type") == "sub"
    return (
        # the three joins on sub_id share one shuffle of the subscriptions
        subs.join(chain, "sub_id", "left")
        .join(paid, "sub_id", "left")
        .join(flow, "sub_id", "left")
        .join(who, "user_id", "left")
        .join(staff, "employee_id", "left")
        .join(name(payment_plans, "prev_payment_plan_id", "prev_payment_plan_name"), "prev_payment_plan_id", "left")
        .join(name(discounts, "discount_id", "discount_name"), "discount_id", "left")
        .join(name(discounts, "discount_id_tr", "discount_name_tr"), "discount_id_tr", "left")
        .join(name(discount_codes, "discount_code_id", "code", "code"), "discount_code_id", "left")
        .join(name(discount_codes, "discount_code_id_tr", "code_tr", "code"), "discount_code_id_tr", "left")
        .join(name(gates, "gate_id", "gate_name"), "gate_id", "left")
        .join(place, "club_id", "left")
        .join(name(cities, "_city", "city_name"), "_city", "left")
        .select(
            "user_id",
            "sub_id",
            "payment_plan_id",
            "subscription_name",
            "subscription_type",
            F.when(first, c.NEW_CLIENT)
            .when(sub, "-")
            .when(F.col("_gap") <= c.RETURN_DAYS, c.RETURNED_SOON)
            .when(F.col("_gap") > c.RETURN_DAYS, c.RETURNED_LATE)
            .otherwise("-")
            .alias("is_new"),
            F.when(first, 0).when(sub, 0).when(F.col("_gap") <= 0, 1).otherwise(0).alias("is_resubbed"),
            "is_new_per_inflow",
            "is_inflow",
            "prev_sub_id",
            "prev_payment_plan_id",
            "prev_payment_plan_name",
            "phone",
            "email",
            "birthday",
            "sex",
            "fitness_experience",
            "signed_date",
            "start_date",
            "payment_date",
            "end_date",
            "club_name",
            "discount_code_id",
            "code",
            "discount_name",
            "card_token_id",
            "status",
            "join_fee",
            "membership_fee",
            # legacy payments did not include the membership fee
            F.when(F.col("sub_id") < c.LEGACY_ID_BELOW, F.col("_paid") + F.col("membership_fee"))
            .otherwise(F.col("_paid"))
            .alias("total_amount"),
            "cancel_reason",
            "gate_id",
            "employee_id",
            "employee_name",
            "last_name",
            "gate_name",
            "discount_amount",
            first_label(F.col("discount_name"), c.CAMPAIGN_RULES).alias("discount_name_new"),
            "discount_code_id_tr",
            "discount_name_tr",
            "discount_id_tr",
            "code_tr",
            "city_name",
            ntz(as_of).alias("updated_at"),
        )
    )


def sale_terms(
    plans: DataFrame, transactions: DataFrame, users: DataFrame, employees: DataFrame, gates: DataFrame
) -> DataFrame:
    """What the flow marketing mart takes from the sales list, without the rest of it: the terms of the first payment.

    The distinct rows are those of ``subscription_sales`` in these columns.
    """
    subs = _reported(plans).select(F.col("id").alias("sub_id"))
    paid = first_payments(transactions).select(
        F.col("user_payment_plan_id").alias("sub_id"), "discount_amount", "membership_fee", "gate_id", "employee_id"
    )
    gate = gates.select(F.col("id").alias("gate_id"), F.col("name").alias("gate_name"))
    return (
        subs.join(paid, "sub_id", "left")
        .join(_staff(employees, users), "employee_id", "left")
        .join(gate, "gate_id", "left")
        .select("sub_id", "discount_amount", "membership_fee", "gate_name", "employee_name", "last_name")
    )


def inflow_outflow_marketing(
    flows: DataFrame,
    users: DataFrame,
    sales: DataFrame,
    plans: DataFrame,
    payment_plans: DataFrame,
    clubs: DataFrame,
    inflow_plan_ids: DataFrame,
    discount_codes: DataFrame,
    as_of: dt.date,
    large: KeyStatistics = NO_STATISTICS,
) -> DataFrame:
    """Flow rows with the user's latest open or ended plan, client class and campaign label. Large keys: ``flows.user``."""
    main = plans.join(
        inflow_plan_ids.select(F.col("id").alias("payment_plan_id")), "payment_plan_id", "left_semi"
    ).select("user_id", "id", "payment_plan_id", "club_id", "status")

    def newest(kept: DataFrame, prefix: str) -> DataFrame:
        top = first_rows(kept, ["user_id"], ["id"], last=True)
        return (
            top.join(payment_plans.select(F.col("id").alias("payment_plan_id"), F.col("name").alias("_plan")), "payment_plan_id", "left")
            .join(clubs.select(F.col("id").alias("club_id"), F.col("name").alias("_club")), "club_id", "left")
            .select(
                "user_id",
                F.col("id").alias(f"{prefix}_id"),
                F.col("_plan").alias(f"{prefix}_plan"),
                F.col("_club").alias(f"{prefix}_club"),
                F.col("status").alias(f"{prefix}_status"),
            )
        )

    live = newest(main.where(~F.col("status").isin(*c.OPEN_PLAN_EXCLUDED)), "_open")
    ended = newest(main.where(F.col("status").isin(*c.CLOSED_PLAN_STATUSES)), "_ended")
    sale = first_rows(
        sales.select(
            F.col("sub_id").alias("first_id"), "discount_amount", "membership_fee", "gate_name",
            "employee_name", F.col("last_name").alias("last_employee_name"),
        ),
        ["first_id"],
        ["discount_amount", "membership_fee", "gate_name", "employee_name", "last_employee_name"],
    )
    code = (
        plans.select(F.col("id").alias("first_id"), "discount_code_id")
        .join(discount_codes.select(F.col("id").alias("discount_code_id"), "code"), "discount_code_id", "left")
        .select("first_id", "code")
    )
    hot = large.of("flows.user")
    running_on = F.col("last_id") == -1
    gone = F.col("_open_id").isNull() & F.col("end_date").isNull()
    joined = (
        # joins on the user come last: the grouping and the window below then
        # find the rows already partitioned by user
        flows.drop("last_name")
        .join(sale, "first_id", "left")
        .join(code, "first_id", "left")
        .join(users.select(F.col("id").alias("user_id"), "last_name"), "user_id", "left")
        .join(live, "user_id", "left")
        .join(ended, "user_id", "left")
        .join(flows.groupBy("user_id").agg(F.max("start_date").alias("_last_start")), "user_id", "left")
        .select(
            "user_id", "name", "last_name", "phone", "email", "birthday", "sex", "first_id",
            F.when(running_on, F.col("_open_id")).otherwise(F.col("last_id")).alias("last_id"),
            "sport_experience",
            "first_payment_plan_name",
            F.when(running_on, F.col("_open_plan")).otherwise(F.col("last_payment_plan_name")).alias("last_payment_plan_name"),
            "discount_name",
            first_label(F.col("discount_name"), c.CAMPAIGN_RULES).alias("discount_name_new"),
            "code",
            "inflow_club_name",
            F.when(running_on, F.col("_open_club")).otherwise(F.col("outflow_club_name")).alias("outflow_club_name"),
            F.when(gone, F.col("_ended_status")).otherwise(F.col("status")).alias("status"),
            F.when(running_on, "-").otherwise(F.col("cancel_reason")).alias("cancel_reason"),
            F.col("is_new").alias("_new"),
            "start_date",
            "start_training_date",
            F.when(gone, F.lit(as_of)).otherwise(F.col("end_date")).alias("end_date"),
            "discount_amount",
            "membership_fee",
            "qty_plans",
            "user_status",
            F.when(F.col("start_date") == F.col("_last_start"), 1).otherwise(0).alias("pp_attribute"),
            "gate_name",
            "employee_name",
            "last_employee_name",
            month_start(F.col("end_date")).alias("end_date_value"),
        )
    )
    rows = joined.groupBy(*[n for n in joined.columns if n != "_new"]).agg(F.min("_new").alias("_new"))
    chained = neighbours(rows, ["user_id"], ["start_date", "first_id"], lag={"_prev_end": "end_date"}, hot=hot)
    gap = days_between(F.coalesce("_prev_end", F.lit(dt.date(1970, 1, 1))), F.col("start_date"))
    return chained.withColumn(
        "is_new",
        F.when(F.col("_new") == 1, c.NEW_CLIENT)
        .when(gap <= c.RETURN_DAYS, c.RETURNED_SOON)
        .otherwise(c.RETURNED_LATE),
    ).drop("_new", "_prev_end")
