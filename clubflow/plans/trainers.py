"""Trainer pay per class."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clubflow import config as c
from clubflow.functions.dates import minutes_between, ntz
from clubflow.functions.text import like_any, phone_plus7


def fold_city(name: Column) -> Column:
    """Satellite towns count as the metropolis."""
    return F.when(name.isin(*c.METRO_SATELLITES), c.METRO_CITY).otherwise(name)


def club_city(club: Column, brand: str) -> Column:
    """City in a club name of the form '<brand> <city> …'; '' when there is none.

    The Cyrillic letter that looks like X is read as X.
    """
    return F.regexp_extract(F.replace(club, F.lit("Х"), F.lit("X")), rf"^{brand} ([\p{{L}}-]+)", 1)


def _filled(name: str) -> Column:
    return F.nullif(F.col(name), F.lit(""))


def trainer_types(users: DataFrame, metro: DataFrame, region: DataFrame) -> DataFrame:
    """Trainer id, phone, name and type from the users table and the two lists.

    Rows meet by phone first, then by id; the first non-empty value wins, metro
    list before region list. Users in neither list can not get a type, so only
    users named in a list (by phone or id) enter the full joins.
    """

    def listed(df: DataFrame, prefix: str, drop_spaces: bool) -> DataFrame:
        return df.where((F.col("name") != "") & (F.col("phone") != "") & F.col("id").isNotNull()).select(
            F.col("id").alias(f"{prefix}_id"),
            phone_plus7(F.col("phone"), drop_spaces).alias(f"{prefix}_phone"),
            F.col("name").alias(f"{prefix}_name"),
            F.col("category").alias(f"{prefix}_type"),
        )

    m, r = listed(metro, "m", True), listed(region, "r", False)
    phones = m.select(F.col("m_phone").alias("phone")).union(r.select("r_phone")).distinct()
    ids = m.select(F.col("m_id").alias("id")).union(r.select("r_id")).distinct()
    people = users.select("id", "phone")
    named = (
        people.join(phones, "phone", "left_semi")
        .unionByName(people.join(ids, "id", "left_semi"))
        .distinct()
        .select(F.col("id").alias("u_id"), F.col("phone").alias("u_phone"))
    )
    by_phone = (
        named.join(m, F.col("u_phone") == F.col("m_phone"), "full")
        .join(r, F.col("u_phone") == F.col("r_phone"), "full")
        .select(
            F.coalesce("u_id", "m_id", "r_id").alias("id"),
            F.coalesce(_filled("m_phone"), _filled("r_phone")).alias("phone"),
            F.coalesce(_filled("m_name"), _filled("r_name")).alias("name"),
            F.coalesce(_filled("m_type"), _filled("r_type")).alias("type"),
        )
    )
    by_id = by_phone.join(m, F.col("id") == F.col("m_id"), "full").join(r, F.col("id") == F.col("r_id"), "full")
    return (
        by_id.select(
            F.coalesce("id", "m_id", "r_id").alias("id"),
            F.coalesce(F.nullif(_filled("phone"), F.lit("+7")), _filled("m_phone")).alias("phone"),
            F.coalesce(_filled("name"), _filled("m_name")).alias("name"),
            F.coalesce(_filled("type"), _filled("m_type")).alias("type"),
        )
        .where(F.col("phone").isNotNull() & F.col("name").isNotNull() & F.col("type").isNotNull())
        .distinct()
    )


def pay_rate(category: Column, minutes: Column, training: Column, trainer_type: Column) -> Column:
    """The rate column that applies to a class, first rule that holds."""
    strength = category == c.STRENGTH_CATEGORY
    intensive = like_any(training, c.INTENSIVE_PATTERNS)
    star = trainer_type == c.STAR_CYCLE_TRAINER
    rate = F.col
    return (
        F.when(strength & minutes.isin(30, 55) & intensive, rate("mk_55"))
        .when(strength & (minutes == 30), rate("mk_30"))
        .when(strength & (minutes == 55), rate("mk_55"))
        .when(strength & (minutes == 90), rate("mk_90"))
        .when(like_any(training, c.YOGA_PATTERNS), rate("yoga"))
        .when(like_any(training, c.SPRINT_PATTERNS) & star, rate("cycle"))
        .when(intensive, rate("grit"))
        .when(like_any(training, c.CYCLE_PATTERNS) & star, rate("cycle"))
        .when(minutes == 30, rate("`30`"))
        .when(minutes == 45, rate("`45`"))
        .when(minutes == 55, rate("`55`"))
    )


def trainer_pay(
    timetables: DataFrame,
    trainings: DataFrame,
    categories: DataFrame,
    class_employees: DataFrame,
    clubs: DataFrame,
    cities: DataFrame,
    employees: DataFrame,
    users: DataFrame,
    metro: DataFrame,
    region: DataFrame,
    rates: DataFrame,
    start: dt.datetime = c.PAY_FROM,
    unpaid: tuple[str, ...] = c.UNPAID_CATEGORIES,
) -> DataFrame:
    """Pay of every trainer for every class from ``start`` on."""
    place = clubs.select(
        F.col("id").alias("club_id"), F.col("name").alias("club_name"), F.col("city_id").alias("_city")
    ).join(cities.select(F.col("id").alias("_city"), fold_city(F.col("name")).alias("city_name")), "_city")
    kind = trainings.select(
        F.col("id").alias("group_training_id"),
        F.col("name").alias("training_name"),
        F.col("group_training_category_id").alias("_category"),
    ).join(
        categories.where(~F.col("name").isin(*unpaid)).select(
            F.col("id").alias("_category"), F.col("name").alias("category_name")
        ),
        "_category",
    )
    who = employees.select(F.col("id").alias("employee_id"), F.col("user_id").alias("trainer_id")).join(
        users.select(
            F.col("id").alias("trainer_id"),
            F.col("last_name").alias("trainer_last_name"),
            F.col("name").alias("trainer_name"),
        ),
        "trainer_id",
    )
    classes = (
        timetables.where(~F.col("is_deleted") & (F.col("start_time") >= ntz(start)))
        .select(F.col("id").alias("timetable_id"), "group_training_id", "club_id", "start_time", "end_time")
        .join(
            class_employees.select(F.col("group_training_time_table_id").alias("timetable_id"), "employee_id"),
            "timetable_id",
        )
        .join(kind, "group_training_id")
        .join(place, "club_id")
        .join(who, "employee_id")
        .withColumn("duration", minutes_between(F.col("start_time"), F.col("end_time")))
    )
    types = trainer_types(users, metro, region).select(F.col("id").alias("trainer_id"), F.col("type").alias("trainer_type"))
    paid = classes.join(types, "trainer_id", "left").join(
        rates.withColumnRenamed("city", "city_name"), ["trainer_type", "city_name"], "left"
    )
    salary = pay_rate(F.col("_category"), F.col("duration"), F.col("training_name"), F.col("trainer_type"))
    return paid.select(
        "timetable_id", "training_name", "club_name", "city_name", "category_name", "trainer_type",
        "trainer_id", "trainer_last_name", "trainer_name", "start_time", "duration",
        F.coalesce(salary, F.lit(0)).alias("salary"),
    ).distinct()
