"""The three dimensions.

All of them read the cleaned events with the copies still in: a copy of an event adds no hour and no user, and the
product rule orders copies just as the de-duplication does. So no dimension pays for the de-duplication shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickloom import schemas as S
from clickloom.functions.calendar import sunday_week
from clickloom.functions.keys import surrogate_key, timestamp_text
from clickloom.plans import staging


def product_sk() -> Column:
    return surrogate_key(F.col("product_id"))


def user_sk() -> Column:
    return surrogate_key(F.col("user_id"))


def datetime_sk() -> Column:
    return surrogate_key(timestamp_text(F.col("datetime_hour_utc")))


def dim_datetime(events: DataFrame) -> DataFrame:
    """One row per hour with at least one event."""
    hour = F.col("datetime_hour_utc")
    day = F.col("date_utc")
    hours = events.select(F.date_trunc("HOUR", "event_time").alias("datetime_hour_utc")).distinct()
    return (
        hours.withColumn("date_utc", F.to_date(hour))
        .select(
            hour,
            datetime_sk().alias("datetime_sk"),
            day,
            F.year(day).alias("year_utc"),
            F.month(day).alias("month_utc"),
            F.dayofmonth(day).alias("day_utc"),
            F.hour(hour).alias("hour_utc"),
            F.date_format(day, "EEEE").alias("day_name_utc"),
            F.date_format(day, "EEE").alias("day_name_short_utc"),
            F.dayofweek(day).alias("day_of_week_utc"),
            F.dayofyear(day).alias("day_of_year_utc"),
            sunday_week(day).alias("week_of_year_utc"),
            F.quarter(day).alias("quarter_of_year_utc"),
            F.date_format(hour, "yyyy-MM").alias("year_month_utc"),
        )
        .orderBy("datetime_hour_utc")
    )


def product_events(events: DataFrame) -> DataFrame:
    """What the events say about products, with all that decides which one is the latest."""
    known = events.where(F.col("product_id").isNotNull())
    return known.select("product_id", "event_time", staging.event_key().alias("event_sk"), *S.SURVIVOR_ORDER)


def latest_per_product(rows: DataFrame) -> DataFrame:
    """The latest row of each product; at equal times the greatest event key wins, then the survivor order.

    "Latest" is taken as the smallest of (minus time, key with its hex digits mirrored, survivor order), so that one
    ``min`` settles the time, the tie and the copies, folded per task before the shuffle. Latest rows of parts of the
    events may be combined the same way.
    """
    mirrored = F.translate("event_sk", "0123456789abcdef", "fedcba9876543210")
    rank = F.struct((-F.unix_micros("event_time")).alias("age"), mirrored.alias("mirrored"), *S.SURVIVOR_ORDER)
    latest = rows.groupBy("product_id").agg(F.min(rank).alias("latest"))
    return latest.select(
        "product_id",
        F.timestamp_micros(-F.col("latest.age")).alias("event_time"),
        F.translate("latest.mirrored", "0123456789abcdef", "fedcba9876543210").alias("event_sk"),
        *[F.col(f"latest.{name}") for name in S.SURVIVOR_ORDER],
    )


def describe_products(latest: DataFrame) -> DataFrame:
    return latest.select(
        "product_id",
        product_sk().alias("product_sk"),
        F.col("category_id").cast(S.CATEGORY_TYPE).alias("category_id"),
        staging.category_code().alias("category_code"),
        staging.product_brand().alias("product_brand"),
    )


def dim_products(events: DataFrame) -> DataFrame:
    """One row per product with the attributes of its latest event."""
    return describe_products(latest_per_product(product_events(events)))


def dim_users(events: DataFrame) -> DataFrame:
    """One row per user; each key is hashed once, after the distinct."""
    users = events.select("user_id").where(F.col("user_id").isNotNull()).distinct()
    return users.select("user_id", user_sk().alias("user_sk"))
