"""Cleaned and de-duplicated events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickloom import schemas as S
from clickloom.functions.keys import surrogate_key, timestamp_text
from clickloom.operators.dedup import smallest_per_key


def clean(raw: DataFrame) -> DataFrame:
    """Raw events that have a user, a product and a time; copies included."""
    return raw.select(*S.RAW.names).where(
        F.col("user_id").isNotNull() & F.col("product_id").isNotNull() & F.col("event_time").isNotNull()
    )


def deduplicate(events: DataFrame) -> DataFrame:
    """One row per raw event key. The time is part of the key, so a filter on it moves below the shuffle."""
    return smallest_per_key(events, S.EVENT_KEY, S.SURVIVOR_ORDER)


def event_key() -> Column:
    """Surrogate key of a raw event, from its columns as they came (a NULL session is not yet named)."""
    return surrogate_key(*[timestamp_text(F.col(c)) if c == "event_time" else F.col(c) for c in S.EVENT_KEY])


def category_code() -> Column:
    return F.coalesce(F.col("category_code"), F.lit(S.UNKNOWN_CATEGORY))


def product_brand() -> Column:
    return F.coalesce(F.col("brand"), F.lit(S.UNKNOWN_BRAND))


def stg_ecom_events(raw: DataFrame) -> DataFrame:
    """Staged events: filtered, one row per event key, named defaults for NULLs, and the event's surrogate key."""
    return deduplicate(clean(raw)).select(
        F.col("user_id").cast("bigint").alias("user_id"),
        F.col("product_id").cast("bigint").alias("product_id"),
        F.col("category_id").cast(S.CATEGORY_TYPE).alias("category_id"),
        F.coalesce(F.col("user_session"), F.lit(S.UNKNOWN_SESSION)).alias("user_session_id"),
        F.col("event_time").cast("timestamp").alias("event_at_utc"),
        F.coalesce(F.col("event_type"), F.lit(S.UNKNOWN_EVENT_TYPE)).alias("event_type"),
        category_code().alias("category_code"),
        product_brand().alias("product_brand"),
        F.coalesce(F.col("price"), F.lit(S.DEFAULT_PRICE)).cast("double").alias("event_price"),
        event_key().alias("event_sk"),
    )
