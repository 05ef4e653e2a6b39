"""The event fact."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickloom import schemas as S
from clickloom.plans import dims


@dataclass(frozen=True)
class Link:
    """How events find their row of a dimension: the shared key, the surrogate key, and the latter's formula."""

    key: str
    sk: str
    formula: Callable[[], Column]


LINKS = {
    "dim_products": Link("product_id", "product_sk", dims.product_sk),
    "dim_users": Link("user_id", "user_sk", dims.user_sk),
    "dim_datetime": Link("datetime_hour_utc", "datetime_sk", dims.datetime_sk),
}


def with_hour(events: DataFrame, time: str) -> DataFrame:
    """Adds the key of the datetime dimension."""
    return events.withColumn("datetime_hour_utc", F.date_trunc("HOUR", time))


def fact_columns(linked: DataFrame) -> DataFrame:
    """The fact's columns, without the surrogate keys of dimensions that were not linked."""
    return linked.select(*[name for name in S.FCT_EVENTS.names if name in linked.columns])


def high_water_mark(fact: DataFrame) -> int | None:
    """Time of the newest row in microseconds, or None if there is no row."""
    return fact.agg(F.unix_micros(F.max("event_at_utc"))).first()[0]


def newer_than(raw: DataFrame, mark: int) -> DataFrame:
    """Raw events strictly after ``mark``, which is a literal and so reaches the scan."""
    return raw.where(F.col("event_time") > F.timestamp_micros(F.lit(mark)))
