"""The figures that FIXTURES.md gives for the sample at sf0.01."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from clickloom import registry
from clickloom.plans import dims, pipeline, reports, staging
from clickloom.schemas import UNKNOWN_MEMBER
from clickloom.sources import samples

FOLDER = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def clickstream(spark):
    return samples.clickstream(spark, FOLDER)


@pytest.fixture(scope="module")
def order_lines(spark):
    return samples.order_lines(spark, FOLDER)


def test_row_counts(clickstream):
    events = staging.clean(clickstream)
    staged = staging.stg_ecom_events(clickstream)
    assert (clickstream.count(), events.count(), staged.count()) == (10_500, 8_953, 8_527)
    assert staged.select("event_sk").distinct().count() == 8_527
    counts = [build(events).count() for build in (dims.dim_datetime, dims.dim_products, dims.dim_users)]
    assert counts == [720, 100, 150]


def test_staged_by_type(clickstream):
    rows = (
        staging.stg_ecom_events(clickstream)
        .groupBy("event_type")
        .agg(F.count("*"), reports.cents(F.col("event_price")).cast("double"))
        .collect()
    )
    assert {r[0]: tuple(r[1:]) for r in rows} == {
        "cart": (1_714, 80_756.95),
        "purchase": (1_662, 73_999.78),
        "remove_from_cart": (1_726, 79_086.93),
        "view": (1_709, 76_224.23),
        "unknown_event_type": (1_716, 79_875.20),
    }


def test_defaults_and_nulls(clickstream):
    conditions = [
        "user_session_id = 'unknown_session'",
        "product_brand = 'Unknown'",
        "category_code = 'N/A'",
        "event_price = 0",
        "event_at_utc < '2024-01-21'",
    ]
    staged = staging.stg_ecom_events(clickstream).agg(*[F.count_if(F.expr(c)) for c in conditions]).first()
    assert tuple(staged) == (853, 1_217, 1_706, 655, 5_699)
    nulls = [F.count_if(F.col(c).isNull()) for c in ("event_time", "product_id", "user_id")]
    assert tuple(clickstream.agg(*nulls).first()) == (619, 554, 457)


def test_unknown_members(spark, clickstream):
    rows = pipeline.link_events(registry.known_members(spark, clickstream), clickstream)
    unknown = [F.count_if(F.col(c) == UNKNOWN_MEMBER) for c in ("product_sk", "user_sk", "datetime_sk")]
    assert tuple(rows.agg(*unknown).first()) == (4_301, 4_256, 4_276)


def test_sessions_with_each_step(clickstream):
    staged = staging.stg_ecom_events(clickstream).where("user_session_id <> 'unknown_session'")
    per_step = staged.groupBy("event_type").agg(F.countDistinct("user_session_id")).collect()
    counts = {r[0]: r[1] for r in per_step}
    assert (counts["view"], counts["cart"], counts["purchase"]) == (1_326, 1_291, 1_280)


def test_order_lines(order_lines):
    events = staging.clean(order_lines)
    assert (order_lines.count(), staging.stg_ecom_events(order_lines).count()) == (60_000, 60_000)
    counts = [build(events).count() for build in (dims.dim_datetime, dims.dim_products, dims.dim_users)]
    assert counts == [2_499, 2_000, 1_500]
    kinds = {r[0]: r[1] for r in order_lines.groupBy("event_type").count().collect()}
    assert kinds == {"cart": 20_028, "purchase": 19_926, "remove_from_cart": 20_046}
    assert order_lines.select(F.date_format("event_time", "yyyy-MM")).distinct().count() == 83


def test_most_purchased_products(spark):
    top = registry.top_products(spark, FOLDER).limit(3).collect()
    assert [(r.product_id, r.n_purchases) for r in top] == [(444, 22), (626, 21), (1139, 21)]
