from __future__ import annotations

import hashlib
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from clickloom.functions.calendar import sunday_week
from clickloom.functions.keys import surrogate_key, timestamp_text
from clickloom.operators.dedup import smallest_per_key
from clickloom.plans import dims, staging
from clickloom.schemas import EVENT_KEY, NULL_KEY_TOKEN, RAW, SURVIVOR_ORDER
from clickloom.sources import samples


def staged(raw):
    return staging.stg_ecom_events(raw).collect()


def test_near_copies_keep_the_smallest(raw_rows):
    rows = staged(raw_rows({"price": 7.0}, {"price": 5.0}, {"price": 5.0, "brand": "zeta"}))
    assert [(r.event_price, r.product_brand) for r in rows] == [(5.0, "acme")]


def test_null_price_is_the_smallest(raw_rows):
    assert [r.event_price for r in staged(raw_rows({"price": 5.0}, {"price": None}))] == [0.0]


def test_null_session_is_one_group_and_hashes_as_null(raw_rows):
    rows = staged(raw_rows({"user_session": None}, {"user_session": None}))
    text = f"{NULL_KEY_TOKEN}-2020-01-05 10:20:30+00-view-1-2"
    assert [(r.user_session_id, r.event_sk) for r in rows] == [
        ("unknown_session", hashlib.md5(text.encode()).hexdigest())
    ]


@pytest.mark.parametrize("column", ["user_id", "product_id", "event_time"])
def test_rows_without_a_key_are_dropped(raw_rows, column):
    assert staged(raw_rows({column: None})) == []


def test_defaults_and_empty_strings(raw_rows):
    blank = {"event_type": None, "category_code": None, "brand": None, "category_id": None}
    first, second = sorted(staged(raw_rows(blank, {"brand": "", "user_id": 3})), key=lambda r: r.user_id)
    assert (first.event_type, first.category_code, first.product_brand) == ("unknown_event_type", "N/A", "Unknown")
    assert first.category_id is None
    assert second.product_brand == ""


def test_time_text_has_as_few_fraction_digits_as_needed(spark):
    times = ["2020-01-02 03:04:05", "2020-01-02 03:04:05.12", "2020-01-02 03:04:05.1234"]
    rows = spark.createDataFrame([(t,) for t in [*times, None]], "t string")
    texts = [r[0] for r in rows.select(timestamp_text(F.col("t").cast("timestamp"))).collect()]
    assert texts == [
        "2020-01-02 03:04:05+00",
        "2020-01-02 03:04:05.120+00",
        "2020-01-02 03:04:05.123400+00",
        None,
    ]


def test_key_of_one_number(spark):
    assert spark.range(42, 43).select(surrogate_key(F.col("id"))).first()[0] == hashlib.md5(b"42").hexdigest()


def test_weeks_start_on_sunday_all_days_of_many_years(spark):
    days = spark.sql("SELECT explode(sequence(DATE'2015-01-01', DATE'2030-12-31')) AS d")
    rows = days.select("d", sunday_week(F.col("d"))).collect()
    assert len(rows) == 5844
    assert [r[1] for r in rows] == [int(r[0].strftime("%U")) for r in rows]


def test_big_category_is_an_error(raw_rows):
    with pytest.raises(Exception, match="NUMERIC_VALUE_OUT_OF_RANGE"):
        raw_rows({"category_id": "1" * 30}).collect()


def test_staging_twice_the_same_input_changes_nothing(spark, samples_folder):
    raw = samples.clickstream(spark, samples_folder)
    once, twice = staging.stg_ecom_events(raw), staging.stg_ecom_events(raw.unionByName(raw))
    assert sorted(map(tuple, once.collect()), key=str) == sorted(map(tuple, twice.collect()), key=str)


def test_dimensions_do_not_need_the_deduplication(spark, samples_folder):
    events = staging.clean(samples.clickstream(spark, samples_folder))
    single = staging.deduplicate(events).select(*RAW.names)
    for build in (dims.dim_datetime, dims.dim_products, dims.dim_users):
        assert sorted(map(str, build(events).collect())) == sorted(map(str, build(single).collect()))


def test_latest_attributes_win(raw_rows):
    rows = raw_rows(
        {"brand": "late", "event_time": "2020-01-06 00:00:00"},
        {"brand": "early", "event_time": "2020-01-05 00:00:00"},
        {"brand": "copy", "price": 9.0, "event_time": "2020-01-06 00:00:00"},
    )
    assert [r.product_brand for r in dims.dim_products(rows).collect()] == ["late"]


def test_equal_times_take_the_greatest_key(raw_rows):
    rows = raw_rows(*[{"user_id": n, "brand": f"b{n}"} for n in range(20)])
    best = max(staged(rows), key=lambda r: r.event_sk)
    assert [r.product_brand for r in dims.dim_products(rows).collect()] == [best.product_brand]


def test_hot_key_is_folded_before_the_shuffle(spark):
    """A third of all rows are copies of one event; each task hands on one row of it."""
    rows = spark.range(0, 30_000, 1, 6).select(
        F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).alias("k"), (F.col("id") % 7).alias("v")
    )
    result = smallest_per_key(rows, ["k"], ["v"])
    assert result.count() == 20_001
    assert result.where("k = -1").first().v == 0
    plan = result._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Aggregate") >= 2 and "Window" not in plan


def test_time_filter_moves_below_the_deduplication(spark, samples_folder, tmp_path):
    path = str(tmp_path / "raw")
    samples.clickstream(spark, samples_folder).write.parquet(path)
    recent = staging.stg_ecom_events(spark.read.parquet(path)).where(
        F.col("event_at_utc") > F.lit(datetime(2024, 1, 20)).cast("timestamp")
    )
    assert "PushedFilters" in (plan := recent._jdf.queryExecution().executedPlan().toString())
    assert "GreaterThan(event_time" in plan


def test_key_columns_are_all_raw_columns():
    assert set(EVENT_KEY) | set(SURVIVOR_ORDER) == set(RAW.names)
