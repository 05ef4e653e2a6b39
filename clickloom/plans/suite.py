"""All checks of the pipeline in one result."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame

from clickloom import schemas as S
from clickloom.operators import quality
from clickloom.session import Scratch

# ---- Fixed values: which column has which check is part of the data contract ----
RESULT = "table_name string, column_name string, check_name string, failures bigint"
NOT_NULL = {
    "ecom_events": ("event_time", "product_id", "user_id"),
    "dim_datetime": ("datetime_sk", "datetime_hour_utc"),
    "dim_products": ("product_sk", "product_id", "product_brand"),
    "dim_users": ("user_sk", "user_id"),
    "fct_events": ("event_sk", "product_sk", "user_sk", "datetime_sk", "event_type", "event_at_utc"),
}
UNIQUE = {
    "dim_datetime": ("datetime_sk", "datetime_hour_utc"),
    "dim_products": ("product_sk", "product_id"),
    "dim_users": ("user_sk", "user_id"),
    "fct_events": ("event_sk",),
}
ACCEPTED = {("fct_events", "event_type"): S.EVENT_TYPES}
RELATIONSHIPS = {
    ("fct_events", "product_sk"): ("dim_products", "product_sk"),
    ("fct_events", "user_sk"): ("dim_users", "user_sk"),
    ("fct_events", "datetime_sk"): ("dim_datetime", "datetime_sk"),
}


def _named(table: str, column: str, check: str, counts: DataFrame) -> DataFrame:
    return counts.selectExpr(
        f"'{table}' AS table_name", f"{column} AS column_name", f"'{check}' AS check_name", "failures"
    )


def _rows(failing: DataFrame) -> DataFrame:
    return failing.selectExpr("count(*) AS failures")


def run_day_checks(tables: dict[str, DataFrame], scratch: Scratch) -> DataFrame:
    """The checks of the fact whose failures add up over days: repeated keys, as copies share a day, and orphans.

    Intermediate tables belong to ``scratch``.
    """
    results = []
    for column in UNIQUE["fct_events"]:
        failing = quality.unique_by_hash(tables["fct_events"], column, scratch.hold)
        results.append(_named("fct_events", f"'{column}'", "unique", _rows(failing)))
    for (table, column), (parent, field) in RELATIONSHIPS.items():
        failing = quality.relationships(tables[table], column, tables[parent], field)
        orphans = failing.selectExpr("coalesce(sum(n_records), 0) AS failures")
        results.append(_named(table, f"'{column}'", "relationships", orphans))
    return reduce(DataFrame.union, results)


def run_checks(tables: dict[str, DataFrame], day_checks: DataFrame) -> DataFrame:
    """``table_name, column_name, check_name, failures`` of the 27 checks; a check passes with 0 failures.

    Failures are NULL rows, repeated values, unaccepted values, and rows without a parent. One scan per table serves
    all its not-null checks; every other check reads its own column only. ``day_checks`` are the results of
    :func:`run_day_checks`, added up if these were run a part of the days at a time.
    """
    results = []
    for table, columns in NOT_NULL.items():
        results.append(_named(table, "column_name", "not_null", quality.null_counts(tables[table], columns)))
    for table, columns in UNIQUE.items():
        if table != "fct_events":
            for column in columns:
                results.append(_named(table, f"'{column}'", "unique", _rows(quality.unique(tables[table], column))))
    for (table, column), values in ACCEPTED.items():
        failing = quality.accepted_values(tables[table], column, values)
        results.append(_named(table, f"'{column}'", "accepted_values", _rows(failing)))
    results.append(day_checks)
    return reduce(DataFrame.union, results)
