"""Table schemas and the values that the stored data depends on."""

from __future__ import annotations

from pyspark.sql import types as T

CATEGORY_TYPE = T.DecimalType(38, 9)

# ---- Fixed values: part of the data contract, so they must not change ----
NULL_KEY_TOKEN = "_dbt_utils_surrogate_key_null_"
KEY_SEPARATOR = "-"
UNKNOWN_SESSION = "unknown_session"
UNKNOWN_EVENT_TYPE = "unknown_event_type"
UNKNOWN_CATEGORY = "N/A"
UNKNOWN_BRAND = "Unknown"
DEFAULT_PRICE = 0.0
UNKNOWN_MEMBER = "-1"
EVENT_TYPES = ("view", "cart", "remove_from_cart", "purchase")
MONTH_LABELS = ("Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec")
# --------------------------------------------------------------------------

#: Day of the event, stored as the partition column of the history and of the fact.
DAY = "event_date"

RAW = T.StructType(
    [
        T.StructField("event_time", T.TimestampType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("product_id", T.LongType()),
        T.StructField("category_id", CATEGORY_TYPE),
        T.StructField("category_code", T.StringType()),
        T.StructField("brand", T.StringType()),
        T.StructField("price", T.DoubleType()),
        T.StructField("user_id", T.LongType()),
        T.StructField("user_session", T.StringType()),
    ]
)

#: Columns that identify one raw event, in the order in which they enter its surrogate key.
EVENT_KEY = ("user_session", "event_time", "event_type", "product_id", "user_id")

#: Which of several copies of one event survives: the smallest, compared in this order, NULLs first.
SURVIVOR_ORDER = ("price", "brand", "category_code", "category_id")

DIM_DATETIME = T.StructType(
    [
        T.StructField("datetime_hour_utc", T.TimestampType()),
        T.StructField("datetime_sk", T.StringType()),
        T.StructField("date_utc", T.DateType()),
        T.StructField("year_utc", T.IntegerType()),
        T.StructField("month_utc", T.IntegerType()),
        T.StructField("day_utc", T.IntegerType()),
        T.StructField("hour_utc", T.IntegerType()),
        T.StructField("day_name_utc", T.StringType()),
        T.StructField("day_name_short_utc", T.StringType()),
        T.StructField("day_of_week_utc", T.IntegerType()),
        T.StructField("day_of_year_utc", T.IntegerType()),
        T.StructField("week_of_year_utc", T.IntegerType()),
        T.StructField("quarter_of_year_utc", T.IntegerType()),
        T.StructField("year_month_utc", T.StringType()),
    ]
)

DIM_PRODUCTS = T.StructType(
    [
        T.StructField("product_id", T.LongType()),
        T.StructField("product_sk", T.StringType()),
        T.StructField("category_id", CATEGORY_TYPE),
        T.StructField("category_code", T.StringType()),
        T.StructField("product_brand", T.StringType()),
    ]
)

#: The latest event of each product, from which its dimension is described and later updated.
PRODUCT_LATEST = T.StructType(
    [
        T.StructField("product_id", T.LongType()),
        T.StructField("event_time", T.TimestampType()),
        T.StructField("event_sk", T.StringType()),
        T.StructField("price", T.DoubleType()),
        T.StructField("brand", T.StringType()),
        T.StructField("category_code", T.StringType()),
        T.StructField("category_id", CATEGORY_TYPE),
    ]
)

#: Months whose events are in the history and in the star schema, and who took them in: ``run`` or ``stream``.
FINISHED_MONTHS = T.StructType([T.StructField("month", T.StringType()), T.StructField("taken_by", T.StringType())])

#: Column of the history that tells which ingest a row came with; NULL in rows that something else wrote.
INGEST = "ingest_id"

#: The ingests of the history and the days that they have rows of; each is entered in one step with its rows.
INGESTS = T.StructType([T.StructField(INGEST, T.StringType()), T.StructField("day", T.DateType())])

#: Ingests that the dimensions have taken in.
DIM_INGESTS = T.StructType([T.StructField(INGEST, T.StringType())])

#: What happened to each product on each day, and in each hour.
DAILY_PRODUCTS = T.StructType(
    [
        T.StructField("product_sk", T.StringType()),
        T.StructField("n_views", T.LongType()),
        T.StructField("n_carts", T.LongType()),
        T.StructField("n_purchases", T.LongType()),
        T.StructField("revenue", T.DecimalType(28, 2)),
    ]
)
DAILY_HOURS = T.StructType(
    [
        T.StructField("datetime_sk", T.StringType()),
        T.StructField("n_purchases", T.LongType()),
        T.StructField("revenue", T.DecimalType(28, 2)),
    ]
)

#: First times of each session's events in microseconds.
SESSION_STATE = T.StructType(
    [T.StructField("user_session_id", T.StringType()), *[T.StructField(n, T.LongType()) for n in ("view", "cart", "purchase")]]
)

DIM_USERS = T.StructType(
    [
        T.StructField("user_id", T.LongType()),
        T.StructField("user_sk", T.StringType()),
    ]
)

FCT_EVENTS = T.StructType(
    [
        T.StructField("product_sk", T.StringType()),
        T.StructField("user_sk", T.StringType()),
        T.StructField("datetime_sk", T.StringType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("user_session_id", T.StringType()),
        T.StructField("event_price", T.DoubleType()),
        T.StructField("event_at_utc", T.TimestampType()),
        T.StructField("event_sk", T.StringType()),
    ]
)


def with_day(schema: T.StructType) -> T.StructType:
    """The stored form of a day-partitioned table."""
    return T.StructType([*schema.fields, T.StructField(DAY, T.DateType())])
