"""Answers of the star schema: popular products, behaviour before a purchase, sales by time."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickloom.schemas import UNKNOWN_SESSION


def cents(price: Column) -> Column:
    """Exact sum of prices."""
    return F.sum(price.cast("decimal(18,2)"))


def product_counts(fact: DataFrame, *by: str) -> DataFrame:
    """Views, carts, purchases and revenue of the fact rows, by product and what else is named."""
    kind = F.col("event_type")
    return fact.groupBy(*by, "product_sk").agg(
        F.count_if(kind == "view").alias("n_views"),
        F.count_if(kind == "cart").alias("n_carts"),
        F.count_if(kind == "purchase").alias("n_purchases"),
        F.coalesce(cents(F.when(kind == "purchase", F.col("event_price"))), F.lit(0)).cast("decimal(28,2)").alias("revenue"),
    )


def ranked_products(counts: DataFrame, dim_products: DataFrame, k: int) -> DataFrame:
    """The ``k`` products with the most purchases, of one row per product."""
    counts = counts.withColumnRenamed("product_sk", "_product_sk")
    return (
        dim_products.join(counts, F.col("product_sk") == F.col("_product_sk"))
        .withColumn("revenue", F.col("revenue").cast("double"))
        .select("product_id", "product_brand", "category_code", "n_views", "n_carts", "n_purchases", "revenue")
        .orderBy(F.desc("n_purchases"), "product_id")
        .limit(k)
    )


def top_products(fact: DataFrame, dim_products: DataFrame, k: int = 20) -> DataFrame:
    """The ``k`` products with the most purchases. Counted per key first, so the join meets one row per product."""
    return ranked_products(product_counts(fact), dim_products, k)


def top_products_of_days(daily_products: DataFrame, dim_products: DataFrame, k: int = 20) -> DataFrame:
    """:func:`top_products` from the daily sums."""
    sums = [F.sum(name).alias(name) for name in ("n_views", "n_carts", "n_purchases", "revenue")]
    return ranked_products(daily_products.groupBy("product_sk").agg(*sums), dim_products, k)


def session_times(fact: DataFrame) -> DataFrame:
    """When each known session first had a view, a cart and a purchase, in microseconds."""

    def first(kind: str) -> Column:
        return F.min(F.when(F.col("event_type") == kind, F.unix_micros("event_at_utc"))).alias(kind)

    known = fact.where(F.col("user_session_id") != UNKNOWN_SESSION)
    return known.groupBy("user_session_id").agg(first("view"), first("cart"), first("purchase"))


def earlier_times(sessions: DataFrame, more: DataFrame) -> DataFrame:
    """First times of sessions from those of two parts of the fact; a part may be given again."""
    firsts = [F.min(name).alias(name) for name in ("view", "cart", "purchase")]
    return sessions.unionByName(more).groupBy("user_session_id").agg(*firsts)


def purchase_funnel(fact: DataFrame) -> DataFrame:
    """One row: how many known sessions reached a view, then a cart, then a purchase, and how fast."""
    return funnel_of_sessions(session_times(fact))


def funnel_of_sessions(sessions: DataFrame) -> DataFrame:
    """:func:`purchase_funnel` from the sessions' first times."""
    view, cart, purchase = F.col("view"), F.col("cart"), F.col("purchase")
    lead = F.when(purchase > view, purchase - view)
    return sessions.agg(
        F.count("*").alias("n_sessions"),
        F.count_if(view.isNotNull()).alias("n_view"),
        F.count_if(cart >= view).alias("n_view_then_cart"),
        F.count_if((purchase >= cart) & (cart >= view)).alias("n_view_cart_purchase"),
        F.count_if(purchase.isNotNull() & view.isNull()).alias("n_purchase_without_view"),
        # 64 bits of microseconds overflow after some 10^8 sessions with a lead of a day.
        (F.sum(lead.cast("decimal(28,0)")).cast("double") / F.count(lead) / 1e6).alias("avg_seconds_view_to_purchase"),
    )


def hour_sales(fact: DataFrame, *by: str) -> DataFrame:
    """Purchases and revenue of the fact rows, by stored hour and what else is named."""
    bought = fact.where(F.col("event_type") == "purchase")
    sums = cents(F.col("event_price")).cast("decimal(28,2)").alias("revenue")
    return bought.groupBy(*by, "datetime_sk").agg(F.count("*").alias("n_purchases"), sums)


def sales_of_hours(per_hour: DataFrame, dim_datetime: DataFrame, *parts: str) -> DataFrame:
    """Purchases and revenue per calendar part, from sums per stored hour, which may be partial ones."""
    sums = [F.sum(name).alias(name) for name in ("n_purchases", "revenue")]
    whole = per_hour.groupBy(F.col("datetime_sk").alias("_datetime_sk")).agg(*sums)
    joined = whole.join(dim_datetime, F.col("_datetime_sk") == F.col("datetime_sk")).groupBy(*parts)
    return joined.agg(F.sum("n_purchases").alias("n_purchases"), F.sum("revenue").cast("double").alias("revenue"))


#: Calendar parts of the two reports on sales.
HOUR, WEEKDAY = ("hour_utc",), ("day_of_week_utc", "day_name_utc")


def sales_by_hour(fact: DataFrame, dim_datetime: DataFrame) -> DataFrame:
    return sales_of_hours(hour_sales(fact), dim_datetime, *HOUR)


def sales_by_weekday(fact: DataFrame, dim_datetime: DataFrame) -> DataFrame:
    return sales_of_hours(hour_sales(fact), dim_datetime, *WEEKDAY)
