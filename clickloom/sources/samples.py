"""Raw clickstreams derived from the generic sample tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clickloom.schemas import CATEGORY_TYPE, RAW
from clickloom.session import prepare


def clickstream_loads(spark: SparkSession, folder: str) -> DataFrame:
    """Dirty clickstream of all ``events`` with the column ``load``: 1 for the first delivery, 2 for a repeated one.

    Every event is in; the modulo rules only blank out single fields and deliver some rows twice.
    """
    prepare(spark)
    events = spark.read.parquet(f"{folder}/events.parquet")
    part = spark.read.parquet(f"{folder}/part.parquet").select("p_partkey", "p_size", "p_type", "p_brand")
    seq = F.col("event_id")

    def blank_every(n: int, value: Column) -> Column:
        return F.when(seq % n != 0, value)

    product = F.get_json_object("props", "$.k").cast("bigint")
    kind = (
        F.when(F.col("kind") == "click", "cart")
        .when(F.col("kind") == "error", "remove_from_cart")
        .when(F.col("kind") == "signup", None)
        .otherwise(F.col("kind"))
    )
    session = F.concat_ws("-", F.col("uid").cast("string"), F.date_format("ts", "yyyy-MM-dd"))
    deliveries = F.when(seq % 20 == 0, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return (
        events.select(
            "event_id",
            F.col("ts").cast("timestamp").alias("ts"),
            F.col("user_id").alias("uid"),
            F.col("event_type").alias("kind"),
            "value",
            product.alias("k"),
        )
        .join(part, F.col("k") == F.col("p_partkey"), "left")
        .select(
            blank_every(17, F.date_trunc("SECOND", "ts")).alias("event_time"),
            kind.alias("event_type"),
            blank_every(19, F.col("k")).alias("product_id"),
            F.col("p_size").cast(CATEGORY_TYPE).alias("category_id"),
            blank_every(5, F.col("p_type")).alias("category_code"),
            blank_every(7, F.col("p_brand")).alias("brand"),
            blank_every(13, F.col("value")).alias("price"),
            blank_every(23, F.col("uid")).alias("user_id"),
            blank_every(10, session).alias("user_session"),
            F.explode(deliveries).alias("load"),
        )
    )


def clickstream(spark: SparkSession, folder: str) -> DataFrame:
    """All deliveries of the dirty clickstream."""
    return clickstream_loads(spark, folder).select(*RAW.names)


def order_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Clean events over many months: every ``lineitem`` as an event of the customer that ordered it."""
    prepare(spark)
    lines = spark.read.parquet(f"{folder}/lineitem.parquet").select(
        "l_orderkey", "l_partkey", "l_returnflag", "l_extendedprice", "l_shipdate"
    )
    orders = spark.read.parquet(f"{folder}/orders.parquet").select("o_orderkey", "o_custkey")
    part = spark.read.parquet(f"{folder}/part.parquet").select("p_partkey", "p_size", "p_type", "p_brand")
    kind = (
        F.when(F.col("l_returnflag") == "R", "remove_from_cart")
        .when(F.col("l_returnflag") == "A", "cart")
        .otherwise("purchase")
    )
    return (
        lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(part, F.col("l_partkey") == F.col("p_partkey"), "left")
        .select(
            F.col("l_shipdate").cast("timestamp").alias("event_time"),
            kind.alias("event_type"),
            F.col("l_partkey").alias("product_id"),
            F.col("p_size").cast(CATEGORY_TYPE).alias("category_id"),
            F.col("p_type").alias("category_code"),
            F.col("p_brand").alias("brand"),
            F.col("l_extendedprice").alias("price"),
            F.col("o_custkey").alias("user_id"),
            F.col("o_orderkey").cast("string").alias("user_session"),
        )
    )
