"""Runnable queries over the sample tables, one per operator or model."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickloom import schemas as S
from clickloom.functions.keys import surrogate_key, timestamp_text
from clickloom.operators import members, quality
from clickloom.plans import dims, fact, pipeline, reports, staging
from clickloom.session import Scratch, prepare, work_folder
from clickloom.sources import files, monthly_csv, samples
from clickloom.sources.tables import Warehouse
from clickloom.streaming.new_files import process_new_files

Query = Callable[[SparkSession, str], DataFrame]

#: The last days of the first and of the second part of the clickstream in the queries about arrival.
ARRIVALS = (10, 20)
#: First event of the second load in the incremental query.
SECOND_LOAD_FROM = "2024-01-21"
#: The restricted dimensions of the unknown-member queries.
KNOWN_PRODUCT, KNOWN_USER, KNOWN_HOUR = "product_id < 50", "user_id < 75", "datetime_hour_utc < '2024-01-16'"
#: The re-delivery of the look-back query: its first day, its price cut, and the days that the second run looks back.
REDELIVERED_FROM, PRICE_CUT, LOOKBACK_DAYS = "2024-01-16", 1.0, 5
#: A look-back over all of the clickstream.
ALL_DAYS = 40


def comparable(result: DataFrame) -> DataFrame:
    """Types that other engines hand over alike: zone-less timestamps; dates and decimals as text."""
    casts = {T.TimestampType: "timestamp_ntz", T.DateType: "string", T.DecimalType: "string"}
    return result.select(
        *[
            F.col(f.name).cast(casts[type(f.dataType)]).alias(f.name) if type(f.dataType) in casts else F.col(f.name)
            for f in result.schema.fields
        ]
    )


def new_warehouse(spark: SparkSession) -> Warehouse:
    return Warehouse(spark, work_folder(spark, "warehouse"))


def held(spark: SparkSession, rows: DataFrame) -> DataFrame:
    """Rows that several jobs read, stored once; a registered query's result may be read at any time, so they stay."""
    return Scratch(spark).hold("raw", rows)[0]


def star(
    spark: SparkSession, raw: DataFrame, names: Sequence[str] = pipeline.DIMENSIONS
) -> tuple[Warehouse, DataFrame]:
    """A warehouse with the named dimensions of ``raw``, and the fact rows linked to them."""
    warehouse, raw = new_warehouse(spark), held(spark, raw)
    pipeline.build_dims(warehouse, raw, names)
    return warehouse, pipeline.link_events(warehouse, raw, names)


def export_csv(rows: DataFrame, folder: str) -> None:
    """Write raw events the way the batches arrive."""
    rows.select(*S.RAW.names).write.option("timestampFormat", "yyyy-MM-dd HH:mm:ss 'UTC'").csv(folder, header=True)


def stg_clickstream(spark: SparkSession, folder: str) -> DataFrame:
    return staging.stg_ecom_events(samples.clickstream(spark, folder))


def stg_order_lines(spark: SparkSession, folder: str) -> DataFrame:
    return staging.stg_ecom_events(samples.order_lines(spark, folder))


def surrogate_keys(spark: SparkSession, folder: str) -> DataFrame:
    """Keys over all events with their times at three precisions, and over parts that may be NULL."""
    events = prepare(spark).read.parquet(f"{folder}/events.parquet")
    ts = F.col("ts").cast("timestamp")

    def key(*parts: Column) -> Column:
        return surrogate_key(*parts)

    return events.select(
        "event_id",
        timestamp_text(ts).alias("micros_text"),
        timestamp_text(F.date_trunc("MILLISECOND", ts)).alias("millis_text"),
        timestamp_text(F.date_trunc("SECOND", ts)).alias("seconds_text"),
        key(F.col("event_id"), timestamp_text(ts), F.col("event_type")).alias("event_key"),
        key(F.nullif(F.col("event_type"), F.lit("signup")), F.col("user_id")).alias("nullable_key"),
    )


def dim_datetime(spark: SparkSession, folder: str) -> DataFrame:
    return dims.dim_datetime(staging.clean(samples.clickstream(spark, folder)))


def dim_datetime_order_lines(spark: SparkSession, folder: str) -> DataFrame:
    return dims.dim_datetime(staging.clean(samples.order_lines(spark, folder)))


def dim_products(spark: SparkSession, folder: str) -> DataFrame:
    return dims.dim_products(staging.clean(samples.order_lines(spark, folder)))


def dim_products_clickstream(spark: SparkSession, folder: str) -> DataFrame:
    return dims.dim_products(staging.clean(samples.clickstream(spark, folder)))


def dim_users(spark: SparkSession, folder: str) -> DataFrame:
    return dims.dim_users(staging.clean(samples.clickstream(spark, folder)))


def fct_events(spark: SparkSession, folder: str) -> DataFrame:
    return star(spark, samples.clickstream(spark, folder))[1]


def fct_order_lines(spark: SparkSession, folder: str) -> DataFrame:
    return star(spark, samples.order_lines(spark, folder))[1]


def known_members(spark: SparkSession, raw: DataFrame, names: Sequence[str] = pipeline.DIMENSIONS) -> Warehouse:
    """A warehouse whose dimensions hold some of the members only."""
    known = {"dim_products": KNOWN_PRODUCT, "dim_users": KNOWN_USER, "dim_datetime": KNOWN_HOUR}
    full, part = new_warehouse(spark), new_warehouse(spark)
    pipeline.build_dims(full, raw, names)
    for name in names:
        part.overwrite(name, full.read(name).where(known[name]))
    return part


def fct_events_unknown_member(spark: SparkSession, folder: str) -> DataFrame:
    raw = held(spark, samples.clickstream(spark, folder))
    return pipeline.link_events(known_members(spark, raw), raw)


def fct_events_large_dims(spark: SparkSession, folder: str) -> DataFrame:
    """The unknown-member fact by the way that dimensions above the broadcast threshold go."""
    raw = held(spark, samples.clickstream(spark, folder))
    return pipeline.link_events(known_members(spark, raw), raw, broadcast_limit=0)


def loads(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """The first delivery of the clickstream, and the repeated one."""
    rows = samples.clickstream_loads(spark, folder)
    return rows.where("load = 1"), rows.where("load = 2")


def incremental_warehouse(
    spark: SparkSession, folder: str, between: Callable[[Warehouse], None] = lambda _: None
) -> Warehouse:
    """Two runs over the clickstream: all events before the split time, then the others."""
    warehouse = new_warehouse(spark)
    raw = samples.clickstream(spark, folder)
    late = F.coalesce(F.col("event_time") >= F.lit(SECOND_LOAD_FROM).cast("timestamp"), F.lit(False))
    warehouse.append("ecom_events", raw.where(~late))
    pipeline.transform(warehouse)
    between(warehouse)
    warehouse.append("ecom_events", raw.where(late))
    pipeline.transform(warehouse)
    return warehouse


def fct_events_incremental(spark: SparkSession, folder: str) -> DataFrame:
    return incremental_warehouse(spark, folder).read("fct_events").drop(S.DAY)


def fct_events_merge_lookback(spark: SparkSession, folder: str) -> DataFrame:
    return redelivered(spark, folder, new_warehouse(spark)).read("fct_events").drop(S.DAY)


def fct_events_merge_clustered(spark: SparkSession, folder: str) -> DataFrame:
    """The same over days of several files each, of which the merge rewrites those with matches."""
    warehouse = Warehouse(spark, work_folder(spark, "warehouse"), cluster_bytes=0)
    return redelivered(spark, folder, warehouse).read("fct_events").drop(S.DAY)


def sales_by_hour_merged(spark: SparkSession, folder: str) -> DataFrame:
    """Sales from the daily sums, which were made before the re-delivery and again after it."""
    warehouse = new_warehouse(spark)
    redelivered(spark, folder, warehouse, between=pipeline.update_summaries)
    pipeline.update_summaries(warehouse)
    return reports.sales_of_hours(warehouse.read("daily_hours"), warehouse.read("dim_datetime"), *reports.HOUR)


def top_products_of_days(spark: SparkSession, folder: str) -> DataFrame:
    """Popular products from the daily sums, after a run over the first days and one over the later ones."""
    warehouse = incremental_warehouse(spark, folder, between=pipeline.update_summaries)
    pipeline.update_summaries(warehouse)
    return reports.top_products_of_days(warehouse.read("daily_products"), warehouse.read("dim_products"))


def purchase_funnel_sessions(spark: SparkSession, folder: str) -> DataFrame:
    """The funnel from the sessions' first times; every session's events come in two runs, and the later ones first."""
    warehouse = new_warehouse(spark)
    raw = held(spark, samples.clickstream(spark, folder))
    late = F.coalesce(F.hour("event_time") >= 12, F.lit(False))
    for rows in (raw.where(late), raw.where(~late)):
        warehouse.append("ecom_events", rows)
        pipeline.transform(warehouse, lookback_days=ALL_DAYS)
        pipeline.update_summaries(warehouse)
    return reports.funnel_of_sessions(warehouse.read("session_state"))


def fct_events_foreign_files(spark: SparkSession, folder: str) -> DataFrame:
    """The second part of the history comes as files of another writer: other names, and no ingest in them."""
    warehouse = new_warehouse(spark)
    first, second, third = by_arrival(spark, folder)
    warehouse.append("ecom_events", first)
    pipeline.transform(warehouse)
    outside = work_folder(spark, "outside")
    dated = second.withColumn(S.DAY, F.to_date("event_time")).where(f"{S.DAY} IS NOT NULL")
    dated.hint("rebalance", S.DAY).write.partitionBy(S.DAY).parquet(outside)
    for day in files.names(spark, outside):
        for n, name in enumerate(files.names(spark, f"{outside}/{day}") if "=" in day else []):
            files.move(spark, f"{outside}/{day}/{name}", f"{warehouse.path('ecom_events')}/{day}/copied {n}.parquet")
    warehouse.append("ecom_events", third)
    pipeline.transform(warehouse)
    return warehouse.read("fct_events").drop(S.DAY)


def redelivered(
    spark: SparkSession, folder: str, warehouse: Warehouse, between: Callable[[Warehouse], None] = lambda _: None
) -> Warehouse:
    """A full run, then a re-delivery at lower prices, of which the look-back takes in the last days only."""
    raw = samples.clickstream(spark, folder)
    warehouse.append("ecom_events", raw)
    pipeline.transform(warehouse)
    between(warehouse)
    again = raw.where(F.col("event_time") >= F.lit(REDELIVERED_FROM).cast("timestamp"))
    warehouse.append("ecom_events", again.withColumn("price", F.col("price") - PRICE_CUT))
    pipeline.transform(warehouse, lookback_days=LOOKBACK_DAYS)
    return warehouse


def high_water_mark(spark: SparkSession, folder: str) -> DataFrame:
    """The mark of a stored fact, and how many raw events a run with a look-back of one day would read."""
    warehouse = new_warehouse(spark)
    warehouse.append("ecom_events", samples.clickstream(spark, folder))
    pipeline.transform(warehouse)
    mark = pipeline.stored_mark(warehouse)
    since = mark - pipeline.DAY_MICROS
    days = warehouse.day_slices("ecom_events", pipeline.SLICE_BYTES, pipeline.day_of(since))
    recent = fact.newer_than(pipeline.events_of(warehouse, days), since)
    return recent.agg(
        F.timestamp_micros(F.lit(mark)).alias("newest_event_at_utc"), F.count("*").alias("n_events_of_last_day")
    )


def export_loads(spark: SparkSession, folder: str, inbox: str) -> None:
    """Write the first delivery as one month's batch and the repeated one as the next month's."""
    first, repeated = loads(spark, folder)
    export_csv(first, f"{inbox}/2024-Jan.csv")
    export_csv(repeated, f"{inbox}/2024-Feb.csv")


def raw_append_history(spark: SparkSession, folder: str) -> DataFrame:
    """Two CSV batches, the second one with events that the first has too, appended one after the other."""
    warehouse = new_warehouse(spark)
    inbox, landing = work_folder(spark, "inbox"), work_folder(spark, "landing")
    export_loads(spark, folder, inbox)
    for month in ("2024-01", "2024-02", "2024-03"):
        pipeline.ingest(warehouse, inbox, landing, [month], keep_staging=True)
    return warehouse.read("ecom_events").drop(S.DAY)


def export_months(rows: DataFrame, inbox: str) -> None:
    """Write one CSV batch per month of the events, all in one job."""
    batch = F.concat(F.date_format("event_time", "yyyy-MMM"), F.lit(".csv"))
    named = rows.withColumn("batch", batch).hint("rebalance", "batch")
    named.write.partitionBy("batch").option("timestampFormat", "yyyy-MM-dd HH:mm:ss 'UTC'").csv(inbox, header=True)


def ingest_months(spark: SparkSession, folder: str) -> DataFrame:
    """All months of the order lines, landed in one job."""
    inbox, landing = work_folder(spark, "inbox"), work_folder(spark, "landing")
    export_months(samples.order_lines(spark, folder), inbox)
    monthly_csv.land(spark, inbox, landing)
    return spark.read.schema(T.StructType([*S.RAW.fields, T.StructField("month", T.StringType())])).parquet(landing)


def stream_new_files(spark: SparkSession, folder: str) -> DataFrame:
    """Two runs over an inbox that gets its second file after the first run; the fact sees the new file alone."""
    warehouse = new_warehouse(spark)
    inbox, checkpoint = work_folder(spark, "inbox"), work_folder(spark, "stream")
    first, repeated = loads(spark, folder)
    export_csv(first, f"{inbox}/2024-Jan.csv")
    process_new_files(warehouse, inbox, checkpoint)
    export_csv(repeated, f"{inbox}/2024-Feb.csv")
    process_new_files(warehouse, inbox, checkpoint)
    return staging.stg_ecom_events(warehouse.read("ecom_events"))


def dq_not_null(spark: SparkSession, folder: str) -> DataFrame:
    return quality.null_failures(samples.clickstream(spark, folder), ("event_time", "product_id", "user_id"))


def dq_unique(spark: SparkSession, folder: str) -> DataFrame:
    """Event keys before the de-duplication."""
    events = staging.clean(samples.clickstream(spark, folder))
    keys = held(spark, events.select(staging.event_key().alias("event_sk")))
    return quality.unique_by_hash(keys, "event_sk", Scratch(spark).hold)


def dq_accepted_values(spark: SparkSession, folder: str) -> DataFrame:
    return quality.accepted_values(stg_clickstream(spark, folder), "event_type", S.EVENT_TYPES)


def natural_fact(staged: DataFrame) -> DataFrame:
    """Staged events with the keys that complete dimensions would give them."""
    return staged.select("event_sk", dims.product_sk().alias("product_sk"), dims.user_sk().alias("user_sk"))


def dq_relationships(spark: SparkSession, folder: str) -> DataFrame:
    raw = samples.clickstream(spark, folder)
    warehouse = known_members(spark, raw, ["dim_products", "dim_users"])
    events = natural_fact(staging.stg_ecom_events(raw))
    users = quality.relationships(events, "user_sk", warehouse.read("dim_users"), "user_sk")
    products = quality.relationships(events, "product_sk", warehouse.read("dim_products"), "product_sk")
    return users.withColumn("column_name", F.lit("user_sk")).unionByName(
        products.withColumn("column_name", F.lit("product_sk"))
    )


def orphan_events(spark: SparkSession, folder: str) -> DataFrame:
    raw = samples.clickstream(spark, folder)
    products = known_members(spark, raw, ["dim_products"]).read("dim_products")
    return members.orphans(natural_fact(staging.stg_ecom_events(raw)), "product_sk", products, "product_sk")


def dq_suite(spark: SparkSession, folder: str) -> DataFrame:
    """The suite over tables whose dimensions miss members, so that most kinds of check have failures."""
    raw = samples.clickstream(spark, folder)
    warehouse = known_members(spark, raw)
    warehouse.append("ecom_events", raw)
    pipeline.build_fact(warehouse)
    return pipeline.check(warehouse)


def run_pipeline(spark: SparkSession, folder: str) -> DataFrame:
    """Two monthly CSV batches, one after the other, to checked tables."""
    inbox, landing = work_folder(spark, "inbox"), work_folder(spark, "landing")
    export_loads(spark, folder, inbox)
    return pipeline.run_pipeline(new_warehouse(spark), inbox, landing, one_by_one=True)


def by_arrival(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The clickstream's events in three parts by their days."""
    raw = held(spark, samples.clickstream(spark, folder))
    day = F.coalesce(F.dayofmonth("event_time"), F.lit(1))
    first, second = day <= ARRIVALS[0], (day > ARRIVALS[0]) & (day <= ARRIVALS[1])
    return raw.where(first), raw.where(second), raw.where(day > ARRIVALS[1])


def fct_events_mixed_ingest(spark: SparkSession, folder: str) -> DataFrame:
    """A pipeline run, a batch that is only ingested, one written straight to the history, then another run."""
    warehouse = new_warehouse(spark)
    inbox, landing = work_folder(spark, "inbox"), work_folder(spark, "landing")
    parts = by_arrival(spark, folder)
    export_csv(parts[0], f"{inbox}/2024-Jan.csv")
    pipeline.run_pipeline(warehouse, inbox, landing)
    export_csv(parts[1].where("user_id % 2 = 0"), f"{inbox}/2024-Feb.csv")
    pipeline.ingest(warehouse, inbox, landing, ["2024-02"])
    warehouse.append("ecom_events", parts[1].where("user_id % 2 IS DISTINCT FROM 0"))
    export_csv(parts[2], f"{inbox}/2024-Mar.csv")
    pipeline.run_pipeline(warehouse, inbox, landing, ["2024-03"])
    return warehouse.read("fct_events").drop(S.DAY)


def fct_events_late_rows(spark: SparkSession, folder: str) -> DataFrame:
    """The middle days arrive last: they are in the history and the dimensions, but not in the fact."""
    warehouse = new_warehouse(spark)
    first, second, third = by_arrival(spark, folder)
    for rows in (first, third, second):
        warehouse.append("ecom_events", rows)
        pipeline.transform(warehouse)
    return warehouse.read("fct_events").drop(S.DAY)


def dims_incremental(spark: SparkSession, folder: str) -> DataFrame:
    """The order lines year by year, newest first: products and users that the dimensions got step by step."""
    warehouse = new_warehouse(spark)
    raw = held(spark, samples.order_lines(spark, folder))
    for low, high in ((1999, 9999), (1997, 1998), (0, 1996)):
        warehouse.append("ecom_events", raw.where(F.year("event_time").between(low, high)))
        pipeline.update_dims(warehouse)
    products = warehouse.read("dim_products").select(
        F.lit("product").alias("dimension"), "product_id", "product_sk", "product_brand", "category_code"
    )
    users = warehouse.read("dim_users").select(F.lit("user").alias("dimension"), "user_id", "user_sk")
    hours = warehouse.read("dim_datetime").select(F.lit("hour").alias("dimension"), "datetime_hour_utc", "datetime_sk")
    both = products.unionByName(users, allowMissingColumns=True)
    return both.unionByName(hours, allowMissingColumns=True)


def landed_month_skipped(spark: SparkSession, folder: str) -> DataFrame:
    """A month is landed once: another file of that name changes neither the landed rows nor what is appended later."""
    warehouse = new_warehouse(spark)
    inbox, again, landing = (work_folder(spark, label) for label in ("inbox", "inbox", "landing"))
    first, second, _ = by_arrival(spark, folder)
    export_csv(first, f"{inbox}/2024-Jan.csv")
    export_csv(second, f"{again}/2024-Jan.csv")
    for source in (inbox, again):
        pipeline.ingest(warehouse, source, landing)
    return warehouse.read("ecom_events").drop(S.DAY)


def stream_fact(spark: SparkSession, folder: str) -> DataFrame:
    """The fact after two stream runs with other files in the inbox, and a pipeline run that finds nothing new."""
    warehouse = new_warehouse(spark)
    inbox, landing, state = (work_folder(spark, label) for label in ("inbox", "landing", "stream"))
    first, second, third = by_arrival(spark, folder)
    export_csv(first, f"{inbox}/2024-Jan.csv")
    export_csv(third, f"{inbox}/other")
    process_new_files(warehouse, inbox, state)
    export_csv(second, f"{inbox}/2024-Feb.csv")
    process_new_files(warehouse, inbox, state)
    pipeline.run_pipeline(warehouse, inbox, landing)
    return warehouse.read("fct_events").drop(S.DAY)


def dq_suite_incremental(spark: SparkSession, folder: str) -> DataFrame:
    """The checks of the days from the second arrival on, where the fact has rows twice and without keys."""
    warehouse = new_warehouse(spark)
    first, *later = by_arrival(spark, folder)
    for rows in (first, later[0].unionByName(later[1])):
        warehouse.append("ecom_events", rows)
        changed_from = pipeline.transform(warehouse)
    bad = warehouse.read("fct_events").where(f"day({S.DAY}) = 1 OR day({S.DAY}) = 25").drop(S.DAY)
    warehouse.append("fct_events", held(spark, bad.withColumn("user_sk", F.lit(None).cast("string"))))
    return pipeline.check(warehouse, changed_from)


def csv_quoted_fields(spark: SparkSession, folder: str) -> DataFrame:
    """A batch by a writer that quotes every field, empty ones too: NULL in a number, an empty text in a text."""
    inbox = work_folder(spark, "inbox")
    rows = samples.clickstream(spark, folder)
    times = F.date_format("event_time", "yyyy-MM-dd HH:mm:ss 'UTC'").alias("event_time")
    texts = rows.select(times, *[F.col(name).cast("string").alias(name) for name in S.RAW.names[1:]])
    filled = texts.select(*[F.coalesce(name, F.lit("")).alias(name) for name in S.RAW.names])
    filled.write.option("quoteAll", True).option("emptyValue", '""').csv(f"{inbox}/2024-Jan.csv", header=True)
    return monthly_csv.scan(spark, [f"{inbox}/2024-Jan.csv"])


def top_products(spark: SparkSession, folder: str) -> DataFrame:
    warehouse, events = star(spark, samples.order_lines(spark, folder), ["dim_products"])
    return reports.top_products(events, warehouse.read("dim_products"))


def purchase_funnel(spark: SparkSession, folder: str) -> DataFrame:
    return reports.purchase_funnel(star(spark, samples.clickstream(spark, folder), [])[1])


def sales_by_hour(spark: SparkSession, folder: str) -> DataFrame:
    warehouse, events = star(spark, samples.clickstream(spark, folder), ["dim_datetime"])
    return reports.sales_by_hour(events, warehouse.read("dim_datetime"))


def sales_by_weekday(spark: SparkSession, folder: str) -> DataFrame:
    warehouse, events = star(spark, samples.clickstream(spark, folder), ["dim_datetime"])
    return reports.sales_by_weekday(events, warehouse.read("dim_datetime"))


def sales_by_weekday_order_lines(spark: SparkSession, folder: str) -> DataFrame:
    warehouse, events = star(spark, samples.order_lines(spark, folder), ["dim_datetime"])
    return reports.sales_by_weekday(events, warehouse.read("dim_datetime"))


QUERIES: dict[str, Query] = {
    "stg_ecom_events": stg_clickstream,
    "stg_order_lines": stg_order_lines,
    "surrogate_keys": surrogate_keys,
    "dim_datetime": dim_datetime,
    "dim_datetime_order_lines": dim_datetime_order_lines,
    "dim_products": dim_products,
    "dim_products_clickstream": dim_products_clickstream,
    "dim_users": dim_users,
    "fct_events": fct_events,
    "fct_order_lines": fct_order_lines,
    "fct_events_unknown_member": fct_events_unknown_member,
    "fct_events_large_dims": fct_events_large_dims,
    "fct_events_incremental": fct_events_incremental,
    "fct_events_merge_lookback": fct_events_merge_lookback,
    "high_water_mark": high_water_mark,
    "raw_append_history": raw_append_history,
    "ingest_months": ingest_months,
    "stream_new_files": stream_new_files,
    "dq_not_null": dq_not_null,
    "dq_unique": dq_unique,
    "dq_accepted_values": dq_accepted_values,
    "dq_relationships": dq_relationships,
    "orphan_events": orphan_events,
    "dq_suite": dq_suite,
    "run_pipeline": run_pipeline,
    "fct_events_mixed_ingest": fct_events_mixed_ingest,
    "fct_events_late_rows": fct_events_late_rows,
    "dims_incremental": dims_incremental,
    "landed_month_skipped": landed_month_skipped,
    "stream_fact": stream_fact,
    "dq_suite_incremental": dq_suite_incremental,
    "csv_quoted_fields": csv_quoted_fields,
    "fct_events_merge_clustered": fct_events_merge_clustered,
    "fct_events_foreign_files": fct_events_foreign_files,
    "sales_by_hour_merged": sales_by_hour_merged,
    "top_products_of_days": top_products_of_days,
    "purchase_funnel_sessions": purchase_funnel_sessions,
    "top_products": top_products,
    "purchase_funnel": purchase_funnel,
    "sales_by_hour": sales_by_hour,
    "sales_by_weekday": sales_by_weekday,
    "sales_by_weekday_order_lines": sales_by_weekday_order_lines,
}


def run(name: str, spark: SparkSession, folder: str) -> DataFrame:
    return comparable(QUERIES[name](prepare(spark), folder))
