"""The batch pipeline: ingest months, build the star schema, check it."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import date, datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickloom import schemas as S
from clickloom.operators import members
from clickloom.operators.dedup import latest_times
from clickloom.plans import dims, fact, reports, staging, suite
from clickloom.session import Scratch, side_by_side, sized
from clickloom.sources import files, monthly_csv
from clickloom.sources.tables import Days, Warehouse, day_ranges

DAY_MICROS = 24 * 60 * 60 * 1_000_000
#: How much of the stored history one fact job takes on.
SLICE_BYTES = 4 * 1024**4
DIMENSIONS = ("dim_datetime", "dim_products", "dim_users")


def taken_months(warehouse: Warehouse, by: str | None = None) -> set[str]:
    """Months whose events are in all tables; those taken in by ``run`` or ``stream`` alone if asked for."""
    if not warehouse.exists("finished_months"):
        return set()
    rows = warehouse.read("finished_months").distinct().collect()
    return {row.month for row in rows if by in (None, row.taken_by)}


def new_months(warehouse: Warehouse, source: str) -> list[str]:
    """Months that ``source`` has and nothing has taken in, oldest first."""
    known = taken_months(warehouse)
    return [month for month in monthly_csv.find_batches(warehouse.spark, source) if month not in known]


def ingest(
    warehouse: Warehouse,
    source: str,
    landing: str,
    months: Sequence[str] | None = None,
    keep_staging: bool = False,
) -> list[str]:
    """Land the given months that ``source`` has (all if None), append them to the history in one job, return them.

    No matching file means nothing is written. The append does not look for copies, so ingesting a month again
    doubles its rows; staging removes them. ``keep_staging`` also leaves the batch in ``ecom_staging``.
    """
    landed = monthly_csv.land(warehouse.spark, source, landing, months)
    if landed:
        batch = monthly_csv.read_landed(warehouse.spark, landing, landed)
        if keep_staging:
            warehouse.overwrite("ecom_staging", batch)
            batch = warehouse.read("ecom_staging")
        warehouse.create("ecom_events")
        warehouse.append("ecom_events", batch)
    return landed


def session_broadcast_limit(spark: SparkSession) -> int:
    """The session's broadcast threshold in bytes."""
    return int(spark._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold())


def latest_candidates(scratch: Scratch, events: DataFrame) -> DataFrame:
    """The events that may be a product's latest: those at its greatest time.

    One cheap scan finds these times. If they are few enough to broadcast, the costly ranking by key then sees little
    more than one event per product; otherwise all events stay in, and the ranking sorts them.
    """
    times, size = scratch.hold("latest-times", latest_times(events, "product_id", "event_time"))
    if size > session_broadcast_limit(scratch.spark):
        return events
    return events.join(times, ["product_id", "event_time"], "left_semi")


def build_dims(warehouse: Warehouse, raw: DataFrame, names: Sequence[str] = DIMENSIONS) -> None:
    """Build dimension tables from raw events, in place of those there are."""
    events = staging.clean(raw)

    def products() -> None:
        with Scratch(warehouse.spark) as scratch:
            candidates = latest_candidates(scratch, events)
            warehouse.overwrite("product_latest", dims.latest_per_product(dims.product_events(candidates)))
        warehouse.overwrite("dim_products", dims.describe_products(warehouse.read("product_latest")))

    builds = {
        "dim_datetime": lambda: warehouse.overwrite("dim_datetime", dims.dim_datetime(events)),
        "dim_products": products,
        "dim_users": lambda: warehouse.overwrite("dim_users", dims.dim_users(events)),
    }
    side_by_side(*[builds[name] for name in names])


def extend_dims(warehouse: Warehouse, added: DataFrame) -> None:
    """Bring the dimension tables up to date with more raw events; reads these events only.

    Equal to a rebuild, also if some of the events were taken in before: hours and users are added if they are new,
    and a product keeps the later of its stored latest event and its added ones.
    """
    events = staging.clean(added)

    def add_new(name: str, rows: DataFrame, key: str) -> None:
        warehouse.append(name, rows.join(warehouse.read(name).select(key), key, "left_anti"))

    def products() -> None:
        with Scratch(warehouse.spark) as scratch:
            candidates = dims.product_events(latest_candidates(scratch, events))
            both = warehouse.read("product_latest").unionByName(candidates)
            warehouse.overwrite("product_latest", dims.latest_per_product(both))
        warehouse.overwrite("dim_products", dims.describe_products(warehouse.read("product_latest")))

    side_by_side(
        lambda: add_new("dim_datetime", dims.dim_datetime(events), "datetime_hour_utc"),
        products,
        lambda: add_new("dim_users", dims.dim_users(events), "user_id"),
    )


def update_dims(warehouse: Warehouse, full_refresh: bool = False, slice_bytes: int = SLICE_BYTES) -> None:
    """Bring the dimensions up to date with all that was ever written to the history, in whatever way.

    Rows carry the id of their ingest, and a table keeps the ids that the dimensions have taken in. Read are the days of
    the other ingests and those whose folders something else changed, a slice of whole days at a time, and of these the
    rows of ingests not taken in, or of none: so files of any name and origin count. No other day is listed. An ingest
    counts as taken in only if it was entered before its rows were looked for. A rebuild takes in all rows.
    """
    spark = warehouse.spark
    known = all(warehouse.exists(name) for name in (*DIMENSIONS, "product_latest", "dim_ingests"))
    rebuild = full_refresh or not known
    if rebuild:
        warehouse.keep("dim_days", {})
        warehouse.overwrite("dim_ingests", spark.createDataFrame([], S.DIM_INGESTS))
    taken, new = warehouse.read("dim_ingests"), []
    if warehouse.exists("ingests"):
        new = warehouse.read("ingests").join(taken, S.INGEST, "left_anti").collect()
    changed, stamps = warehouse.changed_days("ecom_events", "dim_days")
    ingested = {row.day for row in new if row.day is not None}
    days = sorted(changed | ingested)
    sizes = ((day, files.stored_bytes(spark, warehouse.day_path("ecom_events", day))) for day in days)
    slices = day_ranges(sizes, slice_bytes)
    for part in slices:
        own = [day for day in days if part.first <= day <= part.last]
        events = warehouse.read_each_day("ecom_events", own, None if rebuild else taken)
        with sized(spark, part.size):
            if rebuild and part is slices[0]:
                build_dims(warehouse, events)
            elif rebuild or ingested & set(own) or not events.isEmpty():
                extend_dims(warehouse, events)
    if rebuild and not slices:
        build_dims(warehouse, events_of(warehouse, []))
    ids = sorted({(row[S.INGEST],) for row in new})
    if ids:
        warehouse.append("dim_ingests", spark.createDataFrame(ids, S.DIM_INGESTS))
    warehouse.keep("dim_days", stamps)
    for name in ("dim_datetime", "dim_users", "dim_ingests", "ingests"):
        if warehouse.exists(name):
            warehouse.compact(name)


def is_regular(dim: DataFrame, link: fact.Link) -> bool:
    """Whether the dimension has one row per key, with the surrogate key that the formula gives."""
    odd = F.count_if(~F.col(link.sk).eqNullSafe(link.formula()) | F.col(link.key).isNull()).alias("odd")
    found = dim.groupBy(link.key).agg(F.count("*").alias("n"), odd).where("n > 1 OR odd > 0")
    return found.isEmpty()


def link_events(
    warehouse: Warehouse,
    raw: DataFrame,
    names: Sequence[str] = DIMENSIONS,
    broadcast_limit: int | None = None,
    scratch: Scratch | None = None,
) -> DataFrame:
    """Fact rows of the raw events, linked to the named stored dimensions (all for the fact itself).

    A dimension is joined by its key; Catalyst broadcasts a small one, knowing its size. For one above the limit that
    was found to be regular, which any dimension built here is, the join gives what the key's formula gives except
    for the keys that the dimension lacks. So only these are looked for, without the de-duplication, and joined.
    Intermediate tables belong to ``scratch``.
    """
    scratch = scratch or Scratch(warehouse.spark)
    limit = session_broadcast_limit(warehouse.spark) if broadcast_limit is None else broadcast_limit
    keys = fact.with_hour(staging.clean(raw), "event_time")
    linked = fact.with_hour(staging.stg_ecom_events(raw), "event_at_utc")
    for name in names:
        link, dim = fact.LINKS[name], warehouse.read(name)
        if warehouse.stored_bytes(name) > limit and is_regular(dim, link):
            missing, _ = scratch.hold(f"missing-{link.key}", members.missing_keys(keys, dim, link.key))
            linked = members.derive_member(linked, missing, link.key, link.sk, link.formula())
        else:
            linked = members.attach_member(linked, dim, link.key, link.sk)
    return fact.fact_columns(linked)


def stored_mark(warehouse: Warehouse) -> int | None:
    """High-water mark of the stored fact, from one column of its newest day; None if there is no fact row yet."""
    if warehouse.exists("fct_events"):
        for day in reversed(warehouse.days("fct_events")):
            mark = fact.high_water_mark(warehouse.read_days("fct_events", day, day))
            if mark is not None:
                return mark
    return None


def day_of(micros: int) -> date:
    return (datetime(1970, 1, 1) + timedelta(microseconds=micros)).date()


def events_of(warehouse: Warehouse, days: Sequence[Days]) -> DataFrame:
    """Raw events of at most one range of days; of no day at all if there is none."""
    first, last = (days[0].first, days[0].last) if days else (date.max, date.min)
    return warehouse.read_days("ecom_events", first, last)


def build_fact(
    warehouse: Warehouse,
    lookback_days: int | None = None,
    full_refresh: bool = False,
    slice_bytes: int = SLICE_BYTES,
) -> date | None:
    """Bring ``fct_events`` up to date with the history; returns the first day that may have changed, None for all.

    The first run and a full refresh write everything. Later runs add the events strictly after the newest fact row;
    an event that arrives late is then never loaded. ``lookback_days`` moves the mark back and merges instead, so late
    or changed events of these days are loaded too. A fact without rows counts as a first run.

    Copies of an event share its day, so the history is worked off in slices of whole days, oldest first. No shuffle
    grows beyond a slice, and after a break the next run goes on from the last slice written.
    """
    mark = None if full_refresh else stored_mark(warehouse)

    def write(days: Sequence[Days], events: DataFrame, put: Callable[[DataFrame], None]) -> None:
        with Scratch(warehouse.spark) as scratch, sized(warehouse.spark, sum(d.size for d in days)):
            put(link_events(warehouse, events, scratch=scratch))

    def overwrite(rows: DataFrame) -> None:
        warehouse.overwrite("fct_events", rows)

    def append(rows: DataFrame) -> None:
        warehouse.append("fct_events", rows)

    def merge(rows: DataFrame) -> None:
        warehouse.merge("fct_events", rows, "event_sk", one_per_key=True)  # staging leaves one row per key

    if mark is None:
        slices = warehouse.day_slices("ecom_events", slice_bytes)
        write(slices[:1], events_of(warehouse, slices[:1]), overwrite)
        for days in slices[1:]:
            write([days], events_of(warehouse, [days]), append)
        return None
    since = mark - (lookback_days or 0) * DAY_MICROS
    for days in warehouse.day_slices("ecom_events", slice_bytes, day_of(since)):
        # The event time is part of event_sk, so nothing after the mark can match a stored row: a merge would only
        # insert, which an append does without reading the fact.
        events = fact.newer_than(events_of(warehouse, [days]), since)
        write([days], events, merge if lookback_days else append)
    return day_of(since)


def transform(
    warehouse: Warehouse, lookback_days: int | None = None, full_refresh: bool = False
) -> date | None:
    """Update the dimensions, then the fact, and name the tables for SQL; staging is a view.

    Both take in what was written to the history since, by whomever; a full refresh builds them from all of it. Returns
    the first day of the fact that may have changed, None for all.
    """
    update_dims(warehouse, full_refresh)
    changed_from = build_fact(warehouse, lookback_days, full_refresh)
    warehouse.register(*DIMENSIONS, "fct_events")
    raw = warehouse.read("ecom_events")
    raw.createOrReplaceTempView(f"{warehouse.views}ecom_events")
    staging.stg_ecom_events(raw).createOrReplaceTempView(f"{warehouse.views}stg_ecom_events")
    return changed_from


def check(warehouse: Warehouse, first: date | None = None, slice_bytes: int = SLICE_BYTES) -> DataFrame:
    """The check suite over the stored tables; no rows if there are no tables yet.

    ``first`` limits the history and the fact to the days from there on, which is what a run has to check: copies of an
    event share its day, so no other day can break a check that held before. All days are checked a slice at a time.
    """
    spark = warehouse.spark
    if not warehouse.exists("fct_events"):
        return spark.createDataFrame([], suite.RESULT)
    stored = {name: warehouse.read(name) for name in DIMENSIONS}
    events = {name: warehouse.read(name) for name in ("ecom_events", "fct_events")}
    if first is not None:
        events = {name: warehouse.read_days(name, first) for name in events}
    found = []
    for days in warehouse.day_slices("fct_events", slice_bytes, first or date.min):
        part = warehouse.read_days("fct_events", days.first, days.last)
        with sized(spark, days.size), Scratch(spark) as scratch:
            found += suite.run_day_checks(stored | {"fct_events": part}, scratch).collect()
    if not found:  # a fact without days
        found = suite.run_day_checks(stored | events, Scratch(spark)).collect()
    sums = spark.createDataFrame(found, suite.RESULT).groupBy("table_name", "column_name", "check_name")
    return suite.run_checks(stored | events, sums.agg(F.sum("failures").alias("failures")))


def update_summaries(warehouse: Warehouse, slice_bytes: int = SLICE_BYTES) -> None:
    """Bring the daily sums and the sessions' first times up to date with the fact, for the reports.

    Only days whose folders changed since the last time are read, a slice at a time: their sums replace those of the same
    days, and their sessions' times are folded into those known, which repeats no harm. If all days changed, as after a
    full refresh, everything is made anew.
    """
    spark = warehouse.spark
    changed, stamps = warehouse.changed_days("fct_events", "summary_days")
    known = all(warehouse.exists(name) for name in ("daily_products", "daily_hours", "session_state"))
    if not known or changed >= set(warehouse.days("fct_events")):
        changed = set(warehouse.days("fct_events"))
        warehouse.keep("summary_days", {})
        warehouse.overwrite("session_state", spark.createDataFrame([], S.SESSION_STATE))
        for name, schema in (("daily_products", S.DAILY_PRODUCTS), ("daily_hours", S.DAILY_HOURS)):
            warehouse.overwrite(name, spark.createDataFrame([], S.with_day(schema)))
    sizes = ((day, files.stored_bytes(spark, warehouse.day_path("fct_events", day))) for day in sorted(changed))
    for part in day_ranges(sizes, slice_bytes):
        days = sorted(day for day in changed if part.first <= day <= part.last)
        rows = warehouse.read_each_day("fct_events", days)

        def sums(name: str, made: DataFrame, days: Sequence[date] = days) -> Callable[[], None]:
            return lambda: warehouse.replace_days(name, made, days)

        def sessions(rows: DataFrame = rows) -> None:
            folded = reports.earlier_times(warehouse.read("session_state"), reports.session_times(rows))
            warehouse.overwrite("session_state", folded)

        with sized(spark, part.size):
            side_by_side(
                sums("daily_products", reports.product_counts(rows, S.DAY)),
                sums("daily_hours", reports.hour_sales(rows, S.DAY)),
                sessions,
            )
    warehouse.keep("summary_days", stamps)


def run_pipeline(
    warehouse: Warehouse,
    source: str,
    landing: str,
    months: Sequence[str] | None = None,
    one_by_one: bool = False,
    lookback_days: int | None = None,
) -> DataFrame:
    """Ingest months, transform, and return the check results.

    By default these are the months found that no run has finished yet; given months are taken in again. All go
    through one ingest and one transform; ``one_by_one`` runs both for each month, oldest first. Months without a file
    are left out, and nothing is done if there is none. A broken run is simply run again: a second copy of its events
    in the history changes nothing downstream.
    """
    spark = warehouse.spark
    if months is None:
        found = new_months(warehouse, source)
    else:
        found = list(monthly_csv.find_batches(spark, source, months))
    changed_from: date | None = date.max  # no day yet
    for batch in [[m] for m in found] if one_by_one else [found] if found else []:
        ingest(warehouse, source, landing, batch)
        since = transform(warehouse, lookback_days)
        changed_from = None if since is None or changed_from is None else min(since, changed_from)
        finished = spark.createDataFrame([(month, "run") for month in batch], S.FINISHED_MONTHS)
        warehouse.append("finished_months", finished)
    return check(warehouse, changed_from)
