from __future__ import annotations

from collections import Counter

import pytest
from pyspark.sql import functions as F

from clickloom import registry, session
from clickloom.operators import quality
from clickloom.operators.merge import DuplicateMergeKey, upsert
from clickloom.plans import pipeline, reports
from clickloom.plans.staging import stg_ecom_events
from clickloom.schemas import DAY
from clickloom.session import cluster_conf, shuffle_partitions, sized
from clickloom.sources import files, monthly_csv, samples
from clickloom.sources.tables import Warehouse


@pytest.fixture
def warehouse(spark, tmp_path):
    return Warehouse(spark, str(tmp_path / "warehouse"))


def facts(warehouse) -> Counter:
    return Counter(map(tuple, warehouse.read("fct_events").drop(DAY).collect()))


def load(warehouse, raw, **options):
    warehouse.append("ecom_events", raw)
    pipeline.transform(warehouse, **options)


def test_late_rows_need_a_lookback(warehouse, raw_rows):
    load(warehouse, raw_rows({"event_time": "2020-01-05 10:00:00"}))
    late = raw_rows({"event_time": "2020-01-05 09:00:00"}, {"event_time": "2020-01-05 10:00:00", "price": 1.0})
    load(warehouse, late)
    assert [r.event_price for r in warehouse.read("fct_events").collect()] == [5.0]
    pipeline.transform(warehouse, lookback_days=1)
    assert sorted(r.event_price for r in warehouse.read("fct_events").collect()) == [1.0, 5.0]


def test_lookback_leaves_older_days_alone(warehouse, raw_rows):
    times = [f"2020-01-{day:02d} 10:00:00" for day in range(1, 9)]
    load(warehouse, raw_rows(*[{"event_time": t} for t in times]))
    load(warehouse, raw_rows(*[{"event_time": t, "price": 1.0} for t in times]), lookback_days=2)
    prices = {str(r.event_at_utc.date()): r.event_price for r in warehouse.read("fct_events").collect()}
    assert [prices[t[:10]] for t in times] == [5.0] * 6 + [1.0] * 2


def test_empty_fact_counts_as_first_run(warehouse, raw_rows):
    warehouse.create("fct_events")
    load(warehouse, raw_rows({}))
    assert len(facts(warehouse)) == 1


def test_monthly_increments_equal_one_full_build(spark, warehouse, samples_folder):
    days = F.dayofmonth("event_time")
    raw = samples.clickstream(spark, samples_folder).where("event_time IS NOT NULL")
    for low, high in ((1, 10), (11, 20), (21, 31)):
        load(warehouse, raw.where(days.between(low, high)))
    increments = facts(warehouse)
    pipeline.build_fact(warehouse, full_refresh=True)
    assert facts(warehouse) == increments
    assert sum(increments.values()) == stg_ecom_events(raw).count()


def test_slices_of_days_equal_one_build(spark, warehouse, samples_folder):
    raw = samples.clickstream(spark, samples_folder)
    load(warehouse, raw)
    whole = facts(warehouse)
    day = files.stored_bytes(spark, warehouse.day_path("ecom_events", warehouse.days("ecom_events")[0]))
    assert 3 < len(warehouse.day_slices("ecom_events", 8 * day)) < 9
    assert len(warehouse.day_slices("ecom_events", 1)) == 30
    pipeline.build_fact(warehouse, full_refresh=True, slice_bytes=8 * day)
    assert facts(warehouse) == whole
    pipeline.build_fact(warehouse, lookback_days=10, slice_bytes=4 * day)
    assert facts(warehouse) == whole


def test_a_broken_build_goes_on_where_it_stopped(spark, warehouse, samples_folder, monkeypatch):
    load(warehouse, samples.clickstream(spark, samples_folder))
    whole = facts(warehouse)
    size = warehouse.stored_bytes("ecom_events") // 4
    with monkeypatch.context() as patch:
        patch.setattr(Warehouse, "append", lambda *_: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError, match="lost"):
            pipeline.build_fact(warehouse, full_refresh=True, slice_bytes=size)
    assert 0 < sum(facts(warehouse).values()) < sum(whole.values())
    pipeline.build_fact(warehouse, slice_bytes=size)
    assert facts(warehouse) == whole


def test_history_without_days_gives_an_empty_fact(warehouse, raw_rows):
    load(warehouse, raw_rows({"event_time": None}))
    assert warehouse.exists("fct_events") and facts(warehouse) == Counter()


def test_large_dimensions_give_the_same_fact(spark, samples_folder):
    raw = samples.clickstream(spark, samples_folder)
    part = registry.known_members(spark, raw)
    small = pipeline.link_events(part, raw).collect()
    large = pipeline.link_events(part, raw, broadcast_limit=0).collect()
    assert Counter(map(tuple, small)) == Counter(map(tuple, large))
    assert {"-1"} < {r.product_sk for r in small}


def test_an_irregular_dimension_gives_the_same_fact_at_any_size(warehouse, raw_rows):
    """A second row for one key, with another surrogate key: the join's two rows, whichever way the size suggests."""
    raw = raw_rows({"product_id": 1, "user_id": 1}, {"product_id": 1, "user_id": 2})
    pipeline.build_dims(warehouse, raw)
    spark = warehouse.spark
    warehouse.append("dim_users", spark.createDataFrame([(1, "other-key")], "user_id bigint, user_sk string"))
    small = Counter(map(tuple, pipeline.link_events(warehouse, raw).collect()))
    large = Counter(map(tuple, pipeline.link_events(warehouse, raw, broadcast_limit=0).collect()))
    assert small == large and sum(small.values()) == 3


def test_dimensions_take_in_what_others_wrote(warehouse, raw_rows, tmp_path):
    """A run, a batch that was only ingested, a plain append, and another run: no fact row lacks its members."""
    source, landing = str(tmp_path / "in"), str(tmp_path / "landing")
    csv(tmp_path / "in", "2019-Oct.csv", GOOD)
    pipeline.run_pipeline(warehouse, source, landing)
    csv(tmp_path / "in", "2019-Nov.csv", GOOD.replace("2019-10", "2019-11").replace("5773203", "8"))
    pipeline.ingest(warehouse, source, landing, ["2019-11"])
    warehouse.append("ecom_events", raw_rows({"event_time": "2019-11-20 00:00:00", "user_id": 77}))
    csv(tmp_path / "in", "2019-Dec.csv", GOOD.replace("2019-10", "2019-12"))
    checks = pipeline.run_pipeline(warehouse, source, landing, ["2019-12"])
    assert checks.agg(F.sum("failures")).first()[0] == 0
    assert pipeline.check(warehouse).agg(F.sum("failures")).first()[0] == 0
    assert warehouse.read("fct_events").count() == 4
    assert {r.product_id for r in warehouse.read("dim_products").collect()} == {1, 8, 5773203}


def test_rebuild_by_slices_equals_one_pass(spark, warehouse, samples_folder):
    raw = samples.clickstream(spark, samples_folder)
    for n in range(3):
        warehouse.append("ecom_events", raw.where(f"coalesce(day(event_time), 0) % 3 = {n}"))
    tables = []
    for slice_bytes in (pipeline.SLICE_BYTES, 4 * warehouse.stored_bytes("ecom_events") // 30):
        pipeline.update_dims(warehouse, full_refresh=True, slice_bytes=slice_bytes)
        tables.append({n: sorted(map(str, warehouse.read(n).collect())) for n in pipeline.DIMENSIONS})
    assert tables[0] == tables[1] and all(tables[0].values())
    assert warehouse.read("dim_ingests").distinct().count() == 3


def test_only_new_writes_are_read_for_the_dimensions(warehouse, raw_rows, monkeypatch):
    load(warehouse, raw_rows({"event_time": "2020-01-01 00:00:00"}, {"event_time": "2020-01-02 00:00:00"}))
    seen = []
    extend = pipeline.extend_dims
    monkeypatch.setattr(pipeline, "extend_dims", lambda w, rows: (seen.append(rows.count()), extend(w, rows)))
    load(warehouse, raw_rows({"event_time": "2020-01-02 05:00:00"}))
    load(warehouse, raw_rows())
    assert seen == [1]
    pipeline.transform(warehouse)
    assert seen == [1]


def test_shuffles_are_sized_by_the_data(spark, warehouse, raw_rows):
    key = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    before = spark.conf.get(key, None)
    with sized(spark, 10 * 1024**4):
        assert int(spark.conf.get(key)) > 20_000
    with sized(spark, 1000**6):
        assert int(spark.conf.get(key)) == 40_000
    assert spark.conf.get(key, None) == before
    used = []
    append = Warehouse.append
    load(warehouse, raw_rows({"event_time": "2020-01-01 00:00:00"}))
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(Warehouse, "append", lambda *a: (used.append(spark.conf.get(key, None)), append(*a)))
        load(warehouse, raw_rows({"event_time": "2020-01-02 00:00:00"}))
    assert sum(u is not None for u in used) >= 3


def test_merge_rewrites_the_days_of_the_delta_only(spark, warehouse, raw_rows):
    load(warehouse, raw_rows(*[{"event_time": f"2020-01-{d:02d} 01:00:00"} for d in range(1, 8)]))

    def names():
        return {d: files.names(spark, warehouse.day_path("fct_events", d)) for d in warehouse.days("fct_events")}

    before = names()
    delta = warehouse.read("fct_events").where(f"day({DAY}) IN (1, 7)").withColumn("event_price", F.lit(1.0))
    warehouse.merge("fct_events", delta, "event_sk")
    after = names()
    assert [d.day for d in before if before[d] != after[d]] == [1, 7]
    prices = {r.event_at_utc.day: r.event_price for r in warehouse.read("fct_events").collect()}
    assert prices == {d: 1.0 if d in (1, 7) else 5.0 for d in range(1, 8)}


def test_many_small_files_are_compacted(spark, warehouse):
    users = spark.range(200).selectExpr("id AS user_id", "cast(id AS string) AS user_sk").repartition(100)
    warehouse.append("dim_users", users)
    warehouse.compact("dim_users")
    names = files.names(spark, warehouse.path("dim_users"))
    assert sum(name.startswith("part-") for name in names) == 1 and warehouse.read("dim_users").count() == 200
    warehouse.append("dim_users", users.limit(0))
    warehouse.compact("dim_users")
    assert set(names) <= set(files.names(spark, warehouse.path("dim_users")))


def test_a_broken_replacement_leaves_the_table(spark, warehouse, raw_rows):
    load(warehouse, raw_rows({}))
    bad = raw_rows({}).select("*", F.raise_error(F.lit("lost")).alias("boom")).where("boom IS NULL")
    with pytest.raises(Exception, match="lost"):
        warehouse.overwrite("ecom_events", bad)
    assert warehouse.exists("ecom_events") and warehouse.read("ecom_events").count() == 1
    warehouse.overwrite("ecom_events", warehouse.read("ecom_events").drop(DAY).unionByName(raw_rows({})))
    assert warehouse.read("ecom_events").count() == 2


def test_work_folders_are_deleted(spark, warehouse, raw_rows, tmp_path, monkeypatch):
    monkeypatch.setattr(session, "shared_folder", lambda _: str(tmp_path / "work"))
    (tmp_path / "work").mkdir()
    load(warehouse, raw_rows({}))
    load(warehouse, raw_rows({"price": 1.0}), lookback_days=3)
    with monkeypatch.context() as patch:
        patch.setattr(Warehouse, "_write", lambda *_, **__: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError, match="lost"):
            load(warehouse, raw_rows({"price": 2.0}))
    assert list((tmp_path / "work").iterdir()) == []


def test_two_warehouses_keep_their_views_apart(spark, raw_rows, tmp_path):
    for name, n in (("a", 1), ("b", 2)):
        load(Warehouse(spark, str(tmp_path / name), views=f"{name}_"), raw_rows(*[{"user_session": str(i)} for i in range(n)]))
    assert [spark.table(f"{name}_stg_ecom_events").count() for name in "ab"] == [1, 2]


def test_a_session_without_ansi_casts_is_refused(spark, tmp_path):
    other = spark.newSession()
    other.conf.set("spark.sql.ansi.enabled", "false")
    with pytest.raises(ValueError, match="ansi"):
        Warehouse(other, str(tmp_path))
    assert other.conf.get("spark.sql.ansi.enabled") == "false"


def test_two_batches_of_a_month_are_an_error(spark, tmp_path):
    csv(tmp_path / "in", "2024-Jan.csv", GOOD)
    csv(tmp_path / "in" / "batch=2024-Jan.csv", "part-0.csv", GOOD)
    with pytest.raises(ValueError, match="two batches of 2024-01"):
        monthly_csv.find_batches(spark, str(tmp_path / "in"))


def test_long_leads_do_not_overflow_the_funnel(spark):
    rows = spark.range(20_000).selectExpr(
        "cast(id % 10000 as string) AS user_session_id", "if(id < 10000, 'view', 'purchase') AS event_type",
        "if(id < 10000, timestamp'1970-01-01 00:00:00', timestamp'2970-01-01 00:00:00') AS event_at_utc",
    )
    row = reports.purchase_funnel(rows).first()
    assert row.n_view == 10_000 and 3.15e10 < row.avg_seconds_view_to_purchase < 3.16e10


def test_checks_by_slices_and_of_new_days(spark, warehouse, samples_folder):
    raw = samples.clickstream(spark, samples_folder)
    load(warehouse, raw)
    bad = warehouse.read("fct_events").where(f"day({DAY}) IN (3, 20)").drop(DAY)
    held = spark.createDataFrame(bad.collect(), bad.schema)
    warehouse.append("fct_events", held.withColumn("product_sk", F.lit("-1")))
    whole = sorted(map(tuple, pipeline.check(warehouse).collect()))
    size = warehouse.stored_bytes("fct_events") // 5
    assert len(warehouse.day_slices("fct_events", size)) > 3
    assert sorted(map(tuple, pipeline.check(warehouse, slice_bytes=size).collect())) == whole
    failures = {(r[0], r[1], r[2]): r[3] for r in whole}
    assert failures["fct_events", "event_sk", "unique"] == failures["fct_events", "product_sk", "relationships"] > 0
    late = warehouse.days("fct_events")[10]
    some = {(r[0], r[1], r[2]): r[3] for r in map(tuple, pipeline.check(warehouse, late).collect())}
    assert 0 < some["fct_events", "event_sk", "unique"] < failures["fct_events", "event_sk", "unique"]


def test_latest_candidates_do_not_change_the_products(spark, samples_folder, tmp_path):
    raw = samples.order_lines(spark, samples_folder)
    tables = []
    for limit in ("10m", "-1"):
        warehouse = Warehouse(spark, str(tmp_path / limit))
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
        try:
            pipeline.build_dims(warehouse, raw)
        finally:
            spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        tables.append(sorted(map(str, warehouse.read("dim_products").collect())))
    assert tables[0] == tables[1]


def test_extended_dimensions_equal_rebuilt_ones(spark, samples_folder, tmp_path):
    """Batches overlap in days, users, products and even events, and later ones hold earlier times."""
    raw = samples.clickstream(spark, samples_folder)
    parts = [raw.where(f"day(event_time) % 3 = {n}").withColumn("brand", F.lit(f"b{n}")) for n in (2, 0, 1)]
    grown = Warehouse(spark, str(tmp_path / "grown"))
    for part in [*parts, parts[0]]:
        grown.append("ecom_events", part)
        pipeline.transform(grown)
    built = Warehouse(spark, str(tmp_path / "built"))
    pipeline.build_dims(built, grown.read("ecom_events"))
    for name in (*pipeline.DIMENSIONS, "product_latest"):
        expected = sorted(map(str, built.read(name).collect()))
        assert sorted(map(str, grown.read(name).collect())) == expected and expected


def test_quoted_empty_text_is_not_null(spark, tmp_path):
    csv(tmp_path / "in", "2019-Oct.csv", GOOD.replace("runail", '""'), GOOD.replace("runail", ""))
    rows = monthly_csv.scan(spark, [str(tmp_path / "in/2019-Oct.csv")])
    assert [r.brand for r in rows.collect()] == ["", None]


def test_upsert_replaces_and_adds(spark):
    target = spark.createDataFrame([("a", 1), ("b", 1)], "k string, v int")
    delta = spark.createDataFrame([("b", 2), ("c", 2)], "k string, v int")
    assert sorted(map(tuple, upsert(target, delta, "k").collect())) == [("a", 1), ("b", 2), ("c", 2)]


def test_upsert_refuses_two_rows_for_one_match(spark):
    target = spark.createDataFrame([("a", 1)], "k string, v int")
    delta = spark.createDataFrame([("a", 2), ("a", 3)], "k string, v int")
    with pytest.raises(DuplicateMergeKey):
        upsert(target, delta, "k")


def test_unknown_members_fail_the_relationship(spark, warehouse, raw_rows):
    raw = raw_rows({}, {"product_id": 9, "user_session": "s2"})
    pipeline.build_dims(warehouse, raw_rows({}))
    rows = pipeline.link_events(warehouse, raw)
    assert sorted(r.product_sk == "-1" for r in rows.collect()) == [False, True]
    failing = quality.relationships(rows, "product_sk", warehouse.read("dim_products"), "product_sk")
    assert [tuple(r) for r in failing.collect()] == [("-1", 1)]


def test_checks_on_nulls(spark):
    table = spark.createDataFrame([("a",), ("a",), (None,), (None,), ("b",)], "c string")
    assert [tuple(r) for r in quality.unique(table, "c").collect()] == [("a", 2)]
    assert quality.not_null(table, "c").count() == 2
    assert [tuple(r) for r in quality.accepted_values(table, "c", ["a"]).collect()] == [("b", 1)]
    assert [tuple(r) for r in quality.null_counts(table, ["c"]).collect()] == [("c", 2)]
    parents = spark.createDataFrame([("b",), (None,)], "p string")
    assert [tuple(r) for r in quality.relationships(table, "c", parents, "p").collect()] == [("a", 2)]


def test_suite_has_27_checks(spark, warehouse, raw_rows):
    load(warehouse, raw_rows({}, {"event_type": None, "user_id": 3}, {"user_id": None}))
    rows = pipeline.check(warehouse).collect()
    assert Counter(r.check_name for r in rows) == {
        "not_null": 16,
        "unique": 7,
        "relationships": 3,
        "accepted_values": 1,
    }
    assert {(r.table_name, r.column_name): r.failures for r in rows if r.failures} == {
        ("ecom_events", "user_id"): 1,
        ("fct_events", "event_type"): 1,
    }


def test_tables_and_staging_view_have_names(spark, warehouse, raw_rows):
    load(warehouse, raw_rows({}, {}))
    counts = {name: spark.table(name).count() for name in ("ecom_events", "stg_ecom_events", "fct_events")}
    assert counts == {"ecom_events": 2, "stg_ecom_events": 1, "fct_events": 1}


def test_published_tables_are_in_the_catalog(spark, warehouse, raw_rows):
    load(warehouse, raw_rows({"event_time": "2020-01-01 00:00:00"}))
    warehouse.publish("ecom")
    load(warehouse, raw_rows({"event_time": "2020-01-02 00:00:00"}))
    warehouse.publish("ecom")
    assert spark.table("ecom.ecom_events").count() == 2
    assert [r.partition for r in spark.sql("SHOW PARTITIONS ecom.fct_events").collect()] == [
        f"{DAY}=2020-01-01",
        f"{DAY}=2020-01-02",
    ]
    joined = spark.sql("SELECT hour_utc, count(*) AS n FROM ecom.fct_events JOIN ecom.dim_datetime USING (datetime_sk)"
                       " GROUP BY hour_utc")
    assert [tuple(r) for r in joined.collect()] == [(0, 2)]


def test_hot_day_is_split_over_tasks(spark, warehouse, raw_rows, samples_folder):
    """All rows on one day: adaptive execution still writes them with several tasks."""
    raw = samples.order_lines(spark, samples_folder)
    one_day = raw.withColumn("event_time", F.lit("2020-01-05 10:00:00").cast("timestamp"))
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "32k")
    try:
        warehouse.append("ecom_events", one_day.repartition(8))
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    names = files.names(spark, f"{warehouse.path('ecom_events')}/{DAY}=2020-01-05")
    assert sum(name.endswith(".parquet") for name in names) > 2
    assert warehouse.read("ecom_events").count() == raw.count()


def test_files_are_sorted_by_the_cluster_columns(spark, warehouse, samples_folder):
    warehouse.append("ecom_events", samples.clickstream(spark, samples_folder))
    rows = warehouse.read("ecom_events").withColumn("file", F.input_file_name())
    for part in rows.where(f"{DAY} = '2024-01-05'").select("file").distinct().collect():
        keys = [tuple(r) for r in spark.read.parquet(part.file).select("product_id", "user_id").collect()]
        assert keys == sorted(keys, key=lambda k: [(v is not None, v or 0) for v in k])


def test_only_wanted_days_are_read(warehouse, raw_rows):
    warehouse.append("ecom_events", raw_rows(*[{"event_time": f"2020-01-{d:02d} 01:00:00"} for d in range(1, 9)]))
    days = warehouse.days("ecom_events")
    assert len(days) == 8
    some = warehouse.read_days("ecom_events", days[6])
    assert some.count() == 2 and len(some.inputFiles()) == 2


def test_cluster_settings_grow_with_the_data():
    assert shuffle_partitions(0) == 200
    assert shuffle_partitions(2**40) > 5_000
    assert shuffle_partitions(100 * 2**40) == 40_000
    assert cluster_conf(2**50)["spark.sql.session.timeZone"] == "UTC"


def csv(folder, name: str, *lines: str) -> None:
    header = "event_time,event_type,product_id,category_id,category_code,brand,price,user_id,user_session"
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text("\n".join([header, *lines]) + "\n")


GOOD = "2019-10-01 00:00:00 UTC,cart,5773203,1487580005134238553,,runail,2.62,463240011,26dd6e6e"


def test_month_names():
    assert monthly_csv.batch_label("2019-10") == "2019-Oct"
    for bad in ("2019-13", "2019", "Oct-2019"):
        with pytest.raises(ValueError):
            monthly_csv.batch_label(bad)


def test_csv_values(spark, tmp_path, warehouse):
    csv(tmp_path / "in", "2019-Oct.csv", GOOD)
    assert pipeline.ingest(warehouse, str(tmp_path / "in"), str(tmp_path / "landing"), ["2019-10"]) == ["2019-10"]
    row = warehouse.read("ecom_events").first()
    assert (str(row.event_time), row.product_id, row.brand) == ("2019-10-01 00:00:00", 5773203, "runail")
    assert row.category_code is None and int(row.category_id) == 1487580005134238553


def test_quoted_empty_fields(spark, tmp_path):
    header = "event_time,event_type,product_id,category_id,category_code,brand,price,user_id,user_session".split(",")
    csv(tmp_path / "in", "2019-Oct.csv", ",".join(['""'] * len(header)), GOOD)
    row = monthly_csv.scan(spark, [str(tmp_path / "in/2019-Oct.csv")]).where("user_id IS NULL").first()
    texts = {"event_type", "category_code", "brand", "user_session"}
    assert {name: row[name] for name in header} == {name: "" if name in texts else None for name in header}


def test_quoted_newline_is_one_row(spark, tmp_path):
    csv(tmp_path / "in", "2019-Oct.csv", GOOD.replace("runail", '"ru\nnail"'), GOOD.replace("runail", '"a ""b"" c"'))
    paths = [str(tmp_path / "in/2019-Oct.csv")]
    assert monthly_csv.has_quoted_newlines(spark, paths)
    assert sorted(r.brand for r in monthly_csv.scan(spark, paths).collect()) == ['a "b" c', "ru\nnail"]


def test_files_with_quoted_newlines_are_split(spark, tmp_path):
    brands = [f"b{n}\n" * (n % 4) + '"' * (n % 3) + f'\r\n,"{n}' for n in range(3000)]
    long = "x\n" * 100_000
    records = [GOOD.replace("runail", '"' + b.replace('"', '""') + '"').replace("5773203", str(n)) for n, b in enumerate([*brands, long])]
    header = "event_time,event_type,product_id,category_id,category_code,brand,price,user_id,user_session"
    for name, end in (("2019-Oct.csv", "\n"), ("2019-Nov.csv", "\r\n")):
        (tmp_path / name).write_bytes(end.join([header, *records, "", ""]).encode())
        spark.conf.set("spark.sql.files.maxPartitionBytes", "32k")
        try:
            assert monthly_csv.lines_of(spark, [str(tmp_path / name)]).rdd.getNumPartitions() > 8
            rows = monthly_csv.scan(spark, [str(tmp_path / name)]).collect()
        finally:
            spark.conf.unset("spark.sql.files.maxPartitionBytes")
        assert {r.product_id: r.brand for r in rows} == dict(enumerate([*brands, long])) and len(rows) == len(records)


def test_files_without_quoted_newlines_can_be_split(spark, tmp_path):
    csv(tmp_path / "in", "2019-Oct.csv", *[GOOD.replace("runail", '"a ""b"", c"')] * 2000)
    paths = [str(tmp_path / "in/2019-Oct.csv")]
    assert not monthly_csv.has_quoted_newlines(spark, paths)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64k")
    try:
        rows = monthly_csv.scan(spark, paths)
        assert rows.rdd.getNumPartitions() > 1
        assert rows.select("brand").distinct().collect() == [('a "b", c',)]
        assert rows.count() == 2000
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


@pytest.mark.parametrize(
    "bad",
    [
        GOOD.replace("5773203", "zz"),
        GOOD.replace("2.62", "cheap"),
        GOOD.replace("2019-10-01", "2019-31-01"),
        GOOD.replace("1487580005134238553", "1" * 30),
        GOOD.rsplit(",", 2)[0],
        GOOD + ",more",
    ],
    ids=["number", "price", "time", "wide category", "short row", "long row"],
)
def test_bad_record_fails_the_load(spark, tmp_path, warehouse, bad):
    csv(tmp_path / "in", "2019-Oct.csv", GOOD, bad)
    with pytest.raises(Exception, match="MALFORMED|FAILED_READ_FILE"):
        pipeline.ingest(warehouse, str(tmp_path / "in"), str(tmp_path / "landing"))
    assert not files.exists(spark, monthly_csv.landed_path(str(tmp_path / "landing"), "2019-10") + "/_SUCCESS")
    assert not warehouse.exists("ecom_events")


def test_a_bad_month_is_landed_once_it_is_mended(spark, tmp_path, warehouse):
    source, landing = str(tmp_path / "in"), str(tmp_path / "landing")
    csv(tmp_path / "in", "2019-Oct.csv", GOOD)
    csv(tmp_path / "in", "2019-Nov.csv", GOOD.replace("5773203", "zz"))
    with pytest.raises(Exception, match="MALFORMED|FAILED_READ_FILE"):
        pipeline.ingest(warehouse, source, landing)
    csv(tmp_path / "in", "2019-Nov.csv", GOOD.replace("5773203", "8"))
    assert pipeline.ingest(warehouse, source, landing) == ["2019-10", "2019-11"]
    assert sorted(r.product_id for r in warehouse.read("ecom_events").collect()) == [8, 5773203]


def test_category_is_rounded_half_away_from_zero(spark, tmp_path):
    values = {"0.0000000005": "0.000000001", "-0.0000000005": "-0.000000001", "7": "7.000000000"}
    csv(tmp_path / "in", "2019-Oct.csv", *[GOOD.replace("1487580005134238553", v) for v in values])
    rows = monthly_csv.scan(spark, [str(tmp_path / "in/2019-Oct.csv")])
    assert [r[0] for r in rows.selectExpr("CAST(category_id AS string)").collect()] == list(values.values())


def test_absent_month_writes_nothing(spark, tmp_path, warehouse):
    csv(tmp_path / "in", "2019-Oct.csv", GOOD)
    assert pipeline.ingest(warehouse, str(tmp_path / "in"), str(tmp_path / "landing"), ["2019-11"]) == []
    assert not warehouse.exists("ecom_events")


def test_unlistable_source_is_an_error(spark, tmp_path, warehouse):
    with pytest.raises(Exception, match="FileNotFound|does not exist"):
        pipeline.ingest(warehouse, str(tmp_path / "absent"), str(tmp_path / "landing"), ["2019-11"])


def test_landed_month_stays_and_a_second_append_doubles(spark, tmp_path, warehouse):
    source, landing = str(tmp_path / "in"), str(tmp_path / "landing")
    csv(tmp_path / "in", "2019-Oct.csv", GOOD)
    pipeline.ingest(warehouse, source, landing)
    csv(tmp_path / "in", "2019-Oct.csv", GOOD.replace("runail", "other"))
    pipeline.ingest(warehouse, source, landing, keep_staging=True)
    history = warehouse.read("ecom_events")
    assert [r.brand for r in history.collect()] == ["runail", "runail"]
    assert warehouse.read("ecom_staging").count() == 1
    assert stg_ecom_events(history).count() == 1
    monthly_csv.land(spark, source, landing, overwrite=True)
    assert [r.brand for r in monthly_csv.read_landed(spark, landing, ["2019-10"]).collect()] == ["other"]


def test_catch_up_lands_all_months_in_order(spark, tmp_path, warehouse):
    months = {"2019-Dec.csv": "2019-12", "2019-Oct.csv": "2019-10", "2020-Feb.csv": "2020-02"}
    for name, month in months.items():
        csv(tmp_path / "in", name, GOOD.replace("2019-10", month))
    csv(tmp_path / "in", "notes.csv", "not a batch")
    checks = pipeline.run_pipeline(warehouse, str(tmp_path / "in"), str(tmp_path / "landing"))
    assert sorted(monthly_csv.find_batches(spark, str(tmp_path / "in"))) == sorted(months.values())
    assert len(warehouse.days("fct_events")) == 3
    assert checks.agg(F.sum("failures")).first()[0] == 0
    csv(tmp_path / "in", "2020-Mar.csv", GOOD.replace("2019-10", "2020-03"))
    pipeline.run_pipeline(warehouse, str(tmp_path / "in"), str(tmp_path / "landing"))
    assert (warehouse.read("ecom_events").count(), warehouse.read("fct_events").count()) == (4, 4)
    pipeline.run_pipeline(warehouse, str(tmp_path / "in"), str(tmp_path / "landing"), ["2020-02", "2020-03"])
    assert (warehouse.read("ecom_events").count(), warehouse.read("fct_events").count()) == (6, 4)


def test_a_broken_run_is_run_again(spark, tmp_path, warehouse, monkeypatch):
    csv(tmp_path / "in", "2019-Oct.csv", GOOD)
    arguments = (warehouse, str(tmp_path / "in"), str(tmp_path / "landing"))
    with monkeypatch.context() as patch:
        patch.setattr(pipeline, "build_fact", lambda *_, **__: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError, match="lost"):
            pipeline.run_pipeline(*arguments)
    for _ in range(2):
        assert pipeline.run_pipeline(*arguments).agg(F.sum("failures")).first()[0] == 0
        assert (warehouse.read("ecom_events").count(), len(facts(warehouse))) == (2, 1)


def test_stream_takes_each_file_once(spark, tmp_path, warehouse):
    from clickloom.streaming.new_files import process_new_files

    def run():
        return process_new_files(warehouse, str(tmp_path / "in"), str(tmp_path / "seen"), max_files=1)

    csv(tmp_path / "in", "2019-Oct.csv", GOOD)
    csv(tmp_path / "in/2019-Nov.csv", "part-0.csv", GOOD.replace("2019-10", "2019-11").replace("runail", '"a\nb"'))
    assert run() == 2
    assert run() == 0
    csv(tmp_path / "in", "2019-Dec.csv", GOOD.replace("2019-10", "2019-12"))
    assert run() == 1
    assert sorted(r.brand for r in warehouse.read("ecom_events").collect()) == ["a\nb", "runail", "runail"]
    assert len(facts(warehouse)) == 3


def test_stream_leaves_other_files_alone(spark, tmp_path, warehouse):
    from clickloom.streaming.new_files import process_new_files

    csv(tmp_path / "in", "2019-Oct.csv", GOOD)
    (tmp_path / "in/notes.txt").write_text("no batch")
    assert process_new_files(warehouse, str(tmp_path / "in"), str(tmp_path / "seen")) == 1
    assert warehouse.read("ecom_events").count() == 1


def test_stream_and_run_share_one_book(spark, tmp_path, warehouse):
    from clickloom.streaming.new_files import process_new_files

    source, landing, seen = (str(tmp_path / name) for name in ("in", "landing", "seen"))
    csv(tmp_path / "in", "2019-Oct.csv", GOOD)
    process_new_files(warehouse, source, seen)
    pipeline.run_pipeline(warehouse, source, landing)
    assert warehouse.read("ecom_events").count() == 1
    csv(tmp_path / "in", "2019-Nov.csv", GOOD.replace("2019-10", "2019-11"))
    pipeline.run_pipeline(warehouse, source, landing)
    process_new_files(warehouse, source, seen)
    assert warehouse.read("ecom_events").count() == 2
    assert pipeline.taken_months(warehouse) == {"2019-10", "2019-11"}


def test_stream_repeats_a_failed_batch(spark, tmp_path, warehouse, monkeypatch):
    from clickloom.streaming.new_files import process_new_files

    csv(tmp_path / "in", "2019-Oct.csv", GOOD)
    arguments = (warehouse, str(tmp_path / "in"), str(tmp_path / "seen"))
    with monkeypatch.context() as patch:
        patch.setattr(pipeline, "transform", lambda *_, **__: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(Exception, match="lost"):
            process_new_files(*arguments)
    assert warehouse.read("ecom_events").count() == 1
    assert process_new_files(*arguments) == 1
    assert warehouse.read("ecom_events").count() == 1
    assert len(facts(warehouse)) == 1


def day_files(warehouse, table: str) -> dict:
    return {d: files.names(warehouse.spark, warehouse.day_path(table, d)) for d in warehouse.days(table)}


def test_files_of_other_writers_reach_the_dimensions(spark, warehouse, raw_rows, tmp_path):
    """Renamed files, and files without an ingest, on a new day and on one that is known."""
    load(warehouse, raw_rows({"event_time": "2020-01-01 00:00:00"}))
    for n, day in enumerate(("2020-01-01", "2020-01-02")):
        rows = raw_rows({"event_time": f"{day} 05:00:00", "user_id": 70 + n, "product_id": 80 + n})
        rows.coalesce(1).write.parquet(str(tmp_path / day))
        (name,) = [f for f in files.names(spark, str(tmp_path / day)) if f.endswith(".parquet")]
        files.move(spark, str(tmp_path / day / name), f"{warehouse.path('ecom_events')}/{DAY}={day}/some other name {n}")
    pipeline.transform(warehouse)
    assert {r.user_id for r in warehouse.read("dim_users").collect()} == {2, 70, 71}
    assert {r.product_id for r in warehouse.read("dim_products").collect()} == {1, 80, 81}
    assert pipeline.check(warehouse).agg(F.sum("failures")).first()[0] == 0


def test_a_run_looks_at_changed_days_only(spark, warehouse, raw_rows, monkeypatch):
    from clickloom.sources import tables

    monkeypatch.setattr(tables, "FRESH_MS", -1000)
    load(warehouse, raw_rows(*[{"event_time": f"2020-01-{d:02d} 00:00:00"} for d in range(1, 8)]))
    looked = []
    sizes = files.stored_bytes
    monkeypatch.setattr(files, "stored_bytes", lambda s, path: (looked.append(path), sizes(s, path))[1])
    pipeline.update_dims(warehouse)
    assert not [path for path in looked if DAY in path]
    warehouse.append("ecom_events", raw_rows({"event_time": "2020-01-03 01:00:00", "user_id": 9}))
    pipeline.update_dims(warehouse)
    assert {path.split("=")[-1] for path in looked if DAY in path} == {"2020-01-03"}
    assert {r.user_id for r in warehouse.read("dim_users").collect()} == {2, 9}


def test_a_merge_rewrites_the_files_with_matches_only(spark, warehouse, raw_rows):
    for user in (1, 2, 3):
        load(warehouse, raw_rows({"user_id": user, "event_time": f"2020-01-05 0{user}:00:00"}))
    (before,) = day_files(warehouse, "fct_events").values()
    assert len([f for f in before if f.endswith(".parquet")]) == 3
    rows = warehouse.read("fct_events").where("hour(event_at_utc) = 2")
    warehouse.merge("fct_events", rows.withColumn("event_price", F.lit(1.0)), "event_sk")
    (after,) = day_files(warehouse, "fct_events").values()
    assert len(set(before) & set(after)) == len(before) - 1
    prices = {r.event_at_utc.hour: r.event_price for r in warehouse.read("fct_events").collect()}
    assert prices == {1: 5.0, 2: 1.0, 3: 5.0}
    rows = warehouse.read("fct_events").where("hour(event_at_utc) = 2")
    with pytest.raises(DuplicateMergeKey):
        warehouse.merge("fct_events", rows.unionByName(rows), "event_sk")
    assert warehouse.read("fct_events").count() == 3


@pytest.mark.parametrize("broken", ["move", "delete", "write_text"])
def test_a_commit_of_several_days_is_whole_or_not_there(spark, warehouse, raw_rows, monkeypatch, broken):
    load(warehouse, raw_rows(*[{"event_time": f"2020-01-{d:02d} 00:00:00"} for d in range(1, 7)]))
    delta = warehouse.read("fct_events").drop(DAY).withColumn("event_price", F.lit(1.0))
    calls, real = [], getattr(files, broken)

    def failing(spark, path, *more):
        if "/fct_events" in path or "/_commits" in path:
            calls.append(path)
            if len(calls) > (0 if broken == "write_text" else 2):
                raise OSError("lost")
        return real(spark, path, *more)

    with monkeypatch.context() as patch:
        patch.setattr(files, broken, failing)
        with pytest.raises(OSError, match="lost"):
            warehouse.merge("fct_events", delta, "event_sk")
    other = Warehouse(spark, warehouse.root)
    assert [r.event_price for r in other.read("fct_events").collect()] == [5.0 if broken == "write_text" else 1.0] * 6
    assert all(len([f for f in names if f.endswith(".parquet")]) == 1 for names in day_files(other, "fct_events").values())


def test_a_broken_append_is_entered_with_its_rows_or_not_at_all(spark, warehouse, raw_rows, monkeypatch):
    rows = raw_rows(*[{"event_time": f"2020-01-{d:02d} 00:00:00"} for d in range(1, 4)])
    with monkeypatch.context() as patch:
        patch.setattr(files, "move", lambda *_: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError, match="lost"):
            warehouse.append("ecom_events", rows, "batch-1")
    assert warehouse.ingested("batch-1") and not warehouse.append("ecom_events", rows, "batch-1")
    assert warehouse.read("ecom_events").count() == 3 and not warehouse.ingested("batch-2")


def test_files_of_a_large_day_have_ranges_of_their_own(spark, tmp_path, samples_folder):
    warehouse = Warehouse(spark, str(tmp_path / "warehouse"), cluster_bytes=0)
    raw = samples.order_lines(spark, samples_folder)
    times = F.timestamp_seconds(F.lit(1_578_182_400) + F.pmod(F.xxhash64("user_id", "price"), F.lit(86_400)))
    one_day = raw.withColumn("event_time", times)
    held = registry.held(spark, one_day)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", False)
    try:
        warehouse.append("ecom_events", held)
        hot = held.withColumn("product_id", F.lit(7).cast("bigint")).withColumn("user_id", F.lit(7).cast("bigint"))
        warehouse.append("ecom_events", hot.withColumn("event_time", F.lit("2020-01-06 00:00:00").cast("timestamp")).repartition(8))
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    rows = warehouse.read("ecom_events").groupBy(DAY, F.input_file_name().alias("file"))
    found = rows.agg(F.min("product_id").alias("low"), F.max("product_id").alias("high"), F.count("*").alias("n")).collect()
    ranges = sorted((r.low, r.high) for r in found if r[DAY].day == 5)
    assert len(ranges) > 2 and all(high <= low for (_, high), (low, _) in zip(ranges, ranges[1:]))
    wanted = ranges[-1][1]
    assert sum(low <= wanted <= high for low, high in ranges) == 1  # what a search for one product has to read
    assert len([r for r in found if r[DAY].day == 6]) > 2  # one product and user: spread all the same
    assert sum(r.n for r in found) == 2 * raw.count()


def test_reports_from_summaries_equal_direct_ones(spark, warehouse, samples_folder):
    raw = registry.held(spark, samples.clickstream(spark, samples_folder))

    def both():
        pipeline.update_summaries(warehouse)
        events, hours, products = (warehouse.read(n) for n in ("fct_events", "dim_datetime", "dim_products"))
        daily_hours, daily_products = warehouse.read("daily_hours"), warehouse.read("daily_products")
        pairs = [
            (reports.purchase_funnel(events), reports.funnel_of_sessions(warehouse.read("session_state"))),
            (reports.sales_by_hour(events, hours), reports.sales_of_hours(daily_hours, hours, *reports.HOUR)),
            (reports.sales_by_weekday(events, hours), reports.sales_of_hours(daily_hours, hours, *reports.WEEKDAY)),
            (reports.top_products(events, products), reports.top_products_of_days(daily_products, products)),
        ]
        for direct, summed in pairs:
            assert Counter(map(tuple, direct.collect())) == Counter(map(tuple, summed.collect()))

    load(warehouse, raw.where("user_id % 2 = 0"))
    both()
    load(warehouse, raw.where("user_id % 2 = 1").withColumn("price", F.col("price") + 1), lookback_days=40)
    both()
    load(warehouse, raw.where("day(event_time) > 25").withColumn("price", F.col("price") / 2), lookback_days=3)
    both()


def test_repeats_are_found_by_hashes_first(spark):
    values = [("a",), ("a",), (None,), (None,), ("b",), ("c",), ("c",), ("c",)]
    table, held = spark.createDataFrame(values, "c string"), []

    def hold(label, rows):
        held.append(rows.collect())
        return spark.createDataFrame(held[-1], rows.schema), 0

    assert sorted(map(tuple, quality.unique_by_hash(table, "c", hold).collect())) == [("a", 2), ("c", 3)]
    assert len(held[0]) == 2 and [type(v) for row in held[0] for v in row] == [int, int]


@pytest.mark.parametrize("split", ["32k", "128m"])
def test_a_quote_that_is_never_closed_fails_the_load(spark, tmp_path, monkeypatch, split):
    monkeypatch.setattr(monthly_csv, "RECORD_CHARACTERS", 100_000)
    csv(tmp_path, "2019-Oct.csv", GOOD, GOOD.replace("runail", '"open'), *[GOOD] * 3000, GOOD.replace("runail", '"open'))
    csv(tmp_path, "2019-Nov.csv", *[GOOD.replace("runail", '"a\nb"')] * 3000)
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    try:
        with pytest.raises(Exception, match="MALFORMED file .*2019-Oct.csv: a record of over 100000 characters"):
            monthly_csv.scan(spark, [str(tmp_path / "2019-Oct.csv")]).count()
        assert monthly_csv.scan(spark, [str(tmp_path / "2019-Nov.csv")]).count() == 3000
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
