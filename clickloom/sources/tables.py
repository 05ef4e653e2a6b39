"""Named parquet tables below one root folder."""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from datetime import date
from typing import NamedTuple
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickloom import schemas as S
from clickloom.operators.merge import upsert
from clickloom.session import Scratch, bytes_read, prepare, sized
from clickloom.sources import commits, files


#: Folder value of the rows without a day.
NULL_DAY = "__HIVE_DEFAULT_PARTITION__"
#: Size that files of a compacted table have, and files more than needed that are left alone.
FILE_BYTES, SPARE_FILES = 128 * 1024 * 1024, 64
#: Bytes read for a write from which on its days may be split, so that rows are dealt to files by the cluster columns.
CLUSTER_BYTES = 1024 * 1024 * 1024
#: Column of the task that read a row, while rows are dealt.
READ_BY = "_read_by"
#: A folder changed so lately, in milliseconds, may change again without its stamp telling; more where stamps are seconds.
FRESH_MS, FRESH_SECONDS_MS = 20, 2000


class Days(NamedTuple):
    """A range of days and the bytes stored for them."""

    first: date
    last: date
    size: int


def day_ranges(sizes: Iterable[tuple[date, int]], max_bytes: int) -> list[Days]:
    """Days in order as ranges of at most ``max_bytes`` of stored data, or of one day."""
    ranges: list[Days] = []
    for day, size in sizes:
        if ranges and ranges[-1].size + size <= max_bytes:
            ranges[-1] = Days(ranges[-1].first, day, ranges[-1].size + size)
        else:
            ranges.append(Days(day, day, size))
    return ranges


@dataclass(frozen=True)
class Layout:
    """Schema of a table; for a day-partitioned one also the timestamp that gives the day and the sort inside files."""

    schema: T.StructType
    day_of: str | None = None
    cluster: tuple[str, ...] = ()
    ingests: bool = False  # whether rows carry the id of their ingest, unseen by readers

    @property
    def stored(self) -> T.StructType:
        return S.with_day(self.schema) if self.day_of else self.schema

    @property
    def with_ingest(self) -> T.StructType:
        return S.with_day(T.StructType([*self.schema.fields, T.StructField(S.INGEST, T.StringType())]))


TABLES = {
    "ecom_staging": Layout(S.RAW),
    "ecom_events": Layout(S.RAW, "event_time", ("product_id", "user_id"), ingests=True),
    "dim_datetime": Layout(S.DIM_DATETIME),
    "dim_products": Layout(S.DIM_PRODUCTS),
    "dim_users": Layout(S.DIM_USERS),
    "product_latest": Layout(S.PRODUCT_LATEST),
    "finished_months": Layout(S.FINISHED_MONTHS),
    "ingests": Layout(S.INGESTS),
    "dim_ingests": Layout(S.DIM_INGESTS),
    "fct_events": Layout(S.FCT_EVENTS, "event_at_utc", ("product_sk", "user_sk")),
    "daily_products": Layout(S.DAILY_PRODUCTS, S.DAY, ("product_sk",)),
    "daily_hours": Layout(S.DAILY_HOURS, S.DAY, ("datetime_sk",)),
    "session_state": Layout(S.SESSION_STATE),
}


class Warehouse:
    """The pipeline's tables. Schemas are declared, never inferred, so reading costs no footer scan.

    ``views`` leads the names under which tables are registered for SQL, so that several warehouses fit in one session.
    """

    def __init__(self, spark: SparkSession, root: str, views: str = "", cluster_bytes: int = CLUSTER_BYTES):
        self.spark = prepare(spark)
        self.root = root.rstrip("/")
        self.views = views
        self.cluster_bytes = cluster_bytes
        self.journals = f"{self.root}/_commits"

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def day_path(self, name: str, day: date) -> str:
        return f"{self.path(name)}/{S.DAY}={day}"

    def exists(self, name: str) -> bool:
        """Whether the table was written and its last overwrite, if any, came to an end."""
        self.recover()
        return files.exists(self.spark, f"{self.path(name)}/_SUCCESS")

    def recover(self) -> None:
        """Finish the commits that broke off."""
        commits.finish_all(self.spark, self.journals)

    def read(self, name: str) -> DataFrame:
        self.recover()
        return self.spark.read.schema(TABLES[name].stored).parquet(self.path(name))

    def days(self, name: str) -> list[date]:
        """Days of a day-partitioned table in order, from its folder names alone."""
        return sorted(self.day_stamps(name))

    def _moves(self, name: str, staged: str) -> list[tuple[str, str]]:
        """What to move where: the whole table if there is none yet, else whole days; their files where the day is there."""
        if not files.exists(self.spark, self.path(name)):
            return [(staged, self.path(name))]
        there, moves = set(files.names(self.spark, self.path(name))), []
        for entry in files.names(self.spark, staged):
            each = files.names(self.spark, f"{staged}/{entry}") if entry in there and "=" in entry else [""]
            moves += [(f"{staged}/{entry}/{f}".rstrip("/"), f"{self.path(name)}/{entry}/{f}".rstrip("/")) for f in each]
        return moves

    def day_stamps(self, name: str) -> dict[date, int]:
        """The days of a table and when their folders last changed, from a listing of one folder."""
        self.recover()
        prefix, found = f"{S.DAY}=", files.stamps(self.spark, self.path(name))
        days = {entry.removeprefix(prefix): stamp for entry, stamp in found.items() if entry.startswith(prefix)}
        return {date.fromisoformat(day): stamp for day, stamp in days.items() if day != NULL_DAY}

    def changed_days(self, name: str, book: str) -> tuple[set[date], dict[date, int]]:
        """The days whose folders changed since ``book`` was kept, and what to keep there once they are taken in.

        Days that changed a moment ago are not kept, as they may change again within one tick of the clock. On a file
        system that has no times for folders all days are looked at.
        """
        stamps, now, path = self.day_stamps(name), int(time.time() * 1000), self.book_path(book)
        known = json.loads(files.read_text(self.spark, path)) if files.exists(self.spark, path) else {}
        changed = {day for day, stamp in stamps.items() if known.get(str(day)) != stamp}
        fresh = FRESH_SECONDS_MS if all(stamp % 1000 == 0 for stamp in stamps.values()) else FRESH_MS
        return changed, {day: stamp for day, stamp in stamps.items() if 0 < stamp < now - fresh}

    def book_path(self, book: str) -> str:
        return f"{self.root}/_books/{book}.json"

    def keep(self, book: str, stamps: dict[date, int]) -> None:
        """Keep when the folders of days had last changed as their rows were taken in; a number per day."""
        files.make_folder(self.spark, f"{self.root}/_books")
        files.delete(self.spark, self.book_path(book))
        files.write_text(self.spark, self.book_path(book), json.dumps({str(d): s for d, s in sorted(stamps.items())}))

    def day_slices(self, name: str, max_bytes: int, first: date = date.min) -> list[Days]:
        """The days from ``first`` on as ranges of at most ``max_bytes`` of stored data, or of one day, in order."""
        days = [day for day in self.days(name) if day >= first]
        return day_ranges(((d, files.stored_bytes(self.spark, self.day_path(name, d))) for d in days), max_bytes)

    def read_days(self, name: str, first: date, last: date = date.max, without: DataFrame | None = None) -> DataFrame:
        """The rows of some days; the folders of other days are not listed. ``without`` has ingests to leave out."""
        return self.read_each_day(name, [day for day in self.days(name) if first <= day <= last], without)

    def read_each_day(self, name: str, days: Iterable[date], without: DataFrame | None = None) -> DataFrame:
        folders, layout = [self.day_path(name, day) for day in days], TABLES[name]
        schema = layout.stored if without is None else layout.with_ingest
        if not folders:
            return self.spark.createDataFrame([], schema)
        rows = self.spark.read.schema(schema).option("basePath", self.path(name)).parquet(*folders)
        # Rows without an ingest match none, so they always stay.
        return rows if without is None else rows.join(without.select(S.INGEST), S.INGEST, "left_anti")

    def stored_bytes(self, name: str) -> int:
        return files.stored_bytes(self.spark, self.path(name))

    def create(self, name: str) -> None:
        """Make an empty table unless it exists."""
        if not self.exists(name):
            empty = T.StructType([*TABLES[name].schema.fields, T.StructField(S.DAY, T.DateType())])
            self._write(name, self.spark.createDataFrame([], empty), "append")

    def overwrite(self, name: str, rows: DataFrame) -> None:
        """Replace all rows; creates the table if need be. Readers find the old rows until the new ones are complete."""
        new = f"{self.path(name)}.new"
        self._write(name, rows, "overwrite", path=new)
        files.swap(self.spark, new, self.path(name))

    def append(self, name: str, rows: DataFrame, ingest_id: str | None = None) -> bool:
        """Add the rows as they are, without looking for copies.

        All days of a day-partitioned table get their rows in one step, and with them the entry in ``ingests`` if the table
        has ingests. What was ingested under an ``ingest_id`` before is not added again; returns whether rows were added.
        """
        layout = TABLES[name]
        if not layout.day_of:
            self._write(name, rows, "append")
            return True
        if ingest_id is not None and self.ingested(ingest_id):
            return False
        self._commit(name, rows, ingest_id=(ingest_id or uuid.uuid4().hex) if layout.ingests else None)
        return True

    def ingested(self, ingest_id: str) -> bool:
        """Whether rows were added under this id."""
        return self.exists("ingests") and not self.read("ingests").where(F.col(S.INGEST) == ingest_id).isEmpty()

    def replace_days(self, name: str, rows: DataFrame, days: Iterable[date]) -> None:
        """Put rows in place of those of the given days, in one step."""
        there = set(self.days(name)) if self.exists(name) else set()
        old = [
            f"{self.day_path(name, day)}/{file}"
            for day in sorted(set(days) & there)
            for file in files.names(self.spark, self.day_path(name, day))
        ]
        self._commit(name, rows, removes=old)

    def _commit(
        self, name: str, rows: DataFrame, removes: Sequence[str] = (), ingest_id: str | None = None
    ) -> None:
        """Write rows aside, then move them in and delete files, all as one step."""
        staged = f"{self.root}/_staged/{name}-{uuid.uuid4().hex}"
        if ingest_id is not None:
            rows = rows.withColumn(S.INGEST, F.lit(ingest_id))
        self._write(name, rows, "overwrite", path=f"{staged}/{name}")
        moves = self._moves(name, f"{staged}/{name}")
        if ingest_id is not None:
            prefix = f"{S.DAY}="
            folders = [f for f in files.names(self.spark, f"{staged}/{name}") if f.startswith(prefix)]
            days = [f.removeprefix(prefix) for f in folders if not f.endswith(NULL_DAY)]
            rows = [(ingest_id, date.fromisoformat(day)) for day in days] or [(ingest_id, None)]
            self.spark.createDataFrame(rows, S.INGESTS).coalesce(1).write.parquet(f"{staged}/ingests")
            moves += self._moves("ingests", f"{staged}/ingests")
        commits.commit(self.spark, self.journals, staged, moves, removes)

    def compact(self, name: str, file_bytes: int = FILE_BYTES, spare_files: int = SPARE_FILES) -> None:
        """Rewrite a table without days if appends have left it in many more files than its size needs."""
        parts = [entry for entry in files.names(self.spark, self.path(name)) if entry.startswith("part-")]
        needed = -(-self.stored_bytes(name) // file_bytes)
        if len(parts) > 2 * needed + spare_files:
            self.overwrite(name, self.read(name).repartition(max(1, needed)))

    def merge(self, name: str, delta: DataFrame, key: str, one_per_key: bool = False) -> None:
        """Upsert by ``key``, rewriting only the files that hold rows to be replaced, in one step for all days.

        The delta is stored first, as the merge reads it several times.
        """
        with Scratch(self.spark) as scratch:
            stored, size = scratch.hold(f"{name}-delta", self._with_day(name, delta))
            with sized(self.spark, size):
                days = {row[0] for row in stored.select(S.DAY).distinct().collect()}
                if not days:
                    return
                there = self.read_each_day(name, sorted(days & set(self.days(name))))
                hit = self._files_with(name, there, stored, key)
                found = there.limit(0)
                if hit:
                    found = self.spark.read.schema(TABLES[name].stored).option("basePath", self.path(name)).parquet(*hit)
                self._commit(name, upsert(found, stored, key, one_per_key), removes=hit)

    def _files_with(self, name: str, rows: DataFrame, delta: DataFrame, key: str) -> list[str]:
        """Paths of the files that hold a key of the delta; a name per file of its days at most."""
        if not rows.inputFiles():
            return []
        placed = rows.select(key, S.DAY, F.col("_metadata.file_name").alias("file"))
        found = placed.join(delta.select(key), key, "left_semi").select(S.DAY, "file").distinct().collect()
        return sorted(f"{self.day_path(name, row[S.DAY])}/{unquote(row.file)}" for row in found)

    def register(self, *names: str) -> None:
        """Make tables queryable by name in SQL."""
        for name in names:
            self.read(name).createOrReplaceTempView(f"{self.views}{name}")

    def publish(self, database: str) -> None:
        """Declare the tables in the session's catalog, over the same files, with the days that exist now."""
        self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {database} LOCATION '{self.root}'")
        for name, layout in TABLES.items():
            if not self.exists(name):
                continue
            columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in layout.stored.fields)
            days = f"PARTITIONED BY ({S.DAY})" if layout.day_of else ""
            self.spark.sql(
                f"CREATE TABLE IF NOT EXISTS {database}.{name} ({columns}) USING parquet {days}"
                f" LOCATION '{self.path(name)}'"
            )
            self.spark.sql(f"MSCK REPAIR TABLE {database}.{name}" if days else f"REFRESH TABLE {database}.{name}")

    def _with_day(self, name: str, rows: DataFrame) -> DataFrame:
        layout = TABLES[name]
        columns = [F.col(f.name).cast(f.dataType).alias(f.name) for f in layout.schema.fields]
        if layout.ingests and S.INGEST in rows.columns:
            columns.append(F.col(S.INGEST))
        return rows.select(*columns, F.to_date(layout.day_of).alias(S.DAY)) if layout.day_of else rows.select(*columns)

    def _dealt(self, name: str, rows: DataFrame) -> DataFrame:
        """Rows dealt to the tasks that write them, and sorted there. The day leads the sort, else the writer sorts again.

        Few rows are rebalanced on the day, which gives a file for each. Of many a day may need several files, so rows are
        dealt by ranges of the day and the cluster columns: each file then has a range of its own, which the statistics in
        its footer tell. The time and the task that read a row come last, so that a hot product or copies of one event,
        however many, are spread as well.
        """
        layout = TABLES[name]
        if bytes_read(rows) <= self.cluster_bytes:
            return rows.hint("rebalance", S.DAY).sortWithinPartitions(S.DAY, *layout.cluster)
        by = [S.DAY, *layout.cluster, *([layout.day_of] if layout.day_of != S.DAY else []), READ_BY]
        ranged = rows.withColumn(READ_BY, F.spark_partition_id()).repartitionByRange(*by)
        return ranged.drop(READ_BY).sortWithinPartitions(S.DAY, *layout.cluster)

    def _write(self, name: str, rows: DataFrame, mode: str, path: str | None = None) -> None:
        rows = self._with_day(name, rows)
        if TABLES[name].day_of:
            rows = self._dealt(name, rows)
        writer = rows.write.mode(mode)
        if TABLES[name].day_of:
            writer = writer.partitionBy(S.DAY)
        writer.parquet(path or self.path(name))
