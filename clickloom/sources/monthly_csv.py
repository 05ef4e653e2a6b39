"""Monthly CSV batches: find them, scan them, land them.

A batch is named ``YYYY-Mon.csv`` and is one file or a folder of part files with a header each. It is landed once, as
parquet, under ``month=YYYY-MM``; putting records together that span lines happens there, and everything later reads
typed columns.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickloom.schemas import MONTH_LABELS, RAW
from clickloom.session import prepare, side_by_side
from clickloom.sources import files

#: ``2019-Oct.csv``, also as the last part of a folder name such as ``batch=2019-Oct.csv``.
BATCH_NAME = r"(?:^|=)(\d{4}-(?:" + "|".join(MONTH_LABELS) + r"))\.csv$"


#: The most characters of a CSV record that spans lines.
RECORD_CHARACTERS = 16 * 1024 * 1024


def batch_label(month: str) -> str:
    """``2019-10`` to ``2019-Oct``."""
    match = re.fullmatch(r"(\d{4})-(0[1-9]|1[0-2])", month)
    if not match:
        raise ValueError(f"not a month in the form YYYY-MM: {month!r}")
    return f"{match[1]}-{MONTH_LABELS[int(match[2]) - 1]}"


def month_of(label: str) -> str:
    """``2019-Oct`` to ``2019-10``."""
    year, name = label.split("-")
    return f"{year}-{MONTH_LABELS.index(name) + 1:02d}"


def month_in(path: str) -> str | None:
    """The month of the batch that a file is or belongs to, by the names in its path; None if it is not of a batch."""
    for name in reversed(path.split("/")):
        match = re.search(BATCH_NAME, name)
        if match:
            return month_of(match[1])
    return None


def find_batches(spark: SparkSession, folder: str, months: Sequence[str] | None = None) -> dict[str, str]:
    """Month to path, oldest first, of the wanted months (all if None) that ``folder`` has. Absent ones are left out; two
    entries of one month are an error."""
    paths: dict[str, str] = {}
    for name in files.names(spark, folder):
        match = re.search(BATCH_NAME, name)
        if match:
            month = month_of(match[1])
            if month in paths:
                raise ValueError(f"two batches of {month}: {paths[month]} and {folder}/{name}")
            paths[month] = f"{folder}/{name}"
    if months is not None:
        wanted = {batch_label(month): month for month in months}
        paths = {month: path for month, path in paths.items() if month in wanted.values()}
    return dict(sorted(paths.items()))


def lines_of(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """The lines of files with their number of quotes, the block of the file that they begin in, and their order there."""
    read = spark.read.option("recursiveFileLookup", True).option("lineSep", "\n").text(list(paths))
    quotes = F.length("value") - F.length(F.replace(F.col("value"), F.lit('"'), F.lit("")))
    place = [F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block")]
    return read.select(*place, F.monotonically_increasing_id().alias("n"), "value", quotes.alias("quotes"))


def has_quoted_newlines(spark: SparkSession, paths: Sequence[str]) -> bool:
    """Whether any record may span lines: some line then has an odd number of quotes. Reads the files in parallel."""
    return not lines_of(spark, paths).where("quotes % 2 = 1").isEmpty()


def records_of(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """The records of files whose records may span lines, without the header lines; the files are split all the same.

    A line begins a record if the quotes before it in its file are even. Each block counts its quotes; the counts of the
    blocks before it, a row per block, tell how a block begins. A record whose lines lie in two blocks is put together
    from both, like any other. A record of more than ``RECORD_CHARACTERS``, as a quote that is never closed makes one,
    fails the load where its lines are read, with the name of its file, before anything gathers them.
    """
    lines = lines_of(spark, paths)
    in_block = Window.partitionBy("file", "block").orderBy("n")
    until = in_block.rowsBetween(Window.unboundedPreceding, -1)
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)

    def bounded(column: str, size: Column) -> Column:
        told = F.concat(F.lit("MALFORMED file "), F.col("file"), F.lit(f": a record of over {RECORD_CHARACTERS} characters"))
        return F.when(size > RECORD_CHARACTERS, F.raise_error(told).cast("string")).otherwise(F.col(column))

    blocks = lines.groupBy("file", "block").agg(F.sum("quotes").alias("in_it"))
    blocks = blocks.select("file", "block", F.coalesce(F.sum("in_it").over(earlier), F.lit(0)).alias("before"))
    begins = (F.coalesce(F.sum("quotes").over(until), F.lit(0)) + F.col("before")) % 2 == 0
    marked = lines.join(blocks, ["file", "block"]).withColumn("begins", begins.cast("int"))
    # What a line's record has of this block so far: all up to the line less all before the record's first line.
    size = F.length("value") + 1
    marked = marked.withColumns({"record": F.sum("begins").over(in_block), "so_far": F.sum(size).over(in_block)})
    before_record = F.max(F.when(F.col("begins") == 1, F.col("so_far") - size)).over(in_block)
    marked = marked.withColumn("value", bounded("value", F.col("so_far") - F.coalesce(before_record, F.lit(0))))
    # Lines at the start of a block that begin no record belong to the last record of the blocks before it.
    last = marked.groupBy("file", "block").agg(F.max("record").alias("records"), F.max("so_far").alias("size"))
    began = F.when(F.col("records") > 0, F.struct(F.col("block").alias("began_in"), F.col("records").alias("last")))
    # Blocks that lie within one record as a whole.
    inside = F.when(F.col("records") > 0, 0).otherwise(F.col("size"))
    until_here = Window.partitionBy("file").orderBy("block")
    last = last.select("file", "block", "records", F.last(began, ignorenulls=True).over(earlier).alias("open"), inside.alias("inside"))
    last = last.withColumn("inside", F.sum("inside").over(until_here))
    at_begin = F.max(F.when(F.col("records") > 0, F.col("inside"))).over(until_here)
    last = last.withColumn("file", bounded("file", F.col("inside") - F.coalesce(at_begin, F.lit(0)))).select("file", "block", "open")
    placed = marked.join(last, ["file", "block"])
    own = F.col("record") > 0
    keys = [
        "file",
        F.when(own, F.col("block")).otherwise(F.col("open.began_in")).alias("began_in"),
        F.when(own, F.col("record")).otherwise(F.col("open.last")).alias("number"),
    ]
    together = placed.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct("block", "n", "value"))).alias("lines"))
    is_header = (F.col("began_in") == 0) & (F.col("number") == 1)
    text = F.regexp_replace(F.array_join(F.col("lines.value"), "\n"), "\r$", "")
    return together.where(~is_header).select(text.alias("record")).where("record <> ''")


#: Stands for a quoted empty text while a file is parsed; an empty field without quotes is NULL.
EMPTY_TEXT = "\x01empty\x01"


def csv_options(quoted_newlines: bool) -> dict[str, str]:
    """A header line, commas, quotes doubled inside quotes. A record that does not fit the schema fails the job."""
    return {
        "header": "true",
        "sep": ",",
        "escape": '"',
        "emptyValue": EMPTY_TEXT,
        "mode": "FAILFAST",
        "multiLine": str(quoted_newlines).lower(),
        "recursiveFileLookup": "true",
    }


def as_texts() -> T.StructType:
    """The columns of a batch as they are parsed: all as text, so that a quoted empty number can be told from a bad one."""
    return T.StructType([T.StructField(f.name, T.StringType()) for f in RAW.fields])


def typed(rows: DataFrame) -> DataFrame:
    """Raw events of a scan with :func:`csv_options`: quoted empty texts as such, quoted empty numbers and times as NULL.
    A value that does not fit its type fails the job."""

    def value(field: T.StructField) -> Column:
        text = F.col(field.name)
        if isinstance(field.dataType, T.StringType):
            return F.when(text == EMPTY_TEXT, "").otherwise(text)
        given = F.when(text != EMPTY_TEXT, text)
        cast = given.try_cast(field.dataType)
        bad = F.raise_error(F.concat(F.lit(f"MALFORMED value of {field.name}: "), given)).cast(field.dataType)
        return F.when(given.isNotNull() & cast.isNull(), bad).otherwise(cast)

    return rows.select(*[value(field).alias(field.name) for field in RAW.fields])


def scan(spark: SparkSession, paths: Sequence[str], quoted_newlines: bool | None = None) -> DataFrame:
    """Raw events of CSV files.

    ``quoted_newlines`` None looks first whether records span lines. If none does, Spark splits the files and parses
    them line by line; otherwise the records are put together first, also from split files.
    """
    prepare(spark)
    if quoted_newlines is None:
        quoted_newlines = has_quoted_newlines(spark, paths)
    options = csv_options(quoted_newlines)
    if not quoted_newlines:
        return typed(spark.read.schema(as_texts()).options(**options).csv(list(paths)))
    parsed = F.from_csv("record", ", ".join(f"{name} string" for name in RAW.names), options)
    return typed(records_of(spark, paths).select(parsed.alias("r")).select("r.*"))


def landed_path(landing: str, month: str) -> str:
    return f"{landing}/month={month}"


def land(
    spark: SparkSession,
    folder: str,
    landing: str,
    months: Sequence[str] | None = None,
    overwrite: bool = False,
    quoted_newlines: bool | None = None,
) -> list[str]:
    """Land the wanted months that ``folder`` has, and return all of these that are now landed.

    A landed month is left as it is unless ``overwrite`` is set. Each month is a job of its own, so one bad file holds
    up its own month only, and a month whose job broke off is landed anew.
    """
    found = find_batches(spark, folder, months)

    def land_month(month: str) -> None:
        rows = scan(spark, [found[month]], quoted_newlines)
        rows.write.mode("overwrite").parquet(landed_path(landing, month))

    pending = [m for m in found if overwrite or not files.exists(spark, f"{landed_path(landing, m)}/_SUCCESS")]
    side_by_side(*[partial(land_month, month) for month in pending])
    return list(found)


def read_landed(spark: SparkSession, landing: str, months: Sequence[str]) -> DataFrame:
    """Raw events of landed months."""
    prepare(spark)
    return spark.read.schema(RAW).parquet(*[landed_path(landing, month) for month in months])
