"""What the operators share: inputs, intermediate tables, and Python tasks that find this package."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

import clickloom
from clickloom.session import MAX_SHUFFLE_PARTITIONS, SHUFFLE_PARTITION_BYTES, work_folder
from clickloom.sources import files

#: Rows of a batch that are turned into Python objects at a time.
SLICE_ROWS = 256


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def whole_text(column: str = "text") -> F.Column:
    """The text; null counts as empty."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


#: Intermediate tables that this process has written and not yet deleted.
KEPT: list[str] = []


def stored(spark: SparkSession, label: str, rows: DataFrame) -> DataFrame:
    """Write an intermediate result to the shared folder and read it back, so that no plan runs it twice.

    Results are read later, by whoever asked for them, so their tables stay until :func:`clear`.
    """
    path = work_folder(spark, f"llm-{label}")
    KEPT.append(path)
    rows.write.parquet(path)
    return spark.read.schema(rows.schema).parquet(path)


def clear(spark: SparkSession, first: int = 0, but: int = 0) -> None:
    """Delete the intermediate tables of all results so far. Call it once these have been written somewhere.

    Those before the ``first`` one stay, and as many of the last ones as ``but`` says.
    """
    last = len(KEPT) - but
    for path in KEPT[first:last]:
        files.delete(spark, path)
    del KEPT[first:last]


def partitions(spark: SparkSession, moved: int = 0) -> int:
    """Shuffle partitions that the session asks for, more of them if so many bytes are moved that these would be large."""
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return max(least, min(-(-moved // SHUFFLE_PARTITION_BYTES), MAX_SHUFFLE_PARTITIONS))


def ship(spark: SparkSession) -> None:
    """Send this package to the Python workers, once a session; a cluster's workers do not see the driver's folders."""
    context = spark.sparkContext
    if getattr(context, "_clickloom_shipped", False):
        return
    root = os.path.dirname(os.path.abspath(clickloom.__file__))
    path = os.path.join(os.path.realpath(tempfile.mkdtemp(prefix="clickloom-")), f"clickloom-{uuid.uuid4().hex}.zip")
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as package:
        for folder, _, names in os.walk(root):
            for name in names:
                if name.endswith(".py"):
                    file = os.path.join(folder, name)
                    package.write(file, os.path.join("clickloom", os.path.relpath(file, root)))
    context.addPyFile(path)
    context._clickloom_shipped = True


def map_rows(
    rows: DataFrame, task: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str | T.StructType
) -> DataFrame:
    """``mapInArrow`` with this package at hand."""
    ship(rows.sparkSession)
    return rows.mapInArrow(task, schema)


def slices(batches: Iterator[pa.RecordBatch]) -> Iterator[list[list]]:
    """The columns of a few rows at a time, as Python lists."""
    for batch in batches:
        for start in range(0, batch.num_rows, SLICE_ROWS):
            part = batch.slice(start, SLICE_ROWS)
            yield [part.column(i).to_pylist() for i in range(part.num_columns)]


def batch_of(columns: Sequence[Sequence], types: Sequence[pa.DataType], names: Sequence[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], list(names))
