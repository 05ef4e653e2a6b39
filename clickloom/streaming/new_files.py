"""Run the pipeline on files that are new since the last run."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession

from clickloom.plans import pipeline
from clickloom.schemas import FINISHED_MONTHS, RAW
from clickloom.sources import files, monthly_csv
from clickloom.sources.tables import Warehouse

FILE = "path string, modificationTime timestamp, length bigint, content binary"


def stream_id(spark: SparkSession, checkpoint: str) -> str:
    """The id that a stream keeps in its checkpoint, whatever the folder is called."""
    return json.loads(files.read_text(spark, f"{checkpoint}/metadata"))["id"]


def process_new_files(
    warehouse: Warehouse,
    source: str,
    checkpoint: str,
    quoted_newlines: bool | None = None,
    max_files: int = 1000,
    lookback_days: int | None = None,
) -> int:
    """Take all files not yet seen into the history and the star schema; returns the number of batches run.

    Stops when no new file is left. The stream remembers the files seen and hands over the names of the new ones, at
    most ``max_files`` at a time; their contents are scanned like any monthly batch, so large files are split where
    that is safe. If a batch fails it is run again from its start. Its rows are ingested under an id made of the stream and
    the batch, so they are in the history once, and every other step gives the same result again. ``source`` may hold files or folders of part files. Files that are not part of a monthly batch by
    their names are left alone, and so are those of months that a pipeline run has taken in; the months taken in here
    are recorded for such runs.
    """
    spark = warehouse.spark
    warehouse.create("ecom_events")
    found = (
        spark.readStream.format("binaryFile")
        .schema(FILE)
        .option("recursiveFileLookup", True)
        .option("maxFilesPerTrigger", max_files)
        .load(source)
        .select("path")
    )
    batches = []

    def take_in(batch: DataFrame, batch_id: int) -> None:
        months = {row.path: monthly_csv.month_in(row.path) for row in batch.collect()}
        taken = pipeline.taken_months(warehouse, "run")
        paths = [path for path, month in months.items() if month is not None and month not in taken]
        if not paths:
            return
        ingest_id = f"stream-{stream_id(spark, checkpoint)}-{batch_id}"
        if not warehouse.ingested(ingest_id):
            rows = monthly_csv.scan(spark, paths, quoted_newlines).select(*RAW.names)
            warehouse.append("ecom_events", rows, ingest_id)
        pipeline.transform(warehouse, lookback_days)
        new = {months[path] for path in paths} - pipeline.taken_months(warehouse, "stream")
        rows = spark.createDataFrame([(month, "stream") for month in sorted(new)], FINISHED_MONTHS)
        warehouse.append("finished_months", rows)
        batches.append(batch_id)

    query = (
        found.writeStream.foreachBatch(take_in)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return len(batches)
