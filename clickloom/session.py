"""Spark session settings and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from functools import cache

from pyspark.sql import DataFrame, SparkSession

from clickloom.sources import files

MB = 1024 * 1024
#: Size that a shuffle partition should have, and how many there may be before they are better made larger: every map
#: task keeps a block for every partition, and sorts and aggregates spill, so larger partitions cost less than more.
SHUFFLE_PARTITION_BYTES = 192 * MB
MIN_SHUFFLE_PARTITIONS, MAX_SHUFFLE_PARTITIONS = 200, 40_000
#: Bytes that a job over stored, compressed columns is expected to shuffle for each byte read.
SHUFFLED_PER_STORED = 2
JOBS_AT_A_TIME = 4


def shuffle_partitions(shuffled_bytes: int) -> int:
    """Shuffle partitions for a job that moves ``shuffled_bytes``; adaptive execution merges the ones too many."""
    wanted = -(-shuffled_bytes // SHUFFLE_PARTITION_BYTES)
    return min(max(MIN_SHUFFLE_PARTITIONS, wanted), MAX_SHUFFLE_PARTITIONS)


def cluster_conf(shuffled_bytes: int) -> dict[str, str]:
    """Settings for a large run whose largest shuffle moves ``shuffled_bytes``.

    A fact rebuild shuffles one slice of the history at a time (``pipeline.SLICE_BYTES``), however long the history.
    """
    return {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(shuffle_partitions(shuffled_bytes)),
        # Favour full-sized partitions and output files over one partition per core.
        "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "192m",
        # With many partitions map tasks report average block sizes; hot days and keys must be reported as they are,
        # or adaptive execution cuts them into too few pieces.
        "spark.shuffle.accurateBlockSkewedFactor": "5",
        "spark.sql.files.maxPartitionBytes": "256m",
        "spark.sql.parquet.compression.codec": "zstd",
        # A lost executor should cost its own tasks only, not the stages before them.
        "spark.decommission.enabled": "true",
        "spark.storage.decommission.shuffleBlocks.enabled": "true",
        "spark.stage.maxConsecutiveAttempts": "10",
    }


def prepare(spark: SparkSession) -> SparkSession:
    """What the pipeline relies on in any session: UTC, as truncation, dates and key texts depend on the zone, and casts
    that fail instead of giving NULL. The zone is set; a session without ANSI casts is refused."""
    if spark.conf.get("spark.sql.ansi.enabled") != "true":
        raise ValueError("set spark.sql.ansi.enabled: values that do not fit must fail, not become NULL")
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


@contextmanager
def sized(spark: SparkSession, stored_bytes: int) -> Iterator[None]:
    """Shuffle partitions for jobs over so many bytes of stored data; adaptive execution merges those too many.

    The session's own number is a lower bound, and it holds again afterwards.
    """
    key = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    before = spark.conf.get(key, None)
    wanted = -(-SHUFFLED_PER_STORED * stored_bytes // SHUFFLE_PARTITION_BYTES)
    least = int(before or spark.conf.get("spark.sql.shuffle.partitions"))
    spark.conf.set(key, str(max(least, min(wanted, MAX_SHUFFLE_PARTITIONS))))
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


#: Sizes from here on stand for unknown ones.
UNKNOWN_BYTES = 1 << 62


def bytes_read(rows: DataFrame) -> int:
    """Bytes of the stored data that rows are made from, as far as their plan tells; 0 where it does not."""
    leaves = rows._jdf.queryExecution().optimizedPlan().collectLeaves()
    sizes = [int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size())]
    return sum(size for size in sizes if size < UNKNOWN_BYTES)


class Scratch:
    """Intermediate tables in the shared folder, deleted when the block that needs them ends, however it ends."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.paths: list[str] = []

    def __enter__(self) -> Scratch:
        return self

    def __exit__(self, *_: object) -> None:
        for path in self.paths:
            files.delete(self.spark, path)
        self.paths.clear()

    def hold(self, label: str, rows: DataFrame) -> tuple[DataFrame, int]:
        """Write rows; returns them as read back, and their size in bytes."""
        path = work_folder(self.spark, label)
        self.paths.append(path)
        rows.write.parquet(path)
        return self.spark.read.schema(rows.schema).parquet(path), files.stored_bytes(self.spark, path)


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors can reach, as the cluster names it in ``spark.checkpoint.dir``."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    return one_machine_folder()


@cache
def one_machine_folder() -> str:
    """Stands in for the shared folder where a single process is the whole cluster, as in tests."""
    return tempfile.mkdtemp(prefix="clickloom-")


def work_folder(spark: SparkSession, label: str) -> str:
    """A new, unused folder below the shared one."""
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"


def side_by_side(*jobs: Callable[[], None]) -> None:
    """Run jobs that do not depend on each other, some at a time, so that they fill each other's idle executors."""
    with ThreadPoolExecutor(JOBS_AT_A_TIME) as pool:
        for done in [pool.submit(job) for job in jobs]:
            done.result()


def local_session(cores: str = "8", memory: str = "8g") -> SparkSession:
    """A session for tests and measurements on one machine."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("clickloom")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", cores if cores.isdigit() else "8")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.sources.parallelPartitionDiscovery.parallelism", cores if cores.isdigit() else "8")
        .getOrCreate()
    )
