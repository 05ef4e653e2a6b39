"""Connected components of a link table, by joins alone."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.llm.common import partitions, stored

#: Shuffle partitions that share a file of links.
FEWER_FILES = 8


def _pairs(rows: DataFrame) -> DataFrame:
    return rows.where("a <> b").distinct()


def _kept(rows: DataFrame) -> DataFrame:
    """Links written to the shared folder; they are small beside what gave them, so in fewer files."""
    spark = rows.sparkSession
    return stored(spark, "links", rows.coalesce(max(1, partitions(spark) // FEWER_FILES)))


def components(links: DataFrame) -> DataFrame:
    """``node, component`` for each node of the links ``a, b``; the component is its smallest node.

    Alternates two steps until nothing changes: every node links its larger neighbours, then its smaller ones, to the
    smallest node it knows. Links only become shorter and never more, and the number of rounds grows with the logarithm
    of the longest path. Each round is written to the shared folder. No links give no rows; a link of a node to itself
    or to null is left out.
    """
    now = links.where("a is not null and b is not null")
    now = _pairs(now.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")))
    now = _kept(now)
    before = None
    while True:
        # Larger neighbours: (a, b) both ways; the neighbours above a node go to the least of it and its neighbours.
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("least"))
        above = now.select(F.col("b").alias("a"), F.col("a").alias("above")).join(least, "a")
        now = _kept(_pairs(above.select(F.col("above").alias("a"), F.col("least").alias("b"))))
        # Smaller neighbours: all neighbours below a node, and the node, go to the least of them.
        least = now.groupBy("a").agg(F.min("b").alias("least"))
        below = now.join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b"))
        now = _kept(_pairs(below.unionByName(least.select("a", F.col("least").alias("b")))))
        mark = F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
        state = now.agg(F.count("*"), mark).first()
        if state == before:
            return now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
                now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
            )
        before = state
