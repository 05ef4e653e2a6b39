"""Keep one row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def smallest_per_key(rows: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per ``keys``, with the ``order`` columns of the smallest copy (NULLs first; NULL keys are one group).

    An aggregate instead of a row number: each task folds its copies before the shuffle, so a key with very many
    copies reaches its reducer as one row per map task. A hash of the keys leads the grouping; the sorts then settle
    nearly every comparison on its 8 bytes and look at the keys themselves for true copies only.
    """
    smallest = F.min(F.struct(*order)).alias("_smallest")
    groups = rows.groupBy(F.xxhash64(*keys).alias("_hash"), *keys).agg(smallest)
    return groups.select(*keys, *[F.col(f"_smallest.{name}") for name in order])


def latest_times(rows: DataFrame, key: str, time: str) -> DataFrame:
    """``key`` and its greatest ``time``: two fixed-width columns, so a hash aggregate without a sort."""
    return rows.where(F.col(key).isNotNull()).groupBy(key).agg(F.max(time).alias(time))
