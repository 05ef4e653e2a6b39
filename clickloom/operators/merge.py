"""Upsert by key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


class DuplicateMergeKey(ValueError):
    """Several delta rows would replace the same target row."""


def upsert(target: DataFrame, delta: DataFrame, key: str, one_per_key: bool = False) -> DataFrame:
    """All rows after the upsert: target rows whose key the delta has are replaced, its other rows are added.

    Both sides are read several times, so pass stored tables. Two delta rows for one target row are an error; a delta
    that is known to have ``one_per_key`` is not searched for such.
    """
    if not one_per_key:
        repeated = delta.groupBy(key).agg(F.count("*").alias("n")).where("n > 1")
        if not repeated.isEmpty() and not repeated.join(target.select(key), key, "left_semi").isEmpty():
            raise DuplicateMergeKey(f"several delta rows match one target row on {key}")
    return target.join(delta.select(key), key, "left_anti").unionByName(delta)
