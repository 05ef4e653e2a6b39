"""Dimension members: from natural keys to surrogate keys, with a substitute for unknown ones."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickloom.schemas import UNKNOWN_MEMBER


def attach_member(events: DataFrame, dim: DataFrame, key: str, sk: str) -> DataFrame:
    """Left join on ``key`` that adds the dimension's ``sk``, or the unknown member where it has no such row.

    No join hint: Catalyst broadcasts the dimension if its measured size is below the session's threshold, else
    sorts and merges, where adaptive execution splits the partitions of hot keys.
    """
    members = dim.select(F.col(key).alias("_member_key"), F.col(sk).alias("_member_sk"))
    joined = events.join(members, F.col(key) == F.col("_member_key"), "left")
    found = F.coalesce(F.col("_member_sk"), F.lit(UNKNOWN_MEMBER))
    return joined.withColumn(sk, found).drop("_member_key", "_member_sk")


def missing_keys(events: DataFrame, dim: DataFrame, key: str) -> DataFrame:
    """Distinct keys of the events that the dimension lacks; normally none.

    Both sides are distinct before they meet, so a hot key costs one row per map task.
    """
    known = dim.select(F.col(key).alias("_known"))
    keys = events.select(key).where(F.col(key).isNotNull()).distinct()
    return keys.join(known, F.col(key) == F.col("_known"), "left_anti")


def derive_member(events: DataFrame, missing: DataFrame, key: str, sk: str, formula: Column) -> DataFrame:
    """Same result as :func:`attach_member` for a dimension whose ``sk`` is ``formula`` of its key.

    For a dimension too large to broadcast: only its few missing keys are joined, so the events are not shuffled to
    meet all its rows.
    """
    marks = missing.select(F.col(key).alias("_missing"))
    joined = events.join(marks, F.col(key) == F.col("_missing"), "left")
    value = F.when(F.col("_missing").isNotNull(), F.lit(UNKNOWN_MEMBER)).otherwise(formula)
    return joined.withColumn(sk, value).drop("_missing")


def orphans(child: DataFrame, column: str, parent: DataFrame, field: str) -> DataFrame:
    """Child rows whose non-NULL key has no parent row."""
    fields = parent.select(F.col(field).alias("_field"))
    known = child.where(F.col(column).isNotNull())
    return known.join(fields, F.col(column) == F.col("_field"), "left_anti")
