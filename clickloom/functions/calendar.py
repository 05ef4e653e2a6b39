"""Calendar parts that Spark has no function for."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def sunday_week(day: Column) -> Column:
    """Week 0 to 53; weeks start on Sunday and the days before the first Sunday are week 0."""
    return F.floor((F.dayofyear(day) + 7 - F.dayofweek(day)) / 7).cast("int")
