"""Helpers for long column expressions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once however often the body uses it.

    A column that another projection computes may be merged back into a lambda and then runs for every element.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def numbers(values: list[int], kind: str = "int") -> Column:
    """A fixed array."""
    return F.array(*[F.lit(v) for v in values]).cast(f"array<{kind}>")
