"""Declarative checks. Each returns what fails, so an empty result is a pass."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def not_null(table: DataFrame, column: str) -> DataFrame:
    """Rows with a NULL in ``column``."""
    return table.where(F.col(column).isNull())


def null_failures(table: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Failing rows of several not-null checks in one scan, once per failing check, named by ``column_name``."""
    failing = F.array_compact(F.array(*[F.when(F.col(c).isNull(), F.lit(c)) for c in columns]))
    return table.select("*", F.explode(failing).alias("column_name"))


def null_counts(table: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``column_name, failures`` for several not-null checks in one scan."""
    counts = table.selectExpr(*[f"count_if({c} IS NULL) AS {c}" for c in columns])
    return counts.unpivot([], list(columns), "column_name", "failures")


def counted(table: DataFrame, column: str, name: str) -> DataFrame:
    """``name, n_records``: how often each value other than NULL occurs."""
    values = table.where(f"{column} IS NOT NULL").selectExpr(f"{column} AS {name}")
    return values.groupBy(name).count().withColumnRenamed("count", "n_records")


def unique(table: DataFrame, column: str) -> DataFrame:
    """``unique_field, n_records`` for each value that occurs more than once; NULLs are ignored."""
    return counted(table, column, "unique_field").where("n_records > 1")


def unique_by_hash(table: DataFrame, column: str, hold: Callable[[str, DataFrame], tuple[DataFrame, int]]) -> DataFrame:
    """Same result as :func:`unique`, in two phases, for a column of long values that hardly ever repeat.

    8-byte hashes are counted first. Only rows whose hash is repeated are compared in full; ``hold`` stores these hashes,
    so that their size is known when the rows look for them.
    """
    hashed = table.where(f"{column} IS NOT NULL").select(F.xxhash64(column).alias("_hash"), column)
    repeated, _ = hold("repeated-hashes", counted(hashed, "_hash", "_repeated").where("n_records > 1").select("_repeated"))
    suspects = hashed.join(repeated, F.col("_hash") == F.col("_repeated"), "left_semi")
    return unique(suspects, column)


def accepted_values(table: DataFrame, column: str, values: Sequence[str]) -> DataFrame:
    """``value_field, n_records`` for each value outside ``values``; NULLs never fail."""
    return counted(table.where(~F.col(column).isin(*values)), column, "value_field")


def relationships(child: DataFrame, column: str, parent: DataFrame, field: str) -> DataFrame:
    """``from_field, n_records`` for each child key without a parent row; NULL keys are ignored.

    Child rows are counted per key before the anti join, so a hot key cannot overload one join task.
    """
    parents = parent.selectExpr(f"{field} AS from_field")
    return counted(child, column, "from_field").join(parents, "from_field", "left_anti")
