"""Wide to long and long to wide."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def columns_with_prefix(df: DataFrame, prefix: str) -> list[str]:
    return [c for c in df.columns if c.startswith(prefix)]


def melt(
    df: DataFrame,
    ids: Sequence[str],
    values: Sequence[str],
    variable: str = "d",
    value: str = "sales",
) -> DataFrame:
    """Turn value columns into rows, one per id row and column.

    The values are packed into one array and exploded: a single projection whatever the number of
    columns, where the built-in unpivot evaluates one projection per column.
    """
    # One expression text for each array: thousands of columns cost one call instead of one each.
    cells = F.expr("array(" + ", ".join(f"`{v}`" for v in values) + ")")
    names = F.expr("array(" + ", ".join(f"'{v}'" for v in values) + ")")
    return df.select(*ids, F.posexplode(cells).alias("_position", value)).select(
        *ids, names[F.col("_position")].alias(variable), value
    )


def pivot_value(
    df: DataFrame,
    index: str | Sequence[str],
    column: str,
    values: Sequence,
    measure: str | Column,
    names: Sequence[str] | None = None,
) -> DataFrame:
    """One output column per listed value of `column`, holding the only measure of the cell."""
    index = [index] if isinstance(index, str) else list(index)
    cell = F.col(measure) if isinstance(measure, str) else measure
    out = df.groupBy(*index).pivot(column, list(values)).agg(F.first(cell, ignorenulls=True))
    for value, name in zip(values, names or []):
        out = out.withColumnRenamed(str(value), name)
    return out


def pivot_mean(
    df: DataFrame,
    index: str,
    column: str,
    values: Sequence,
    measure: str,
    names: Sequence[str],
) -> DataFrame:
    """Pivot table of means."""
    out = df.groupBy(index).pivot(column, list(values)).agg(F.avg(measure))
    for value, name in zip(values, names):
        out = out.withColumnRenamed(str(value), name)
    return out


def with_change_percent(df: DataFrame, base: str, other: str, name: str = "change_pct"):
    """Relative change of `other` against `base`, in percent."""
    return df.withColumn(name, (F.try_divide(F.col(other), F.col(base)) - 1) * 100)
