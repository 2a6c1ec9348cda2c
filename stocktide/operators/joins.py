"""Joins with a stated cardinality, checked inside the plan, and key containment."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class CardinalityError(AssertionError):
    """A join key repeats on a side that must hold it once, or rows went missing."""


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their number of rows."""
    return df.groupBy(*keys).agg(F.count("*").alias("rows")).where("rows > 1")


def require_unique(df: DataFrame, keys: Sequence[str], side: str) -> None:
    """Look at once for repeated keys; runs a job."""
    sample = duplicate_keys(df, keys).limit(3).collect()
    if sample:
        raise CardinalityError(f"{side} side repeats {list(keys)}: {[tuple(r) for r in sample]}")


def _refused(wrong: Column, message: Column) -> Column:
    """A filter that keeps all rows and fails the action at the first wrong one."""
    return F.when(wrong, F.raise_error(message).cast("boolean")).otherwise(F.lit(True))


def one_row_per_key(df: DataFrame, keys: Sequence[str], side: str) -> DataFrame:
    """The same rows, by an aggregate over the keys that fails the action where a key has several.

    No job of its own: the aggregate's shuffle by the keys is the one that a join on them needs anyway.
    """
    keys = list(keys)
    others = [c for c in df.columns if c not in keys]
    row = F.first(F.struct(*others)) if others else F.lit(None)
    grouped = df.groupBy(*keys).agg(F.count("*").alias("_times"), row.alias("_row"))
    said = F.concat(F.lit(f"CardinalityError: {side} side repeats "), F.to_json(F.struct(*keys)))
    checked = grouped.where(_refused(F.col("_times") > 1, said))
    return checked.select(*[F.col(c) if c in keys else F.col(f"_row.`{c}`").alias(c) for c in df.columns])


def join_checked(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    how: str = "left",
    validate: str = "many_to_one",
    keep_rows: bool = False,
) -> DataFrame:
    """Join that fails the action if a "one" side holds a key twice. It runs no job of its own.

    `keep_rows` also demands that each left row has its partner, so that the result has as many rows as
    the left side.
    """
    on = list(on)
    if validate not in ("many_to_one", "one_to_one", "one_to_many"):
        raise ValueError(f"unknown cardinality {validate}")
    if keep_rows and validate == "one_to_many":
        raise ValueError("a left row with several partners can't be kept once")
    if validate.endswith("_to_one"):
        right = one_row_per_key(right, on, "right")
    if validate.startswith("one_to_"):
        left = one_row_per_key(left, on, "left")
    if not keep_rows or how == "left":
        return left.join(right, on, how)
    joined = left.join(right.withColumn("_there", F.lit(True)), on, "left")
    said = F.concat(F.lit("CardinalityError: rows changed in the join, no partner for "), F.to_json(F.struct(*on)))
    return joined.where(_refused(F.col("_there").isNull(), said)).drop("_there")


def keys_missing_from(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    """Distinct left keys without a partner on the right; empty when contained."""
    return left.select(*on).distinct().join(right.select(*on), list(on), "left_anti")


def key_containment(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    """One row: how many left keys are absent on the right, and whether all are present."""
    return keys_missing_from(left, right, on).agg(
        F.count("*").alias("missing_keys"), (F.count("*") == 0).alias("contained")
    )
