"""Helpers that several text operators share."""

from __future__ import annotations

import sys
from collections.abc import Callable

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Java pattern of what separates words: space, tab, line feed, vertical tab, form feed, return.
GAPS = r"[ \t-\r]+"


def ship(module_name: str) -> None:
    """Send a module's worker code by value, so that executors need no copy of the library."""
    cloudpickle.register_pickle_by_value(sys.modules[module_name])


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def text_or_empty(column: str = "text") -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def words_of(text: Column) -> Column:
    """Array of the words `[^\\x20\\x09-\\x0D]+` of a text; empty for a text without any."""
    return F.array_remove(F.split(text, GAPS), "")


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body(value)` with `value` computed once, however often the body or a lambda in it uses it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def packed(df: DataFrame) -> DataFrame:
    """All columns as one struct `row`, so that working columns can't clash with the caller's."""
    return df.select(F.struct(*[F.col(quoted(c)) for c in df.columns]).alias("row"))


def unpacked(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.select(*[F.col(f"row.{quoted(c)}").alias(c) for c in columns])


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def row_key(*columns: Column) -> Column:
    """128-bit key of a row's content; rows of equal content share it. Never null."""
    return F.struct(
        F.xxhash64(*columns).alias("a"), F.xxhash64(F.lit("key"), *reversed(columns)).alias("b")
    )
