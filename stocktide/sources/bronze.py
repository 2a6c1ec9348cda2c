"""Readers for the raw retail files: calendar, weekly prices and wide daily sales."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stocktide.config import CALENDAR_COLUMNS, ID_COLUMNS, NO_EVENT, PRICE_COLUMNS
from stocktide.functions.columns import nan_to_null

DAY_PREFIX = "d_"
EVENT_COLUMNS = ("event_name_1", "event_type_1", "event_name_2", "event_type_2")

_CALENDAR_TYPES = {"wm_yr_wk": T.IntegerType(), "month": T.ByteType(), "year": T.ShortType()}


def _header(spark: SparkSession, path: str) -> list[str]:
    """Column names of a CSV file, from its first line only."""
    return spark.read.option("header", True).csv(path).columns


def _calendar_type(name: str) -> T.DataType:
    if name in _CALENDAR_TYPES:
        return _CALENDAR_TYPES[name]
    return T.ByteType() if name.startswith("snap_") or name == "wday" else T.StringType()


def _read_csv(spark: SparkSession, path: str, typed) -> DataFrame:
    """Read with a schema made from the header, so no pass is spent on inference."""
    schema = T.StructType([T.StructField(c, typed(c)) for c in _header(spark, path)])
    return spark.read.schema(schema).option("header", True).csv(path)


def read_calendar(
    spark: SparkSession,
    path: str,
    columns: Sequence[str] = CALENDAR_COLUMNS,
    date_format: str = "yyyy-MM-dd",
) -> DataFrame:
    """Calendar with typed dates and "No Event" on ordinary days."""
    raw = _read_csv(spark, path, _calendar_type).select(*columns)
    return prepare_calendar(raw.withColumn("date", F.to_date("date", date_format)))


def prepare_calendar(calendar: DataFrame) -> DataFrame:
    return calendar.fillna({c: NO_EVENT for c in EVENT_COLUMNS if c in calendar.columns})


def read_prices(
    spark: SparkSession, path: str, columns: Sequence[str] = PRICE_COLUMNS
) -> DataFrame:
    """Weekly prices as exact amounts."""
    types = {"wm_yr_wk": T.IntegerType(), "sell_price": T.DecimalType(10, 2)}
    return _read_csv(spark, path, lambda c: types.get(c, T.StringType())).select(*columns)


def read_sales_wide(
    spark: SparkSession, path: str, ids: Sequence[str] = ID_COLUMNS
) -> DataFrame:
    """Wide sales: the id columns as text and every day column as an integer."""

    def typed(name: str) -> T.DataType:
        return T.StringType() if name in ids else T.IntegerType()

    return _read_csv(spark, path, typed)


def clean_prices(prices: DataFrame) -> DataFrame:
    """Prices as doubles with NaN turned into NULL."""
    return prices.withColumn("sell_price", nan_to_null(F.col("sell_price").cast("double")))
