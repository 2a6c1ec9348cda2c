"""Reference forecasts: last day repeated, and last week repeated."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stocktide.config import SERIES_KEYS
from stocktide.operators.hierarchy import last_days


def naive_forecast(train: DataFrame, valid: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Sales of the last training day for every later day; 0 for a series absent then."""
    keys = [*SERIES_KEYS, *by]
    last = last_days(train, 1, by).select(*keys, F.col("sales").alias("prediction"))
    return valid.join(last, keys, "left").withColumn(
        "prediction", F.coalesce(F.col("prediction"), F.lit(0)).cast("double")
    )


def seasonal_forecast(train: DataFrame, valid: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Sales of the same weekday in the last training week; 0 where there is none."""
    keys = [*SERIES_KEYS, *by, "_wday"]
    week = (
        last_days(train, 7, by)
        .withColumn("_wday", F.weekday("date"))
        .select(*keys, F.col("sales").alias("prediction"))
    )
    return (
        valid.withColumn("_wday", F.weekday("date"))
        .join(week, keys, "left")
        .withColumn("prediction", F.coalesce(F.col("prediction"), F.lit(0)).cast("double"))
        .drop("_wday")
    )
