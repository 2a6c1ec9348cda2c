"""Weighted scaled error over the hierarchy, and pointwise error metrics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stocktide.operators.hierarchy import level_errors, level_scales, level_weights

def series_metrics(
    train: DataFrame,
    valid: DataFrame,
    *,
    scales: DataFrame | None = None,
    weights: DataFrame | None = None,
    by: Sequence[str] = (),
) -> DataFrame:
    """Scale, error and revenue of every series at every level."""
    keys = ["level", "series_id", *by]
    scales = level_scales(train, by=by) if scales is None else scales
    weights = level_weights(train, by=by) if weights is None else weights
    return scales.join(level_errors(valid, by=by), keys).join(weights, keys)


def _level_share(metrics: DataFrame, by: Sequence[str]) -> DataFrame:
    """Add each series' share of its level's revenue.

    Levels are few and the series level holds nearly all rows, so the level totals are aggregated
    and joined back (one row per level and fold) instead of being windowed over one level.
    """
    keys = ["level", *by]
    totals = metrics.groupBy(*keys).agg(F.sum("dollar_sales").alias("_level_dollars"))
    return (
        metrics.join(F.broadcast(totals), keys)
        .withColumn("weight", F.try_divide("dollar_sales", "_level_dollars"))
        .drop("_level_dollars")
    )


def weighted_levels(
    metrics: DataFrame, zero_scale: str = "drop", by: Sequence[str] = ()
) -> DataFrame:
    """Weighted scaled error per level.

    `drop` removes series with no scale before the weights are shared out; `keep` leaves them in
    and scores a series with no error as 0, so a series with an error and no scale is infinite.
    """
    mse, scale = F.col("mse"), F.col("scale")
    if zero_scale == "drop":
        metrics = metrics.where(scale > 0)
        rmsse: Column = F.sqrt(mse / scale)
    elif zero_scale == "keep":
        infinite = F.lit(float("inf"))
        rmsse = (
            F.when(~(mse > 0), F.lit(0.0))
            .when(scale == 0, infinite)
            .otherwise(F.sqrt(F.try_divide(mse, scale)))
        )
    else:
        raise ValueError(f"unknown zero_scale {zero_scale}")
    # The shares of a level sum to one, so the weighted mean needs no join with the level totals.
    # A series without weight adds nothing, also where its error is infinite (infinity x 0 is no number).
    dollars = F.col("dollar_sales")
    term = F.when(dollars != 0, rmsse * dollars).otherwise(0.0)
    return metrics.groupBy("level", *by).agg(
        F.try_divide(F.sum(term), F.sum(dollars)).alias("wrmsse_level")
    )


def wrmsse(levels: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Mean of the level scores, one row (or one per fold)."""
    return levels.groupBy(*by).agg(F.avg("wrmsse_level").alias("wrmsse"))


def score(
    train: DataFrame, valid: DataFrame, *, zero_scale: str = "drop", by: Sequence[str] = ()
) -> DataFrame:
    return wrmsse(weighted_levels(series_metrics(train, valid, by=by), zero_scale, by), by)


def zero_scale_audit(metrics: DataFrame) -> DataFrame:
    """Series without a usable scale, their share of the level and whether that share counts."""
    bad = F.col("scale").isNull() | (F.col("scale") <= 0)
    return (
        _level_share(metrics, ())
        .where(bad)
        .withColumn("causes_inf", F.col("weight") > 0)
        .orderBy(F.desc("causes_inf"), F.desc("weight"), "level", "series_id")
    )


def zero_scale_counts(audit: DataFrame) -> DataFrame:
    return audit.groupBy("level").agg(
        F.count("*").alias("series"), F.count_if("causes_inf").alias("series_with_weight")
    )


def with_errors(predictions: DataFrame) -> DataFrame:
    """Error columns of point forecasts."""
    error = F.col("prediction") - F.col("sales")
    return predictions.withColumns(
        {
            "error": error,
            "abs_error": F.abs(error),
            "squared_error": error * error,
            "actual_zero": F.col("sales") == 0,
            "underforecast": error < 0,
            "overforecast": error > 0,
            "demand_status": F.when(F.col("sales") == 0, "zero_sales").otherwise(
                "positive_sales"
            ),
        }
    )


def rate(flag: str) -> Column:
    return F.avg(F.col(flag).cast("int")) * 100


def point_metrics(errors: DataFrame) -> DataFrame:
    """Bias, absolute and squared error, spread, and shares of over, under and exact forecasts."""
    return errors.agg(
        F.count("*").alias("n_forecasts"),
        F.avg("error").alias("bias"),
        F.avg("abs_error").alias("mae"),
        F.sqrt(F.avg("squared_error")).alias("rmse"),
        F.stddev("error").alias("error_std"),
        rate("overforecast").alias("pct_overforecast"),
        rate("underforecast").alias("pct_underforecast"),
        (F.avg((F.col("error") == 0).cast("int")) * 100).alias("pct_exact"),
        rate("actual_zero").alias("pct_actual_zero"),
    )
