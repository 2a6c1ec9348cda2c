"""Where and how forecasts miss: errors by series, slice, horizon, calendar and price change."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stocktide.config import HORIZON, NO_EVENT, SERIES_KEYS
from stocktide.functions import columns as C
from stocktide.operators.hierarchy import last_days, level_errors, level_scales, level_weights
from stocktide.operators.ranking import decile_of_rank, exact_quantiles, medians, with_row_number
from stocktide.operators.reshape import pivot_mean, with_change_percent
from stocktide.operators.scoring import rate, with_errors

SLICES = ("store_id", "cat_id", "dept_id", "price_band", "volume_decile", "sale_frequency")
INTERMITTENCY_DAYS = 91
NO_SALES_DECILE = "D00 no sales"
UNKNOWN_DECILE = "unknown"
KEYS = list(SERIES_KEYS)


def series_scores(train: DataFrame, valid: DataFrame, squared: bool = False) -> DataFrame:
    """Attributes, scale, error, revenue and scaled error per series.

    Series without a positive scale are left out. `squared` gives mse over scale without the root.
    """
    attributes = valid.select(
        *KEYS, "cat_id", "dept_id", "state_id", C.joined_key(*KEYS).alias("series_id")
    ).distinct()
    scores = attributes
    for part in (
        level_scales(train, bottom_only=True),
        level_errors(valid, bottom_only=True),
        level_weights(train, bottom_only=True),
    ):
        scores = scores.join(part.drop("level"), "series_id")
    ratio = F.col("mse") / F.col("scale")
    return (
        scores.where(F.col("scale") > 0)
        .withColumn("rmsse", ratio if squared else F.sqrt(ratio))
        .drop("series_id")
    )


def price_bands(valid: DataFrame) -> DataFrame:
    """Mean price of each series over the forecast window, and its band."""
    mean = valid.groupBy(*KEYS).agg(F.avg("sell_price").alias("mean_price"))
    return mean.withColumn(
        "price_band", C.cut_left_closed("mean_price", C.MEAN_PRICE_EDGES, C.MEAN_PRICE_LABELS)
    )


def recent_volume(train: DataFrame, days: int = HORIZON) -> DataFrame:
    return last_days(train, days).groupBy(*KEYS).agg(F.avg("sales").alias("mean_sales"))


def volume_deciles(volume: DataFrame) -> DataFrame:
    """Tenths of the selling series by mean sales; ties are ranked by item and store.

    A series without a known volume has a label of its own.
    """
    selling = volume.where(F.col("mean_sales") > 0)
    ranked = with_row_number(selling, ["mean_sales", "item_id", "store_id"], "_rank")
    total = ranked.agg(F.count("*").alias("n")).scalar()
    label = F.concat(
        F.lit("D"), F.lpad(decile_of_rank(F.col("_rank"), total).cast("string"), 2, "0")
    )
    known = F.col("mean_sales").isNotNull()
    silent = volume.where(~known | ~(F.col("mean_sales") > 0)).withColumn(
        "volume_decile", F.when(known, NO_SALES_DECILE).otherwise(UNKNOWN_DECILE)
    )
    return ranked.withColumn("volume_decile", label).drop("_rank").unionByName(silent)


def sale_frequency(train: DataFrame, days: int = INTERMITTENCY_DAYS) -> DataFrame:
    """Share of recent days with a sale, and its band."""
    share = (
        last_days(train, days)
        .groupBy(*KEYS)
        .agg(F.avg((F.col("sales") > 0).cast("int")).alias("nonzero_rate"))
    )
    return share.withColumn(
        "sale_frequency", C.cut_right_closed("nonzero_rate", C.SALE_RATE_EDGES, C.SALE_RATE_LABELS)
    )


def series_profile(train: DataFrame, valid: DataFrame, squared: bool = False) -> DataFrame:
    """One row per series: scores, price band, volume decile, sale frequency and weight."""
    profile = (
        series_scores(train, valid, squared)
        .join(price_bands(valid), KEYS, "left")
        .join(volume_deciles(recent_volume(train)), KEYS, "left")
        .join(sale_frequency(train), KEYS, "left")
    )
    total = profile.agg(F.sum("dollar_sales").alias("total")).scalar()
    return profile.withColumn("weight", F.try_divide(F.col("dollar_sales"), total))


def _by_dimension(df: DataFrame, dimensions: Sequence[str]) -> DataFrame:
    """Repeat each row once per dimension as (dimension, value), so all slices share one job."""
    pairs = [
        F.struct(F.lit(d).alias("dimension"), F.col(d).cast("string").alias("value"))
        for d in dimensions
    ]
    return df.withColumn("_slice", F.explode(F.array(*pairs))).select(
        "_slice.dimension", "_slice.value", *[c for c in df.columns]
    )


def _join_null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    renamed = right.withColumnsRenamed({k: f"_{k}" for k in keys})
    same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys]
    return left.join(renamed, same).drop(*[f"_{k}" for k in keys])


def _with_total(df: DataFrame, of: str, name: str, keys: Sequence[str]) -> DataFrame:
    """Share of the total of `of` within each group of `keys`; the input has one row per slice."""
    return df.withColumn(name, F.col(of) / F.sum(of).over(Window.partitionBy(*keys)))


SLICE = ["dimension", "value"]


def unweighted_slices(profile: DataFrame, dimensions: Sequence[str] = SLICES) -> DataFrame:
    """Series, mean and median scaled error and share of series, for every slice with a value."""
    rows = _by_dimension(profile, dimensions).where(F.col("value").isNotNull())
    table = rows.groupBy(*SLICE).agg(
        F.count("*").alias("n_series"), F.avg("rmsse").alias("mean_rmsse")
    )
    table = _join_null_safe(table, medians(rows, "rmsse", "median_rmsse", SLICE), SLICE)
    return _with_total(table, "n_series", "share_of_series", ["dimension"])


def slice_errors(profile: DataFrame, dimensions: Sequence[str] = SLICES) -> DataFrame:
    """As `unweighted_slices`, with the share of series above 1; a missing value is a slice."""
    rows = _by_dimension(profile, dimensions)
    table = rows.groupBy(*SLICE).agg(
        F.count("rmsse").alias("n_series"),
        F.avg("rmsse").alias("mean_rmsse"),
        (F.avg((F.col("rmsse") > 1).cast("int")) * 100).alias("pct_rmsse_gt_1"),
    )
    table = _join_null_safe(table, medians(rows, "rmsse", "median_rmsse", SLICE), SLICE)
    return _with_total(table, "n_series", "share_of_series", ["dimension"])


def weighted_slices(profile: DataFrame, dimensions: Sequence[str] = SLICES) -> DataFrame:
    """Contribution of every slice to the weighted error."""
    known = profile.where(F.col("rmsse").isNotNull() & F.col("weight").isNotNull())
    rows = _by_dimension(known, dimensions)
    contribution = F.col("weight") * F.col("rmsse")
    table = rows.groupBy(*SLICE).agg(
        F.count("*").alias("n_series"),
        F.avg("rmsse").alias("mean_rmsse"),
        F.sum(contribution).alias("weighted_error_contribution"),
        F.sum("weight").alias("total_weight"),
    )
    table = _join_null_safe(table, medians(rows, "rmsse", "median_rmsse", SLICE), SLICE)
    return _with_total(
        table, "weighted_error_contribution", "share_of_weighted_error", ["dimension"]
    )


def summary(profile: DataFrame) -> DataFrame:
    """Distribution of the scaled error over all series."""
    known = profile.where(F.col("rmsse").isNotNull())
    points = {"median_rmsse": 0.5, "p90_rmsse": 0.9, "p95_rmsse": 0.95, "p99_rmsse": 0.99}
    totals = known.agg(
        F.count("*").alias("n_series"),
        F.avg("rmsse").alias("mean_rmsse"),
        (F.avg((F.col("rmsse") > 1).cast("int")) * 100).alias("pct_series_rmsse_gt_1"),
    )
    quantiles = exact_quantiles(known, "rmsse", points)
    return quantiles.withColumns({c: totals.select(c).scalar() for c in totals.columns})


def high_errors(profile: DataFrame, limit: float = 1.0) -> DataFrame:
    return profile.where(F.col("rmsse") > limit).select(
        *KEYS, "rmsse", "dollar_sales", "weight"
    )


def extreme_series(
    profile: DataFrame, by: str = "contribution", worst: bool = True, n: int = 10
) -> DataFrame:
    """The n worst or best series with any weight, by contribution or by scaled error."""
    ranked = profile.where(F.col("weight") > 0).select(
        *KEYS,
        "rmsse",
        (F.col("weight") * F.col("rmsse")).alias("contribution"),
        F.col("weight").alias("total_weight"),
    )
    order = F.desc(by) if worst else F.asc(by)
    return ranked.orderBy(order, *KEYS).limit(n)


def series_error_kind(predictions: DataFrame) -> DataFrame:
    """Bias, absolute error, spread and directions per series."""
    return (
        with_errors(predictions)
        .groupBy(*KEYS)
        .agg(
            F.countDistinct("date").alias("n_dates"),
            F.avg("error").alias("bias"),
            F.avg("abs_error").alias("mae"),
            F.sqrt(F.avg("squared_error")).alias("rmse"),
            F.stddev("error").alias("error_std"),
            rate("actual_zero").alias("pct_actual_zero"),
            rate("underforecast").alias("pct_underforecast"),
            rate("overforecast").alias("pct_overforecast"),
        )
    )


def error_kind_by_slice(
    profile: DataFrame,
    predictions: DataFrame,
    dimensions: Sequence[str] = ("cat_id", "store_id", "sale_frequency", "price_band"),
) -> DataFrame:
    """Mean error kinds of the series in each slice, and their median absolute error."""
    rows = _by_dimension(
        profile.join(series_error_kind(predictions), KEYS, "left"), dimensions
    ).where(F.col("value").isNotNull())
    means = ("bias", "mae", "error_std", "pct_actual_zero", "pct_underforecast", "pct_overforecast")
    table = rows.groupBy(*SLICE).agg(
        F.count("item_id").alias("n_series"), *[F.avg(c).alias(f"mean_{c}") for c in means]
    )
    return _join_null_safe(table, medians(rows, "mae", "median_mae", SLICE), SLICE)


def _basic() -> list[Column]:
    return [
        F.count("*").alias("n"),
        F.avg("error").alias("bias"),
        F.avg("abs_error").alias("mae"),
    ]


def _directions() -> list[Column]:
    return [
        rate("underforecast").alias("pct_underforecast"),
        rate("overforecast").alias("pct_overforecast"),
    ]


def _levels() -> list[Column]:
    return [
        F.avg("prediction").alias("mean_predicted_sales"),
        F.avg("sales").alias("mean_actual_sales"),
    ]


def error_by(errors: DataFrame, keys: Sequence[str | Column]) -> DataFrame:
    """Rows, bias and absolute error per group."""
    return errors.groupBy(*keys).agg(*_basic())


def error_and_level_by(errors: DataFrame, keys: Sequence[str | Column]) -> DataFrame:
    """As `error_by`, with mean predicted and actual sales."""
    return errors.groupBy(*keys).agg(*_basic(), *_levels())


def series_status_errors(errors: DataFrame) -> DataFrame:
    return errors.groupBy(*KEYS, "demand_status").agg(*_basic(), *_directions())


def with_horizon_day(errors: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Days since the forecast origin, 1 for the first forecast day (per fold when given)."""
    if by:
        origin = errors.groupBy(*by).agg(F.min("date").alias("_first"))
        rows = errors.join(F.broadcast(origin), list(by))
        return rows.withColumn("horizon_day", F.datediff("date", "_first") + 1).drop("_first")
    first = errors.agg(F.min("date").alias("first")).scalar()
    return errors.withColumn("horizon_day", F.datediff("date", first) + 1)


def horizon_errors(errors: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    return (
        with_horizon_day(errors, by)
        .groupBy("horizon_day")
        .agg(*_basic(), F.sqrt(F.avg("squared_error")).alias("rmse"), *_directions())
    )


def horizon_status_errors(errors: DataFrame) -> DataFrame:
    return error_by(with_horizon_day(errors), ["horizon_day", "demand_status"])


def frequency_errors(errors: DataFrame, profile: DataFrame, by_status: bool = False) -> DataFrame:
    """Errors by sale frequency; series outside the profile form no group."""
    rows = errors.join(profile.select(*KEYS, "sale_frequency"), KEYS, "left").where(
        F.col("sale_frequency").isNotNull()
    )
    keys = ["sale_frequency", "demand_status"] if by_status else ["sale_frequency"]
    return error_by(rows, keys)


def attach_context(predictions: DataFrame, panel: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Bring panel columns of the same item, store and day to predictions."""
    context = panel.select(*KEYS, "date", *columns)
    return predictions.drop(*columns).join(context, [*KEYS, "date"], "left")


def is_event() -> Column:
    return (F.coalesce(F.col("event_name_1"), F.lit(NO_EVENT)) != NO_EVENT).cast("int")


def event_errors(errors: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    return error_and_level_by(errors.withColumn("is_event", is_event()), ["is_event", *keys])


def event_ratio(errors: DataFrame) -> DataFrame:
    """Absolute error on event days relative to ordinary days."""
    event = F.avg(F.when(is_event() == 1, F.col("abs_error")))
    normal = F.avg(F.when(is_event() == 0, F.col("abs_error")))
    return errors.agg(F.try_divide(event, normal).alias("event_ratio"))


def _mae_pivot(errors: DataFrame, flag: str, names: Sequence[str]) -> DataFrame:
    return with_change_percent(
        pivot_mean(errors, "cat_id", flag, [0, 1], "abs_error", names), names[0], names[1]
    )


def event_pivot(errors: DataFrame) -> DataFrame:
    """Absolute error by category on ordinary and event days, and the change in percent."""
    marked = errors.withColumn("is_event", is_event())
    return _mae_pivot(marked, "is_event", ["normal_day_mae", "event_day_mae"])


def snap_pivot(errors: DataFrame) -> DataFrame:
    return _mae_pivot(errors, "snap", ["normal_day_mae", "snap_day_mae"])


def with_price_changed(errors: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Mark days whose price differs from the price of the previous forecast day."""
    previous = F.lag("sell_price").over(Window.partitionBy(*KEYS, *by).orderBy("date"))
    return (
        errors.withColumn("_previous", previous)
        .withColumn(
            "price_changed",
            F.col("sell_price").isNotNull()
            & F.col("_previous").isNotNull()
            & ~F.coalesce(C.close_to("sell_price", "_previous"), F.lit(False)),
        )
        .drop("_previous")
    )


def price_change_errors(errors: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    return error_by(with_price_changed(errors), ["price_changed", *keys])


def recent_peaks(
    rows: DataFrame, item_id: str, store_id: str, least: int, days: int = 50
) -> DataFrame:
    """Days of one series with at least `least` units among its last `days` days."""
    tail = (
        rows.where((F.col("item_id") == item_id) & (F.col("store_id") == store_id))
        .orderBy(F.desc("date"))
        .limit(days)
    )
    return tail.where(F.col("sales") >= least)
