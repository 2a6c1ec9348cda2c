"""Operators on one series (item and store): launch, running sums, gaps, autocorrelation and an
additive decomposition. A series has at most one row per day, which bounds every window here."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stocktide.config import SERIES_KEYS


def series_window(keys: Sequence[str] = SERIES_KEYS):
    return Window.partitionBy(*keys)


def launch_table(panel: DataFrame, keys: Sequence[str] = SERIES_KEYS) -> DataFrame:
    """First priced date and week of each series."""
    return (
        panel.where(F.col("sell_price").isNotNull())
        .groupBy(*keys)
        .agg(F.min("date").alias("launch_date"), F.min("wm_yr_wk").alias("launch_week"))
    )


LAUNCH_COLUMNS = ("launch_date", "launch_week")


def with_launch(
    panel: DataFrame, how: str = "inner", launches: DataFrame | None = None
) -> DataFrame:
    """Add launch date and week to each row; `inner` drops series that never had a price.

    A panel stored with the launch columns is taken as it is. With a stored `launches` table the
    rows are joined to it, and the planner broadcasts it if its files are small enough. Otherwise a
    window over the series finds the launch in one read of the panel, without a shuffle when the
    panel is already partitioned by series.
    """
    if set(LAUNCH_COLUMNS) <= set(panel.columns):
        out = panel
    elif launches is not None:
        return panel.join(launches, list(SERIES_KEYS), how)
    else:
        w = series_window()
        priced = F.col("sell_price").isNotNull()
        out = panel.withColumns(
            {
                "launch_date": F.min(F.when(priced, F.col("date"))).over(w),
                "launch_week": F.min(F.when(priced, F.col("wm_yr_wk"))).over(w),
            }
        )
    return out.where(F.col("launch_date").isNotNull()) if how == "inner" else out


def with_running_sum(
    df: DataFrame,
    value: str = "sales",
    name: str = "cum_sales",
    keys: Sequence[str] = SERIES_KEYS,
    order: str = "date",
) -> DataFrame:
    w = Window.partitionBy(*keys).orderBy(order)
    return df.withColumn(
        name, F.sum(value).over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    )


def largest_gap(dates: DataFrame, date: str = "date") -> DataFrame:
    """Longest step in days between consecutive dates of a calendar (one row per day)."""
    days = dates.select(date).distinct().withColumn("_year", F.year(date))
    inside = Window.partitionBy("_year").orderBy(date)
    # Steps inside a year are windowed per year; steps across years compare yearly extremes, a
    # table with one row per year.
    within = days.withColumn("step", F.datediff(date, F.lag(date).over(inside))).select("step")
    yearly = days.groupBy("_year").agg(F.min(date).alias("lo"), F.max(date).alias("hi"))
    across = yearly.withColumn(
        "step", F.datediff("lo", F.lag("hi").over(Window.orderBy("_year")))
    ).select("step")
    return within.unionByName(across).agg(F.max("step").alias("max_gap_days"))


def autocorrelation(
    panel: DataFrame, max_lag: int = 56, value: str = "sales", keys: Sequence[str] = SERIES_KEYS
) -> DataFrame:
    """Autocorrelation of every series at lags 0..max_lag, one row per series and lag.

    r_k = sum of (x_t - m)(x_{t-k} - m) over sum of (x_t - m)^2. The lagged products are summed
    within each series, so only one row per series leaves the window stage.
    """
    w = Window.partitionBy(*keys)
    by_day = w.orderBy("d")
    centred = panel.select(*keys, "d", (F.col(value) - F.avg(value).over(w)).alias("x"))
    lagged = centred.select(
        *keys, "x", *[F.lag("x", k).over(by_day).alias(f"x_{k}") for k in range(1, max_lag + 1)]
    )
    sums = lagged.groupBy(*keys).agg(
        F.sum(F.col("x") * F.col("x")).alias("c_0"),
        *[F.sum(F.col("x") * F.col(f"x_{k}")).alias(f"c_{k}") for k in range(1, max_lag + 1)],
    )
    return sums.select(
        *keys,
        F.col("c_0"),
        F.posexplode(F.array(*[F.col(f"c_{k}") for k in range(max_lag + 1)])).alias("lag", "c_k"),
    ).select(*keys, "lag", F.try_divide("c_k", "c_0").alias("acf"))


def missing_days(panel: DataFrame, keys: Sequence[str] = SERIES_KEYS) -> DataFrame:
    """Rows, expected rows and missing days of each series between its first and last date."""
    return (
        panel.groupBy(*keys)
        .agg(
            F.count("*").alias("rows"),
            (F.datediff(F.max("date"), F.min("date")) + 1).cast("long").alias("expected_days"),
        )
        .withColumn("missing_days", F.col("expected_days") - F.col("rows"))
    )


def decompose(panel: DataFrame, value: str = "sales", keys: Sequence[str] = SERIES_KEYS):
    """Additive decomposition of every series: trend, weekly, monthly (30-day) and yearly parts.

    The trend is a centred 365-day mean where a full window exists, else a centred 29-day mean
    over the days at hand. Each seasonal part is the mean of what is left after the trend and the
    parts before it, per weekday, per position in a 30-day cycle and per day of year; the rest is
    the residual.
    """
    by_day = Window.partitionBy(*keys).orderBy("d")
    so_far = by_day.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # The long frame is a difference of running totals: one step per row instead of 365.
    upper, first = F.lead("_total", 182).over(by_day), F.lag("_total", 182).over(by_day)
    before = F.lag("_total", 183, 0.0).over(by_day)
    trend = F.when(upper.isNotNull() & first.isNotNull(), (upper - before) / 365).otherwise(
        F.avg("observed").over(by_day.rowsBetween(-14, 14))
    )
    out = (
        panel.select(*keys, "d", "date", F.col(value).cast("double").alias("observed"))
        .withColumn("_total", F.sum("observed").over(so_far))
        .withColumn("trend", trend)
        .drop("_total")
        .withColumns(
            {"_wday": F.weekday("date"), "_cycle": F.col("d") % 30, "_yday": F.dayofyear("date")}
        )
    )
    rest = F.col("observed") - F.col("trend")
    for name, phase in (
        ("seasonal_7", "_wday"), ("seasonal_30", "_cycle"), ("seasonal_365", "_yday"),
    ):
        out = out.withColumn(name, F.avg(rest).over(Window.partitionBy(*keys, phase)))
        rest = rest - F.col(name)
    return out.withColumn("residual", rest).drop("_wday", "_cycle", "_yday")
