"""Exploratory questions about a long panel: zero-sales shares, launch effects, seasonality, drivers.

Every function takes the panel and returns a small aggregate. They reduce with partial
aggregation, so a dominant store or item only costs each task one row per group.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stocktide.functions import columns as C
from stocktide.operators.reshape import pivot_value
from stocktide.operators.series import with_launch, with_running_sum


def zero() -> Column:
    return F.col("sales") == 0


def positive() -> Column:
    return F.col("sales") > 0


def launched() -> Column:
    return F.col("date") >= F.col("launch_date")


def sales_profile(panel: DataFrame) -> DataFrame:
    """Rows, sum, mean, median, range and spread of daily sales.

    The median counts rows per distinct sales value, so its state grows with the number of
    different daily unit counts and not with the rows.
    """
    return panel.agg(
        F.count("*").alias("rows"),
        F.sum("sales").alias("total_sales"),
        F.avg("sales").alias("avg_sales"),
        F.median("sales").alias("median_sales"),
        F.min("sales").alias("min_sales"),
        F.max("sales").alias("max_sales"),
        F.stddev("sales").alias("std_sales"),
    )


def zero_share(panel: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Observations and zero-sales days, per group."""
    return panel.groupBy(*keys).agg(
        F.count("*").alias("total_observations"),
        C.count_where(zero()).alias("zero_sales"),
        C.percent(C.count_where(zero()), F.count("*")).alias("zero_sales_pct"),
    )


def totals(panel: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Sum, mean and number of daily sales, per group."""
    return panel.groupBy(*keys).agg(
        F.sum("sales").alias("total_sales"),
        F.avg("sales").alias("avg_sales"),
        F.count("*").alias("observations"),
    )


def launch_panel(panel: DataFrame) -> DataFrame:
    """One distinct row per item, store and day with its launch date and week."""
    return (
        with_launch(panel)
        .select("store_id", "item_id", "date", "launch_date", "launch_week", "sales", "sell_price")
        .distinct()
    )


def zero_split_by_launch(panel: DataFrame, per_series: bool = False) -> DataFrame:
    """Zero days before and after launch, over all rows or per series."""
    keys = ["store_id", "item_id", "launch_date"] if per_series else []
    before, after = zero() & ~launched(), zero() & launched()
    return (
        with_launch(panel)
        .groupBy(*keys)
        .agg(
            F.count("*").alias("total_sales"),
            C.count_where(before).alias("zero_sales_before_launch"),
            C.count_where(after).alias("zero_sales_after_launch"),
            C.percent(C.count_where(before), F.count("*")).alias("zero_pct_before_launch"),
            C.percent(C.count_where(after), F.count("*")).alias("zero_pct_after_launch"),
        )
    )


def zero_timing(panel: DataFrame) -> DataFrame:
    """Where the zero days lie; series without any price stay in the totals."""
    before, after = zero() & ~launched(), zero() & launched()
    zeros = C.count_where(zero())
    return with_launch(panel, how="left").agg(
        F.count("*").alias("total_observations"),
        zeros.alias("zero_sales"),
        C.count_where(positive()).alias("positive_sales"),
        C.count_where(before).alias("zero_sales_before_launch"),
        C.count_where(after).alias("zero_sales_after_launch"),
        C.percent(zeros, F.count("*")).alias("zero_sales_pct"),
        C.percent(C.count_where(positive()), F.count("*")).alias("positive_sales_pct"),
        C.percent(C.count_where(before), zeros).alias("pct_zero_sales_before_launch"),
        C.percent(C.count_where(after), zeros).alias("pct_zero_sales_after_launch"),
    )


def days_after() -> Column:
    return C.count_where(launched())


def zero_after() -> Column:
    return C.count_where(zero() & launched())


def positive_after() -> Column:
    return C.count_where(positive() & launched())


def post_launch_zero(
    panel: DataFrame, keys: Sequence[str], launched_only: bool = False
) -> DataFrame:
    """Post-launch days, zero days and their share, per group.

    A group whose rows all lie before launch stays, with a count of 0 and a NULL share, unless
    `launched_only` drops the earlier rows first.
    """
    rows = with_launch(panel)
    rows = rows.where(launched()) if launched_only else rows
    return rows.groupBy(*keys).agg(
        days_after().alias("total_sales_after_launch"),
        zero_after().alias("zero_sales_after_launch"),
        C.percent(zero_after(), days_after()).alias("zero_pct_after_launch"),
    )


def post_launch_positive(panel: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Post-launch days, days with a sale and their share, per group."""
    return (
        with_launch(panel)
        .groupBy(*keys)
        .agg(
            days_after().alias("total_observations"),
            positive_after().alias("total_sales_after_launch"),
            C.percent(positive_after(), days_after()).alias("sales_pct_after_launch"),
        )
    )


def snap_effect(panel: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Post-launch zero and positive days as fractions, per group."""
    return (
        with_launch(panel)
        .groupBy(*keys)
        .agg(
            days_after().alias("total_observations"),
            zero_after().alias("zero_sales"),
            positive_after().alias("positive_sales"),
            C.share(zero_after(), days_after()).alias("zero_sales_share"),
            C.share(positive_after(), days_after()).alias("positive_sales_share"),
        )
    )


def _demand_measures() -> list[Column]:
    return [
        C.percent(zero_after(), days_after()).alias("zero_sales_pct"),
        C.percent(positive_after(), days_after()).alias("positive_sales_pct"),
        C.mean_where("sales", launched()).alias("avg_sales_all_days"),
        C.mean_where("sales", launched() & positive()).alias("avg_sales_positive_days"),
    ]


def post_launch_profile(
    panel: DataFrame, keys: Sequence[str | Column], after_launch_mean: bool = False
) -> DataFrame:
    """Post-launch zero and positive shares with mean sales, per group.

    `after_launch_mean` adds the mean over the days strictly after the launch day.
    """
    measures = _demand_measures()
    if after_launch_mean:
        measures.append(
            C.mean_where("sales", F.col("date") > F.col("launch_date")).alias(
                "avg_sales_after_launch_day"
            )
        )
    return with_launch(panel).groupBy(*keys).agg(*measures)


def snap_pivot(panel: DataFrame, index: str | Column, measure: str, name: str) -> DataFrame:
    """A post-launch measure by `index` and benefit flag, one column per flag value."""
    column = C.as_column(index).alias(name)
    if measure == "positive_sales_share":
        table = snap_effect(panel.withColumn(name, column), [name, "snap"])
    else:
        table = post_launch_profile(panel.withColumn(name, column), [name, "snap"])
    return pivot_value(table, name, "snap", [0, 1], measure, ["snap_0", "snap_1"])


def duplicate_grain(panel: DataFrame, keys: Sequence[str] = ("store_id", "item_id", "date")):
    return panel.groupBy(*keys).agg(F.count("*").alias("grain_count")).where("grain_count > 1")


def series_slice(panel: DataFrame, item_id: str, store_id: str, first: str, last: str):
    """Daily sales of one series between two dates, with the running total."""
    rows = panel.where(
        (F.col("item_id") == item_id)
        & (F.col("store_id") == store_id)
        & F.col("date").between(F.lit(first).cast("date"), F.lit(last).cast("date"))
    )
    daily = rows.groupBy("item_id", "store_id", "date").agg(F.sum("sales").alias("sales"))
    return with_running_sum(daily)


def sales_histogram(panel: DataFrame, limit: int | None = None) -> DataFrame:
    """Days per sales value and their percentage of all days, or of those up to `limit` units."""
    kept = panel.where(F.col("sales").isNotNull() if limit is None else F.col("sales") <= limit)
    counts = kept.groupBy("sales").agg(F.count("*").alias("sales_dist"))
    total = counts.agg(F.sum("sales_dist")).scalar()
    return counts.withColumn("pct", C.percent("sales_dist", total))


def sales_buckets(panel: DataFrame) -> DataFrame:
    return (
        panel.groupBy(C.sales_bucket().alias("sales_bucket"))
        .agg(F.count("*").alias("sales_dist"))
        .orderBy(C.sales_bucket_order())
    )


def top_sales(panel: DataFrame, n: int = 30) -> DataFrame:
    """The highest daily sales; ties go to the first store, item and date."""
    return (
        panel.select(
            "state_id", "store_id", "item_id", "cat_id", "date", "weekday", "sell_price", "sales",
            "event_type_1", "event_name_1", "snap",
        )
        .orderBy(F.desc("sales"), "store_id", "item_id", "date")
        .limit(n)
    )


def tail_profile(
    panel: DataFrame, low: int = 400, high: int = 800, price_limit: float = 5.0
) -> DataFrame:
    """Context of the days strictly between two sales levels, most frequent first."""
    return (
        panel.where((F.col("sales") > low) & (F.col("sales") < high))
        .select(
            "store_id",
            "cat_id",
            "weekday",
            C.event_flag().alias("event"),
            "snap",
            C.price_level_flag(limit=price_limit).alias("price"),
        )
        .groupBy("store_id", "cat_id", "weekday", "event", "snap", "price")
        .agg(F.count("*").alias("sales_count"))
        .orderBy(F.desc("sales_count"))
    )


def post_launch_zero_per_series(panel: DataFrame) -> DataFrame:
    return (
        with_launch(panel)
        .groupBy("store_id", "item_id")
        .agg(C.percent(zero_after(), days_after()).alias("pct_zero_sales_after_launch"))
    )


def post_launch_zero_distribution(panel: DataFrame) -> DataFrame:
    """Spread of the per-series zero share: count, mean, deviation, quartiles and range.

    The shares are percentages with two decimals, so the quartiles count at most 10,001 values.
    """
    x = F.col("pct_zero_sales_after_launch")
    quartiles = F.percentile(x, F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)))
    return (
        post_launch_zero_per_series(panel)
        .agg(
            F.count(x).alias("count"),
            F.avg(x).alias("mean"),
            F.stddev(x).alias("std"),
            F.min(x).alias("min"),
            quartiles.alias("q"),
            F.max(x).alias("max"),
        )
        .select(
            "count",
            "mean",
            "std",
            "min",
            F.col("q")[0].alias("p25"),
            F.col("q")[1].alias("p50"),
            F.col("q")[2].alias("p75"),
            "max",
        )
    )


def price_quantiles(panel: DataFrame) -> DataFrame:
    """Price range and upper quantiles of launched series.

    Prices are amounts of money: the quantile state holds one counter per price point.
    """
    x = F.col("sell_price")
    points = F.percentile(x, F.array(*[F.lit(p) for p in (0.5, 0.75, 0.9, 0.95, 0.99)]))
    return (
        with_launch(panel)
        .agg(F.min(x).alias("min_price"), points.alias("q"), F.max(x).alias("max_price"))
        .select(
            "min_price",
            F.col("q")[0].alias("median_price"),
            F.col("q")[1].alias("p75"),
            F.col("q")[2].alias("p90"),
            F.col("q")[3].alias("p95"),
            F.col("q")[4].alias("p99"),
            "max_price",
        )
    )


def price_bands(panel: DataFrame, bounds: Sequence[float] = C.PRICE_BOUNDS) -> DataFrame:
    """Demand by price band over all rows of launched series, with post-launch shares."""
    return (
        with_launch(panel)
        .groupBy(C.price_bucket("sell_price", bounds).alias("price_bucket"))
        .agg(*_demand_measures(), F.median("sales").alias("median_sales"))
    )


def item_price(panel: DataFrame, max_price: float = 3.0) -> DataFrame:
    """Demand of each item at each of its low prices."""
    return (
        with_launch(panel)
        .where(F.col("sell_price") <= max_price)
        .groupBy("item_id", "sell_price")
        .agg(*_demand_measures())
    )


def hierarchy_census(sales_wide_ids: DataFrame) -> DataFrame:
    """Distinct ids at each level of the business hierarchy."""
    return sales_wide_ids.agg(
        *[
            F.countDistinct(c).alias(f"n_{c}")
            for c in ("id", "item_id", "store_id", "dept_id", "cat_id", "state_id")
        ],
        F.count("*").alias("rows"),
    )


def value_counts(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows per value or combination, most frequent first."""
    return df.groupBy(*keys).agg(F.count("*").alias("count")).orderBy(F.desc("count"), *keys)


def id_dependency(sales_wide_ids: DataFrame) -> DataFrame:
    """Most items and stores found under one id; both are 1 when the id names a series."""
    per_id = sales_wide_ids.groupBy("id").agg(
        F.countDistinct("item_id").alias("items"), F.countDistinct("store_id").alias("stores")
    )
    return per_id.agg(F.max("items").alias("max_items"), F.max("stores").alias("max_stores"))


def calendar_profile(calendar: DataFrame) -> DataFrame:
    """Date span, event days by slot and benefit days by state."""
    snaps = [c for c in calendar.columns if c.startswith("snap_")]
    events = ("event_name_1", "event_type_1", "event_name_2", "event_type_2")
    return calendar.agg(
        F.min("date").alias("first_date"),
        F.max("date").alias("last_date"),
        F.countDistinct("date").alias("n_days"),
        *[F.count(c).alias(f"n_{c}") for c in events],
        *[F.sum(c).alias(c) for c in snaps],
    )
