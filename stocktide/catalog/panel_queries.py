"""Registered queries on the panel sources and the exploratory questions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stocktide.functions import columns as C
from stocktide.operators import series
from stocktide.plans import eda
from stocktide.sources import star_schema as star

# The panel's prices run from 900 to 1000; these bands take the place of the retail ones.
PANEL_PRICE_BOUNDS = (905, 910, 920, 930, 940, 960, 975, 990)
PANEL_LOW_PRICE = 905
PANEL_TAIL = (40, 90, 950.0)

ONE_SERIES = ("Brand#13", "NATION_7")


def rounded(df: DataFrame, *names: str, digits: int = 6) -> DataFrame:
    """Round float columns whose last bits depend on summation order."""
    return df.withColumns({n: F.round(n, digits) for n in names})


def on_panel(question, *args, **kwargs):
    return lambda spark, folder: question(star.sales_panel(spark, folder), *args, **kwargs)


def series_ids(spark, folder) -> DataFrame:
    """The id columns of the wide table: one row per series."""
    panel = star.sales_panel(spark, folder)
    return panel.select("item_id", "dept_id", "cat_id", "store_id", "state_id").distinct().select(
        C.joined_key("item_id", "store_id").alias("id"), "*"
    )


def queries():
    zero, total, profile = eda.zero_share, eda.totals, eda.post_launch_profile
    positive, snap = eda.post_launch_positive, eda.snap_effect
    return {
        "sales_profile": lambda s, f: rounded(
            eda.sales_profile(star.sales_panel(s, f)), "std_sales"
        ),
        "zero_share_all": on_panel(zero),
        "zero_share_store_item": on_panel(zero, ["store_id", "item_id"]),
        "zero_share_date": on_panel(zero, ["date"]),
        "zero_share_cat": on_panel(zero, ["cat_id"]),
        "zero_share_year_cat": on_panel(zero, ["year", "cat_id"]),
        "launch_panel": on_panel(eda.launch_panel),
        "launch_one_series": lambda s, f: eda.launch_panel(star.sales_panel(s, f)).where(
            (F.col("item_id") == ONE_SERIES[0]) & (F.col("store_id") == ONE_SERIES[1])
        ),
        "launch_table": on_panel(series.launch_table),
        "launch_zero_split": on_panel(eda.zero_split_by_launch),
        "launch_zero_split_series": on_panel(eda.zero_split_by_launch, per_series=True),
        "launch_zero_split_prefix": lambda s, f: eda.zero_split_by_launch(
            star.sales_panel(s, f), per_series=True
        )
        .where(F.col("item_id").startswith("Brand#1"))
        .select("store_id", "item_id", "launch_date", "total_sales"),
        "post_launch_zero_year_weekday": on_panel(
            eda.post_launch_zero,
            ["store_id", "item_id", "launch_date", "year", "weekday"],
            launched_only=True,
        ),
        "post_launch_zero_store_cat_weekday": on_panel(
            eda.post_launch_zero, ["store_id", "cat_id", "weekday"]
        ),
        "post_launch_store_cat_weekday": on_panel(positive, ["store_id", "cat_id", "weekday"]),
        "post_launch_cat_month": on_panel(positive, ["cat_id", "month"]),
        "post_launch_store_cat_month": on_panel(positive, ["store_id", "cat_id", "month"]),
        "snap_effect": on_panel(snap, ["snap"]),
        "snap_effect_state": on_panel(snap, ["state_id", "snap"]),
        "snap_effect_state_store_cat": on_panel(snap, ["state_id", "store_id", "cat_id", "snap"]),
        "snap_weekday_pivot": on_panel(
            eda.snap_pivot, "weekday", "positive_sales_share", "weekday"
        ),
        "snap_event_pivot": lambda s, f: eda.snap_pivot(
            star.sales_panel(s, f), C.event_flag(), "positive_sales_share", "event_type"
        ),
        "totals_store": on_panel(total, ["store_id"]),
        "totals_state": on_panel(total, ["state_id"]),
        "totals_cat": on_panel(total, ["cat_id"]),
        "totals_dept": on_panel(total, ["dept_id"]),
        "totals_year": on_panel(total, ["year"]),
        "totals_month": on_panel(total, ["month"]),
        "totals_weekday": on_panel(total, ["weekday"]),
        "totals_date": on_panel(total, ["date"]),
        "totals_event": on_panel(total, ["event_type_1"]),
        "duplicate_grain": on_panel(eda.duplicate_grain),
        "duplicate_order_lines": lambda s, f: eda.duplicate_grain(
            star.table(s, f, "lineitem"), ["l_orderkey", "l_linenumber"]
        ),
        "series_slice": on_panel(eda.series_slice, *ONE_SERIES, "2000-03-15", "2000-04-24"),
        "sales_hist": on_panel(eda.sales_histogram),
        "sales_buckets": on_panel(eda.sales_buckets),
        "top_sales": on_panel(eda.top_sales),
        "tail_profile": on_panel(eda.tail_profile, *PANEL_TAIL),
        "zero_timing": on_panel(eda.zero_timing),
        "post_launch_zero_series": on_panel(eda.post_launch_zero_per_series),
        "post_launch_zero_distribution": lambda s, f: rounded(
            eda.post_launch_zero_distribution(star.sales_panel(s, f)), "mean", "std"
        ),
        "post_launch_year": on_panel(profile, ["year"]),
        "post_launch_year_month": on_panel(profile, ["year", "month"], after_launch_mean=True),
        "post_launch_month_weekday": on_panel(
            profile, ["month", "weekday"], after_launch_mean=True
        ),
        "post_launch_year_cat": on_panel(profile, ["year", "cat_id"]),
        "post_launch_store_cat": on_panel(profile, ["store_id", "cat_id"]),
        "post_launch_snap": on_panel(profile, ["snap"]),
        "event_snap_pivot": lambda s, f: eda.snap_pivot(
            star.sales_panel(s, f), C.event_flag(), "avg_sales_positive_days", "event_type"
        ),
        "weekday_snap_zero_pivot": on_panel(
            eda.snap_pivot, "weekday", "zero_sales_pct", "weekday"
        ),
        "weekday_snap_mean_pivot": on_panel(
            eda.snap_pivot, "weekday", "avg_sales_positive_days", "weekday"
        ),
        "post_launch_store_item_snap": on_panel(profile, ["store_id", "item_id", "snap"]),
        "price_quantiles": on_panel(eda.price_quantiles),
        "price_buckets": on_panel(eda.price_bands, PANEL_PRICE_BOUNDS),
        "item_price": on_panel(eda.item_price, PANEL_LOW_PRICE),
        "hierarchy_census": lambda s, f: eda.hierarchy_census(series_ids(s, f)),
        "series_per_hierarchy": lambda s, f: eda.value_counts(
            series_ids(s, f), ["state_id", "store_id", "cat_id", "dept_id"]
        ),
        "series_per_state": lambda s, f: eda.value_counts(series_ids(s, f), ["state_id"]),
        "id_dependency": lambda s, f: eda.id_dependency(series_ids(s, f)),
        "totals_year_month": lambda s, f: total(
            star.sales_panel(s, f), [C.year_month().alias("year_month")]
        ),
        "totals_month_weekday": lambda s, f: total(
            star.sales_panel(s, f),
            ["month", F.weekday("date").alias("weekday_no"), C.month_weekday().alias("month_weekday")],
        ).orderBy("month", "weekday_no"),
        "daily_units": lambda s, f: star.sales_panel(s, f)
        .groupBy("date")
        .agg(F.sum("sales").alias("units")),
    }


def oracle_sql():
    from oracles import eda as sql

    return sql.statements(PANEL_PRICE_BOUNDS, PANEL_LOW_PRICE, PANEL_TAIL)
