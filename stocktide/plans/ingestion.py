"""Raw tables to the long panel."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stocktide.config import ID_COLUMNS, PANEL_COLUMNS, Settings
from stocktide.functions import columns as C
from stocktide.operators import quality
from stocktide.operators.joins import one_row_per_key
from stocktide.operators.reshape import columns_with_prefix, melt
from stocktide.sources import bronze, tables


def melt_sales(wide: DataFrame, ids: Sequence[str] = ID_COLUMNS) -> DataFrame:
    """One row per series and day, `d` still as text."""
    return melt(wide, ids, columns_with_prefix(wide, bronze.DAY_PREFIX), "d", "sales")


def build_panel(
    wide: DataFrame,
    calendar: DataFrame,
    prices: DataFrame,
    *,
    panel_columns: Sequence[str] = PANEL_COLUMNS,
    check_keys: bool = True,
) -> DataFrame:
    """Melt wide sales and attach calendar, benefit flag and weekly price.

    A checked calendar holds one row per day and is broadcast; an unchecked one is left to the planner. Prices
    hold one row per series and week and are joined by shuffle on that key, which spreads any single
    store or item over its weeks. The checks are part of the plan: a repeated key fails the action.
    """
    price = bronze.clean_prices(prices)
    if check_keys:
        calendar = F.broadcast(one_row_per_key(calendar, ["d"], "calendar"))
        price = one_row_per_key(price, ["store_id", "item_id", "wm_yr_wk"], "price")
    snaps = {c[len("snap_") :]: c for c in columns_with_prefix(calendar, "snap_")}
    return (
        melt_sales(wide)
        .join(calendar, "d", "left")
        .withColumns(
            {
                "snap": C.select_by_value("state_id", snaps).cast("int"),
                "d": C.strip_prefix_int("d", bronze.DAY_PREFIX),
                "wm_yr_wk": F.col("wm_yr_wk").cast("int"),
                "month": F.col("month").cast("int"),
                "year": F.col("year").cast("int"),
                "sales": F.col("sales").cast("int"),
            }
        )
        .join(price, ["store_id", "item_id", "wm_yr_wk"], "left")
        .select(*panel_columns)
    )


def run(
    spark: SparkSession,
    calendar_path: str,
    prices_path: str,
    sales_path: str,
    output_path: str,
    settings: Settings = Settings(),
) -> dict:
    """Read the raw files, check them, write the panel, check it and return a summary."""
    calendar = bronze.read_calendar(spark, calendar_path, settings.calendar_columns)
    prices = bronze.read_prices(spark, prices_path, settings.price_columns)
    wide = bronze.read_sales_wide(spark, sales_path, settings.id_columns)
    expected = settings.expected_rows
    quality.raise_on_failure(
        quality.check_raw_table(
            calendar, settings.calendar_columns, expected["calendar"], "calendar"
        )
    )
    quality.raise_on_failure(
        quality.check_raw_table(prices, settings.price_columns, expected["prices"], "prices")
    )
    quality.raise_on_failure(
        quality.check_raw_table(wide, settings.id_columns, expected["sales_wide"], "sales")
    )
    panel = build_panel(wide, calendar, prices, panel_columns=settings.panel_columns)
    summary = tables.write_panel(panel, output_path)
    stored = tables.read_panel(spark, output_path)
    quality.raise_on_failure(quality.panel_checks(stored, expected["sales_melted"]))
    return summary
