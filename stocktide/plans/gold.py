"""Long panel to feature table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stocktide.config import HORIZON
from stocktide.operators import features as f

BASE_COLUMNS = (
    "item_id", "store_id", "state_id", "cat_id", "dept_id", "d", "date", "wm_yr_wk",
    "year", "month", "weekday", "sell_price", "event_name_1", "event_type_1", "snap", "sales",
)


def in_years(df: DataFrame, start_year: int, end_year: int) -> DataFrame:
    return df.where(F.col("year").between(start_year, end_year))


def build_features(
    panel: DataFrame,
    start_year: int,
    end_year: int,
    *,
    horizon: int = HORIZON,
    truncate_first: bool = False,
) -> DataFrame:
    """Feature table of the rows with a price, restricted to a window of years.

    Features are computed over the whole history and the years are cut afterwards, so the first
    days of the window have their lags and the launch date is the real one. `truncate_first` cuts
    first: launch is then the first day inside the window and early lags are NULL.
    """
    rows = f.priced_rows(panel.select(*BASE_COLUMNS))
    if truncate_first:
        rows = in_years(rows, start_year, end_year)
    # Windows over the series come first and share its partitioning; the year filter then cuts
    # the rows before the two joins move them.
    own = (
        rows.transform(f.own_price_features)
        .transform(f.calendar_features)
        .transform(f.own_sales_features, horizon)
    )
    window = in_years(own, start_year, end_year)
    return f.group_features(window, rows, horizon).transform(f.trend_features)
