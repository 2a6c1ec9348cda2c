"""Forecast features. Everything derived from sales looks back at least one horizon.

The panel is dense (one row per series and day), so a ROWS frame counts days. All series windows
share one partitioning and one ordering, hence one shuffle and one sort.

Rolling counts, sums and sums of squares are differences of running totals taken at two lags.
That is O(1) per row whatever the frame length, and exact because sales are whole numbers.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.window import WindowSpec

from stocktide.config import ENCODINGS, HORIZON, SERIES_KEYS
from stocktide.functions import columns as C

SMOOTHING = 0.1
LAG_STEPS = (*range(8), 28)


def series() -> WindowSpec:
    return Window.partitionBy(*SERIES_KEYS)


def by_day() -> WindowSpec:
    return series().orderBy("d")


def running() -> WindowSpec:
    return by_day().rowsBetween(Window.unboundedPreceding, Window.currentRow)


def priced_rows(panel: DataFrame) -> DataFrame:
    """Rows with a known price: a series enters at its launch."""
    return panel.where(C.is_present("sell_price"))


def with_launch_date(panel: DataFrame) -> DataFrame:
    return panel.withColumn("launch_date", F.min("date").over(series()))


def calendar_features(panel: DataFrame) -> DataFrame:
    return panel.withColumns(
        {
            "week_of_year": F.weekofyear("date"),
            "day_of_week": C.iso_weekday("date"),
            "day_of_month": F.dayofmonth("date"),
            "is_weekend": C.weekend_flag("date"),
        }
    )


def _lags(horizon: int, steps: Sequence[int]) -> dict[str, Column]:
    lags = [step + horizon for step in steps]
    return {f"lag_{n}": F.lag("sales", n).over(by_day()).cast("int") for n in lags}


def lag_features(
    panel: DataFrame, horizon: int = HORIZON, steps: Sequence[int] = LAG_STEPS
) -> DataFrame:
    return panel.withColumns(_lags(horizon, steps))


def _sold() -> Column:
    return F.col("sales") > 0


def _totals() -> dict[str, Column]:
    units = F.col("sales").cast("long")
    return {
        "_n": units.isNotNull().cast("long"),
        "_sum": units,
        "_n_pos": _sold().cast("long"),
        "_n_zero": (units == 0).cast("long"),
        "_sum_pos": F.when(_sold(), units),
        "_sq_pos": F.when(_sold(), units * units),
    }


def _with_running_totals(panel: DataFrame, names: Sequence[str]) -> DataFrame:
    totals = _totals()
    return panel.withColumns(
        {n: F.coalesce(F.sum(totals[n]).over(running()), F.lit(0)) for n in names}
    )


def _window_total(total: str, size: int, horizon: int) -> Column:
    """Total over the `size` rows that end `horizon` rows back; NULL when there is no such row."""
    upper = F.lag(total, horizon).over(by_day())
    return upper - F.lag(total, horizon + size, 0).over(by_day())


def _mean_of(total: str, count: str, size: int, horizon: int) -> Column:
    return C.round_half_up(
        F.try_divide(
            _window_total(total, size, horizon).cast("double"),
            _window_total(count, size, horizon).cast("double"),
        )
    )


def _spread(n: Column, total: Column, squares: Column) -> Column:
    """Sample standard deviation from count, sum and sum of squares; NULL below two values."""
    return F.when(
        n > 1, F.sqrt(F.greatest(squares - total * total / n, F.lit(0.0)) / (n - 1))
    )


def _intermittency(horizon: int) -> dict[str, Column]:
    last_sale = F.max(F.when(_sold(), F.col("date"))).over(
        by_day().rowsBetween(Window.unboundedPreceding, -horizon)
    )
    return {
        "rolling_positive_rate_7": _mean_of("_n_pos", "_n", 7, horizon),
        "rolling_positive_rate_28": _mean_of("_n_pos", "_n", 28, horizon),
        "rolling_zero_rate_28": _mean_of("_n_zero", "_n", 28, horizon),
        "days_since_last_sale": F.datediff("date", last_sale),
    }


def _recent_demand(horizon: int, sizes: Sequence[int] = (7, 28, 56)) -> dict[str, Column]:
    return {f"rolling_mean_{k}": _mean_of("_sum", "_n", k, horizon) for k in sizes}


def _magnitude(horizon: int) -> dict[str, Column]:
    frame = by_day().rowsBetween(-(horizon + 27), -horizon)
    sold = F.when(_sold(), F.col("sales"))
    n, total, squares = (
        _window_total(name, 28, horizon).cast("double")
        for name in ("_n_pos", "_sum_pos", "_sq_pos")
    )
    return {
        "rolling_positive_mean_7": _mean_of("_sum_pos", "_n_pos", 7, horizon),
        "rolling_positive_mean_28": _mean_of("_sum_pos", "_n_pos", 28, horizon),
        "rolling_positive_median_28": C.round_half_up(F.percentile(sold, 0.5).over(frame)),
        "rolling_positive_std_28": C.round_half_up(_spread(n, total, squares)),
        "rolling_positive_max_28": F.max(sold).over(frame).cast("double"),
    }


def intermittency_features(panel: DataFrame, horizon: int = HORIZON) -> DataFrame:
    """Share of days with and without a sale, and days since the last known sale."""
    used = ["_n", "_n_pos", "_n_zero"]
    return _with_running_totals(panel, used).withColumns(_intermittency(horizon)).drop(*used)


def recent_demand_features(panel: DataFrame, horizon: int = HORIZON) -> DataFrame:
    """Mean daily sales over one, four and eight weeks."""
    used = ["_n", "_sum"]
    return _with_running_totals(panel, used).withColumns(_recent_demand(horizon)).drop(*used)


def magnitude_features(panel: DataFrame, horizon: int = HORIZON) -> DataFrame:
    """Mean, median, spread and maximum of the days with a sale."""
    used = ["_n_pos", "_sum_pos", "_sq_pos"]
    return _with_running_totals(panel, used).withColumns(_magnitude(horizon)).drop(*used)


def own_sales_features(
    panel: DataFrame, horizon: int = HORIZON, steps: Sequence[int] = LAG_STEPS
) -> DataFrame:
    """Lags, intermittency, recent demand, magnitude and own encodings in two window stages.

    One stage makes the running totals, the other everything read from them; each stage moves the
    wide rows once.
    """
    used = list(_totals())
    return (
        _with_running_totals(panel, used)
        .withColumns(
            {
                **_lags(horizon, steps),
                **_intermittency(horizon),
                **_recent_demand(horizon),
                **_magnitude(horizon),
                **_own_encodings(horizon),
                "price_weekly_change": _price_ratio(F.lag("sell_price", 7).over(by_day())),
            }
        )
        .drop(*used)
    )


def _price_ratio(base: Column) -> Column:
    return C.round_half_up(F.try_divide(F.col("sell_price"), base))


def own_price_features(panel: DataFrame) -> DataFrame:
    """Price position and movement within the series, and its launch date.

    Price means run over the whole series, month or year, later days included: prices are plan
    data, known ahead. The distinct count collects the prices of one series, which is at most one
    per week. The windows go from the finest partitioning to the coarsest, so one sort by series,
    year and month serves them all.
    """
    price = F.col("sell_price")
    month = Window.partitionBy(*SERIES_KEYS, "year", "month")
    year = Window.partitionBy(*SERIES_KEYS, "year")
    return (
        panel.withColumn("price_change_m", _price_ratio(F.avg(price).over(month)))
        .withColumn("price_change_y", _price_ratio(F.avg(price).over(year)))
        .withColumns(
            {
                "price_unique_count": F.size(F.collect_set(price).over(series())).cast("long"),
                "price_max": F.max(price).over(series()),
                "price_min": F.min(price).over(series()),
                "price_mean": C.round_half_up(F.avg(price).over(series())),
                "price_norm": _price_ratio(F.max(price).over(series())),
                "price_vs_usual": _price_ratio(F.avg(price).over(series())),
                "launch_date": F.min("date").over(series()),
            }
        )
    )


def exact_price() -> Column:
    """Price as an exact amount: sums of it do not depend on the order of the rows.

    So means that lie on a rounding boundary come out alike in every run.
    """
    return F.col("sell_price").try_cast("decimal(18,4)")


def price_features(panel: DataFrame) -> DataFrame:
    """Own price features and the price against the department's mean of the week.

    A department week of a big store is a hot key, so its mean is aggregated (with map-side
    combine) and joined back instead of being windowed in one task.
    """
    keys = ["store_id", "dept_id", "wm_yr_wk"]
    mean = F.try_divide(F.sum(exact_price()).cast("double"), F.count(exact_price()).cast("double"))
    dept = panel.groupBy(*keys).agg(mean.alias("_dept_price"))
    return (
        own_price_features(panel)
        .drop("launch_date")
        .withColumn("price_weekly_change", _price_ratio(F.lag("sell_price", 7).over(by_day())))
        .join(dept, keys, "left")
        .withColumn("price_vs_dept", _price_ratio(F.col("_dept_price")))
        .drop("_dept_price")
    )


def _daily_totals(panel: DataFrame, keys: Sequence[str]) -> DataFrame:
    s = F.col("sales").cast("long")
    return panel.groupBy(*keys, "d").agg(
        F.count("sales").alias("_n"), F.sum(s).alias("_s"), F.sum(s * s).alias("_q")
    )


def _expanding(keys: Sequence[str], name: str, horizon: int) -> dict[str, Column]:
    """Mean and spread of all units of a key up to one horizon back, from daily reductions."""
    frame = (
        Window.partitionBy(*keys).orderBy("d").rangeBetween(Window.unboundedPreceding, -horizon)
    )
    n, s, q = (F.sum(c).over(frame).cast("double") for c in ("_n", "_s", "_q"))
    return {f"enc_{name}_mean": F.try_divide(s, n), f"enc_{name}_std": _spread(n, s, q)}


def store_dept_rolling(horizon: int = HORIZON, size: int = 28) -> Column:
    """Mean daily units of a store department over `size` days, ending one horizon back."""
    frame = (
        Window.partitionBy("store_id", "dept_id")
        .orderBy("d")
        .rowsBetween(-(horizon + size - 1), -horizon)
    )
    return C.round_half_up(F.avg("_s").over(frame))


def store_dept_features(panel: DataFrame, horizon: int = HORIZON) -> DataFrame:
    daily = _daily_totals(panel, ["store_id", "dept_id"])
    rolled = daily.select(
        "store_id", "dept_id", "d", store_dept_rolling(horizon).alias("store_dept_rolling_avg")
    )
    return panel.join(rolled, ["store_id", "dept_id", "d"], "left")


CELL = ("store_id", "dept_id")


def _own_encodings(horizon: int) -> dict[str, Column]:
    known = by_day().rangeBetween(Window.unboundedPreceding, -horizon)
    return {
        "enc_item_store_mean": F.avg("sales").over(known),
        "enc_item_store_std": F.stddev("sales").over(known),
    }


def own_encodings(panel: DataFrame, horizon: int = HORIZON) -> DataFrame:
    """Expanding mean and spread of the series itself."""
    return panel.withColumns(_own_encodings(horizon))


def cell_table(panel: DataFrame, horizon: int = HORIZON) -> DataFrame:
    """Everything known per store, department and day, one row each.

    Expanding encodings of the three store keys, the rolling department mean and the mean price of
    the department's week. The panel is reduced once; every window then runs over the reduced rows
    of one store, at most departments times days, and all of them share a shuffle by store. A
    department belongs to one category, as in the business hierarchy.
    """
    units = F.col("sales").cast("long")
    cells = (
        panel.groupBy(*CELL, "wm_yr_wk", "d")
        .agg(
            F.min("cat_id").alias("cat_id"),
            F.count("sales").alias("_n"),
            F.sum(units).alias("_s"),
            F.sum(units * units).alias("_q"),
            F.sum(exact_price()).alias("_p"),
            F.count(exact_price()).alias("_pn"),
        )
        .repartition("store_id")
    )
    week = Window.partitionBy(*CELL, "wm_yr_wk")
    new = {
        "_dept_price": F.try_divide(
            F.sum("_p").over(week).cast("double"), F.sum("_pn").over(week).cast("double")
        ),
        "store_dept_rolling_avg": store_dept_rolling(horizon),
    }
    for name in ("store_dept", "store_cat", "store"):
        new |= _expanding(ENCODINGS[name], name, horizon)
    return cells.withColumns(new).drop("wm_yr_wk", "cat_id", "_n", "_s", "_q", "_p", "_pn")


def item_table(panel: DataFrame, horizon: int = HORIZON) -> DataFrame:
    """Expanding mean and spread per item and day."""
    items = _daily_totals(panel, ["item_id"])
    return items.withColumns(_expanding(ENCODINGS["item"], "item", horizon)).drop(
        "_n", "_s", "_q"
    )


def encoding_features(panel: DataFrame, horizon: int = HORIZON) -> DataFrame:
    """Expanding mean and spread of sales per item, store, series, store department and category.

    The frame depends on the day only, so each key is first reduced to one row per day; the
    expanding window then runs over days, never over the rows of a whole store.
    """
    cells = cell_table(panel, horizon).drop("store_dept_rolling_avg", "_dept_price")
    return (
        own_encodings(panel, horizon)
        .join(cells, [*CELL, "d"], "left")
        .join(item_table(panel, horizon), ["item_id", "d"], "left")
    )


def group_features(features: DataFrame, panel: DataFrame, horizon: int = HORIZON) -> DataFrame:
    """Attach all features shared by several series: two joins, by cell and by item."""
    return (
        features.join(cell_table(panel, horizon), [*CELL, "d"], "left")
        .join(item_table(panel, horizon), ["item_id", "d"], "left")
        .withColumn("price_vs_dept", _price_ratio(F.col("_dept_price")))
        .drop("_dept_price")
    )


def trend_features(features: DataFrame) -> DataFrame:
    """Ratios of recent level to longer and wider levels; needs rolling means and encodings."""
    recent = F.col("rolling_mean_28") + SMOOTHING

    def against(base: str) -> Column:
        return F.try_divide(recent, F.col(base))

    return features.withColumns(
        {
            "trend_28_vs_long": against("enc_item_store_mean"),
            "trend_7_vs_28": (F.col("rolling_mean_7") + SMOOTHING) / recent,
            "trend_28_vs_56": recent / (F.col("rolling_mean_56") + SMOOTHING),
            "item_vs_dept": against("enc_store_dept_mean"),
            "item_vs_cat": against("enc_store_cat_mean"),
            "item_store_vs_global": F.try_divide("enc_item_store_mean", "enc_item_mean"),
        }
    )


def lifecycle_features(panel: DataFrame, short_lags: Sequence[int] = ()) -> DataFrame:
    """Days since launch, availability, price steps and days since the last price change.

    Works on the full panel: rows before launch have no price and are not available.
    `short_lags` adds lags below the horizon; they leak into a direct forecast and are off unless
    asked for.
    """
    price = F.col("sell_price")
    launched = panel.withColumns(
        {
            "launch_date": F.min(F.when(price.isNotNull(), F.col("date"))).over(series()),
            "previous_price": F.lag(price).over(by_day()),
        }
    )
    out = launched.withColumns(
        {
            "days_since_launch": F.datediff("date", "launch_date"),
            "is_available": (F.col("date") >= F.col("launch_date")).cast("int"),
            "price_change": price - F.col("previous_price"),
            "price_change_pct": F.try_divide(price - F.col("previous_price"), "previous_price"),
        }
    )
    changed = price.isNotNull() & F.col("previous_price").isNotNull() & ~C.close_to(
        price, "previous_price"
    )
    last_change = F.max(F.when(changed, F.col("date"))).over(running())
    return out.withColumns(
        {
            "days_since_price_change": F.datediff("date", last_change),
            **{f"lag_{n}": F.lag("sales", n).over(by_day()) for n in short_lags},
        }
    ).drop("previous_price")
