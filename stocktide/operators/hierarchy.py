"""Daily sales at the twelve aggregation levels, and the scale, error and weight of each series.

The levels are built along a lattice instead of expanding every row twelve times. The series level is the
input grouped by series and day, in one shuffle by series that the windows over a series share; item levels
roll up from item by state; the nine upper levels are grouping sets over the small daily table of state,
store, category and department.

A step between two days doesn't depend on where the training rows end, so the scales of all folds come from
one pass over the whole history, each fold averaging the steps up to its own end.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stocktide.config import HIERARCHY_LEVELS, HORIZON

UPPER_KEYS = ("state_id", "store_id", "cat_id", "dept_id")
UPPER_LEVELS = tuple(n for n, keys in HIERARCHY_LEVELS.items() if set(keys) <= set(UPPER_KEYS))
ITEM_LEVELS = ("state_item", "item")


def series_id(level: str) -> Column:
    keys = HIERARCHY_LEVELS[level]
    return F.concat_ws("_", *keys) if keys else F.lit("total")


def _named(df: DataFrame, level: str, by: Sequence[str], measures: Sequence[str]) -> DataFrame:
    return df.select(
        F.lit(level).alias("level"), series_id(level).alias("series_id"), *by, *measures
    )


def _sums(measures: Sequence[str]) -> list[Column]:
    return [F.sum(m).alias(m) for m in measures]


def upper_levels(rows: DataFrame, measures: Sequence[str], by: Sequence[str]) -> DataFrame:
    """Sums at the levels above the item, from one grouping-sets aggregate."""
    cells = rows.groupBy(*UPPER_KEYS, *by).agg(*_sums(measures))
    sets = [[*HIERARCHY_LEVELS[level], *by] for level in UPPER_LEVELS]
    grouped = cells.groupingSets(sets, *UPPER_KEYS, *by).agg(
        F.grouping_id().alias("_gid"), *_sums(measures)
    )
    width = len(UPPER_KEYS)
    level: Column | None = None
    name: Column | None = None
    for key in UPPER_LEVELS:
        # grouping_id sets a bit for each grouping column that is rolled away, first column first.
        bits = sum(
            1 << (width - 1 - i + len(by))
            for i, column in enumerate(UPPER_KEYS)
            if column not in HIERARCHY_LEVELS[key]
        )
        test = F.col("_gid") == bits
        level = F.when(test, key) if level is None else level.when(test, key)
        name = F.when(test, series_id(key)) if name is None else name.when(test, series_id(key))
    return grouped.select(level.alias("level"), name.alias("series_id"), *by, *measures)


def item_levels(rows: DataFrame, measures: Sequence[str], by: Sequence[str]) -> DataFrame:
    """Sums per item and state, and per item."""
    state_item = rows.groupBy("item_id", "state_id", *by).agg(*_sums(measures))
    item = state_item.groupBy("item_id", *by).agg(*_sums(measures))
    return _named(state_item, "state_item", by, measures).unionByName(
        _named(item, "item", by, measures)
    )


def series_level(rows: DataFrame, measures: Sequence[str], by: Sequence[str]) -> DataFrame:
    sums = rows.groupBy("item_id", "store_id", *by).agg(*_sums(measures))
    return _named(sums, "item_store", by, measures)


def level_sums(
    rows: DataFrame,
    measures: Mapping[str, Column],
    by: Sequence[str] = ("date",),
    bottom_only: bool = False,
) -> DataFrame:
    """Sums of the measures per level, series and `by` columns, for all twelve levels.

    `bottom_only` gives the item and store level alone.
    """
    rows = rows.select("item_id", *UPPER_KEYS, *by, *[c.alias(n) for n, c in measures.items()])
    names = list(measures)
    builders = (series_level,) if bottom_only else (upper_levels, item_levels, series_level)
    return reduce(DataFrame.unionByName, [build(rows, names, by) for build in builders])


def _by_series(rows: DataFrame, measures: Sequence[str], by: Sequence[str]) -> DataFrame:
    """Daily sums per series; rows lie by series, so what follows per series needs no further shuffle."""
    placed = rows.repartition("item_id", "store_id")
    return placed.groupBy("item_id", "store_id", *by, "date").agg(*_sums(measures))


def _per_series(
    rows: DataFrame,
    measures: Mapping[str, Column],
    by: Sequence[str],
    finish: Callable[[DataFrame, list[str], Column], DataFrame],
    bottom_only: bool,
) -> DataFrame:
    """`finish(daily, keys, is_total)` of the daily sums at all levels, named by level and series.

    `finish` returns one row per `keys`.
    """
    rows = rows.select("item_id", *UPPER_KEYS, *by, "date", *[c.alias(n) for n, c in measures.items()])
    names = list(measures)
    own = ["item_id", "store_id", *by]
    bottom = finish(_by_series(rows, names, by), own, F.lit(False))
    found = [c for c in bottom.columns if c not in own]
    parts = [_named(bottom, "item_store", by, found)]
    if not bottom_only:
        upper = [build(rows, names, [*by, "date"]) for build in (upper_levels, item_levels)]
        keys = ["level", "series_id", *by]
        above = finish(reduce(DataFrame.unionByName, upper), keys, F.col("level") == "total")
        parts.append(above.select(*keys, *found))
    return reduce(DataFrame.unionByName, parts)


def with_steps(daily: DataFrame, keys: Sequence[str], every: Column) -> DataFrame:
    """Add `step`, the squared change since the day before, once the sales before that day are positive in total.

    Leading zeros so do not shrink a scale. Where `every` holds, each change counts.
    """
    w = Window.partitionBy(*keys).orderBy("date")
    before = F.sum("x").over(w.rowsBetween(Window.unboundedPreceding, -1))
    change = F.col("x") - F.lag("x").over(w)
    return daily.withColumn("step", F.when((before > 0) | every, change * change))


def level_scales(
    train: DataFrame, value: str = "sales", by: Sequence[str] = (), bottom_only: bool = False
) -> DataFrame:
    """Mean squared day-over-day change of each series after its first sale.

    The level `total` counts every change. `by` carries further keys, such as a fold number.
    """

    def finish(daily: DataFrame, keys: list[str], every: Column) -> DataFrame:
        return with_steps(daily, keys, every).groupBy(*keys).agg(F.avg("step").alias("scale"))

    return _per_series(train, {"x": F.col(value).cast("double")}, by, finish, bottom_only)


def level_scales_at(
    rows: DataFrame, ends: Mapping[int, date], value: str = "sales", bottom_only: bool = False
) -> DataFrame:
    """`level_scales` of the rows up to each fold's end day, marked with the `fold`, from one pass."""

    def finish(daily: DataFrame, keys: list[str], every: Column) -> DataFrame:
        upto = {f: F.col("date") <= F.lit(end) for f, end in ends.items()}
        scales = [
            F.struct(F.lit(f).alias("fold"), F.avg(F.when(u, F.col("step"))).alias("scale"), F.count_if(u).alias("days"))
            for f, u in upto.items()
        ]
        found = with_steps(daily, keys, every).groupBy(*keys).agg(F.array(*scales).alias("folds"))
        return found.select(*keys, F.inline("folds")).where("days > 0").drop("days")

    return _per_series(rows, {"x": F.col(value).cast("double")}, (), finish, bottom_only)


def level_errors(
    valid: DataFrame,
    actual: str = "sales",
    prediction: str = "prediction",
    by: Sequence[str] = (),
    bottom_only: bool = False,
) -> DataFrame:
    """Mean squared error of daily sums per level and series."""
    error = F.col("a") - F.col("p")

    def finish(daily: DataFrame, keys: list[str], every: Column) -> DataFrame:
        return daily.groupBy(*keys).agg(F.avg(error * error).alias("mse"))

    both = {"a": F.col(actual).cast("double"), "p": F.col(prediction).cast("double")}
    return _per_series(valid, both, by, finish, bottom_only)


def level_weights(
    train: DataFrame,
    horizon: int = HORIZON,
    by: Sequence[str] = (),
    bottom_only: bool = False,
) -> DataFrame:
    """Revenue per level and series over the last `horizon` days of the training rows."""
    recent = last_days(train, horizon, by)
    dollars = F.col("sales").cast("double") * F.col("sell_price").cast("double")
    return level_sums(recent, {"dollar_sales": dollars}, by, bottom_only)


def last_days(rows: DataFrame, days: int, by: Sequence[str] = ()) -> DataFrame:
    """Rows of the last `days` days, per `by` group when given (one end date per fold)."""
    if not by:
        last = rows.agg(F.max("date").alias("last")).scalar()
        return rows.where(F.col("date") > F.date_sub(last, days))
    ends = rows.groupBy(*by).agg(F.date_sub(F.max("date"), days).alias("_start"))
    return rows.join(F.broadcast(ends), list(by)).where("date > _start").drop("_start")
