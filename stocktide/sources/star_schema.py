"""Build a retail demand panel from order lines, parts, suppliers, nations and regions.

An item is a part brand, a store is a supplier nation, a state is its region, a day is the ship
date. The result has the columns of the long panel, so everything downstream runs on it unchanged.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stocktide.config import NO_EVENT, PANEL_COLUMNS
from stocktide.functions.columns import day_name
from stocktide.session import cut_lineage, shuffle_width

FIRST_WEEK = 11101
DAYS_PER_WEEK = 7

# Yearly events as (month, day, name, type), in the first and second event slot.
FIRST_EVENTS = (
    (1, 1, "NewYear", "National"),
    (7, 4, "Independence", "National"),
    (12, 25, "Christmas", "National"),
    (2, 14, "Valentines", "Cultural"),
)
SECOND_EVENTS = ((10, 31, "Halloween", "Cultural"),)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _department(item: Column) -> Column:
    number = F.regexp_replace(item, "^Brand#", "").cast("int")
    return F.concat(F.lit("DEPT_"), F.ceil(number / 5).cast("string"))


def _category(dept: Column) -> Column:
    return (
        F.when(dept.isin("DEPT_1", "DEPT_2"), "CAT_A")
        .when(dept.isin("DEPT_3", "DEPT_4"), "CAT_B")
        .otherwise("CAT_C")
    )


def _event(events, date: Column, position: int) -> Column:
    result: Column | None = None
    for month, day, *texts in events:
        test = (F.month(date) == month) & (F.dayofmonth(date) == day)
        text = texts[position]
        result = F.when(test, text) if result is None else result.when(test, text)
    return result


def raw_calendar_columns(date: Column) -> dict[str, Column]:
    """Calendar attributes of a date; event columns are NULL on ordinary days."""
    return {
        "weekday": day_name(date),
        "month": F.month(date),
        "year": F.year(date),
        "event_name_1": _event(FIRST_EVENTS, date, 0),
        "event_type_1": _event(FIRST_EVENTS, date, 1),
        "event_name_2": _event(SECOND_EVENTS, date, 0),
        "event_type_2": _event(SECOND_EVENTS, date, 1),
    }


def snap_flag(date: Column, region: Column) -> Column:
    """Ten benefit days a month, shifted by the region number."""
    return F.dayofmonth(date).between(region + 1, region + 10).cast("int")


def date_span(spark: SparkSession, folder: str) -> DataFrame:
    """One row: first and last ship date."""
    day = F.col("l_shipdate").cast("date")
    return table(spark, folder, "lineitem").agg(
        F.min(day).alias("first_date"), F.max(day).alias("last_date")
    )


def daily_sales(spark: SparkSession, folder: str) -> DataFrame:
    """Units and lowest price per item, store and date; only days with order lines.

    The sum is combined before it is shuffled, so a brand or nation that dominates the order
    lines costs each task no more than one row per day and series.
    """
    lines = table(spark, folder, "lineitem").select(
        "l_partkey", "l_suppkey", "l_quantity", F.col("l_shipdate").cast("date").alias("date")
    )
    parts = table(spark, folder, "part").select(
        F.col("p_partkey").alias("l_partkey"), F.col("p_brand").alias("item_id"), "p_retailprice"
    )
    suppliers = table(spark, folder, "supplier").select(
        F.col("s_suppkey").alias("l_suppkey"), F.col("s_nationkey").alias("n_nationkey")
    )
    by_nation = (
        lines.join(parts, "l_partkey")
        .join(suppliers, "l_suppkey")
        .groupBy("item_id", "n_nationkey", "date")
        .agg(
            F.sum("l_quantity").cast("long").alias("sales"),
            F.min("p_retailprice").alias("price"),
        )
    )
    # Names join after the reduction. Each dimension is joined on its own, so the planner sees its
    # real size and decides on a broadcast from it.
    nations = table(spark, folder, "nation").select(
        "n_nationkey", F.col("n_name").alias("store_id"), F.col("n_regionkey").alias("region")
    )
    regions = table(spark, folder, "region").select(
        F.col("r_regionkey").alias("region"), F.col("r_name").alias("state_id")
    )
    return (
        by_nation.join(nations, "n_nationkey")
        .join(regions, "region")
        .select("item_id", "store_id", "state_id", "region", "date", "sales", "price")
    )


def _dense_days(spark: SparkSession, folder: str) -> DataFrame:
    """One row per series and day of the whole span, zero where nothing was sold.

    Each sparse row opens a segment that lasts until the next row; exploding the segment after the
    shuffle means only days with sales travel over the network. A week's price holds from the
    first day of that week, so the first row of a week opens its segment there.
    """
    span = date_span(spark, folder)
    first_date = span.select("first_date").scalar()
    last_day = span.select(F.datediff("last_date", "first_date") + 1).scalar()

    series = Window.partitionBy("item_id", "store_id")
    by_day = series.orderBy("d")
    week_start = F.floor((F.col("d") - 1) / DAYS_PER_WEEK).cast("int") * DAYS_PER_WEEK + 1

    sparse = (
        daily_sales(spark, folder)
        .withColumn("d", F.datediff("date", first_date) + 1)
        .drop("date")
        # A fixed width: the rows are few here but multiply in the explode below, which the
        # adaptive coalescing rule cannot foresee.
        .repartition(shuffle_width(spark), "item_id", "store_id")
        .withColumn("week_start", week_start)
        .withColumn(
            "week_price",
            F.min("price").over(Window.partitionBy("item_id", "store_id", "week_start")),
        )
        .withColumn("previous_week", F.lag("week_start").over(by_day))
        .withColumn(
            "opens",
            F.when(
                F.col("previous_week").isNull() | (F.col("previous_week") < F.col("week_start")),
                F.col("week_start"),
            ).otherwise(F.col("d")),
        )
        .withColumn("next_opens", F.lead("opens").over(by_day))
    )
    first_row = F.col("previous_week").isNull()
    return (
        sparse.withColumn("last_day", F.coalesce(F.col("next_opens") - 1, last_day))
        .withColumn("from_day", F.when(first_row, F.lit(1)).otherwise(F.col("opens")))
        .withColumn("day", F.explode(F.sequence("from_day", "last_day")))
        .select(
            "item_id",
            "store_id",
            "state_id",
            "region",
            F.col("day").alias("d"),
            F.when(F.col("day") == F.col("d"), F.col("sales"))
            .otherwise(F.lit(0))
            .cast("int")
            .alias("sales"),
            F.when(F.col("day") >= F.col("opens"), F.col("week_price")).alias("sell_price"),
            F.date_add(first_date, F.col("day") - 1).alias("date"),
        )
    )


def sales_panel(spark: SparkSession, folder: str) -> DataFrame:
    """The long panel: one row per item, store and day, hash-partitioned by series."""
    days = _dense_days(spark, folder)
    date = F.col("date")
    calendar = raw_calendar_columns(date)
    for name in ("event_name_1", "event_type_1", "event_name_2", "event_type_2"):
        calendar[name] = F.coalesce(calendar[name], F.lit(NO_EVENT))
    dept = _department(F.col("item_id"))
    return days.withColumns(
        {
            "dept_id": dept,
            "cat_id": _category(dept),
            "wm_yr_wk": week_number(F.col("d")),
            "snap": snap_flag(date, F.col("region")),
            **calendar,
        }
    ).select(*PANEL_COLUMNS)


def week_number(day: Column) -> Column:
    return (F.lit(FIRST_WEEK) + F.floor((day - 1) / DAYS_PER_WEEK)).cast("int")


def region_names(spark: SparkSession, folder: str) -> list[tuple[int, str]]:
    """Region keys and names; a dimension with one row per region."""
    rows = table(spark, folder, "region").select("r_regionkey", "r_name").orderBy("r_regionkey")
    return [(r["r_regionkey"], r["r_name"]) for r in rows.collect()]


def calendar_raw(spark: SparkSession, folder: str) -> DataFrame:
    """Raw calendar table: one row per day, `d_1..`, events NULL when there is none."""
    span = date_span(spark, folder)
    days = span.select(
        F.posexplode(F.sequence("first_date", "last_date")).alias("position", "date")
    )
    date = F.col("date")
    snaps = {
        f"snap_{name}": snap_flag(date, F.lit(key)) for key, name in region_names(spark, folder)
    }
    return days.withColumns(
        {
            "d": F.concat(F.lit("d_"), (F.col("position") + 1).cast("string")),
            "wm_yr_wk": week_number(F.col("position") + 1),
            **raw_calendar_columns(date),
            **snaps,
        }
    ).select(
        "d", "date", "wm_yr_wk", "weekday", "month", "year",
        "event_name_1", "event_type_1", "event_name_2", "event_type_2", *snaps,
    )


def dense_days(spark: SparkSession, folder: str) -> DataFrame:
    """What wide sales and weekly prices are made of, stored where both are."""
    return cut_lineage(_dense_days(spark, folder))


def prices_raw(spark: SparkSession, folder: str, dense: DataFrame | None = None) -> DataFrame:
    """Raw weekly prices: one row per store, item and week from launch on."""
    return (
        (_dense_days(spark, folder) if dense is None else dense)
        .where(F.col("sell_price").isNotNull())
        .withColumn("wm_yr_wk", week_number(F.col("d")))
        .groupBy("store_id", "item_id", "wm_yr_wk")
        .agg(F.min("sell_price").alias("sell_price"))
    )


def sales_wide(spark: SparkSession, folder: str, dense: DataFrame | None = None) -> DataFrame:
    """Raw wide sales: one row per series with its ids and one column per day."""
    span = date_span(spark, folder)
    n_days = span.select(F.datediff("last_date", "first_date") + 1).first()[0]
    dept = _department(F.col("item_id"))
    units = (
        (_dense_days(spark, folder) if dense is None else dense)
        .groupBy("item_id", "store_id", "state_id")
        .agg(F.array_sort(F.collect_list(F.struct("d", "sales"))).alias("days"))
        .withColumn("units", F.col("days.sales"))
    )
    named = units.select(
        F.concat_ws("_", "item_id", "store_id").alias("id"),
        "item_id",
        dept.alias("dept_id"),
        _category(dept).alias("cat_id"),
        "store_id",
        "state_id",
        "units",
    )
    days = ", ".join(f"units[{i}] AS d_{i + 1}" for i in range(n_days))
    ids = ", ".join(c for c in named.columns if c != "units")
    return spark.sql(f"SELECT {ids}, {days} FROM {{named}}", named=named)
