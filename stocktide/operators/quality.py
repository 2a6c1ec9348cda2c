"""Data-quality checks. Each check is a row (check, level, passed, failing_rows)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stocktide.config import SERIES_KEYS
from stocktide.functions.columns import is_present
from stocktide.operators.joins import duplicate_keys
from stocktide.operators.series import with_launch


class QualityError(AssertionError):
    """At least one data-quality check failed."""


def _result(name: str, level: str, failing: Column, passed: Column | None = None) -> list[Column]:
    return [
        F.lit(name).alias("check"),
        F.lit(level).alias("level"),
        (failing == 0 if passed is None else passed).alias("passed"),
        failing.cast("long").alias("failing_rows"),
    ]


def failing_groups(name: str, level: str, failing: DataFrame) -> DataFrame:
    """Result row of a check whose violations are the rows of `failing`."""
    return failing.agg(F.count("*").alias("n")).select(*_result(name, level, F.col("n")))


def raise_on_failure(results: DataFrame) -> DataFrame:
    """Run the checks once and raise with every failed one named."""
    failed = [r for r in results.collect() if not r["passed"]]
    if failed:
        text = "; ".join(f"{r['level']}.{r['check']}: {r['failing_rows']} rows" for r in failed)
        raise QualityError(text)
    return results


def missing_columns(df: DataFrame, required: Sequence[str]) -> list[str]:
    return sorted(set(required) - set(df.columns))


def check_raw_table(
    df: DataFrame, required: Sequence[str], expected_rows: int | None, level: str
) -> DataFrame:
    """Not empty, all required columns there, and the exact row count where one is known."""
    absent = missing_columns(df, required)
    counted = df.agg(F.count("*").alias("n"))
    rules = [
        _result("not_empty", level, F.when(F.col("n") == 0, 1).otherwise(0)),
        _result("columns_present", level, F.lit(len(absent))),
    ]
    if expected_rows is not None:
        rules.append(_result("row_count", level, F.abs(F.col("n") - expected_rows)))
    return _stack(counted, rules)


def _stack(one_row: DataFrame, rules: Sequence[Sequence[Column]]) -> DataFrame:
    """Turn several results computed from one row into one row each."""
    return one_row.select(
        F.explode(F.array(*[F.struct(*rule) for rule in rules])).alias("r")
    ).select("r.*")


def value_checks(panel: DataFrame, expected_rows: int | None = None) -> DataFrame:
    """Row count, negative and NULL sales, and non-positive prices in a single pass."""
    price = F.col("sell_price")
    one = panel.agg(
        F.count("*").alias("n"),
        F.count_if(F.col("sales") < 0).alias("negative"),
        F.count_if(F.col("sales").isNull()).alias("null_sales"),
        F.count_if(is_present(price) & (price <= 0)).alias("bad_price"),
    )
    rules = [
        _result("sales_not_negative", "silver", F.col("negative")),
        _result("sales_not_null", "silver", F.col("null_sales")),
        _result("price_positive", "silver", F.col("bad_price")),
    ]
    if expected_rows is not None:
        rules.append(_result("row_count", "silver", F.abs(F.col("n") - expected_rows)))
    return _stack(one, rules)


def negative_sales(panel: DataFrame) -> DataFrame:
    return panel.where(F.col("sales") < 0)


def null_sales(panel: DataFrame) -> DataFrame:
    return panel.where(F.col("sales").isNull())


def bad_prices(panel: DataFrame) -> DataFrame:
    return panel.where(is_present("sell_price") & (F.col("sell_price") <= 0))


def broken_series(panel: DataFrame, keys: Sequence[str] = SERIES_KEYS) -> DataFrame:
    """Series whose number of rows differs from the days between their first and last date."""
    return (
        panel.groupBy(*keys)
        .agg(
            F.count("*").alias("rows"),
            (F.datediff(F.max("date"), F.min("date")) + 1).cast("long").alias("expected_days"),
        )
        .where("rows <> expected_days")
    )


def unique_grain(panel: DataFrame, keys: Sequence[str] = (*SERIES_KEYS, "date")) -> DataFrame:
    return failing_groups("unique_grain", "silver", duplicate_keys(panel, keys))


def continuous_dates(panel: DataFrame) -> DataFrame:
    return failing_groups("continuous_dates", "silver", broken_series(panel))


def launch_price_checks(panel: DataFrame) -> DataFrame:
    """Prices are unknown before the launch week and known from it on.

    The first rule wants at least one unpriced row before launch; the second wants none after.
    """
    unpriced = ~is_present("sell_price")
    one = with_launch(panel).agg(
        F.count_if(unpriced & (F.col("wm_yr_wk") < F.col("launch_week"))).alias("before"),
        F.count_if(unpriced & (F.col("wm_yr_wk") >= F.col("launch_week"))).alias("after"),
    )
    return _stack(
        one,
        [
            _result(
                "null_price_before_launch",
                "silver",
                F.when(F.col("before") == 0, 1).otherwise(0),
            ),
            _result("no_null_price_after_launch", "silver", F.col("after")),
        ],
    )


def panel_checks(panel: DataFrame, expected_rows: int | None = None) -> DataFrame:
    """All checks of the long panel, the row count among them where it is known, in one pass.

    Rows are shuffled once, by series. A window finds the launch week, an aggregate by day the repeated keys, one by
    series the gaps; all three share that partitioning, and only counts leave it.
    """
    price, unpriced = F.col("sell_price"), ~is_present("sell_price")
    placed = panel.repartition(*SERIES_KEYS).withColumn(
        "_launch", F.min(F.when(price.isNotNull(), F.col("wm_yr_wk"))).over(Window.partitionBy(*SERIES_KEYS))
    )
    counted = {
        "negative": F.col("sales") < 0, "null_sales": F.col("sales").isNull(), "bad_price": is_present(price) & (price <= 0),
        "before": unpriced & (F.col("wm_yr_wk") < F.col("_launch")), "after": unpriced & (F.col("wm_yr_wk") >= F.col("_launch")),
    }
    days = placed.groupBy(*SERIES_KEYS, "date").agg(F.count("*").alias("n"), *[F.count_if(c).alias(k) for k, c in counted.items()])
    series = days.groupBy(*SERIES_KEYS).agg(
        F.sum("n").alias("n"), F.count_if(F.col("n") > 1).alias("repeated"),
        (F.datediff(F.max("date"), F.min("date")) + 1).alias("span"), *[F.sum(k).alias(k) for k in counted],
    )
    total = lambda c: F.coalesce(F.sum(c), F.lit(0))
    one = series.agg(
        total("n").alias("n"), total("repeated").alias("repeated"), F.count_if(F.col("n") != F.col("span")).alias("broken"),
        *[total(k).alias(k) for k in counted],
    )
    rules = [
        _result("unique_grain", "silver", F.col("repeated")),
        _result("continuous_dates", "silver", F.col("broken")),
        _result("sales_not_negative", "silver", F.col("negative")),
        _result("sales_not_null", "silver", F.col("null_sales")),
        _result("price_positive", "silver", F.col("bad_price")),
        _result("null_price_before_launch", "silver", F.when(F.col("before") == 0, 1).otherwise(0)),
        _result("no_null_price_after_launch", "silver", F.col("after")),
    ]
    if expected_rows is not None:
        rules.append(_result("row_count", "silver", F.abs(F.col("n") - expected_rows)))
    return _stack(one, rules)


def null_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """NULLs per column, in one row."""
    return df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns or df.columns])


def duplicate_rows(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows beyond the first of each key."""
    return (
        df.groupBy(*keys)
        .agg(F.count("*").alias("n"))
        .agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("duplicates"))
    )


def raw_sales_profile(long_sales: DataFrame) -> DataFrame:
    """Profile of melted sales: missing ids, zeros, negatives, range, mean and median."""
    s = F.col("sales")
    return long_sales.agg(
        F.count("*").alias("observations"),
        F.count_if(F.col("id").isNull()).alias("missing_ids"),
        F.count_if(s.isNull()).alias("missing_sales"),
        F.count_if(s == 0).alias("zero_sales"),
        (F.count_if(s == 0) / F.count("*") * 100).alias("zero_pct"),
        F.count_if(s < 0).alias("negative_sales"),
        F.min(s).alias("min_sales"),
        F.max(s).alias("max_sales"),
        F.avg(s).alias("mean_sales"),
        F.median(s).alias("median_sales"),
    )


def raw_id_profile(wide_ids: DataFrame) -> DataFrame:
    """Duplicate ids and duplicate item and store pairs among the wide rows."""
    per_id = duplicate_rows(wide_ids, ["id"]).scalar()
    return duplicate_rows(wide_ids, ["item_id", "store_id"]).select(
        per_id.alias("duplicate_ids"), F.col("duplicates").alias("duplicate_pairs")
    )


def price_profile(prices: DataFrame) -> DataFrame:
    """Profile of the weekly prices: rows, ids, weeks, spread, gaps and duplicates."""
    repeated = duplicate_rows(prices, ["store_id", "item_id", "wm_yr_wk"]).scalar()
    p = F.col("sell_price").cast("double")
    return prices.agg(
        F.count("*").alias("rows"),
        F.countDistinct("store_id").alias("stores"),
        F.countDistinct("item_id").alias("items"),
        F.countDistinct("wm_yr_wk").alias("weeks"),
        F.count_if(p.isNull()).alias("missing_prices"),
        F.min(p).alias("min_price"),
        F.avg(p).alias("mean_price"),
        F.max(p).alias("max_price"),
    ).withColumn("duplicate_rows", repeated)


def dataset_profile(df: DataFrame) -> DataFrame:
    """Rows, date range, distinct ids and a fingerprint of these facts and the schema."""
    facts = df.agg(
        F.count("*").alias("row_count"),
        F.min("date").alias("min_date"),
        F.max("date").alias("max_date"),
        F.countDistinct("date").alias("unique_dates"),
        F.countDistinct("item_id").alias("unique_items"),
        F.countDistinct("store_id").alias("unique_stores"),
    )
    schema = ",".join(f"{f.name}:{f.dataType.simpleString()}" for f in df.schema)
    return facts.withColumn(
        "fingerprint",
        F.sha2(
            F.to_json(
                F.struct(
                    F.lit(schema).alias("columns"),
                    "max_date",
                    "min_date",
                    "row_count",
                    "unique_dates",
                    "unique_items",
                    "unique_stores",
                )
            ),
            256,
        ),
    )


def dead_series(panel: DataFrame, keys: Sequence[str] = SERIES_KEYS) -> DataFrame:
    """Series that never sold or never changed."""
    return (
        panel.groupBy(*keys)
        .agg(F.sum("sales").alias("total"), F.stddev("sales").alias("spread"))
        .where("total = 0 OR spread = 0")
    )
