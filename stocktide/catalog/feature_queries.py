"""Registered queries on raw tables, data quality and features."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stocktide.config import ENCODINGS, PANEL_COLUMNS
from stocktide.catalog.panel_queries import rounded, series_ids
from stocktide.operators import features as f
from stocktide.operators import joins, quality, sampling, series
from stocktide.operators.narrowing import narrowest_types
from stocktide.plans import eda, gold, ingestion
from stocktide.session import shared_folder
from stocktide.sources import bronze, tables
from stocktide.sources import star_schema as star
from stocktide.streaming import append

SPREADS = [f"enc_{n}_std" for n in ENCODINGS]
TRENDS = [
    "trend_28_vs_long", "trend_7_vs_28", "trend_28_vs_56", "item_vs_dept", "item_vs_cat",
    "item_store_vs_global",
]


def panel_days(spark, folder):
    """Number of days of the panel and its last date."""
    span = star.date_span(spark, folder).first()
    return (span["last_date"] - span["first_date"]).days + 1, span["last_date"]


def training_years(spark, folder):
    """First and last year of the training window: the panel's last two years."""
    last = panel_days(spark, folder)[1].year
    return last - 1, last


def feature(build, *args, also=(), round_to=(), **kwargs):
    """A feature group over the whole history."""

    def query(spark, folder):
        rows = f.priced_rows(star.sales_panel(spark, folder))
        before = set(rows.columns)
        out = build(rows, *args, **kwargs)
        new = [c for c in out.columns if c not in before and (not also or c in also)]
        out = out.select("item_id", "store_id", "d", *new)
        return rounded(out, *round_to) if round_to else out

    return query


def _trends(rows):
    return (
        rows.transform(f.recent_demand_features)
        .transform(f.encoding_features)
        .transform(f.trend_features)
    )


def calendar(spark, folder):
    return bronze.prepare_calendar(star.calendar_raw(spark, folder))


def _panel_from_raw_tables(spark, folder):
    dense = star.dense_days(spark, folder)
    return ingestion.build_panel(
        star.sales_wide(spark, folder, dense),
        calendar(spark, folder),
        star.prices_raw(spark, folder, dense),
        panel_columns=PANEL_COLUMNS,
    )


def _panel_checks(spark, folder):
    """All checks of the panel, with the row count that series and days make up."""
    series = star.daily_sales(spark, folder).select("item_id", "store_id").distinct().count()
    return quality.panel_checks(star.sales_panel(spark, folder), series * panel_days(spark, folder)[0])


SAMPLE_SHARES = {"CAT_A": 0.02, "CAT_B": 0.05}


def _strata(spark, folder):
    """Series of each category by its share, with all their rows."""
    sampled = sampling.sample_strata(star.sales_panel(spark, folder), ["item_id", "store_id"], "cat_id", SAMPLE_SHARES, 0.1, seed=7)
    return sampled.select("item_id", "store_id", "date", "sales")


def _lines(spark, folder):
    """A share of the orders, each with all its lines."""
    lines = star.table(spark, folder, "lineitem")
    return sampling.sample(lines, ["l_orderkey"], 0.05, seed=3).groupBy("l_orderkey").agg(
        F.count("*").alias("lines"), F.sum("l_quantity").cast("long").alias("units")
    )


def _some_series(spark, folder):
    return sampling.smallest_of_each(star.sales_panel(spark, folder), ["item_id", "store_id"], "cat_id", 5, seed=11)


def _appended(spark, folder):
    """Daily sales that arrive in two files which disagree on a year, each twice, in two runs and in one.

    The rows of the file that came first stay in either case.
    """
    daily = star.daily_sales(spark, folder).select("item_id", "store_id", "date", "sales", F.year("date").alias("year"))
    cut = panel_days(spark, folder)[1].year - 2
    first, second = daily.where(F.col("year") <= cut), daily.where(F.col("year") >= cut).withColumn("sales", F.col("sales") + 1000)
    found = []
    for mode in ("two runs", "one run"):
        base = f"{shared_folder(spark).rstrip('/')}/appended/{uuid.uuid4().hex}"
        for number, part in enumerate((first, second, first, second)):
            part.coalesce(1).write.mode("append").parquet(f"{base}/in")
            if mode == "two runs" or number == 3:
                append.append_new_files(spark, f"{base}/in", daily.schema, f"{base}/panel", f"{base}/marks")
        held = spark.read.parquet(f"{base}/panel").groupBy(F.col("year").cast("int").alias("year"))
        found.append(held.agg(F.count("*").alias("rows"), F.sum("sales").cast("long").alias("units")).withColumn("mode", F.lit(mode)))
    return found[0].unionByName(found[1])


def _raw_files(spark, folder):
    """Calendar, prices and wide sales written as CSV files with headers, as they come from outside."""
    base = f"{shared_folder(spark).rstrip('/')}/raw/{uuid.uuid4().hex}"
    dense = star.dense_days(spark, folder)
    raw = {"calendar": star.calendar_raw(spark, folder), "prices": star.prices_raw(spark, folder, dense), "sales": star.sales_wide(spark, folder, dense)}
    for name, frame in raw.items():
        frame.write.option("header", True).csv(f"{base}/{name}")
    return base


def _csv_panel(spark, folder):
    """The panel from CSV files, stored by year and read back; per store and year what it holds."""
    base = _raw_files(spark, folder)
    days = star.calendar_raw(spark, folder).columns
    panel = ingestion.build_panel(
        bronze.read_sales_wide(spark, f"{base}/sales"), bronze.read_calendar(spark, f"{base}/calendar", days),
        bronze.read_prices(spark, f"{base}/prices"), panel_columns=PANEL_COLUMNS,
    )
    tables.write_panel(panel, f"{base}/silver")
    stored = tables.read_panel(spark, f"{base}/silver")
    return stored.groupBy("store_id", F.col("year").cast("int").alias("year")).agg(
        F.count("*").alias("rows"), F.sum("sales").cast("long").alias("units"), F.count("sell_price").alias("priced"),
        F.sum("snap").cast("long").alias("snap_days"), F.count_if(F.col("event_name_1") != "No Event").alias("event_days"),
    )


def _stored_features(spark, folder):
    """Features stored by year, one year written anew with fewer stores, and two years' folders read in one scan.

    Only the year that the second write holds is replaced.
    """
    first, last = training_years(spark, folder)
    rows = f.calendar_features(f.priced_rows(star.sales_panel(spark, folder))).where(F.col("year").between(first, last))
    path = f"{shared_folder(spark).rstrip('/')}/gold/{uuid.uuid4().hex}"
    tables.write_features(rows, path)
    tables.write_features(rows.where((F.col("year") == last) & (F.col("state_id") == STORED_STATE)), path)
    both = tables.read_panel(spark, f"{path}/year={first}", f"{path}/year={last}")
    return both.groupBy("store_id", F.year("date").alias("year")).agg(
        F.count("*").alias("rows"), F.sum("week_of_year").cast("long").alias("weeks"), F.sum("sales").cast("long").alias("units")
    )


STORED_STATE = "ASIA"


def _stored_report(spark, folder):
    """A report written as CSV and read back with its types, ordered as it was written."""
    path = f"{shared_folder(spark).rstrip('/')}/reports/{uuid.uuid4().hex}"
    report = eda.totals(star.sales_panel(spark, folder), ["state_id", "cat_id"]).orderBy("state_id", "cat_id")
    tables.write_report(report, path)
    typed = spark.read.option("header", True).schema(report.schema).csv(path)
    place = Window.orderBy(F.monotonically_increasing_id())  # one file of a small report
    return typed.withColumn("line", F.row_number().over(place))


def _narrow_types(spark, folder):
    chosen = narrowest_types(star.table(spark, folder, "lineitem"))
    return spark.createDataFrame(list(chosen.items()), "column_name string, storage_type string")


def _raw_table_checks(spark, folder):
    days = panel_days(spark, folder)[0]
    raw = (
        ("lineitem", star.table(spark, folder, "lineitem"), ["l_orderkey", "l_shipdate"], None),
        ("nation", star.table(spark, folder, "nation"), ["n_name", "n_comment"], 25),
        ("calendar", star.calendar_raw(spark, folder), ["d", "date", "wm_yr_wk"], days),
        ("prices", star.prices_raw(spark, folder), ["store_id", "item_id", "sell_price"], None),
    )
    checks = [quality.check_raw_table(df, names, rows, level) for level, df, names, rows in raw]
    return reduce(DataFrame.unionByName, checks)


def _with_gold(**kwargs):
    return lambda s, folder: rounded(
        gold.build_features(star.sales_panel(s, folder), *training_years(s, folder), **kwargs),
        *SPREADS,
    )


def launched_rows(spark, folder):
    return series.with_launch(star.sales_panel(spark, folder)).where(eda.launched())


def queries():
    return {
        "daily_sales": lambda s, p: star.daily_sales(s, p).drop("region"),
        "calendar_table": calendar,
        "calendar_profile": lambda s, p: eda.calendar_profile(star.calendar_raw(s, p)),
        "calendar_event_counts": lambda s, p: eda.value_counts(
            calendar(s, p), ["event_name_1", "event_type_1"]
        ),
        "calendar_gap": lambda s, p: series.largest_gap(calendar(s, p)),
        "shipping_gap": lambda s, p: series.largest_gap(
            star.table(s, p, "lineitem").select(F.col("l_shipdate").cast("date").alias("date"))
        ),
        "price_table": star.prices_raw,
        "price_profile": lambda s, p: rounded(
            quality.price_profile(star.prices_raw(s, p)), "mean_price"
        ),
        "melt_panel": lambda s, p: ingestion.melt_sales(star.sales_wide(s, p)),
        "silver_panel": _panel_from_raw_tables,
        "raw_sales_profile": lambda s, p: quality.raw_sales_profile(
            ingestion.melt_sales(star.sales_wide(s, p))
        ),
        "raw_id_profile": lambda s, p: quality.raw_id_profile(series_ids(s, p)),
        "day_key_containment": lambda s, p: joins.key_containment(
            star.daily_sales(s, p), calendar(s, p), ["date"]
        ),
        "narrow_types": _narrow_types,
        "dataset_profile": lambda s, p: quality.dataset_profile(
            star.sales_panel(s, p)
        ).drop("fingerprint"),
        "dataset_fingerprint": lambda s, p: quality.dataset_profile(star.sales_panel(s, p)),
        "null_counts": lambda s, p: quality.null_counts(
            star.sales_panel(s, p), ["item_id", "store_id", "date", "sales", "sell_price"]
        ),
        "dead_series": lambda s, p: rounded(quality.dead_series(star.sales_panel(s, p)), "spread"),
        "dq_panel": _panel_checks,
        "sample_strata": _strata,
        "sample_orders": _lines,
        "sample_series": _some_series,
        "append_conflicts": _appended,
        "csv_round_trip": _csv_panel,
        "feature_round_trip": _stored_features,
        "report_round_trip": _stored_report,
        "dq_raw_tables": _raw_table_checks,
        "dq_broken_series": lambda s, p: quality.broken_series(star.daily_sales(s, p)),
        "dq_negative_balance": lambda s, p: star.table(s, p, "customer")
        .select("c_custkey", "c_acctbal")
        .where("c_acctbal < 0"),
        "feat_calendar": feature(f.calendar_features),
        "feat_lags": feature(f.lag_features),
        "feat_intermittency": feature(f.intermittency_features),
        "feat_recent": feature(f.recent_demand_features),
        "feat_magnitude": feature(f.magnitude_features),
        "feat_price": feature(f.price_features),
        "feat_store_dept": feature(f.store_dept_features),
        "feat_encodings": feature(f.encoding_features, round_to=SPREADS),
        "feat_trend": feature(_trends, also=TRENDS),
        "feat_lifecycle": lambda s, p: f.lifecycle_features(
            star.sales_panel(s, p), short_lags=(1, 7, 14)
        ).select(
            "item_id", "store_id", "d", "launch_date", "days_since_launch", "is_available",
            "price_change", "price_change_pct", "days_since_price_change",
            "lag_1", "lag_7", "lag_14",
        ),
        "gold_features": _with_gold(),
        "gold_features_truncated": _with_gold(truncate_first=True),
        "acf": lambda s, p: rounded(series.autocorrelation(star.sales_panel(s, p)), "acf"),
        "missing_days": lambda s, p: series.missing_days(launched_rows(s, p)),
        "decompose": lambda s, p: rounded(
            series.decompose(launched_rows(s, p)),
            "trend", "seasonal_7", "seasonal_30", "seasonal_365", "residual",
        ),
    }


def oracle_sql():
    from oracles import features as sql

    return sql.statements()
