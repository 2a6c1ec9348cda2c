"""Parquet and CSV scans and sinks of the panel, the feature table and the reports."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from stocktide.config import HORIZON


def read_panel(spark: SparkSession, *paths: str) -> DataFrame:
    """One scan over one or more Parquet folders; partition columns are discovered."""
    return spark.read.parquet(*paths)


def load_window(
    features: DataFrame,
    cutoff: int,
    *,
    include_test: bool = False,
    horizon: int = HORIZON,
    filters: Sequence[Column] = (),
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """Rows up to the training cutoff, or up to the end of the test window after it.

    The conditions reach the scan: `d` prunes row groups and a filter on `year` prunes folders.
    """
    last_day = cutoff + horizon if include_test else cutoff
    rows = reduce(DataFrame.where, filters, features.where(F.col("d") <= last_day))
    return rows.select(*columns) if columns else rows


def write_panel(panel: DataFrame, path: str, max_rows_per_file: int = 5_000_000) -> dict:
    """Replace the long panel, written by year, and return rows written and the output folder.

    The counters ride on the write itself, so no second pass counts the rows.
    """
    seen = Observation()
    (
        panel.observe(seen, F.count("*").alias("rows"))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "static")
        .option("compression", "zstd")
        .option("maxRecordsPerFile", max_rows_per_file)
        .partitionBy("year")
        .parquet(path)
    )
    return {"total_rows": seen.get["rows"], "output_path": path}


def write_features(
    features: DataFrame,
    path: str,
    by: str = "year",
    order: Sequence[str] = ("store_id", "item_id", "date"),
    max_rows_per_file: int = 5_000_000,
) -> None:
    """Overwrite the year folders present in `features`, sorted inside each task.

    Feature rows leave the window stage partitioned by series, so they are written from there
    without another shuffle; the sort keeps neighbouring rows alike for compression and row-group
    pruning.
    """
    (
        features.sortWithinPartitions(by, *order)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", "zstd")
        .option("maxRecordsPerFile", max_rows_per_file)
        .partitionBy(by)
        .parquet(path)
    )


def write_predictions(predictions: DataFrame, path: str, by: str | None = "fold") -> None:
    """Replace all stored predictions, also of folds that the new ones lack."""
    writer = predictions.write.mode("overwrite").option("partitionOverwriteMode", "static")
    (writer.partitionBy(by) if by else writer).parquet(path)


def write_report(report: DataFrame, path: str) -> None:
    """Write a small report as one CSV file with a header."""
    report.coalesce(1).write.mode("overwrite").option("header", True).csv(path)


def append_run(spark: SparkSession, path: str, row: dict) -> None:
    """Append one row about a run to the table of runs."""
    frame = spark.createDataFrame([{k: str(v) for k, v in row.items()}])
    frame.write.mode("append").parquet(path)
