"""Incremental ingestion: new raw sales files are appended to the long panel as they arrive.

Each run takes the files that came since the last one and stops. The stream carries no unbounded
state: a replayed file is recognised by an anti-join against the days the panel already holds.

Where files disagree on a day of a series, the row of the file that arrived first stays: of an earlier run, then of
the file with the smaller (modification time, path), and within one file the row with the smallest content hash.
So a replay, or the same files in other batches, gives the same panel.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stocktide.config import SERIES_KEYS

GRAIN = (*SERIES_KEYS, "date")


#: Where a raw row came from: modification time and path of its file.
ORIGIN = "_origin"


def first_rows(batch: DataFrame, keys: Sequence[str] = GRAIN) -> DataFrame:
    """One row of each key: the one of the first file, by an aggregate that is combined before the shuffle."""
    columns = [c for c in batch.columns if c not in (ORIGIN, *keys)]
    row = F.struct(*columns)
    origin = F.col(ORIGIN) if ORIGIN in batch.columns else F.lit(0)
    best = batch.groupBy(*keys).agg(F.min_by(row, F.struct(origin.alias("o"), F.xxhash64(*columns).alias("h"))).alias("_r"))
    return best.select(*[F.col(c) if c in keys else F.col(f"_r.`{c}`").alias(c) for c in batch.columns if c != ORIGIN])


def new_rows(batch: DataFrame, panel: DataFrame, keys: Sequence[str] = GRAIN) -> DataFrame:
    """Rows of a batch whose key the panel does not hold yet, each key once."""
    years = [r["year"] for r in batch.select("year").distinct().collect()]
    known = panel.where(F.col("year").isin(years)).select(*keys)
    return first_rows(batch, keys).join(known, list(keys), "left_anti")


def append_new_files(
    spark: SparkSession,
    source: str,
    schema: T.StructType,
    target: str,
    checkpoint: str,
    transform: Callable[[DataFrame], DataFrame] = lambda df: df,
    keys: Sequence[str] = GRAIN,
    files_per_batch: int = 1000,
) -> None:
    """Append the rows of new Parquet files to the panel, partitioned by year.

    `transform` turns raw rows into panel rows and carries the column `ORIGIN` along; where it doesn't, rows of one
    batch count as of one file. Running the same files again, or a batch that was interrupted after its
    write, adds nothing.
    """
    origin = F.struct("_metadata.file_modification_time", "_metadata.file_path").alias(ORIGIN)

    def write(batch: DataFrame, _batch_id: int) -> None:
        rows = transform(batch)
        session = batch.sparkSession
        if _exists(session, target):
            rows = new_rows(rows, session.read.parquet(target), keys)
        else:
            rows = first_rows(rows, keys)
        rows.write.mode("append").partitionBy("year").parquet(target)

    (
        spark.readStream.schema(schema)
        .option("maxFilesPerTrigger", files_per_batch)
        .parquet(source)
        .select("*", origin)
        .writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )


def _exists(spark: SparkSession, path: str) -> bool:
    """Whether the folder holds a table; any other error is passed on."""
    try:
        return bool(spark.read.parquet(path).columns)
    except Exception as error:
        if "PATH_NOT_FOUND" in str(error) or "UNABLE_TO_INFER_SCHEMA" in str(error):
            return False
        raise
