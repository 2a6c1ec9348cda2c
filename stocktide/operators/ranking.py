"""Exact ranks and quantiles over data too large for one task.

The rows are range-partitioned on the full sort key, stored reliably, numbered inside each
partition, and shifted by the number of rows in the partitions before. Storing matters: range
bounds come from a sample, and a recomputed partition could otherwise move rows between the count
and the numbering.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stocktide.session import cut_lineage, shuffle_width


def with_running_total(
    df: DataFrame, order: Sequence[Column | str], weight: Column, name: str
) -> DataFrame:
    """Add the inclusive running total of `weight` in the given order over all rows."""
    sort = [F.col(c) if isinstance(c, str) else c for c in order]
    placed = cut_lineage(
        df.withColumn("_weight", weight)
        .repartitionByRange(shuffle_width(df.sparkSession), *sort)
        .withColumn("_part", F.spark_partition_id())
    )
    # One row per partition, so the window over all of them is as small as the partition count.
    per_part = placed.groupBy("_part").agg(F.sum("_weight").alias("_part_total"))
    before = per_part.select(
        "_part",
        F.coalesce(
            F.sum("_part_total").over(
                Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
            ),
            F.lit(0),
        ).alias("_before"),
    )
    inside = (
        Window.partitionBy("_part")
        .orderBy(*sort)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return (
        placed.withColumn("_inside", F.sum("_weight").over(inside))
        .join(F.broadcast(before), "_part")
        .withColumn(name, F.col("_inside") + F.col("_before"))
        .drop("_weight", "_part", "_inside", "_before")
    )


def with_row_number(df: DataFrame, order: Sequence[Column | str], name: str = "rank") -> DataFrame:
    """Number all rows 1..n in the given order, which should break every tie."""
    return with_running_total(df, order, F.lit(1).cast("long"), name)


def decile_of_rank(rank: Column, total: Column, parts: int = 10) -> Column:
    """Part of a rank when 1..n is cut at equally spaced quantiles of the ranks."""
    cut = F.ceil((rank - 1) * parts / F.greatest(total - 1, F.lit(1)))
    return F.greatest(cut, F.lit(1)).cast("int")


def exact_quantiles(
    df: DataFrame,
    value: str,
    probabilities: dict[str, float],
    keys: Sequence[str] = (),
) -> DataFrame:
    """Linear-interpolation quantiles per group, exact at any size.

    Rows are first counted per group and distinct value, so a value that repeats often is one row.
    """
    counts = (
        df.where(F.col(value).isNotNull())
        .groupBy(*keys, value)
        .agg(F.count("*").alias("_rows"))
    )
    order = [F.col(k).asc_nulls_first() for k in keys] + [F.col(value).asc()]
    ranked = with_running_total(counts, order, F.col("_rows"), "_upto")
    starts = ranked.groupBy(*keys).agg(
        F.min(F.col("_upto") - F.col("_rows")).alias("_start"), F.sum("_rows").alias("_n")
    )
    if keys:
        renamed = starts.withColumnsRenamed({k: f"_{k}" for k in keys})
        same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys]
        located = ranked.join(renamed, same)
    else:
        located = ranked.withColumns({"_start": F.lit(0), "_n": starts.select("_n").scalar()})
    last = F.col("_upto") - F.col("_start")
    first = last - F.col("_rows")

    def holds(index: Column) -> Column:
        return (index >= first) & (index < last)

    measures = []
    for name, p in probabilities.items():
        position = (F.col("_n") - 1) * F.lit(float(p))
        low = F.max(F.when(holds(F.floor(position)), F.col(value)))
        high = F.max(F.when(holds(F.ceil(position)), F.col(value)))
        fraction = F.max(position - F.floor(position))
        measures.append((low + (high - low) * fraction).alias(name))
    return located.groupBy(*keys).agg(*measures)


def medians(
    df: DataFrame, value: str, name: str, keys: Sequence[str] = ()
) -> DataFrame:
    return exact_quantiles(df, value, {name: 0.5}, keys)
