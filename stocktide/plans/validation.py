"""Rolling-origin folds and hold-out splits."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import asdict, dataclass
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stocktide.config import HORIZON, N_FOLDS


@dataclass(frozen=True)
class Fold:
    folds: int
    train_start: date
    train_end: date
    valid_start: date
    valid_end: date


def make_folds(
    start: date, end: date, n_folds: int = N_FOLDS, horizon: int = HORIZON
) -> list[Fold]:
    """Expanding training windows, each followed by one horizon of validation days."""
    folds = []
    for number in range(1, n_folds + 1):
        train_end = end - timedelta(days=(n_folds - number + 1) * horizon)
        folds.append(
            Fold(
                number,
                start,
                train_end,
                train_end + timedelta(days=1),
                train_end + timedelta(days=horizon),
            )
        )
    return folds


def folds_of(df: DataFrame, n_folds: int = N_FOLDS, horizon: int = HORIZON) -> list[Fold]:
    """Folds over the date range of a frame; reads one row of bounds."""
    first, last = df.agg(F.min("date"), F.max("date")).first()
    return make_folds(first, last, n_folds, horizon)


def fold_table(spark: SparkSession, folds: list[Fold]) -> DataFrame:
    return spark.createDataFrame(
        [tuple(asdict(f).values()) for f in folds],
        "folds int, train_start date, train_end date, valid_start date, valid_end date",
    )


def train_part(df: DataFrame, fold: Fold) -> DataFrame:
    return df.where(F.col("date") <= F.lit(fold.train_end))


def valid_part(df: DataFrame, fold: Fold) -> DataFrame:
    return df.where(F.col("date").between(F.lit(fold.valid_start), F.lit(fold.valid_end)))


def split(df: DataFrame, fold: Fold) -> tuple[DataFrame, DataFrame]:
    return train_part(df, fold), valid_part(df, fold)


def ends(folds: list[Fold]) -> dict[int, date]:
    return {f.folds: f.train_end for f in folds}


def windows(df: DataFrame, spans: Mapping[int, tuple[date, date]]) -> DataFrame:
    """The rows of each fold's span of days, marked with the `fold`, from one read.

    A row that several spans hold is copied, one that none holds is left out by the scan's filter.
    """
    if not spans:
        return df.withColumn("fold", F.lit(None).cast("int")).where("false")
    table = F.array(*[F.struct(F.lit(f).alias("fold"), F.lit(a).alias("a"), F.lit(b).alias("b")) for f, (a, b) in spans.items()])
    first, last = min(a for a, _ in spans.values()), max(b for _, b in spans.values())
    hits = F.filter(table, lambda s: F.col("date").between(s["a"], s["b"]))
    inside = df.where(F.col("date").between(F.lit(first), F.lit(last)))
    return inside.withColumn("fold", F.explode(F.transform(hits, lambda s: s["fold"])))


def valid_windows(df: DataFrame, folds: list[Fold]) -> DataFrame:
    """The validation rows of all folds."""
    return windows(df, {f.folds: (f.valid_start, f.valid_end) for f in folds})


def recent_windows(df: DataFrame, folds: list[Fold], days: int = HORIZON) -> DataFrame:
    """The last training days of all folds, all that baselines and revenue weights look at."""
    return windows(df, {f.folds: (f.train_end - timedelta(days=days - 1), f.train_end) for f in folds})


def train_sizes(df: DataFrame, folds: list[Fold]) -> DataFrame:
    """`fold` and `train_rows`, from one pass."""
    counts = [F.struct(F.lit(f).alias("fold"), F.count_if(F.col("date") <= F.lit(e)).alias("train_rows")) for f, e in ends(folds).items()]
    return df.agg(F.array(*counts).alias("c")).select(F.inline("c"))


def holdout(df: DataFrame, horizon: int = HORIZON) -> tuple[DataFrame, DataFrame]:
    """Everything before the last `horizon` days, and those days."""
    start = F.date_sub(df.agg(F.max("date").alias("last")).scalar(), horizon - 1)
    return df.where(F.col("date") < start), df.where(F.col("date") >= start)
