"""Samples that depend on the rows alone: the same whatever the partitioning, the run or the engine."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Hexadecimal digits of a draw: 52 bits, which a double holds exactly.
DIGITS = 13


def uniform(keys: Sequence[Column | str], seed: int = 0) -> Column:
    """A number from 0 up to 1 by the MD5 of seed and keys; NULL keys count as empty."""
    parts = [F.coalesce((F.col(k) if isinstance(k, str) else k).cast("string"), F.lit("")) for k in keys]
    digest = F.md5(F.concat_ws("|", F.lit(str(seed)), *parts))
    return F.conv(F.substring(digest, 1, DIGITS), 16, 10).cast("double") / float(1 << 4 * DIGITS)


def sample(df: DataFrame, keys: Sequence[str], share: float, seed: int = 0) -> DataFrame:
    """About `share` of the keys, each with all its rows; no shuffle.

    A larger share of the same seed holds the smaller one's rows.
    """
    if not 0 <= share <= 1:
        raise ValueError(f"a share lies from 0 to 1, not at {share}")
    return df.where(uniform(keys, seed) < share)


def sample_strata(
    df: DataFrame, keys: Sequence[str], stratum: str, shares: Mapping[str, float], default: float = 0.0, seed: int = 0
) -> DataFrame:
    """About the stated share of the keys of each stratum, `default` of strata without one."""
    wrong = [s for s in [*shares.values(), default] if not 0 <= s <= 1]
    if wrong:
        raise ValueError(f"a share lies from 0 to 1, not at {wrong[0]}")
    limit = F.lit(float(default))
    for value, share in shares.items():
        limit = F.when(F.col(stratum) == value, float(share)).otherwise(limit)
    return df.where(uniform(keys, seed) < limit)


def smallest_of_each(df: DataFrame, keys: Sequence[str], stratum: str, n: int, seed: int = 0) -> DataFrame:
    """Exactly `n` keys of each stratum (all where it has fewer), those of the smallest draws, as (stratum, keys).

    Each task keeps `n` candidates per stratum, so no stratum is ever in one place whole.
    """
    drawn = df.select(stratum, *keys).distinct()
    key = F.struct(uniform(keys, seed).alias("u"), *keys)
    # Two steps: the smallest of each of some parts of a stratum, then of those.
    part = F.pmod(F.xxhash64(*keys), F.lit(64))
    some = drawn.withColumn("_part", part).groupBy(stratum, "_part").agg(F.slice(F.sort_array(F.collect_list(key)), 1, n).alias("k"))
    best = some.groupBy(stratum).agg(F.slice(F.sort_array(F.flatten(F.collect_list("k"))), 1, n).alias("k"))
    return best.select(stratum, F.explode("k").alias("k")).select(stratum, *[f"k.{c}" for c in keys])
