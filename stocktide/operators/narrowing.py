"""Choose the narrowest storage type that holds every value of a column."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Largest magnitude each integer type holds.
INTEGER_TYPES = (
    ("tinyint", -128, 127),
    ("smallint", -32768, 32767),
    ("int", -2147483648, 2147483647),
)
_WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def integer_type_for(low: int | None, high: int | None) -> str:
    if low is None or high is None:
        return "tinyint"
    for name, smallest, largest in INTEGER_TYPES:
        if smallest <= low and high <= largest:
            return name
    return "bigint"


def narrowest_types(df: DataFrame) -> dict[str, str]:
    """Storage type per numeric column, from one pass over minima, maxima and round trips.

    A double becomes a float only if every value of the column comes back from it unchanged.
    """
    whole = [f.name for f in df.schema if isinstance(f.dataType, _WHOLE)]
    real = [f.name for f in df.schema if isinstance(f.dataType, T.DoubleType)]
    if not whole and not real:
        return {}
    changed = [~F.col(c).cast("float").cast("double").eqNullSafe(F.col(c)) for c in real]
    found = df.agg(
        *[F.min(c).alias(f"lo_{c}") for c in whole],
        *[F.max(c).alias(f"hi_{c}") for c in whole],
        *[F.count(F.when(x, 1)).alias(f"changed_{c}") for c, x in zip(real, changed)],
    ).first()
    chosen = {c: "double" if found[f"changed_{c}"] else "float" for c in real}
    return chosen | {c: integer_type_for(found[f"lo_{c}"], found[f"hi_{c}"]) for c in whole}


def narrow_types(df: DataFrame) -> DataFrame:
    """Cast numeric columns down for storage; arithmetic should cast back to long or double."""
    chosen = narrowest_types(df)
    return df.select(
        *[F.col(c).cast(chosen[c]).alias(c) if c in chosen else F.col(c) for c in df.columns]
    )


def widen_for_arithmetic(df: DataFrame, columns) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("double") for c in columns})
