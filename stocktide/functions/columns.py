"""Column expressions shared by the operators. All of them are built-ins, so they stay in codegen."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnLike = Column | str


def as_column(value: ColumnLike) -> Column:
    return F.col(value) if isinstance(value, str) else value


def round_half_up(value: ColumnLike, digits: int = 2) -> Column:
    """Round by scaling, adding a half and flooring; stays in primitive arithmetic."""
    factor = float(10**digits)
    return F.floor(as_column(value) * factor + 0.5) / factor


def percent(part: ColumnLike, whole: ColumnLike, digits: int | None = 2) -> Column:
    """`part` as a percentage of `whole`; NULL when there is nothing to divide by."""
    value = F.try_divide(as_column(part).cast("double"), as_column(whole).cast("double")) * 100
    return value if digits is None else round_half_up(value, digits)


def share(part: ColumnLike, whole: ColumnLike, digits: int | None = 2) -> Column:
    """`part` as a fraction of `whole`; NULL when there is nothing to divide by."""
    value = F.try_divide(as_column(part).cast("double"), as_column(whole).cast("double"))
    return value if digits is None else round_half_up(value, digits)


def count_where(condition: Column) -> Column:
    """Rows for which the condition holds; NULL counts as not holding."""
    return F.count_if(condition)


def mean_where(value: ColumnLike, condition: Column) -> Column:
    return F.avg(F.when(condition, as_column(value)))


def is_present(value: ColumnLike) -> Column:
    """Neither NULL nor NaN."""
    c = as_column(value).cast("double")
    return c.isNotNull() & ~F.isnan(c)


def nan_to_null(value: ColumnLike) -> Column:
    c = as_column(value)
    return F.when(F.isnan(c), None).otherwise(c)


def close_to(
    left: ColumnLike, right: ColumnLike, *, relative: float = 1e-5, absolute: float = 1e-8
) -> Column:
    """Float equality within a tolerance that grows with `right`."""
    a, b = as_column(left), as_column(right)
    return F.abs(a - b) <= F.lit(absolute) + F.lit(relative) * F.abs(b)


def strip_prefix_int(value: ColumnLike, prefix: str) -> Column:
    """`d_12` -> 12."""
    return F.regexp_replace(as_column(value), f"^{prefix}", "").cast("int")


def last_token_int(value: ColumnLike, separator: str = "_") -> Column:
    """The number after the last separator."""
    return F.element_at(F.split(as_column(value), separator), -1).cast("int")


def select_by_value(key: ColumnLike, choices: Mapping[str, ColumnLike], default=0) -> Column:
    """Pick one of several columns by the value of `key`, as for state-level flags."""
    picked: Column | None = None
    for value, column in choices.items():
        test = as_column(key) == F.lit(value)
        picked = (
            F.when(test, as_column(column))
            if picked is None
            else picked.when(test, as_column(column))
        )
    return F.lit(default) if picked is None else picked.otherwise(F.lit(default))


def joined_key(*columns: ColumnLike, separator: str = "_") -> Column:
    return F.concat_ws(separator, *[as_column(c) for c in columns])


def year_month(year: ColumnLike = "year", month: ColumnLike = "month") -> Column:
    """`2015-03`."""
    return F.concat_ws(
        "-", as_column(year).cast("string"), F.lpad(as_column(month).cast("string"), 2, "0")
    )


def month_weekday(month: ColumnLike = "month", weekday: ColumnLike = "weekday") -> Column:
    """`3_Monday`."""
    return F.concat_ws("_", as_column(month).cast("string"), as_column(weekday))


# Upper bounds of the sales buckets and their labels.
SALES_BUCKETS = ((0, "0"), (5, "1-5"), (10, "6-10"), (20, "11-20"), (50, "21-50"), (100, "51-100"))
SALES_BUCKET_REST = "100+"


def sales_bucket(sales: ColumnLike = "sales") -> Column:
    s = as_column(sales)
    low, label = SALES_BUCKETS[0]
    result = F.when(s == low, label)
    for (below, _), (upper, label) in zip(SALES_BUCKETS, SALES_BUCKETS[1:]):
        result = result.when(s.between(below + 1, upper), label)
    return result.otherwise(SALES_BUCKET_REST)


def sales_bucket_order(bucket: ColumnLike = "sales_bucket") -> Column:
    b = as_column(bucket)
    result = F.when(b == SALES_BUCKETS[0][1], 1)
    for rank, (_, label) in enumerate(SALES_BUCKETS[1:], start=2):
        result = result.when(b == label, rank)
    return result.otherwise(len(SALES_BUCKETS) + 1)


# Price bounds of the demand-by-price bands.
PRICE_BOUNDS = (2, 3, 4, 5, 6, 9, 11, 18)


def price_bucket_labels(bounds: Sequence[float] = PRICE_BOUNDS) -> list[str]:
    return [
        f"< ${bounds[0]:g}",
        *[f"${low:g}–${high:g}" for low, high in zip(bounds, bounds[1:])],
        f"${bounds[-1]:g}+",
    ]


def price_bucket(price: ColumnLike, bounds: Sequence[float] = PRICE_BOUNDS) -> Column:
    """Band a price; a NULL price keeps a NULL band instead of falling into the top one."""
    p = as_column(price)
    labels = price_bucket_labels(bounds)
    result = F.when(p.isNull(), F.lit(None).cast("string"))
    for bound, label in zip(bounds, labels):
        result = result.when(p < bound, label)
    return result.otherwise(labels[-1])


def cut_left_closed(value: ColumnLike, edges: Sequence[float], labels: Sequence[str]) -> Column:
    """`[a, b)` bins, the last one open-ended when its upper edge is infinite; else NULL."""
    v = as_column(value)
    result = F.when(v.isNull(), F.lit(None).cast("string"))
    for low, high, label in zip(edges, edges[1:], labels):
        inside = v >= low
        if high != float("inf"):
            inside = inside & (v < high)
        result = result.when(inside, label)
    return result


def cut_right_closed(value: ColumnLike, edges: Sequence[float], labels: Sequence[str]) -> Column:
    """`(a, b]` bins with the lowest edge included; out of range is NULL."""
    v = as_column(value)
    result = F.when(v.isNull(), F.lit(None).cast("string"))
    for i, (low, high, label) in enumerate(zip(edges, edges[1:], labels)):
        above = v >= low if i == 0 else v > low
        result = result.when(above & (v <= high), label)
    return result


# Bands of the mean price of a series and of its share of days with a sale.
MEAN_PRICE_EDGES = (0, 1, 2, 5, 10, float("inf"))
MEAN_PRICE_LABELS = ("<$1", "$1-2", "$2-5", "$5-10", "$10+")
SALE_RATE_EDGES = (0, 0.10, 0.50, 1.000001)
SALE_RATE_LABELS = ("Highly intermittent", "Moderately intermittent", "Low intermittency")


def event_flag(event_type: ColumnLike = "event_type_1") -> Column:
    return F.when(as_column(event_type) == "No Event", "No Event").otherwise("Event")


def price_level_flag(price: ColumnLike = "sell_price", limit: float = 5.0) -> Column:
    return F.when(as_column(price).between(0.0, limit), "low_price").otherwise("high_price")


def iso_weekday(date: ColumnLike = "date") -> Column:
    """1 = Monday .. 7 = Sunday."""
    return F.weekday(as_column(date)) + 1


def weekend_flag(date: ColumnLike = "date") -> Column:
    return (F.weekday(as_column(date)) >= 5).cast("int")


def day_name(date: ColumnLike = "date") -> Column:
    return F.date_format(as_column(date), "EEEE")
