"""Numbers, booleans and timestamps. A value that does not fit its type becomes the
default instead of stopping the job (``try_cast``)."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, functions as F

from tillwork.functions._args import ColumnLike, as_column

# The accepted shapes of a timestamp text, ISO date-time to the second
# (yyyy-MM-dd'T'HH:mm:ss) and ISO date (yyyy-MM-dd).
TIMESTAMP_SHAPE = r"^\d{4}-\d{2}-\d{2}(T\d{2}:\d{2}:\d{2})?$"
TIME_TYPES = ("timestamp", "timestamp_ntz", "date")


def cast_to_integer(name: ColumnLike, default_val: int = 0) -> Column:
    return F.coalesce(as_column(name).try_cast("int"), F.lit(default_val).cast("int"))


def cast_to_decimal(
    name: ColumnLike, precision: int = 10, scale: int = 2, default_val: float = 0.0
) -> Column:
    kind = f"decimal({precision},{scale})"
    default = F.lit(Decimal(str(default_val))).cast(kind)
    return F.coalesce(as_column(name).try_cast(kind), default)


def cast_to_boolean(name: ColumnLike, default_val: bool = False) -> Column:
    return F.coalesce(as_column(name).try_cast("boolean"), F.lit(default_val))


def standardize_date(name: ColumnLike) -> Column:
    """Timestamp from ISO date-time or ISO date text; anything else is null.

    A column that already holds times passes through. The shape test comes first, so
    the cast parses only text in one of the two forms, and no value raises an error.
    """
    value = as_column(name)
    is_time = F.typeof(value).isin(*TIME_TYPES)
    has_shape = value.cast("string").rlike(TIMESTAMP_SHAPE)
    return F.when(is_time | has_shape, value.try_cast("timestamp"))


def gross_margin_percentage(
    unit_price: ColumnLike, cost_price: ColumnLike, margin_positive: ColumnLike
) -> Column:
    """Margin as percent of the price, decimal(5,2); 0.00 without a positive margin and price."""
    price, cost = as_column(unit_price), as_column(cost_price)
    percent = (price - cost) / price * 100
    earns = as_column(margin_positive) & (price > 0)
    return F.when(earns, percent).otherwise(F.lit(Decimal("0.00"))).try_cast("decimal(5,2)")
