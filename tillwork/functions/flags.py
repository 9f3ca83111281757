"""Validity flags. A flag is null when one of its inputs is missing; filters that keep
only true rows drop such rows."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from tillwork.functions._args import ColumnLike, as_column
from tillwork.functions.phone import format_phone_e164

# Accepted event types, device types and email shape.
ALLOWED_EVENTS = ("PAGE_VIEW", "SEARCH", "ADD_TO_CART", "REMOVE_FROM_CART", "PURCHASE")
ALLOWED_DEVICES = ("DESKTOP", "MOBILE", "TABLET")
EMAIL_PATTERN = r"^[a-zA-Z0-9_.+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}$"


def is_verified_email(name: ColumnLike) -> Column:
    """Whether the text looks like an email address; null in, null out."""
    return as_column(name).rlike(EMAIL_PATTERN)


def is_verified_phone(name: ColumnLike) -> Column:
    """Whether the text can be a phone number; missing text counts as false."""
    return format_phone_e164(name).isNotNull()


def is_event_allowed(name: ColumnLike) -> Column:
    return as_column(name).isin(*ALLOWED_EVENTS)


def is_device_allowed(name: ColumnLike) -> Column:
    return as_column(name).isin(*ALLOWED_DEVICES)


def is_pricing_correct(
    total: ColumnLike, quantity: ColumnLike, unit_price: ColumnLike, discount: ColumnLike
) -> Column:
    """Total equals quantity x price x (1 - discount), rounded half up to cents.

    The product stays in exact decimal: a double would misplace half-cents.
    """
    due = as_column(quantity) * as_column(unit_price) * (F.lit(1) - as_column(discount))
    return as_column(total) == F.round(due, 2)


def is_time_valid(transaction: ColumnLike, last_modified: ColumnLike) -> Column:
    return as_column(last_modified) >= as_column(transaction)


def is_margin_positive(unit_price: ColumnLike, cost_price: ColumnLike) -> Column:
    return as_column(unit_price) >= as_column(cost_price)


def is_reorder_needed(stock: ColumnLike, threshold: ColumnLike) -> Column:
    return as_column(stock) <= as_column(threshold)
