"""Column functions. Every one is a built-in expression, so plans stay inside codegen."""

from tillwork.functions.flags import (
    is_event_allowed,
    is_device_allowed,
    is_margin_positive,
    is_pricing_correct,
    is_reorder_needed,
    is_time_valid,
    is_verified_email,
    is_verified_phone,
)
from tillwork.functions.phone import clean_phone, format_phone_e164
from tillwork.functions.text import (
    clean_email,
    clean_spaces,
    clean_text_standard,
    full_name,
    lower_trim,
    null_text,
    search_term,
    trim_only,
    upper_trim,
)
from tillwork.functions.values import (
    cast_to_boolean,
    cast_to_decimal,
    cast_to_integer,
    gross_margin_percentage,
    standardize_date,
)

__all__ = [
    "cast_to_boolean",
    "cast_to_decimal",
    "cast_to_integer",
    "clean_email",
    "clean_phone",
    "clean_spaces",
    "clean_text_standard",
    "format_phone_e164",
    "full_name",
    "gross_margin_percentage",
    "is_device_allowed",
    "is_event_allowed",
    "is_margin_positive",
    "is_pricing_correct",
    "is_reorder_needed",
    "is_time_valid",
    "is_verified_email",
    "is_verified_phone",
    "lower_trim",
    "null_text",
    "search_term",
    "standardize_date",
    "trim_only",
    "upper_trim",
]
