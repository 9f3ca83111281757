"""Phone numbers as column expressions.

The rules read a number the way a US caller writes it:

* a leading ``00`` stands for ``+``; an extension (``x``, ``ext``, ``#``) is dropped;
* without ``+``: 10 digits, or 11 starting with 1, or 7 (a local number);
* with ``+``: the first three digits settle the calling code, as no code of ``calling_codes``
  is the beginning of another one, and as many digits must follow as that country uses;
* with a code that is not listed: 7 to 15 digits in all, the first one not 0.

Anything else is null. Letters are not turned into digits. The lengths are an array by the first
three digits, so a number costs one look-up however many countries there are.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import cache

from pyspark.sql import Column, functions as F

from tillwork.functions._args import ColumnLike, as_column
from tillwork.functions.calling_codes import CALLING_CODE_LENGTHS, length_masks

# Country code of numbers without one, and the accepted forms once
# everything but digits and a leading plus is gone.
DEFAULT_COUNTRY_CODE = "1"
LOCAL_FORM = r"^(\d{7}|\d{10})$"
NATIONAL_FORM = r"^1\d{10}$"
INTERNATIONAL_FORM = r"^\+[1-9]\d{5,18}$"
UNLISTED_DIGITS = (7, 15)

_EXTENSION = r"(?i)\s*(?:;?ext|x|#).*$"
_NOT_LEADING_PLUS_OR_DIGIT = r"(?!^\+)\D"


def clean_phone(name: ColumnLike) -> Column:
    """Keep digits and plus signs only."""
    return F.regexp_replace(as_column(name), "[^0-9+]", "")


@cache
def _masks(codes: tuple[tuple[str, str], ...]) -> str:
    return f"array({', '.join(f'{m}L' for m in length_masks(dict(codes)))})"


def is_possible_length(digits: Column, codes: Mapping[str, str] = CALLING_CODE_LENGTHS) -> Column:
    """Whether as many digits follow the calling code as its country uses; ``digits`` starts with the code."""
    mask = F.get(F.expr(_masks(tuple(codes.items()))), F.substring(digits, 1, 3).try_cast("int"))
    allowed = F.call_function("shiftright", mask, F.length(digits)).bitwiseAND(F.lit(1))
    return F.when(mask > 0, allowed == 1).otherwise(F.length(digits).between(*UNLISTED_DIGITS))


def format_phone_e164(name: ColumnLike, codes: Mapping[str, str] = CALLING_CODE_LENGTHS) -> Column:
    """Phone number in E.164 form (``+12125550147``), or null if it cannot be one."""
    number = F.regexp_replace(F.trim(as_column(name)), "^00", "+")
    number = F.regexp_replace(number, _EXTENSION, "")
    packed = F.regexp_replace(number, _NOT_LEADING_PLUS_OR_DIGIT, "")
    return (
        F.when(
            packed.startswith("+"),
            F.when(packed.rlike(INTERNATIONAL_FORM) & is_possible_length(F.substring(packed, 2, 20), codes), packed),
        )
        .when(packed.rlike(LOCAL_FORM), F.concat(F.lit("+" + DEFAULT_COUNTRY_CODE), packed))
        .when(packed.rlike(NATIONAL_FORM), F.concat(F.lit("+"), packed))
    )
