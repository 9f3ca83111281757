"""Text, id and URL cleaners."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from tillwork.functions._args import ColumnLike, as_column

# The longest one-word text treated as an acronym, the URL query
# parameter that holds a search term, and the event type it belongs to.
ACRONYM_MAX_LENGTH = 5
SEARCH_PARAMETER_PATTERN = r"[?&]q=([^&]+)"
SEARCH_EVENT = "SEARCH"


def clean_spaces(name: ColumnLike) -> Column:
    """Collapse every run of whitespace to one space and trim the ends."""
    return F.trim(F.regexp_replace(as_column(name), r"\s+", " "))


def clean_text_standard(
    name: ColumnLike, enforce_title_case: bool = True, is_acronym: bool = False
) -> Column:
    """Collapse spaces, then set the case.

    With ``is_acronym`` one short word becomes upper case (``latam`` -> ``LATAM``)
    and any other text title case. Otherwise ``enforce_title_case`` decides between
    title case and the text as it is.
    """
    text = clean_spaces(name)
    if not (is_acronym or enforce_title_case):
        return text
    titled = F.initcap(text)
    if not is_acronym:
        return titled
    one_short_word = (F.length(text) <= ACRONYM_MAX_LENGTH) & ~F.contains(text, F.lit(" "))
    return F.when(one_short_word, F.upper(text)).otherwise(titled)


def clean_email(name: ColumnLike) -> Column:
    return F.lower(F.trim(as_column(name)))


def upper_trim(name: ColumnLike) -> Column:
    return F.upper(F.trim(as_column(name)))


def lower_trim(name: ColumnLike) -> Column:
    return F.lower(F.trim(as_column(name)))


def trim_only(name: ColumnLike) -> Column:
    return F.trim(as_column(name))


def null_text(name: ColumnLike) -> Column:
    """Upper-trimmed id; the word "null" in any case counts as missing."""
    return F.nullif(upper_trim(name), F.lit("NULL"))


def full_name(first: ColumnLike, last: ColumnLike) -> Column:
    """``first last``; null when either part is missing."""
    return F.concat(as_column(first), F.lit(" "), as_column(last))


def search_term(event_type: ColumnLike, url: ColumnLike) -> Column:
    """Search text of a SEARCH event's URL; null for other events or no text."""
    term = F.regexp_extract(as_column(url), SEARCH_PARAMETER_PATTERN, 1)
    return F.when(as_column(event_type) == SEARCH_EVENT, F.nullif(term, F.lit("")))
