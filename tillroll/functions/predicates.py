"""Row predicates."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F


def equals_text(column: str, value: str, trim: bool = True) -> Column:
    """Case-insensitive equality; outer blanks are ignored unless ``trim`` is off."""
    text = F.col(column)
    return F.lower(F.trim(text) if trim else text) == value.lower()


def in_year(column: str, year: int) -> Column:
    """Calendar-year test as a date range, so that it reaches the Parquet scan."""
    day = F.col(column)
    return (day >= F.lit(f"{year}-01-01").cast("date")) & (day < F.lit(f"{year + 1}-01-01").cast("date"))


def contains_any(columns: Sequence[str], keywords: Sequence[str]) -> Column:
    """Any keyword inside any of the text columns, ignoring case; NULL text matches nothing."""
    texts = [F.lower(F.coalesce(F.col(c), F.lit(""))) for c in columns]
    return reduce(or_, [text.contains(word.lower()) for text in texts for word in keywords])


def is_missing(column: str, is_float: bool) -> Column:
    """NULL, or NaN where the column can hold one (``isnan`` on text fails under ANSI)."""
    missing = F.col(column).isNull()
    return missing | F.isnan(column) if is_float else missing


def is_observed(category: str, count: str, placeholders: Sequence[str] = ("unknown", "undefined")) -> Column:
    """Keep categories with observations; a placeholder without any is never shown."""
    placeholder = F.lower(F.trim(F.col(category).cast("string"))).isin(*placeholders)
    return ~(F.coalesce(placeholder, F.lit(False)) & (F.col(count) <= 0)) & (F.col(count) > 0)
