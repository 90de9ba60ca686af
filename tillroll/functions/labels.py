"""Label and bucket columns."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Display names of coded columns.
CHANNEL_NAMES = {1: "Store", 2: "Online"}
WEEKDAY_NAMES = {
    1: "Sunday", 2: "Monday", 3: "Tuesday", 4: "Wednesday",
    5: "Thursday", 6: "Friday", 7: "Saturday",
}
WINTER_MONTHS = (12, 1, 2)
SUMMER_MONTHS = (6, 7, 8)

# First and last day of each retention bucket; the last one is open.
GAP_BUCKETS: tuple[tuple[int, int | None, str], ...] = (
    (0, 0, "0 days (same day)"),
    (1, 7, "1-7 days"),
    (8, 30, "8-30 days"),
    (31, 90, "31-90 days"),
    (91, 180, "91-180 days"),
    (181, 365, "181-365 days"),
    (366, None, "366+ days"),
)


def lookup_name(code: Column, names: Mapping[int, str]) -> Column:
    """Name of a code from a literal map, NULL where the code is not listed."""
    entries = [F.lit(part) for pair in names.items() for part in pair]
    return F.try_element_at(F.create_map(*entries), code)


def channel_name(code: Column | str = "sales_channel_id") -> Column:
    code = F.col(code) if isinstance(code, str) else code
    return F.coalesce(lookup_name(code, CHANNEL_NAMES), F.concat(F.lit("Channel "), code.cast("string")))


def weekday_name(code: Column | str) -> Column:
    """Full weekday name of a Sunday-first code 1..7."""
    code = F.col(code) if isinstance(code, str) else code
    return F.coalesce(lookup_name(code, WEEKDAY_NAMES), F.lit("Unknown"))


def weekday_short(code: Column | str) -> Column:
    """Three-letter weekday name; an unlisted code keeps its number."""
    code = F.col(code) if isinstance(code, str) else code
    return F.coalesce(F.left(lookup_name(code, WEEKDAY_NAMES), F.lit(3)), code.cast("string"))


def or_default(column: str, default: str) -> Column:
    return F.coalesce(F.col(column), F.lit(default))


def season(date: Column | str) -> Column:
    """``Winter`` or ``Summer``; NULL in spring and autumn."""
    month = F.month(date)
    return (F.when(month.isin(*WINTER_MONTHS), "Winter").when(month.isin(*SUMMER_MONTHS), "Summer"))


def bucket_start(value: Column | str, width: int) -> Column:
    value = F.col(value) if isinstance(value, str) else value
    return (F.floor(value / width) * width).cast("int")


def bucket_label(start: Column | str, width: int) -> Column:
    """``lo-hi`` text of an integer bucket."""
    start = F.col(start) if isinstance(start, str) else start
    return F.concat_ws("-", start.cast("string"), (start + (width - 1)).cast("string"))


def gap_bucket(days: Column | str) -> Column:
    """Retention bucket of a day gap; whatever fits no closed bucket is in the open one."""
    days = F.col(days) if isinstance(days, str) else days
    *closed, (_, _, open_label) = GAP_BUCKETS
    label = F.lit(open_label)
    for low, high, name in reversed(closed):
        label = F.when(days.between(low, high), F.lit(name)).otherwise(label)
    return label


def month_start(date: Column | str) -> Column:
    """First day of the month, as a date (no session time zone involved)."""
    return F.trunc(date, "month")


def year_month(date: Column | str) -> Column:
    return F.date_format(date, "yyyy-MM")


def year_week(year: Column | str, week: Column | str) -> Column:
    return F.format_string("%d-W%02d", year, week)


def title_case(column: Column | str) -> Column:
    return F.initcap(column)


def joined_label(template: str, parts: Sequence[Column | str]) -> Column:
    return F.format_string(template, *parts)
