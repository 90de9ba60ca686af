"""Derived metrics as Column builders. Every division is guarded, so ANSI mode stays on."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Decimal places at which a band limit is compared: hides the last bits of a
# floating-point deviation, so a value exactly on the limit is no outlier.
BAND_PLACES = 9


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def _double(value: Column | str) -> Column:
    return _col(value).cast("double")


def ratio(part: Column | str, whole: Column | str) -> Column:
    """``part / whole`` in double; NULL where ``whole`` is 0 or NULL."""
    return F.when(_col(whole) != 0, _double(part) / _double(whole))


def delta(current: Column | str, previous: Column | str) -> Column:
    return _col(current) - _col(previous)


def growth_pct(current: Column | str, previous: Column | str, positive_base: bool = False) -> Column:
    """Change in percent of ``previous``; NULL without a usable base.

    ``positive_base`` also rejects negative bases, not only zero.
    """
    base = _col(previous)
    usable = base > 0 if positive_base else base != 0
    return F.when(usable, delta(current, previous).cast("double") / _double(previous) * 100.0)


def share(part: Column | str, whole: Column | str) -> Column:
    """Fraction of a total, 0 for an empty total."""
    return F.coalesce(ratio(part, whole), F.lit(0.0))


def share_pct(part: Column | str, whole: Column | str) -> Column:
    """Percentage of a total, 0 for an empty total."""
    return F.coalesce(ratio(part, whole) * 100.0, F.lit(0.0))


def rounded_share_pct(part: Column | str, whole: Column | str, places: int = 1) -> Column:
    """Display percentage, halves rounded to even."""
    return F.bround(share_pct(part, whole), places)


def index_to_100(value: Column | str, peer_mean: Column | str) -> Column:
    """100 = as large as the mean of the peers."""
    return share_pct(value, peer_mean)


def seasonal_delta_pct(first: Column | str, second: Column | str) -> Column:
    """Difference of two seasons in percent of the larger one."""
    return share_pct(delta(first, second), F.greatest(_col(first), _col(second)))


def seasonality_index(first: Column | str, second: Column | str) -> Column:
    """Share of the first season in both."""
    return share_pct(first, _col(first) + _col(second))


def intensity(value: Column | str, median: Column | str) -> Column:
    """Multiple of the median; NULL unless the median is positive."""
    return F.when(_col(median) > 0, _double(value) / _double(median))


def z_score(value: Column | str, mean: Column | str, deviation: Column | str) -> Column:
    """Distance from the mean in deviations, 0 where nothing varies."""
    return F.when(_col(deviation) > 0, (_double(value) - _double(mean)) / _double(deviation)).otherwise(0.0)


def upper_band(mean: Column | str, deviation: Column | str, width: float = 2.0) -> Column:
    return _col(mean) + width * _col(deviation)


def lower_band(mean: Column | str, deviation: Column | str, width: float = 2.0) -> Column:
    return F.greatest(F.lit(0.0), _col(mean) - width * _col(deviation))


def above_band(value: Column | str, upper: Column | str) -> Column:
    """Strictly above the limit.

    When the value is one of the ``n`` the band was made from, its distance is
    at most ``sqrt(n - 1)`` population deviations, so a two-deviation band can
    flag nothing with five values or fewer.
    """
    return _col(value) > F.round(_col(upper), BAND_PLACES)


def rank_gain(rank: Column | str, previous: Column | str) -> Column:
    """Places won since the previous rank; NULL without one."""
    return _col(previous) - _col(rank)


def relative_size(value: Column | str, largest: Column | str) -> Column:
    """Square root of the fraction of the largest value (area-true marker size)."""
    return F.sqrt(share(value, largest))
