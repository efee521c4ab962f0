"""Text of a trend listing to typed values."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The category names a trend may carry.
TREND_CATEGORIES = (
    "other",
    "cars and vehicles",
    "beauty and mode",
    "entertainment",
    "food and drink",
    "health",
    "hobby",
    "pets and animals",
    "climate",
    "politic",
    "travel and transportation",
    "shopping",
    "games",
    "sport",
    "technology",
    "jobs and education",
    "science",
    "government",
    "business and finance",
)


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_volume(text: Column | str) -> Column:
    """``2K+`` -> 2000, ``1M`` -> 1000000, ``200+`` -> 200; NULL when there is no number."""
    t = _col(text)
    pattern = r"^\s*([0-9]+(?:\.[0-9]+)?)\s*([KkMm]?)"
    number = F.regexp_extract(t, pattern, 1).try_cast("decimal(20,6)")
    unit = F.upper(F.regexp_extract(t, pattern, 2))
    factor = F.when(unit == "K", 1000).when(unit == "M", 1000000).otherwise(1)
    return (number * factor).cast("bigint")


# an amount and its unit: 4 hours ago, 11h ago, Lasted 3 hours
_SPAN = r"([0-9]+)\s*(minute|min|m|hour|h|day|d)s?\b"


def _span(text: Column) -> tuple[Column, Column]:
    amount = F.regexp_extract(text, _SPAN, 1).try_cast("int")
    unit = F.regexp_extract(text, _SPAN, 2)
    return amount, unit


def text_interval(text: Column | str) -> Column:
    """``4 hours ago`` / ``11h ago`` / ``Lasted 3 hours`` to an interval; NULL without one."""
    amount, unit = _span(_col(text))
    zero = F.lit(0)
    days = F.when(unit.isin("day", "d"), amount).otherwise(zero)
    hours = F.when(unit.isin("hour", "h"), amount).otherwise(zero)
    mins = F.when(unit.isin("minute", "min", "m"), amount).otherwise(zero)
    return F.when(amount.isNotNull(), F.make_dt_interval(days, hours, mins, F.lit(0).cast("decimal(18,6)")))


def relative_time(text: Column | str, now: Column | str) -> Column:
    """The point in time ``text`` before ``now``."""
    return _col(now) - text_interval(text)


def end_time(start: Column | str, text: Column | str) -> Column:
    """``start`` plus the duration in ``text``; NULL while the trend is still active."""
    return _col(start) + text_interval(text)


def is_active(text: Column | str) -> Column:
    """``Active`` against ``Lasted x hours``."""
    return F.lower(F.trim(_col(text))) == "active"


def strip_special(text: Column | str) -> Column:
    """Keep letters, digits, blanks and ``. , -``."""
    return F.regexp_replace(_col(text), r"[^\p{L}\p{N} .,-]", "")


def split_list(text: Column | str) -> Column:
    """Comma list to a trimmed array without empty entries."""
    parts = F.transform(F.split(_col(text), ","), lambda x: F.trim(x))
    return F.filter(parts, lambda x: x != "")


def join_list(values: Column | str) -> Column:
    """Array to the comma separated form."""
    return F.array_join(_col(values), ", ")


def valid_categories(values: Column | str) -> Column:
    """Known categories only, ``['other']`` when none is left."""
    known = F.array(*[F.lit(c) for c in TREND_CATEGORIES])
    kept = F.filter(F.coalesce(_col(values), F.array().cast("array<string>")), lambda x: F.array_contains(known, x))
    return F.when(F.size(kept) == 0, F.array(F.lit("other"))).otherwise(kept)
