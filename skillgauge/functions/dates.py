"""Posting dates as calendar dates."""

from pyspark.sql import Column
from pyspark.sql import functions as F

_CLOCK = (
    r"(?:[T ]\d{2}(?::?\d{2}(?::?\d{2}(?:[.,]\d+)?)?)?"
    r"\s?(?:Z|[+-]\d{2}(?::?\d{2}(?::?\d{2})?)?)?)?$"
)
_DASHED = r"^(\d{4})-(\d{1,2})-(\d{1,2})" + _CLOCK
_COMPACT = r"^(\d{4})(\d{2})(\d{2})" + _CLOCK
_WEEK = r"^(\d{4})-?W(\d{2})(?:-?([1-7]))?" + _CLOCK


def _calendar(text: Column, pattern: str) -> Column:
    year, month, day = (F.regexp_extract(text, pattern, i) for i in (1, 2, 3))
    joined = F.concat_ws("-", year, F.lpad(month, 2, "0"), F.lpad(day, 2, "0"))
    return F.when(text.rlike(pattern), joined.try_cast("date"))


def _week_date(text: Column) -> Column:
    year, week, day = (F.regexp_extract(text, _WEEK, i) for i in (1, 2, 3))
    # The week with 4 January is week 1; weeks start on Monday.
    first = F.date_trunc("week", F.concat(year, F.lit("-01-04")).try_cast("date"))
    weeks = week.try_cast("int")
    days = F.coalesce(day.try_cast("int"), F.lit(1))
    date = F.date_add(first.cast("date"), (weeks - 1) * 7 + days - 1)
    return F.when(text.rlike(_WEEK) & (F.weekofyear(date) == weeks), date)


def posted_date(text: Column) -> Column:
    """Calendar date as written, without any time-zone shift; null if the text
    is not an ISO date."""
    return F.coalesce(
        _calendar(text, _DASHED), _calendar(text, _COMPACT), _week_date(text)
    )
