"""Dates, hours, minutes and ages. Days are cut in the session time zone."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

_DAY, _HOUR = "yyyy-MM-dd", "HH"
# Fixed value: an age counts years of 365 days, not calendar years.
_YEAR_MILLIS = 365 * 24 * 60 * 60 * 1000


def epoch_day(millis: Column) -> Column:
    return F.date_format(F.timestamp_millis(millis), _DAY)


def epoch_hour(millis: Column) -> Column:
    return F.date_format(F.timestamp_millis(millis), _HOUR)


def epoch_minute(millis: Column) -> Column:
    return F.call_function("div", millis, F.lit(60_000))


def text_day(date_time: Column) -> Column:
    """`yyyy-MM-dd HH:mm:ss` -> `yyyy-MM-dd`."""
    return F.get(F.split(date_time, " "), F.lit(0))


def text_hour(date_time: Column) -> Column:
    """`yyyy-MM-dd HH:mm:ss` -> `HH`; null where the text has no time part."""
    return F.get(F.split(F.get(F.split(date_time, " "), F.lit(1)), ":"), F.lit(0))


def readable(date_time: Column) -> Column:
    """Whether a text is a date and a time of day."""
    return F.try_to_timestamp(date_time, F.lit("yyyy-MM-dd HH:mm:ss")).isNotNull()


def previous_day(day: Column) -> Column:
    return F.date_format(F.date_sub(F.to_date(day), 1), _DAY)


def next_day(day: Column) -> Column:
    return F.date_format(F.date_add(F.to_date(day), 1), _DAY)


def age_years(birthday: Column, as_of: Column | None = None) -> Column:
    """Whole 365-day years from `birthday` to `as_of` (now by default); null where the birthday is not a date."""
    now = F.current_timestamp() if as_of is None else as_of
    # Months and days may have one digit, and a time may follow.
    born = F.try_to_timestamp(F.regexp_extract(birthday, r"^\d{1,4}-\d{1,2}-\d{1,2}", 0), F.lit("y-M-d"))
    lived = F.unix_millis(now) - F.unix_millis(born)
    return F.call_function("div", lived, F.lit(_YEAR_MILLIS)).cast("int")
