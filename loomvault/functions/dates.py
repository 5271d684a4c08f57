"""Calendar arithmetic that counts crossed boundaries, on zone-free timestamps."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import config


def at(instant: str | datetime | date) -> Column:
    """Literal zone-free timestamp."""
    return F.lit(str(instant)).cast("timestamp_ntz")


def end_of_time() -> Column:
    return at(config.END_OF_TIME)


def ghost_time() -> Column:
    return at(config.GHOST_TIME)


def days_between(start: Column, end: Column) -> Column:
    return F.datediff(F.to_date(end), F.to_date(start))


def hours_between(start: Column, end: Column) -> Column:
    return days_between(start, end) * 24 + F.hour(end) - F.hour(start)


def minutes_between(start: Column, end: Column) -> Column:
    return hours_between(start, end).cast("bigint") * 60 + F.minute(end) - F.minute(start)


def seconds_between(start: Column, end: Column) -> Column:
    return minutes_between(start, end) * 60 + F.second(end) - F.second(start)


def months_between(start: Column, end: Column) -> Column:
    return (F.year(end) * 12 + F.month(end)) - (F.year(start) * 12 + F.month(start))


def epoch_seconds(instant: Column) -> Column:
    return seconds_between(at("1970-01-01 00:00:00"), instant)


def hour_start(instant: Column) -> Column:
    return F.window(instant, "1 hour").start


def add_hours(instant: Column, hours: Column | int) -> Column:
    amount = F.lit(hours) if isinstance(hours, int) else hours
    return instant + F.make_dt_interval(F.lit(0), amount.cast("int"))


def add_days(instant: Column, days: Column | int) -> Column:
    amount = F.lit(days) if isinstance(days, int) else days
    return instant + F.make_dt_interval(amount.cast("int"))


def date_key(instant: Column) -> Column:
    return F.date_format(instant, "yyyyMMdd")


def weekday_from_sunday(day: Column) -> Column:
    """0 = Sunday ... 6 = Saturday."""
    return F.dayofweek(day) - 1


def lookback_start(as_of: str, days: int = config.LOOKBACK_DAYS) -> Column:
    """Literal lower bound of an incremental read, so that file statistics can prune."""
    return F.date_sub(F.to_date(at(as_of)), days)


def fiscal_year(day: Column) -> Column:
    return F.year(day) - F.when(F.month(day) >= config.FISCAL_START_MONTH, 0).otherwise(1)


def fiscal_quarter(day: Column) -> Column:
    months_in = F.pmod(F.month(day) - config.FISCAL_START_MONTH, F.lit(12))
    return (F.floor(months_in / 3) + 1).cast("int")
