"""Dates and ages."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, functions as F

DAYS_PER_YEAR = 365.25


def _column(value: Column | str | dt.date) -> Column:
    if isinstance(value, dt.date):
        return F.lit(value)
    return F.col(value) if isinstance(value, str) else value


def parse_date(value: Column | str) -> Column:
    """The ISO date a text or timestamp starts with; null, not an error, when malformed."""
    return _column(value).try_cast("date")


def age_fraction(born: Column | str, on: Column | str | dt.date) -> Column:
    return F.datediff(_column(on), _column(born)) / F.lit(DAYS_PER_YEAR)


def age_years(born: Column | str, on: Column | str | dt.date) -> Column:
    """Completed years as an integer."""
    return F.floor(age_fraction(born, on)).cast("int")


def utc_now_text() -> Column:
    """Current instant in UTC as ISO 8601 text, whatever zone the session uses."""
    now = F.to_utc_timestamp(F.current_timestamp(), F.current_timezone())
    return F.concat(F.date_format(now, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("+00:00"))
