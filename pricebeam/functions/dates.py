"""Calendar helpers. Every clock is an explicit `as_of`, so a rerun gives the same answer."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, functions as F


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def as_of_date(as_of: dt.date | str | None = None) -> Column:
    """The run date as a DATE column; today when not given."""
    if as_of is None:
        return F.current_date()
    day = dt.date.fromisoformat(as_of) if isinstance(as_of, str) else as_of
    return F.lit(day)


def month_start(day: Column | str) -> Column:
    return F.trunc(_col(day), "month")


def week_start(day: Column | str) -> Column:
    """Monday of the week of `day`."""
    return F.trunc(_col(day), "week")


def trailing_days(day: Column | str, as_of: Column, days: int) -> Column:
    """True from `days` days before `as_of` up to and including it."""
    return _col(day).between(F.date_sub(as_of, days), as_of)


def date_text(day: Column | str, pattern: str = "yyyy-MM-dd") -> Column:
    return F.date_format(_col(day), pattern)
