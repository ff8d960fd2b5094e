"""Message time and look-back predicates."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

AsOf = dt.date | str | None


def instant(c: Column) -> Column:
    """Timestamp of a text or timestamp column; NULL where it cannot be read."""
    return c.try_cast("timestamp")


def day(as_of: AsOf) -> Column:
    """``as_of`` as a date literal, today when it is None. Folds at planning time."""
    if as_of is None:
        return F.current_date()
    return F.lit(dt.date.fromisoformat(as_of) if isinstance(as_of, str) else as_of)


def within_days(date: Column, days: int, as_of: AsOf = None) -> Column:
    """From ``days`` days before ``as_of`` up to and including ``as_of`` (days + 1 dates)."""
    return (date >= F.date_sub(day(as_of), days)) & (date <= day(as_of))


def last_dates(date: Column, n: int, as_of: AsOf = None) -> Column:
    """The ``n`` calendar dates that end with ``as_of``."""
    return within_days(date, n - 1, as_of)
