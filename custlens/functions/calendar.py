"""Calendar parts and whole-day gaps (JVM built-ins only)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def day_of_year(tm) -> Column:
    return F.dayofyear(_c(tm))


def iso_week(tm) -> Column:
    """ISO-8601 week number (weeks start on Monday, week 1 has > 3 days)."""
    return F.weekofyear(_c(tm))


def weekday_mon0(tm) -> Column:
    """Day of week with Monday = 0 ... Sunday = 6 (``dayofweek`` is Sunday = 1)."""
    return F.weekday(_c(tm))


def hour(tm) -> Column:
    return F.hour(_c(tm))


def calendar_parts(tm, prefix: str = "") -> list[Column]:
    """``day, week, weekday, hour`` of a timestamp column."""
    return [day_of_year(tm).alias(f"{prefix}day"), iso_week(tm).alias(f"{prefix}week"),
            weekday_mon0(tm).alias(f"{prefix}weekday"), hour(tm).alias(f"{prefix}hour")]


def whole_days_between(earlier, later) -> Column:
    """Whole-day component of ``later - earlier``; for ``later >= earlier`` this is
    the floor of the elapsed days (truncation and floor agree)."""
    return F.timestamp_diff("DAY", _c(earlier), _c(later))
