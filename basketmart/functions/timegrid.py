"""Relative time grid: DAY and WEEK_NO are unanchored indexes, so periods are counted, never dated."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

WEEKS_PER_PERIOD = 4
DAYS_PER_PERIOD = 28
WEEKS_PER_QUARTER = 13
WEEKS_PER_YEAR = 52
LABEL_WEEKS = 13


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def period_of_week(week: Column | str) -> Column:
    """Four-week period of a week index (week 1..4 is period 1)."""
    return (F.floor((_col(week) - 1) / WEEKS_PER_PERIOD) + 1).cast("int")


def period_of_day(day: Column | str) -> Column:
    """Four-week period of a day index (day 1..28 is period 1)."""
    return (F.floor((_col(day) - 1) / DAYS_PER_PERIOD) + 1).cast("int")


def quarter_of_week(week: Column | str) -> Column:
    """Thirteen-week, quarter-like period of a week index."""
    return (F.floor((_col(week) - 1) / WEEKS_PER_QUARTER) + 1).cast("int")


def hour_of_hhmm(hhmm: Column) -> Column:
    """Hour of an HHMM number; NULL unless it lies in 0..2359 with minutes below 60."""
    valid = hhmm.between(0, 2359) & (hhmm % 100 < 60)
    return F.when(valid, F.floor(hhmm / 100).cast("int"))
