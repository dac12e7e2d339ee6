"""Calendar attributes of a date."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Season months and weekend nights (Monday = 0).
PEAK_MONTHS = (6, 7, 8)
OFF_MONTHS = (12, 1, 2)
WEEKEND_NIGHTS = (4, 5)


def in_months(date: Column, months: tuple[int, ...]) -> Column:
    return F.month(date).isin(*months)


def is_peak(date: Column) -> Column:
    return in_months(date, PEAK_MONTHS)


def is_off_season(date: Column) -> Column:
    return in_months(date, OFF_MONTHS)


def is_weekend_night(date: Column) -> Column:
    return F.weekday(date).isin(*WEEKEND_NIGHTS)
