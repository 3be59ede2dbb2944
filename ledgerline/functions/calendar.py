"""Calendar expressions: fiscal years, week and month ends, publication calendars."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def fiscal_year(d: Column) -> Column:
    """July to June, named by the year it ends in."""
    return F.year(d) + F.when(F.month(d) >= 7, 1).otherwise(0)


def fy_label(fy: Column) -> Column:
    """2025 -> 2024-25."""
    return F.format_string("%d-%02d", fy - 1, F.pmod(fy, F.lit(100)))


def week_ending_friday(d: Column) -> Column:
    return F.date_add(d, F.pmod(F.lit(4) - F.weekday(d), F.lit(7)).cast("int"))


def month_number(d: Column) -> Column:
    """Months since year 0, for consecutive-month frames."""
    return F.year(d) * 12 + F.month(d)
