"""Calendar expressions."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

MONTH_KEY = "yyyy-MM"
MONTH_LABEL = "MMM-yyyy"


def day(value: str | dt.date | Column) -> Column:
    """A run day given as ISO text, date or column."""
    if isinstance(value, Column):
        return value
    return F.lit(value).cast("date")


def month_key(c: Column) -> Column:
    return F.date_format(c, MONTH_KEY)


def month_label(c: Column) -> Column:
    return F.date_format(c, MONTH_LABEL)


def year_of(c: Column) -> Column:
    return F.year(c).cast("bigint")


def month_of(c: Column) -> Column:
    return F.month(c).cast("bigint")


def days_between(later: Column, earlier: Column) -> Column:
    """Number of midnights from ``earlier`` to ``later``."""
    return F.datediff(F.to_date(later), F.to_date(earlier)).cast("bigint")


def first_of_month(year: Column, month: Column) -> Column:
    return F.make_date(year.cast("int"), month.cast("int"), F.lit(1))


def within_years(event: Column, start: Column, years: int) -> Column:
    return event <= F.add_months(start, 12 * years)
