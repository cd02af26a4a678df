"""Date expressions. Rules that depend on "today" take an ``as_of`` date."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F

from .conditions import ColumnLike, as_column, case_bucket
from .text import strip

DAYS_PER_YEAR = 365.25


def parse_iso_date(c: ColumnLike) -> Column:
    """``yyyy-MM-dd`` text to a date; NULL when it is no calendar day."""
    return F.try_to_date(strip(c), "yyyy-MM-dd")


def date_key(c: ColumnLike) -> Column:
    """``yyyyMMdd`` as an integer, 0 when the date is missing."""
    day = as_column(c)
    return F.coalesce(F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day), F.lit(0))


def age_in_years(birth: ColumnLike, as_of: date) -> Column:
    """Completed years; 0 when the birth date is missing."""
    return F.coalesce(F.floor(F.months_between(F.lit(as_of), as_column(birth)) / 12).cast("int"), F.lit(0))


def years_since(c: ColumnLike, as_of: date) -> Column:
    """Days divided by 365.25, as a fraction."""
    return F.datediff(F.lit(as_of), as_column(c)) / F.lit(DAYS_PER_YEAR)


def season(c: ColumnLike) -> Column:
    month = F.month(as_column(c))
    return case_bucket(
        [(month.isin(12, 1, 2), "Winter"), (month.isin(3, 4, 5), "Spring"), (month.isin(6, 7, 8), "Summer")], "Fall"
    )


def day_name(c: ColumnLike) -> Column:
    return F.date_format(as_column(c), "EEEE")


def month_name(c: ColumnLike) -> Column:
    return F.date_format(as_column(c), "MMMM")


def is_weekend(c: ColumnLike) -> Column:
    return F.weekday(as_column(c)) >= 5
