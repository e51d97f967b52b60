"""Date expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def is_leap_day(d: Column) -> Column:
    return (F.month(d) == 2) & (F.dayofmonth(d) == 29)


def is_leap_year(d: Column) -> Column:
    return F.dayofmonth(F.last_day(F.make_date(F.year(d), F.lit(2), F.lit(1)))) == 29


def no_leap_day_of_year(d: Column) -> Column:
    """1 to 365; days after 29 February of a leap year move back by one."""
    day = F.dayofyear(d)
    return day - F.when(is_leap_year(d) & (day > 60), 1).otherwise(0)


def decimal_year(d: Column) -> Column:
    return F.year(d) + (F.dayofyear(d) - 1) / 365.25


def month_start(d: Column) -> Column:
    return F.trunc(d, "MM")


def days(first: Column, last: Column) -> Column:
    """The days from first to last, both included, as an array; an error if reversed."""
    return F.when(first > last, F.raise_error(F.lit("the range of dates is reversed")).cast("array<date>")).otherwise(F.sequence(first, last))
