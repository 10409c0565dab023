"""Fiscal calendar arithmetic. Quarters start on 1 Feb, 1 May, 1 Aug and 1 Nov."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from pipecast.config import OTHER_QUARTER_DAYS, Q1_DAYS


def quarter_start(day: Column) -> Column:
    """First day of the fiscal quarter that holds ``day``."""
    return F.add_months(F.trunc(F.add_months(day, -1), "quarter"), 1)


def quarter_end(start: Column) -> Column:
    return F.date_sub(F.add_months(start, 3), 1)


def quarter_label(start: Column) -> Column:
    """``FY02 Q2`` for the quarter that starts on 2001-05-01: years are named after their last month."""
    fiscal_year = F.year(start) + F.when(F.month(start) >= 2, 1).otherwise(0)
    number = F.floor((F.month(start) - 2) / 3) + 1
    return F.concat(
        F.lit("FY"),
        F.lpad((fiscal_year % 100).cast("string"), 2, "0"),
        F.lit(" Q"),
        number.cast("string"),
    )


def day_of_quarter(day: Column, start: Column) -> Column:
    return F.datediff(day, start) + 1


def quarter_elapsed(day_number: Column, fy_quarter: Column) -> Column:
    """Share of the quarter gone by; a 90-day first quarter ends slightly above 1."""
    days = day_number.cast("double")
    return F.when(fy_quarter.like("%Q1"), days / Q1_DAYS).otherwise(days / OTHER_QUARTER_DAYS)


def month_day(day: Column) -> Column:
    return F.date_format(day, "MM-dd")


def as_of_day(as_of) -> Column:
    """The run's "today" as a column: a literal if pinned, else the session's current date."""
    return F.current_date() if as_of is None else F.lit(as_of).cast("date")
