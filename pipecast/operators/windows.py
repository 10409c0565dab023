"""Window operators. Their partitions are calendar-bounded: at most 92 days of one division."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pipecast.functions.labels import division_or_undefined


def bookings_to_date(daily: DataFrame) -> DataFrame:
    """Running quarter-to-date bookings per division, on days that had bookings.

    The running sum keys on the clean label before ``UnDefined`` replaces NULL.
    """
    so_far = (
        Window.partitionBy("fy_quarter", "sales_div_clean")
        .orderBy("booking_date__c")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return daily.select(
        F.col("booking_date__c").alias("dt"),
        "fy_quarter",
        division_or_undefined().alias("sales_div"),
        F.sum("bookings").over(so_far).alias("bookings_qtd"),
    )


def filled_bookings(fill_rows: int = 30) -> Column:
    """The day's own bookings-to-date, else the peak of the ``fill_rows`` rows before it, else 0.

    The peak is not the last value: after a net refund the fill shows the level
    before it.
    """
    recent = (
        Window.partitionBy("fy_quarter", "sales_div").orderBy("dt").rowsBetween(-fill_rows, Window.currentRow)
    )
    own = F.col("bookings_qtd")
    return F.coalesce(own, F.max(own).over(recent), F.lit(0))


def same_day_lags(calendar: DataFrame, day: Column, quarters: int) -> DataFrame:
    """One row: the last ``quarters`` dates with the fiscal-day number of ``day``, nearest first.

    Columns ``dt, lag_1 .. lag_n``. Quarters too short to have that day number
    are passed over, so on days 90 to 92 a lag may reach further back. Only the
    quarter days with one number are sorted, four a year.
    """
    number = calendar.where(F.col("dt") == day).select("day_of_fiscal_quarter").scalar()
    same_day = calendar.where(F.col("day_of_fiscal_quarter") == number)
    by_date = Window.orderBy("dt")
    lags = [F.lag("dt", k).over(by_date).alias(f"lag_{k}") for k in range(1, quarters + 1)]
    return same_day.select("dt", *lags).where(F.col("dt") == day)


def lag_days(lags: DataFrame) -> DataFrame:
    """The lag columns of ``same_day_lags`` as distinct ``dt`` rows."""
    names = [c for c in lags.columns if c != "dt"]
    return lags.select(F.explode(F.array(*names)).alias("dt")).where(F.col("dt").isNotNull()).distinct()
