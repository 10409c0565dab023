"""The dates a forecast run hangs on."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pipecast.config import ForecastConfig
from pipecast.functions.fiscal import as_of_day
from pipecast.operators.aggregates import latest_booking_day
from pipecast.operators.windows import same_day_lags
from pipecast.sources.readers import Sources

LAGS = 4


def current_quarter_start(quarter_mapping: DataFrame, cfg: ForecastConfig) -> Column:
    """First day of the running quarter, as a scalar subquery."""
    today = as_of_day(cfg.as_of)
    running = quarter_mapping.where(today.between(F.col("qtr_start"), F.col("qtr_end")))
    return running.select("qtr_start").scalar()


def latest_day(bookings: DataFrame, cfg: ForecastConfig) -> Column:
    """The last booking date known on the run's day, as a scalar subquery."""
    return latest_booking_day(bookings, cfg).scalar()


@dataclass(frozen=True)
class RunDates:
    """Dates of one run, as columns to filter with.

    ``lags`` holds the same point of the preceding quarters, nearest first.
    ``lazy`` leaves every date a scalar subquery, to be answered whenever a result
    is read; ``resolve`` looks all of them up once (a single row) and makes them
    literals, so that scans are pruned at planning time.
    """

    quarter_start: Column
    latest_booking: Column
    lags: tuple[Column, ...]

    @classmethod
    def lazy(cls, src: Sources, cfg: ForecastConfig) -> RunDates:
        latest = latest_day(src.bookings, cfg)
        lags = same_day_lags(src.calendar, latest, LAGS)
        return cls(
            quarter_start=current_quarter_start(src.quarter_mapping, cfg),
            latest_booking=latest,
            lags=tuple(lags.select(f"lag_{k}").scalar() for k in range(1, LAGS + 1)),
        )

    @classmethod
    def resolve(cls, src: Sources, cfg: ForecastConfig) -> RunDates:
        latest = F.lit(latest_booking_day(src.bookings, cfg).first()["dt"]).cast("date")
        lags = same_day_lags(src.calendar, latest, LAGS).first()
        start = src.calendar.sparkSession.range(1).select(
            current_quarter_start(src.quarter_mapping, cfg).alias("start")
        )
        days = [lags[f"lag_{k}"] if lags else None for k in range(1, LAGS + 1)]
        return cls(
            quarter_start=F.lit(start.first()["start"]).cast("date"),
            latest_booking=latest,
            lags=tuple(F.lit(day).cast("date") for day in days),
        )
