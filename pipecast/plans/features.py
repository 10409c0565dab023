"""The feature table: one row per day and sales division."""

from __future__ import annotations

from datetime import date
from functools import reduce
from operator import add

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pipecast import schemas
from pipecast.config import ForecastConfig
from pipecast.functions.fiscal import quarter_elapsed
from pipecast.functions.predicates import forecast_division, known_by
from pipecast.functions.ratios import feature_ratios
from pipecast.operators.aggregates import (
    daily_bookings,
    days_of_labels,
    pipeline_cells,
    quarter_bookings,
    quota_by_quarter,
    totals_of_cells,
)
from pipecast.operators.joins import assemble_features, calendar_spine
from pipecast.operators.windows import bookings_to_date, filled_bookings
from pipecast.sources.readers import Sources
from pipecast.sources.sinks import overwrite_quarters


def history_quarters(quarter_mapping: DataFrame, cfg: ForecastConfig) -> DataFrame:
    """The quarters that reach into the history window."""
    return quarter_mapping.where(F.col("qtr_end") >= F.lit(cfg.min_dt))


def scan_bounds(quarters: DataFrame) -> tuple[Column, Column]:
    """First and last day of ``quarters``.

    The bounds are scalar subqueries over a tiny table: Spark resolves them before
    the scan and uses them to skip partitions and row groups.
    """
    return quarters.agg(F.min("qtr_start")).scalar(), quarters.agg(F.max("qtr_end")).scalar()


def snapshot_cells(
    src: Sources, cfg: ForecastConfig, quarters: DataFrame | None = None, later_days: bool = False
) -> DataFrame:
    """The sums of snapshots that ``build_features`` rests on, whatever its division map."""
    if quarters is None:
        quarters = history_quarters(src.quarter_mapping, cfg)
    known = F.lit(True) if later_days else known_by(cfg, "dt")
    since = F.lit(cfg.min_dt)
    snapshots = src.snapshots(*scan_bounds(quarters)).where((F.col("dt") >= F.date_sub(since, 1)) & known)
    return pipeline_cells(snapshots, quarters, cfg)


def build_features(
    src: Sources,
    cfg: ForecastConfig,
    quarters: DataFrame | None = None,
    later_days: bool = False,
    cells: DataFrame | None = None,
    booked: DataFrame | None = None,
) -> DataFrame:
    """All 36 feature columns for every day of ``quarters`` (default: the whole history).

    Sources are read once each, and only over the days of ``quarters``. Whole
    quarters are independent of each other (running sums and gap filling stay
    inside one), so any set of them gives the same rows as a cut from the full
    table. ``min_dt`` is applied ahead of the gap filling; a run pinned to a day knows no later
    snapshot and has no later row, unless ``later_days`` asks for the rows of all snapshots there are.

    A caller that needs them more than once can store ``snapshot_cells`` and ``label_bookings`` and pass
    them as ``cells`` and ``booked``.
    """
    if quarters is None:
        quarters = history_quarters(src.quarter_mapping, cfg)
    since = F.lit(cfg.min_dt)
    known = F.lit(True) if later_days else known_by(cfg, "dt")
    in_quarters = F.col("booking_date__c").between(*scan_bounds(quarters))
    if cells is None:
        cells = snapshot_cells(src, cfg, quarters, later_days)
    pipeline = totals_of_cells(cells, src.division_map).where("touched_deals > 0")
    if booked is None:
        daily = daily_bookings(src.bookings.where(in_quarters), quarters, src.division_map, cfg)
    else:
        counted = booked.where(in_quarters & (F.col("deals") > 0)).drop("deals")
        daily = days_of_labels(counted, quarters, src.division_map)
    assembled = assemble_features(
        quota=quota_by_quarter(src.quota, quarters, src.division_map),
        spine=calendar_spine(quarters, src.calendar).where((F.col("dt") >= since) & known),
        pipeline=pipeline.where(forecast_division(cfg)),
        qtd=bookings_to_date(daily),
        quarter_total=quarter_bookings(daily),
    )
    return feature_columns(assembled, cfg)


def feature_columns(assembled: DataFrame, cfg: ForecastConfig) -> DataFrame:
    """Fill booking gaps once, move from exact decimals to doubles, and add the ratios."""
    filled = assembled.withColumn("bookings_qtd", filled_bookings(cfg.fill_rows))
    money = ["quota", "bookings_qtd", "direct_bookings", *schemas.STAGE_AMOUNTS, *schemas.LARGE_DEALS]
    open_amount = reduce(add, (F.col(name).cast("double") for name in schemas.STAGE_AMOUNTS_ALL))
    return (
        filled.withColumns({name: F.col(name).cast("double") for name in money})
        .withColumn("open_amount", open_amount)
        .withColumn("qtr_pct", quarter_elapsed(F.col("day_of_qtr"), F.col("fy_quarter")))
        .withColumns(feature_ratios())
        .select(*schemas.FEATURE_COLUMNS)
    )


def refresh_features(src: Sources, cfg: ForecastConfig, path: str, since: date | None = None) -> DataFrame:
    """Bring the feature table stored at ``path`` up to date and return a frame that reads it.

    Only the quarter of the last stored day and later ones are built and written; pass ``since`` to build
    again from the quarter of that day, e.g. after corrections. Quarters are independent of each other, so
    the result is that of a full build. The first run stores all of the history.
    """
    spark = src.calendar.sparkSession
    quarters = history_quarters(src.quarter_mapping, cfg)
    try:
        stored = spark.read.schema(schemas.FEATURES).parquet(path)
        last = since or stored.agg(F.max("dt")).first()[0]
    except AnalysisException:  # nothing is stored yet
        last = since
    if last is not None:
        quarters = quarters.where(F.col("qtr_end") >= F.lit(last))
    overwrite_quarters(build_features(src, cfg, quarters), path)
    return spark.read.schema(schemas.FEATURES).parquet(path).select(*schemas.FEATURE_COLUMNS)


def sort_for_output(df: DataFrame) -> DataFrame:
    """Published row order; only for final results."""
    return df.orderBy("sales_div", "dt", "fy_quarter", "day_of_qtr")
