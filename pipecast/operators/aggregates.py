"""Aggregations of the forecast.

The two large inputs, snapshots and bookings, are reduced before they meet
anything but the day lookup. Their first ``groupBy`` keys on the raw owner label
and keeps one sum per row, so that map-side aggregation shrinks every input
split to (days x labels) rows whatever the key skew; cleaning labels and
spreading stages over columns then happens on that small result. Sums and counts
distribute over both steps, so totals are exact.
"""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pipecast.config import ForecastConfig
from pipecast.functions.labels import division_or_undefined
from pipecast.functions.predicates import (
    closing_in_quarter,
    counted_booking,
    known_by,
    not_excluded,
    open_opportunity,
    segment_quota,
    touched_recently,
)
from pipecast.operators.joins import join_division, join_quarter, join_quota_quarter
from pipecast.schemas import (
    LARGE_DEALS,
    MEASURE_COLUMNS,
    STAGE_AMOUNTS,
    STAGE_AMOUNTS_ALL,
    STAGE_COLUMNS,
)

PIPELINE_KEYS = ("dt", "fy_quarter", "sales_div")


def countable_opportunities(
    opportunities: DataFrame, quarter_mapping: DataFrame, cfg: ForecastConfig
) -> DataFrame:
    """Open snapshots that should close in the quarter they were taken in, touched or not."""
    eligible = opportunities.where(
        open_opportunity() & not_excluded("id", cfg.excluded_opportunity_ids)
    )
    return join_quarter(eligible, quarter_mapping, "dt", how="inner").where(closing_in_quarter())


def _stage_number(cfg: ForecastConfig) -> Column:
    """1 to 5, or 0 for a stage the forecast does not know."""
    number = F.lit(0)
    for k, name in enumerate(cfg.stages, start=1):
        number = F.when(F.col("stagename") == name, k).otherwise(number)
    return number


def pipeline_cells(opportunities: DataFrame, quarter_mapping: DataFrame, cfg: ForecastConfig) -> DataFrame:
    """One count and one sum per (day, quarter, raw label, stage, touched, large)."""
    return (
        countable_opportunities(opportunities, quarter_mapping, cfg)
        .select(
            "dt",
            "fy_quarter",
            "owner_division__c",
            _stage_number(cfg).alias("stage"),
            F.coalesce(touched_recently(cfg), F.lit(False)).alias("touched"),
            (F.col("amount") > cfg.large_deal).alias("large"),
            "amount",
        )
        .groupBy("dt", "fy_quarter", "owner_division__c", "stage", "touched", "large")
        .agg(F.count(F.lit(1)).alias("deals"), F.sum("amount").alias("amount"))
    )


def pipeline_totals(
    opportunities: DataFrame,
    quarter_mapping: DataFrame,
    division_map: DataFrame,
    cfg: ForecastConfig,
) -> DataFrame:
    """Touched and unfiltered pipeline per (day, quarter, division), from one scan of the snapshots.

    ``touched_deals`` tells groups that only exist without the touched filter.
    """
    return totals_of_cells(pipeline_cells(opportunities, quarter_mapping, cfg), division_map)


def totals_of_cells(cells: DataFrame, division_map: DataFrame) -> DataFrame:
    """``pipeline_totals`` from ``pipeline_cells``, which are the same for every division map."""
    cells = join_division(cells, division_map, "owner_division__c")
    touched = F.col("touched")
    by_stage = (
        cells.groupBy("dt", "fy_quarter", division_or_undefined().alias("sales_div"))
        .pivot("stage", list(range(6)))
        .agg(
            F.sum(F.when(touched, F.col("deals"))).alias("deals"),
            F.sum(F.when(touched, F.col("amount"))).alias("amount"),
            F.sum(F.when(touched & F.col("large"), F.col("amount"))).alias("large"),
            F.sum("amount").alias("all"),
        )
    )

    def cell(stage: int, measure: str) -> Column:
        return F.coalesce(F.col(f"{stage}_{measure}"), F.lit(0))

    def total(stages: range, measure: str) -> Column:
        return reduce(add, (cell(k, measure) for k in stages))

    columns: dict[str, Column] = {}
    for k in range(1, 6):
        columns[f"stage_{k}_count"] = cell(k, "deals")
        columns[f"stage_{k}_amount"] = cell(k, "amount")
        columns[f"stage_{k}_amount_all"] = cell(k, "all")
    for first, name in zip((3, 4, 5), LARGE_DEALS):
        columns[name] = total(range(first, 6), "large")
    columns["touched_deals"] = total(range(6), "deals")
    return by_stage.select(*PIPELINE_KEYS, *[column.alias(name) for name, column in columns.items()])


def touched_pipeline(totals: DataFrame) -> DataFrame:
    """Stage counts and amounts and the large-deal sums of recently touched opportunities."""
    return totals.where("touched_deals > 0").select(*PIPELINE_KEYS, *STAGE_COLUMNS, *LARGE_DEALS)


def open_pipeline(totals: DataFrame) -> DataFrame:
    """Stage amounts of all open opportunities."""
    return totals.select(*PIPELINE_KEYS, *STAGE_AMOUNTS_ALL)


def daily_bookings(
    bookings: DataFrame,
    quarter_mapping: DataFrame,
    division_map: DataFrame,
    cfg: ForecastConfig,
) -> DataFrame:
    """Counted bookings per (day, quarter, clean label), as known on the run's day.

    The label stays NULL where unmapped.
    """
    per_label = (
        bookings.where(counted_booking(cfg) & known_by(cfg, "booking_date__c"))
        .groupBy("booking_date__c", "owner_division__c")
        .agg(F.sum("amount__c").alias("bookings"))
    )
    return days_of_labels(per_label, quarter_mapping, division_map)


def label_bookings(bookings: DataFrame, cfg: ForecastConfig) -> DataFrame:
    """One row per (day, raw label) with bookings known on the run's day: ``deals`` of them count.

    The days are all those with bookings, whether any of them counts or not.
    """
    counted = counted_booking(cfg)
    return (
        bookings.where(known_by(cfg, "booking_date__c"))
        .groupBy("booking_date__c", "owner_division__c")
        .agg(F.count_if(counted).alias("deals"), F.sum(F.when(counted, F.col("amount__c"))).alias("bookings"))
    )


def days_of_labels(per_label: DataFrame, quarter_mapping: DataFrame, division_map: DataFrame) -> DataFrame:
    """``daily_bookings`` from the sums of counted bookings per (day, raw label)."""
    labelled = join_division(
        join_quarter(per_label, quarter_mapping, "booking_date__c"), division_map, "owner_division__c"
    )
    return labelled.groupBy("booking_date__c", "fy_quarter", "sales_div_clean").agg(
        F.sum("bookings").alias("bookings")
    )


def quarter_bookings(daily: DataFrame) -> DataFrame:
    """Whole-quarter bookings per division, the numerator of the label; built on ``daily_bookings``."""
    return daily.groupBy("fy_quarter", division_or_undefined().alias("sales_div")).agg(
        F.sum("bookings").alias("direct_bookings")
    )


def quota_by_quarter(quota: DataFrame, quarter_mapping: DataFrame, division_map: DataFrame) -> DataFrame:
    """Segment quota per (quarter, division); quota owners are mapped by their e-mail label."""
    lines = join_division(
        join_quota_quarter(quota.where(segment_quota()), quarter_mapping), division_map, "email__c"
    )
    return lines.groupBy("fy_quarter", division_or_undefined().alias("sales_div")).agg(
        F.sum("gross_quota__c").alias("quota")
    )


def latest_booking_day(bookings: DataFrame, cfg: ForecastConfig) -> DataFrame:
    """One row: the last booking date known on the run's day, whether the booking counts or not."""
    return bookings.where(known_by(cfg, "booking_date__c")).agg(F.max("booking_date__c").alias("dt"))


def four_quarter_average(features: DataFrame) -> DataFrame:
    """Mean of every measure per division; counts and the day number become doubles."""
    means = [F.avg(name).alias(name) for name in MEASURE_COLUMNS]
    return features.groupBy("sales_div").agg(
        F.min("dt").alias("dt"), F.lit("STL4Q").alias("fy_quarter"), *means
    )


def correlation_matrix(df: DataFrame, columns: tuple[str, ...] = MEASURE_COLUMNS) -> DataFrame:
    """Pearson correlation of every column pair as (col_a, col_b, r), skipping NULLs pair by pair.

    Every row contributes to each pair of columns once, in the map-side aggregation;
    what is shuffled is one partial result per pair and task, whatever the number of
    rows.
    """
    values = df.select(F.array(*[F.col(c).cast("double") for c in columns]).alias("all_values"))
    pairs = (
        values.select("all_values", F.posexplode("all_values").alias("a", "value_a"))
        .select("a", "value_a", F.posexplode("all_values").alias("b", "value_b"))
        .where("a <= b")
    )
    upper = pairs.groupBy("a", "b").agg(F.corr("value_a", "value_b").alias("r"))
    names = F.array(*[F.lit(c) for c in columns])
    a, b = F.get(names, F.col("a")), F.get(names, F.col("b"))
    both_ways = F.array_distinct(
        F.array(
            F.struct(a.alias("col_a"), b.alias("col_b")),
            F.struct(b.alias("col_a"), a.alias("col_b")),
        )
    )
    return upper.select(F.inline(both_ways), "r").select("col_a", "col_b", "r")
