"""Joins of the forecast.

No join carries a broadcast hint. Dimensions (quarters, calendar, division map)
are a few thousand rows, so the planner broadcasts them by their measured size
and falls back to a shuffled join if one ever outgrows
``spark.sql.autoBroadcastJoinThreshold``; AQE re-checks at run time.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pipecast.functions.fiscal import day_of_quarter
from pipecast.functions.labels import currency_or_default


def quarter_days(quarter_mapping: DataFrame) -> DataFrame:
    """One row per (quarter, day in it), so that day lookups are hash joins, not range joins."""
    return quarter_mapping.select(
        "fy_quarter",
        "qtr_start",
        "qtr_end",
        F.explode(F.sequence("qtr_start", "qtr_end")).alias("quarter_day"),
    )


def join_quarter(df: DataFrame, quarter_mapping: DataFrame, day: str, how: str = "left") -> DataFrame:
    """Attach the fiscal quarter whose ``qtr_start..qtr_end`` holds ``day``.

    Days meet as numbers: Spark looks up a whole number by its place in an array, a date by hashing a row.
    """
    days = quarter_days(quarter_mapping)
    return df.join(days, F.unix_date(df[day]) == F.unix_date(days["quarter_day"]), how).drop("quarter_day")


def calendar_spine(quarter_mapping: DataFrame, calendar: DataFrame) -> DataFrame:
    """One row per (quarter, calendar day) with the day's number in the quarter.

    A quarter without calendar days yields nothing: every reader of the spine
    filters on ``dt``.
    """
    days = quarter_days(quarter_mapping)
    dates = calendar.select("dt")
    return days.join(dates, days["quarter_day"] == dates["dt"]).select(
        "fy_quarter", "dt", day_of_quarter(F.col("dt"), F.col("qtr_start")).alias("day_of_qtr")
    )


def join_division(df: DataFrame, division_map: DataFrame, dirty: str) -> DataFrame:
    """Attach ``sales_div_clean`` for the raw label in column ``dirty``; NULL if unmapped."""
    return df.join(division_map, df[dirty] == division_map["sales_div_dirty"], "left").drop("sales_div_dirty")


def join_quota_quarter(quota: DataFrame, quarter_mapping: DataFrame) -> DataFrame:
    """A quota line belongs to the quarter that starts on its start date."""
    quarters = quarter_mapping.select("fy_quarter", "qtr_start")
    return quota.join(quarters, F.to_date(quota["start_date__c"]) == quarters["qtr_start"], "left")


def join_currency(opportunities: DataFrame, currency: DataFrame) -> DataFrame:
    """Attach the exchange rate of the snapshot's currency; amounts stay as they are."""
    rates = currency.select("alphabeticcode", "rate")
    code = currency_or_default(opportunities["currencyisocode"])
    return opportunities.join(rates, code == rates["alphabeticcode"], "left")


def join_account(opportunities: DataFrame, account: DataFrame) -> DataFrame:
    """Attach the account row. Both sides can be large, so both are shuffled; of each partition the accounts
    are held in a hash table, while snapshots, of which there are far more, stream past it unsorted."""
    accounts = account.select(F.col("id").alias("account_id")).hint("shuffle_hash")
    return opportunities.join(accounts, opportunities["accountid"] == accounts["account_id"], "left")


def duplicate_keys(dimension: DataFrame, key: str) -> DataFrame:
    """Keys that occur more than once, i.e. would multiply rows in a lookup join."""
    return dimension.groupBy(key).agg(F.count(F.lit(1)).alias("copies")).where("copies > 1")


def shift_to_next_day(pipeline: DataFrame) -> DataFrame:
    """Date pipeline rows by the day that reports them: a day shows yesterday's closing pipeline."""
    return pipeline.withColumn("dt", F.date_add("dt", 1))


def assemble_features(
    quota: DataFrame,
    spine: DataFrame,
    pipeline: DataFrame,
    qtd: DataFrame,
    quarter_total: DataFrame,
) -> DataFrame:
    """Bring the aggregates together, one row per (day, division).

    ``pipeline`` carries both the touched and the unfiltered sums. The joins to
    the spine and to the pipeline are inner because later filters on day and
    division reject their NULL rows anyway; bookings stay optional. The pipeline
    is keyed by (quarter, division, next day), so day 1 of a quarter, whose
    "yesterday" lies in another quarter, has no row.
    """
    keys = ["fy_quarter", "sales_div"]
    goals = quota.join(quarter_total, keys, "left")
    return (
        shift_to_next_day(pipeline)
        .join(spine, ["fy_quarter", "dt"])
        .join(qtd, [*keys, "dt"], "left")
        .join(goals, keys)
    )


def on_days(df: DataFrame, days: DataFrame) -> DataFrame:
    """Rows whose ``dt`` is among ``days`` (a left-semi join, duplicates in ``days`` are harmless)."""
    return df.join(days, "dt", "left_semi")
