"""Scores of a forecast, each a one-row aggregate with partial sums only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def r2(actual: str, predicted: str) -> Column:
    """Share of the label's variance explained, over rows with both values; NULL for a constant label."""
    missed = F.sum(F.pow(F.col(actual) - F.col(predicted), 2))
    known = F.when(F.col(predicted).isNotNull(), F.col(actual))
    return 1 - F.try_divide(missed, F.var_pop(known) * F.count(known))


def mean_abs_error(actual: str, predicted: str) -> Column:
    return F.avg(F.abs(F.col(actual) - F.col(predicted)))


def mean_abs_pct_error(actual: str, predicted: str) -> Column:
    """Mean of |error / actual|; rows with an actual of 0 have no percentage and are left out."""
    return F.avg(F.abs(F.try_divide(F.col(actual) - F.col(predicted), F.col(actual))))


def score(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    """All scores in one pass, with the number of rows the percentage error leaves out."""
    return df.agg(
        r2(actual, predicted).alias("r2_score"),
        mean_abs_error(actual, predicted).alias("avg_abs_var_finish"),
        mean_abs_pct_error(actual, predicted).alias("avg_abs_var_pct"),
        F.count_if(F.col(actual) == 0).alias("rows_without_pct"),
        F.count(F.lit(1)).alias("n_rows"),
    )
