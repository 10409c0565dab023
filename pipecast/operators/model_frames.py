"""Preparing feature rows for a model."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pipecast.functions.labels import clean_header
from pipecast.schemas import DROPPED_FOR_MODEL, LABEL

HOLDOUT_BUCKETS = 51  # of 256, i.e. one row in five


def fill_missing(df: DataFrame) -> DataFrame:
    """NULL and NaN become 0 in every number, and ``"0.0"`` in every string."""
    return df.fillna(0.0).fillna("0.0")


def drop_unused(df: DataFrame) -> DataFrame:
    """Drop keys, raw amounts and the leaking quarter total."""
    return df.drop(*DROPPED_FOR_MODEL)


def label_only(df: DataFrame) -> DataFrame:
    return df.select(LABEL)


def row_bucket(first_digit: int) -> Column:
    """0 to 255 from two hex digits of a hash of (division, day).

    Unlike a random split it does not depend on partitioning or row order, so a
    re-run on other hardware holds out the same rows.
    """
    digest = F.md5(F.concat_ws("|", "sales_div", F.col("dt").cast("string")))
    return F.conv(F.substring(digest, first_digit, 2), 16, 10).cast("int")


def with_holdout(df: DataFrame, buckets: int = HOLDOUT_BUCKETS) -> DataFrame:
    return df.withColumn("is_test", row_bucket(1) < buckets)


def split_holdout(df: DataFrame, buckets: int = HOLDOUT_BUCKETS) -> tuple[DataFrame, DataFrame]:
    """(train, test), about 80 to 20."""
    marked = with_holdout(df, buckets)
    return marked.where(~F.col("is_test")).drop("is_test"), marked.where("is_test").drop("is_test")


def with_fold(df: DataFrame, folds: int = 3) -> DataFrame:
    """Add the cross-validation fold, independent of the hold-out bucket."""
    return df.withColumn("fold", row_bucket(3) % folds)


def one_hot(df: DataFrame, column: str, levels: list[str]) -> DataFrame:
    """Replace ``column`` by a 0/1 column per level, none left out."""
    dummies = {
        clean_header(f"{column}_{level}"): F.coalesce((F.col(column) == level).cast("int"), F.lit(0))
        for level in levels
    }
    return df.withColumns(dummies).drop(column)
