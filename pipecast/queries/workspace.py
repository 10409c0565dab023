"""What the queries share: run parameters, derived sources, stored features, fitted models.

Sources are derived per (session, folder). The feature table is stored once in
the shared folder and then read by every query that only slices it or trains on
it, as in a production run; queries about building it start from the sources.
"""

from __future__ import annotations

from dataclasses import replace
from datetime import date
from functools import lru_cache

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession

from pipecast.config import ForecastConfig
from pipecast.operators.aggregates import label_bookings
from pipecast.operators.model_frames import split_holdout
from pipecast.plans import models, tree_tables
from pipecast.plans.dates import RunDates
from pipecast.plans.features import build_features, snapshot_cells
from pipecast.plans.slices import SLICES
from pipecast.sources.orders_mapping import derive_sources
from pipecast.sources.readers import Sources
from pipecast.sources.sinks import cut_lineage, run_folder, store_features

CONFIG = ForecastConfig(as_of=date(2001, 6, 15), min_dt=date(1995, 8, 1))
BACK_DATED = replace(CONFIG, as_of=date(2000, 6, 15))

# Trees of every registered model; their depth is unlimited. Tests set a smaller number.
TREES = models.TREES


@lru_cache(maxsize=16)
def sources(spark: SparkSession, folder: str, together: bool = False) -> Sources:
    return derive_sources(spark, folder, together)


@lru_cache(maxsize=16)
def booked(spark: SparkSession, folder: str) -> DataFrame:
    """Bookings per day and raw label, stored once for the run's dates and both feature tables."""
    return cut_lineage(label_bookings(sources(spark, folder).bookings, CONFIG))


@lru_cache(maxsize=16)
def cells(spark: SparkSession, folder: str) -> DataFrame:
    """Sums of snapshots per day and raw label, stored once for both feature tables."""
    return cut_lineage(snapshot_cells(sources(spark, folder), CONFIG))


@lru_cache(maxsize=16)
def dates(spark: SparkSession, folder: str) -> RunDates:
    """The dates need the days with bookings only."""
    return RunDates.resolve(replace(sources(spark, folder), bookings=booked(spark, folder)), CONFIG)


@lru_cache(maxsize=16)
def stored_features(spark: SparkSession, folder: str, together: bool = False) -> DataFrame:
    src = sources(spark, folder, together)
    features = build_features(src, CONFIG, cells=cells(spark, folder), booked=booked(spark, folder))
    return store_features(features, run_folder(spark, "features"))


def stored_slice(spark: SparkSession, folder: str, name: str, together: bool = False) -> DataFrame:
    return SLICES[name](stored_features(spark, folder, together), dates(spark, folder))


@lru_cache(maxsize=16)
def holdout_split(
    spark: SparkSession, folder: str, together: bool = False
) -> tuple[DataFrame, DataFrame]:
    return split_holdout(cut_lineage(models.model_rows(stored_slice(spark, folder, "train", together))))


@lru_cache(maxsize=16)
def model(spark: SparkSession, folder: str, kind: str, together: bool = False) -> PipelineModel:
    train, _ = holdout_split(spark, folder, together)
    if kind == "linear":
        return models.fit(train, models.linear_regression())
    if kind == "forest":
        return models.fit(train, models.random_forest(together, TREES))
    if kind == "boosting":
        return models.fit(train, models.gradient_boosting(together, TREES))
    raise ValueError(kind)


LASSO_ALPHA = 0.01


@lru_cache(maxsize=16)
def lasso(spark: SparkSession, folder: str) -> PipelineModel:
    train, _ = holdout_split(spark, folder)
    return models.fit(train, *models.lasso_on_scaled(alpha=LASSO_ALPHA))


@lru_cache(maxsize=16)
def search(spark: SparkSession, folder: str, together: bool = False) -> tree_tables.ForestSearch:
    train, _ = holdout_split(spark, folder, together)
    return tree_tables.search_forest(train, trees=TREES, parallelism=8)
