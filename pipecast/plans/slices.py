"""The five published slices of the feature table.

Each slice exists in two forms that give the same rows: ``cut_*`` filters a
feature table that is already there (best stored once, see
``pipecast.sources.sinks.store_features``), while ``build_slice`` starts from the
sources and reads only the quarters the slice needs.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pipecast.config import ForecastConfig
from pipecast.operators.aggregates import four_quarter_average
from pipecast.plans.dates import RunDates
from pipecast.plans.features import build_features, history_quarters, sort_for_output
from pipecast.schemas import FEATURE_COLUMNS
from pipecast.sources.readers import Sources
from pipecast.sources.sinks import publish_table, publish_view


def cut_train(features: DataFrame, dates: RunDates) -> DataFrame:
    """All days of past quarters."""
    return features.where((F.col("dt") < dates.quarter_start) & (F.col("quota") != 0))


def cut_test(features: DataFrame, dates: RunDates) -> DataFrame:
    """The running quarter up to the last booking date."""
    return features.where(F.col("dt").between(dates.quarter_start, dates.latest_booking))


def cut_current_day(features: DataFrame, dates: RunDates) -> DataFrame:
    """The last booking date only."""
    return cut_test(features, dates).where(F.col("dt") == dates.latest_booking)


def cut_same_time_last_quarter(features: DataFrame, dates: RunDates) -> DataFrame:
    """The same day of the preceding quarter."""
    return cut_train(features, dates).where(F.col("dt") == dates.lags[0])


def cut_last_four_quarters(features: DataFrame, dates: RunDates) -> DataFrame:
    """Mean of the same day over the last four quarters, one row per division."""
    same_days = cut_train(features, dates).where(F.col("dt").isin(*dates.lags))
    return four_quarter_average(same_days).select(*FEATURE_COLUMNS)


SLICES: dict[str, Callable[[DataFrame, RunDates], DataFrame]] = {
    "train": cut_train,
    "test": cut_test,
    "current_day": cut_current_day,
    "stlq": cut_same_time_last_quarter,
    "stl4q_avg": cut_last_four_quarters,
}

# The names slices are published under.
VIEW_STEMS = {
    "train": "sales_fcst_train",
    "test": "sales_fcst_test",
    "current_day": "sales_fcst_test_curr_day",
    "stlq": "sales_fcst_stlq",
    "stl4q_avg": "sales_fcst_stl4q_avg",
}
VIEW_SUFFIX = {False: "intl_separated", True: "intl_as_one"}


def slice_quarters(name: str, src: Sources, cfg: ForecastConfig, dates: RunDates) -> DataFrame:
    """The quarters a slice needs."""
    quarters = history_quarters(src.quarter_mapping, cfg)
    starts, ends = F.col("qtr_start"), F.col("qtr_end")
    if name == "train":
        return quarters.where(starts < dates.quarter_start)
    if name in ("test", "current_day"):
        return quarters.where((ends >= dates.quarter_start) & (starts <= dates.latest_booking))
    days = dates.lags[: {"stlq": 1, "stl4q_avg": 4}[name]]
    holds_one = [day.between(starts, ends) for day in days]
    return quarters.where(F.coalesce(*[F.when(hit, True) for hit in holds_one], F.lit(False)))


def build_slice(name: str, src: Sources, cfg: ForecastConfig, dates: RunDates | None = None) -> DataFrame:
    """One slice straight from the sources, reading only the days it needs."""
    dates = dates or RunDates.resolve(src, cfg)
    features = build_features(src, cfg, slice_quarters(name, src, cfg, dates))
    return SLICES[name](features, dates)


def view_name(name: str, together: bool) -> str:
    return f"{VIEW_STEMS[name]}_{VIEW_SUFFIX[together]}"


def view_names(together: bool) -> list[str]:
    """Names of all slices in the order they are published in."""
    return [view_name(name, together) for name in SLICES]


def publish_slices(
    features: DataFrame,
    dates: RunDates,
    together: bool = False,
    materialize: bool = False,
) -> list[str]:
    """Publish all five slices of ``features`` in output order; returns their names.

    Pass ``RunDates.lazy`` to let views follow the clock and the bookings, or
    ``RunDates.resolve`` to pin them to this run.
    """
    publish = publish_table if materialize else publish_view
    names = []
    for name, cut in SLICES.items():
        target = view_name(name, together)
        publish(sort_for_output(cut(features, dates)), target)
        names.append(target)
    return names


def read_view(spark: SparkSession, name: str, together: bool = False) -> DataFrame:
    """A published slice by name."""
    return spark.table(view_name(name, together))
