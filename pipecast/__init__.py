"""pipecast: sales-pipeline forecasting on Spark DataFrames."""

from pipecast.config import ForecastConfig

__all__ = ["ForecastConfig"]
