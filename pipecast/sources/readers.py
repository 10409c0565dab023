"""Reading the source tables and exported feature files."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, fields

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pipecast import schemas


@dataclass(frozen=True)
class Sources:
    """The source tables of a forecast.

    ``opportunity_history`` is by far the largest, one row per opportunity and
    day. Keep it partitioned (or at least sorted) by ``dt``: every plan filters on
    a range of days and reads only those files. ``division_map`` decides whether
    international divisions are kept apart or merged.
    """

    opportunity_history: DataFrame
    bookings: DataFrame
    quota: DataFrame
    quarter_mapping: DataFrame
    calendar: DataFrame
    division_map: DataFrame
    currency: DataFrame | None = None
    account: DataFrame | None = None
    history_between: Callable[[Column, Column], DataFrame] | None = None

    def snapshots(self, first: Column, last: Column) -> DataFrame:
        """The snapshots of the days from ``first`` to ``last``.

        A source that derives its snapshots can pass ``history_between`` to read less for them.
        """
        rows = self.history_between(first, last) if self.history_between else self.opportunity_history
        return rows.where((F.col("dt") >= first) & (F.col("dt") <= last))

    @classmethod
    def from_parquet(cls, spark: SparkSession, root: str, **paths: str) -> Sources:
        """Read ``root/<table>``; ``paths`` overrides single locations, e.g. another division map."""
        return cls(
            **{
                f.name: spark.read.schema(schemas.SOURCE_SCHEMAS[f.name]).parquet(
                    paths.get(f.name, f"{root}/{f.name}")
                )
                for f in fields(cls)
                if f.name in schemas.SOURCE_SCHEMAS
            }
        )

    @classmethod
    def from_tables(cls, spark: SparkSession, **tables: str) -> Sources:
        """Read catalog tables or views, named by keyword; columns are cast to the declared types."""
        return cls(
            **{
                name: conform(spark.table(table), schemas.SOURCE_SCHEMAS[name])
                for name, table in tables.items()
            }
        )


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Pick and cast the columns of ``schema``; a missing one fails at analysis."""
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def read_features_csv(spark: SparkSession, path: str) -> DataFrame:
    """Read an exported feature table (training or running quarter) with its declared schema."""
    return spark.read.csv(path, header=True, schema=schemas.FEATURES, mode="FAILFAST")
