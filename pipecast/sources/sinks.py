"""Publishing results: named views, stored tables and CSV exports."""

from __future__ import annotations

import uuid
from datetime import date

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder that the driver and all executors see.

    ``spark.checkpoint.dir`` names it; where that is unset, it lies below the
    warehouse. Raises ValueError if executors run on other machines and the
    path is on the driver's own disk.
    """
    context = spark.sparkContext
    configured = context.getConf().get("spark.checkpoint.dir") or context.getCheckpointDir()
    folder = configured or spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_pipecast"
    if not configured and not context.master.startswith("local") and _is_local_path(folder):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    return folder


def _is_local_path(path: str) -> bool:
    scheme = path.split("://")[0] if "://" in path else path.split(":", 1)[0] if ":/" in path else ""
    return scheme in ("", "file")


def run_folder(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder; never an existing one."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Compute ``df`` once into reliable storage, so that iterative readers do not redo it."""
    shared_folder(df.sparkSession)
    return df.checkpoint()


def publish_view(df: DataFrame, name: str) -> None:
    """Publish under a session-wide name; recomputed on every read."""
    df.createOrReplaceTempView(name)


def publish_table(df: DataFrame, name: str) -> None:
    """Publish under a catalog name, stored once; readers see the old rows or the new ones, never a part.

    Each call stores a table of its own beside the ones before, then points the view ``name`` to it. The
    version before the new one stays for readers that have begun with it; older ones are dropped. A table
    called ``name`` has to be dropped by the caller first.
    """
    spark = df.sparkSession
    versions = sorted(t.name for t in spark.catalog.listTables(pattern=f"{name}__v*") if not t.isTemporary)
    number = int(versions[-1].rsplit("__v", 1)[1]) + 1 if versions else 1
    version = f"{name}__v{number:09d}"
    df.write.saveAsTable(version)
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS SELECT * FROM {version}")
    for old in versions[:-1]:
        spark.sql(f"DROP TABLE IF EXISTS {old}")


def store_features(df: DataFrame, path: str) -> DataFrame:
    """Store a feature table by quarter and return a frame that reads it back.

    Slices then prune to their quarters. Rows are few (days x divisions), so
    each quarter becomes a single file.
    """
    df.repartition("fy_quarter").write.partitionBy("fy_quarter").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path).select(*df.columns)


def overwrite_quarters(df: DataFrame, path: str) -> None:
    """Replace the quarters that ``df`` has rows of in a feature table at ``path``; others keep their files."""
    writer = df.repartition("fy_quarter").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy("fy_quarter").parquet(path)


def export_csv(df: DataFrame, path: str, run_date: date | None = None) -> str:
    """Write with header below ``path``; ``run_date`` marks the run in the name. Returns the folder."""
    target = path if run_date is None else f"{path}_{run_date.isoformat()}"
    df.write.csv(target, header=True)
    return target


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back.

    Later plans then start from files with a known size and skippable row groups.
    """
    path = run_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
