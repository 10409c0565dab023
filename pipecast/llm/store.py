"""Reading the given tables and cutting lineage in the shared folder."""

from __future__ import annotations

import gc
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pipecast.sources.sinks import run_folder

# The folders that each running operator has kept, innermost last.
_kept: list[list[str]] = []

DOCUMENT_COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def keep(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: a lost executor then costs a re-read.

    Inside an operator marked ``freeing`` the folder goes when the operator's result is stored.
    """
    path = run_folder(df.sparkSession, name)
    df.write.parquet(path)
    if _kept:
        _kept[-1].append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Delete at the end what is kept inside; what comes out is stored elsewhere or a plain number."""
    _kept.append([])
    try:
        yield
    finally:
        folders = _kept.pop()
        gc.collect()
        spark.sparkContext._jvm.System.gc()
        for folder in folders:
            _delete(spark, folder)


def freeing(operator: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """Store an operator's result, then delete all that it kept on the way.

    Every table lives until its readers' results are stored, so a lost executor never needs a deleted
    one. Shuffle files go once nothing on the driver refers to them, hence the collection of garbage.
    """

    @wraps(operator)
    def run(docs: DataFrame, *args, **options) -> DataFrame:
        spark = docs.sparkSession
        with scratch(spark):
            result = operator(docs, *args, **options)
            path = run_folder(spark, operator.__name__)
            result.write.parquet(path)
            schema = result.schema
            del result
        if _kept:
            _kept[-1].append(path)
        return spark.read.schema(schema).parquet(path)

    return run


def _delete(spark: SparkSession, folder: str) -> None:
    """Delete a folder of this run through Spark's file systems."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def unused(df: DataFrame, name: str) -> str:
    """``name``, made longer until ``df`` has no such column."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def fold(doc_id="doc_id", folds: int = 5):
    """crc32 of the id as text, modulo ``folds``; null ids give null."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % folds
