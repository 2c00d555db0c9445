"""Intermediate tables in the folder all executors share."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_SETTING = "spark.checkpoint.dir"
_WAREHOUSE = "spark.sql.warehouse.dir"
#: Spark's own setting to drop the shuffle files of a query when it ends.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_folder(spark: SparkSession) -> str:
    """Folder named in ``spark.checkpoint.dir``, or else one in the warehouse.

    The warehouse is the session's own storage: on a cluster every executor
    reaches it. The caller's checkpoint folder is read and never set.
    """
    folder = spark.conf.get(_SETTING, None) or spark.sparkContext.getCheckpointDir()
    return folder or f"{spark.conf.get(_WAREHOUSE).rstrip('/')}/ordermill"


def new_path(spark: SparkSession, label: str) -> str:
    """Fresh path in the shared folder; never reused, so nothing is overwritten."""
    return f"{shared_folder(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def settle(df: DataFrame, label: str, compression: str | None = None) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    This runs a job. It cuts the lineage in a way that survives lost executors,
    and it gives the planner the true size of the table: joins against it are
    broadcast below ``spark.sql.autoBroadcastJoinThreshold`` and shuffled, with
    skewed partitions split at run time, above. Nothing is broadcast by hint.
    """
    path = new_path(df.sparkSession, label)
    df.write.parquet(path, compression=compression)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """Spark drops the shuffle files of each query made within when that query ends.

    For queries that run once: their shuffles only fill the disk afterwards, until the
    driver's garbage collector meets them. The caller's setting is put back.
    """
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_CLEANUP)
        else:
            spark.conf.set(_CLEANUP, before)


def settle_and_free(df: DataFrame, label: str, compression: str | None = None) -> DataFrame:
    """As ``settle``; the table stands for the job, whose shuffle files are dropped."""
    with shuffles_freed(df.sparkSession):
        return settle(df, label, compression)


def forget(spark: SparkSession, path: str) -> None:
    """Delete a table that was written to ``path``."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


class Scratch:
    """Tables of one job in the shared folder, deleted when the job ends.

    >>> with Scratch(spark) as scratch:
    ...     orders = scratch.settle(orders, "orders")
    """

    def __init__(self, spark: SparkSession) -> None:
        self._spark = spark
        self._paths: list[str] = []

    def __enter__(self) -> Scratch:
        return self

    def __exit__(self, *_: object) -> None:
        for path in self._paths:
            forget(self._spark, path)

    def settle(self, df: DataFrame, label: str) -> DataFrame:
        """As ``settle``, for as long as the job runs."""
        path = new_path(self._spark, label)
        self._paths.append(path)
        df.write.parquet(path)
        return self._spark.read.schema(df.schema).parquet(path)
