"""The shared folder for intermediate tables."""

import tempfile
from collections.abc import Iterator
from contextlib import contextmanager
from functools import cache

from pyspark.sql import SparkSession

_REMOVE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@cache
def _local_folder() -> tempfile.TemporaryDirectory:
    return tempfile.TemporaryDirectory(prefix="demandspark-")


def shared_folder(spark: SparkSession) -> str | None:
    """The folder in spark.checkpoint.dir; where that is unset, a temporary one in a local session and None on a cluster."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    return _local_folder().name if spark.sparkContext.master.startswith("local") else None


def allow_checkpoints(spark: SparkSession) -> None:
    """Give the context the shared folder for `checkpoint()` where it has none."""
    folder = shared_folder(spark)
    if folder and spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(folder)


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Queries that run inside remove their shuffle files when they end; else those stay until the driver collects its garbage."""
    before = spark.conf.get(_REMOVE_SHUFFLES, "false")
    spark.conf.set(_REMOVE_SHUFFLES, "true")
    try:
        yield
    finally:
        spark.conf.set(_REMOVE_SHUFFLES, before)
