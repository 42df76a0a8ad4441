"""Append-only tables whose batches count once they are committed.

    path/data/<folder>/...     the rows of one attempt to write a batch
    path/commits/<batch>       names the folder that counts for the batch

A commit file is created only if there is none of its name, which file systems do atomically.  So a batch that is
written twice, by a retry or by two writers, is read once, and a write that ends before its commit is never read.
"""

from urllib.parse import quote
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def _place(spark: SparkSession, path: str):
    """A Hadoop path and its file system."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _commit_path(path: str, batch: str) -> str:
    return f"{path}/commits/{quote(batch, safe='')}"


def is_committed(spark: SparkSession, path: str, batch: str) -> bool:
    place, system = _place(spark, _commit_path(path, batch))
    return system.exists(place)


def write_attempt(df: DataFrame, path: str) -> str:
    """Write the rows of a batch to a folder of its own, which nobody reads yet; returns the folder's name."""
    folder = uuid4().hex
    df.write.parquet(f"{path}/data/{folder}")
    return folder


def commit(spark: SparkSession, path: str, batch: str, folder: str) -> bool:
    """Make the folder the one that counts for the batch; False where the batch is committed already."""
    place, system = _place(spark, _commit_path(path, batch))
    try:
        stream = system.create(place, False)
    except Exception:
        if system.exists(place):
            return False
        raise
    try:
        stream.write(bytearray(f"{folder}\n".encode()))
    finally:
        stream.close()
    return True


def append(df: DataFrame, path: str, batch: str) -> bool:
    """Write and commit a batch; False, and nothing is written, where a batch of this name is committed."""
    spark = df.sparkSession
    if is_committed(spark, path, batch):
        return False
    return commit(spark, path, batch, write_attempt(df, path))


def _folders(spark: SparkSession, path: str) -> list[str]:
    """The committed folders, one per batch; an unfinished commit file names none."""
    place, system = _place(spark, f"{path}/commits")
    if not system.exists(place):
        return []
    return sorted(r.value for r in spark.read.text(f"{path}/commits").filter(F.length("value") > 0).collect())


def read(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """The rows of all committed batches; none while nothing is committed."""
    folders = [f"{path}/data/{folder}" for folder in _folders(spark, path)]
    return spark.read.schema(schema).parquet(*folders) if folders else spark.createDataFrame([], schema)


def uncommitted(spark: SparkSession, path: str) -> list[str]:
    """Folders that no commit names: writes that are under way, were overtaken, or failed."""
    place, system = _place(spark, f"{path}/data")
    there = [s.getPath().getName() for s in system.listStatus(place)] if system.exists(place) else []
    return sorted(set(there) - set(_folders(spark, path)))


def remove_uncommitted(spark: SparkSession, path: str) -> int:
    """Delete those folders, for a time when no writer is at work; returns their number."""
    folders = uncommitted(spark, path)
    for folder in folders:
        place, system = _place(spark, f"{path}/data/{folder}")
        system.delete(place, True)
    return len(folders)
