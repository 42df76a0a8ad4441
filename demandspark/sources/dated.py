"""Tables in month partitions with a manifest of their dates, which answers questions about dates without a scan.

    path/rows/date_bucket=2026-01/...       the rows, in date order inside a month
    path/manifest/date_bucket=2026-01/...   min_date, max_date and rows of the month

A write replaces the months that it brings and no others.  The manifest of those months follows the rows; a reader that
takes its bounds from the manifest never misses rows of a month that was not being rewritten.
"""

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from demandspark.functions.guards import require_columns
from demandspark.operators.splits import slice_bounds

BUCKET = "date_bucket"
MONTH_FORMAT = "yyyy-MM"


def _bucket(date: Column) -> Column:
    return F.date_format(date, MONTH_FORMAT)


def _replace(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(BUCKET).parquet(path)


def write_dated(df: DataFrame, path: str, order: Sequence[str] = ("store_id", "sku_id")) -> None:
    """Write the rows of `df` in place of the months they belong to; rows without a date make a bucket of their own.

    Rows are dealt by ranges of month and date, so a month of any size is written by many tasks, and a task writes few months.
    The manifest is read from the written months, one narrow column.
    """
    require_columns(df, ["date", *order], "dated table")
    bucketed = df.withColumn(BUCKET, _bucket(F.col("date")))
    dealt = bucketed.repartitionByRange(BUCKET, "date", *order).sortWithinPartitions(BUCKET, "date", *order)
    seen = Observation()
    _replace(dealt.observe(seen, F.min(BUCKET).alias("low"), F.max(BUCKET).alias("high")), f"{path}/rows")
    low, high = seen.get["low"], seen.get["high"]
    if low is None:
        return
    written = df.sparkSession.read.schema(bucketed.schema).parquet(f"{path}/rows").filter(F.col(BUCKET).between(low, high))
    counted = written.groupBy(BUCKET).agg(F.min("date").alias("min_date"), F.max("date").alias("max_date"), F.count("*").alias("rows"))
    _replace(counted.coalesce(1), f"{path}/manifest")


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """(date_bucket, min_date, max_date, rows), a row per month."""
    return spark.read.schema(f"min_date date, max_date date, rows bigint, {BUCKET} string").parquet(f"{path}/manifest")


def read_dated(
    spark: SparkSession, path: str, low: Column | dt.date | None = None, high: Column | dt.date | None = None
) -> DataFrame:
    """The rows from `low` to before `high`; only files of the months between them are opened.

    The bounds may be dates or scalar subqueries.
    """
    rows = spark.read.option("basePath", f"{path}/rows").parquet(f"{path}/rows")
    rows = rows.withColumn(BUCKET, F.col(BUCKET).cast("string"))
    for bound, after in ((low, True), (high, False)):
        if bound is not None:
            bound = bound if isinstance(bound, Column) else F.lit(bound)
            day, month = F.col("date"), F.col(BUCKET)
            rows = rows.filter(day >= bound if after else day < bound)
            rows = rows.filter(month >= _bucket(bound) if after else month <= _bucket(bound))
    return rows.drop(BUCKET)


def read_slice(spark: SparkSession, path: str, name: str, validation_days: int = 21, test_days: int = 21) -> DataFrame:
    """One time split, like `splits.time_slice`, with the last date from the manifest: the rows are not scanned for it."""
    last = read_manifest(spark, path).agg(F.max("max_date").alias("last_date"))
    low, high = slice_bounds(last, name, validation_days, test_days)
    return read_dated(spark, path, low, high)
