"""Bronze and silver tables."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from demandspark.functions.guards import floor_at, require_columns
from demandspark.schemas import KEY_COLUMNS, RAW_COLUMNS, SERIES_COLUMNS


def bronze(raw: DataFrame, ingest_order: Sequence[str]) -> DataFrame:
    """Keep the first row, in ingest order, of every (date, store, SKU).

    `ingest_order` must be a total order within a key.  The `row = 1` filter lets Spark keep one row per
    key and input partition before the shuffle, so a heavily repeated key never travels as a whole.
    Each input partition is sorted for that, so the rows are dealt out first, by a hash of the key, into partitions
    of the advisory size of adaptive execution: the sort of a task does not grow with the table, and
    adaptive execution cuts the partition of a heavily repeated key between the tasks that wrote it.
    """
    require_columns(raw, RAW_COLUMNS + tuple(ingest_order), "raw demand data")
    first = Window.partitionBy(*KEY_COLUMNS).orderBy(*ingest_order)
    return (
        raw.select(*dict.fromkeys(RAW_COLUMNS + tuple(ingest_order)))
        .withColumn("__deal", F.xxhash64(*KEY_COLUMNS))
        .hint("rebalance", "__deal")
        .drop("__deal")
        .withColumn("__position", F.row_number().over(first))
        .filter(F.col("__position") == 1)
        .select(*RAW_COLUMNS)
    )


def bronze_checks(raw: DataFrame) -> DataFrame:
    """Rows kept, columns kept and duplicates removed, from one hash aggregation of the keys."""
    copies = raw.groupBy(*KEY_COLUMNS).agg(F.count(F.lit(1)).alias("copies"))
    return copies.agg(
        F.count(F.lit(1)).alias("rows"),
        F.lit(",".join(RAW_COLUMNS)).alias("columns"),
        (F.coalesce(F.sum("copies"), F.lit(0)) - F.count(F.lit(1))).alias("duplicates_removed"),
    )


def sort_bronze(bronze_table: DataFrame) -> DataFrame:
    return bronze_table.orderBy(*[F.col(c).asc_nulls_last() for c in KEY_COLUMNS])


def sort_series(frame: DataFrame) -> DataFrame:
    return frame.orderBy(*[F.col(c).asc_nulls_last() for c in SERIES_COLUMNS + ("date",)])


def clip_values(bronze_table: DataFrame) -> DataFrame:
    """Floor units at zero and prices at one cent; missing values stay missing."""
    return bronze_table.withColumns(
        {
            "units_sold": floor_at(F.col("units_sold"), 0),
            "price": floor_at(F.col("price"), 0.01),
        }
    )


def add_calendar(frame: DataFrame) -> DataFrame:
    """Weekend flag, day of week (Monday = 0), month and ISO week."""
    weekday = F.weekday("date")
    return frame.withColumns(
        {
            "is_weekend": weekday.isin(5, 6).cast("int"),
            "day_of_week": weekday,
            "month": F.month("date"),
            "week_of_year": F.weekofyear("date"),
        }
    )


def silver(bronze_table: DataFrame) -> DataFrame:
    """Clean values, revenue and calendar columns; a projection without a shuffle."""
    require_columns(bronze_table, RAW_COLUMNS, "bronze table")
    clipped = clip_values(bronze_table.select(*RAW_COLUMNS))
    return add_calendar(clipped.withColumn("revenue", F.col("price") * F.col("units_sold")))


def silver_check_columns() -> dict[str, Column]:
    """Checks of a silver table, as aggregates usable in `agg` or `observe`."""
    return {
        "rows": F.count(F.lit(1)),
        "min_date": F.min("date"),
        "max_date": F.max("date"),
        "negative_units": F.count_if(F.col("units_sold") < 0),
    }


def silver_checks(silver_table: DataFrame) -> DataFrame:
    return silver_table.agg(*[expr.alias(name) for name, expr in silver_check_columns().items()])


def layer_manifest(raw: DataFrame, silver_table: DataFrame) -> DataFrame:
    """One row per layer with its checks as text, without writing the layers."""
    kept = bronze_checks(raw).select(
        F.lit("bronze").alias("layer"),
        F.lit("raw").alias("source"),
        F.explode(
            F.array(
                F.struct(F.lit("rows").alias("check"), F.col("rows").cast("string").alias("value")),
                F.struct(F.lit("columns").alias("check"), F.col("columns").alias("value")),
                F.struct(F.lit("duplicates_removed").alias("check"), F.col("duplicates_removed").cast("string").alias("value")),
            )
        ).alias("entry"),
    )
    clean = silver_checks(silver_table).select(
        F.lit("silver").alias("layer"),
        F.lit("bronze").alias("source"),
        F.explode(
            F.array(
                *[
                    F.struct(F.lit(name).alias("check"), F.col(name).cast("string").alias("value"))
                    for name in silver_check_columns()
                ]
            )
        ).alias("entry"),
    )
    return kept.unionByName(clean).select("layer", "source", "entry.check", "entry.value")
