"""Raw demand rows: the file reader and the mapping of the star-schema tables to demand rows."""

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from demandspark.functions.guards import ensure, nan_to_null, require_columns
from demandspark.schemas import BASELINE_SCHEMA, FEATURE_SCHEMA, RAW_COLUMNS, RAW_SCHEMA, SILVER_SCHEMA

# A total order of the lineitem rows: no two rows of one (date, store, SKU) key tie on it.
INGEST_ORDER = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_discount")

# Category names, in the order used by the mapping.
CATEGORIES = ("grocery", "home", "personal_care", "seasonal")


def read_raw(spark: SparkSession, path: str, fmt: str = "parquet", strict: bool = False) -> DataFrame:
    """Scan raw demand rows and project them to the contract.

    All contract columns must exist; extra columns are pruned from the scan.  Dates in text form are
    parsed and an unreadable date stops the job.  `strict` runs one small job that rejects an empty input.
    """
    if fmt not in ("csv", "parquet"):
        raise ValueError("fmt must be csv or parquet")
    reader = spark.read.option("header", True) if fmt == "csv" else spark.read
    frame = reader.csv(path) if fmt == "csv" else reader.parquet(path)
    require_columns(frame, RAW_COLUMNS, "raw demand data")
    frame = conform(frame)
    if strict and frame.isEmpty():
        raise ValueError("raw demand data is empty")
    return frame


def conform(frame: DataFrame) -> DataFrame:
    """Project to the nine contract columns with their declared types; NaN becomes NULL."""
    require_columns(frame, RAW_COLUMNS, "raw demand data")
    typed = frame.select(
        *[
            (F.to_date(f.name) if f.name == "date" else F.col(f.name).cast(f.dataType)).alias(f.name)
            for f in RAW_SCHEMA.fields
        ]
    )
    return nan_to_null(typed)


def read_silver(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(SILVER_SCHEMA).parquet(path)


def read_features(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(FEATURE_SCHEMA).parquet(path)


def read_baseline(spark: SparkSession, path: str, by: Sequence[str] = ("model_version",)) -> DataFrame:
    """Stored baselines, JSON lines with the keys `by`; fields that a file lacks are NULL."""
    keys = [StructField(c, StringType()) for c in by]
    return spark.read.schema(StructType([*keys, *BASELINE_SCHEMA.fields])).json(path)


def check_not_empty(df: DataFrame, message: str) -> DataFrame:
    """One-row table with the row count of `df`; computing it fails when `df` has no rows."""
    return df.agg(F.count(F.lit(1)).alias("rows")).filter(ensure(F.col("rows") > 0, message))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def demand_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One raw demand row per line item, plus the ingest-order columns.

    The dimension joins carry no broadcast hint: Spark broadcasts a side only when its size statistics
    are below the configured threshold and otherwise uses a skew-aware sort-merge join.  Each table joins the lines
    by itself, because the size estimate of two joined tables is their product, which would shuffle the lines.
    """
    lines = table(spark, sf_dir, "lineitem")
    stores = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    regions = table(spark, sf_dir, "nation").select(
        "n_nationkey", F.concat(F.lit("store_"), F.lpad(F.col("n_regionkey").cast("string"), 2, "0")).alias("store_id")
    )
    category = F.element_at(
        F.array(*[F.lit(c) for c in CATEGORIES]),
        (F.substring("p_brand", 7, 10).cast("int") % len(CATEGORIES)) + 1,
    )
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_retailprice", category.alias("category"))
    return (
        lines.join(stores, F.col("l_suppkey") == F.col("s_suppkey"))
        .join(regions, F.col("s_nationkey") == F.col("n_nationkey"))
        .join(parts, F.col("l_partkey") == F.col("p_partkey"))
        .select(
            F.col("l_shipdate").cast("date").alias("date"),
            "store_id",
            F.col("p_brand").alias("sku_id"),
            "category",
            F.col("p_retailprice").alias("price"),
            F.when(F.col("l_discount") >= 0.08, 1).otherwise(0).alias("promotion"),
            F.when(F.col("l_quantity") <= 2, 1).otherwise(0).alias("stockout"),
            (F.lit(55.0) + F.month("l_shipdate")).alias("temperature"),
            F.col("l_quantity").cast("bigint").alias("units_sold"),
            *INGEST_ORDER,
        )
    )
