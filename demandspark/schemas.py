"""Table contracts: column names, types and keys."""

from pyspark.sql import types as T

# The column names of the raw, silver and feature tables, in table order.
RAW_COLUMNS = (
    "date",
    "store_id",
    "sku_id",
    "category",
    "price",
    "promotion",
    "stockout",
    "temperature",
    "units_sold",
)

CALENDAR_COLUMNS = ("is_weekend", "day_of_week", "month", "week_of_year")

FEATURE_COLUMNS = (
    "price",
    "promotion",
    "stockout",
    "temperature",
    "is_weekend",
    "day_sin",
    "day_cos",
    "month_sin",
    "month_cos",
    "lag_1_units",
    "lag_7_units",
    "lag_14_units",
    "rolling_7_mean_units",
    "rolling_14_mean_units",
    "rolling_28_mean_units",
    "rolling_7_std_units",
    "rolling_14_std_units",
    "rolling_mean_delta_7_28",
    "price_vs_sku_avg",
    "promotion_price",
    "sku_avg_units",
    "store_avg_units",
)

CATEGORICAL_COLUMNS = ("store_id", "sku_id", "category")

KEY_COLUMNS = ("date", "store_id", "sku_id")
SERIES_COLUMNS = ("store_id", "sku_id")
TARGET_COLUMN = "units_sold"

# What the feature operators read from a silver table.
SILVER_REQUIRED = RAW_COLUMNS + ("is_weekend", "day_of_week", "month")

RAW_SCHEMA = T.StructType(
    [
        T.StructField("date", T.DateType()),
        T.StructField("store_id", T.StringType()),
        T.StructField("sku_id", T.StringType()),
        T.StructField("category", T.StringType()),
        T.StructField("price", T.DoubleType()),
        T.StructField("promotion", T.IntegerType()),
        T.StructField("stockout", T.IntegerType()),
        T.StructField("temperature", T.DoubleType()),
        T.StructField("units_sold", T.LongType()),
    ]
)

SILVER_SCHEMA = T.StructType(
    RAW_SCHEMA.fields
    + [
        T.StructField("revenue", T.DoubleType()),
        T.StructField("is_weekend", T.IntegerType()),
        T.StructField("day_of_week", T.IntegerType()),
        T.StructField("month", T.IntegerType()),
        T.StructField("week_of_year", T.IntegerType()),
    ]
)

# A feature table has its silver columns, the features that silver lacks, and the name of the series.
FEATURE_SCHEMA = T.StructType(
    SILVER_SCHEMA.fields
    + [
        T.StructField(c, T.LongType() if c.startswith("lag_") else T.DoubleType())
        for c in FEATURE_COLUMNS
        if c not in SILVER_SCHEMA.names
    ]
    + [T.StructField("entity_id", T.StringType())]
)

PROFILE_SCHEMA = T.StructType(
    [
        T.StructField("mean", T.DoubleType()),
        T.StructField("std", T.DoubleType()),
        T.StructField("bin_edges", T.ArrayType(T.DoubleType())),
        T.StructField("expected_share", T.ArrayType(T.DoubleType())),
    ]
)

BASELINE_SCHEMA = T.StructType(
    [
        T.StructField("target", PROFILE_SCHEMA),
        T.StructField("prediction_reference", PROFILE_SCHEMA),
        T.StructField(
            "features",
            T.MapType(
                T.StringType(),
                T.StructType([T.StructField("mean", T.DoubleType()), T.StructField("std", T.DoubleType())]),
            ),
        ),
        T.StructField("reference_metrics", T.StructType([T.StructField("mae", T.DoubleType())])),
        T.StructField(
            "prediction_interval", T.StructType([T.StructField("target_coverage", T.DoubleType())])
        ),
    ]
)
