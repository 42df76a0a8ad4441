"""Time-aware features.

All series windows are row based and end at the previous row, so a row never sees its own target.
They share one partitioning and one order, which Spark plans as one exchange and one sort.  The input
must be unique on (date, store, SKU), as a bronze table is: a series then holds at most one row per
calendar day, which bounds every window partition by the length of the calendar, whatever the table
size.  The requirement is checked at run time inside the same window.
"""

from math import pi

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from demandspark.functions.guards import ensure, require_columns
from demandspark.schemas import FEATURE_COLUMNS, SERIES_COLUMNS, SILVER_REQUIRED, TARGET_COLUMN

LAGS = (1, 7, 14)
# window length -> fewest non-missing rows that give a value
MEAN_WINDOWS = {7: 3, 14: 5, 28: 7}
STD_WINDOWS = {7: 3, 14: 5}
EXPANDING_MINIMUM = 3


def series_window() -> WindowSpec:
    return Window.partitionBy(*SERIES_COLUMNS).orderBy(F.col("date").asc_nulls_last())


def _guarded(aggregate: Column, value: Column, frame: WindowSpec, minimum: int) -> Column:
    return F.when(F.count(value).over(frame) >= minimum, aggregate.over(frame))


def lag_columns(window: WindowSpec | None = None) -> dict[str, Column]:
    window = window or series_window()
    return {f"lag_{k}_units": F.lag(TARGET_COLUMN, k).over(window) for k in LAGS}


def rolling_mean_columns(window: WindowSpec | None = None) -> dict[str, Column]:
    window = window or series_window()
    units = F.col(TARGET_COLUMN)
    return {
        f"rolling_{n}_mean_units": _guarded(F.avg(units), units, window.rowsBetween(-n, -1), minimum)
        for n, minimum in MEAN_WINDOWS.items()
    }


def rolling_std_columns(window: WindowSpec | None = None) -> dict[str, Column]:
    window = window or series_window()
    units = F.col(TARGET_COLUMN)
    return {
        f"rolling_{n}_std_units": _guarded(F.stddev_samp(units), units, window.rowsBetween(-n, -1), minimum)
        for n, minimum in STD_WINDOWS.items()
    }


def expanding_mean(value: Column, window: WindowSpec, minimum: int = EXPANDING_MINIMUM) -> Column:
    return _guarded(F.avg(value), value, window.rowsBetween(Window.unboundedPreceding, -1), minimum)


def cyclic_columns() -> dict[str, Column]:
    day = F.lit(2.0 * pi) * F.col("day_of_week") / 7.0
    month = F.lit(2.0 * pi) * F.col("month") / 12.0
    return {"day_sin": F.sin(day), "day_cos": F.cos(day), "month_sin": F.sin(month), "month_cos": F.cos(month)}


def add_series_features(silver: DataFrame, check_days: bool = True) -> DataFrame:
    """Lags, rolling means and deviations, the window delta and the expanding series mean.

    `check_days` stops the job when a series has two rows for one day; it costs one more column in the
    same window.
    """
    window = series_window()
    columns: dict[str, Column] = {
        **lag_columns(window),
        **rolling_mean_columns(window),
        **rolling_std_columns(window),
        "sku_avg_units": expanding_mean(F.col(TARGET_COLUMN), window),
    }
    if check_days:
        # Rows of the same day, from the window alone: a check that read `date` itself could be merged
        # with a caller's filter on `date` and then reject rows that filter was meant to drop.
        columns["__copies"] = F.count("date").over(window.rangeBetween(Window.currentRow, Window.currentRow))
    frame = silver.withColumns(columns).withColumn(
        "rolling_mean_delta_7_28", F.col("rolling_7_mean_units") - F.col("rolling_28_mean_units")
    )
    if not check_days:
        return frame
    unique = ensure(F.col("__copies") <= 1, "silver table has two rows for one date, store and SKU")
    return frame.filter(unique).drop("__copies")


def sku_price_means(silver: DataFrame) -> DataFrame:
    """Mean price per SKU over all stores and dates."""
    return silver.filter(F.col("sku_id").isNotNull()).groupBy("sku_id").agg(F.avg("price").alias("sku_avg_price"))


def prior_price_means(silver: DataFrame) -> DataFrame:
    """Mean price of a SKU over all earlier dates, per SKU and date; a window holds one row per date."""
    known = silver.filter(F.col("sku_id").isNotNull() & F.col("date").isNotNull())
    daily = known.groupBy("sku_id", "date").agg(F.sum("price").alias("__total"), F.count("price").alias("__n"))
    earlier = Window.partitionBy("sku_id").orderBy("date").rowsBetween(Window.unboundedPreceding, -1)
    mean = F.try_divide(F.sum("__total").over(earlier), F.sum("__n").over(earlier))
    return daily.select("sku_id", "date", mean.alias("sku_avg_price"))


def add_price_position(frame: DataFrame, silver: DataFrame | None = None, prior_only: bool = False) -> DataFrame:
    """`price_vs_sku_avg`: aggregate then join, so a popular SKU is never gathered in one task.

    The mean covers all dates, or with `prior_only` the dates before the row's own, which looks at no later price.
    """
    source = frame if silver is None else silver
    if prior_only:
        joined = join_many_to_one(frame, prior_price_means(source), ["sku_id", "date"])
        return joined.withColumn("price_vs_sku_avg", F.col("price") - F.col("sku_avg_price")).drop("sku_avg_price")
    means = sku_price_means(source)
    return (
        frame.join(means, "sku_id", "left")
        .withColumn("price_vs_sku_avg", F.col("price") - F.col("sku_avg_price"))
        .drop("sku_avg_price")
    )


def store_daily(silver: DataFrame) -> DataFrame:
    """Mean units per store and day; missing keys drop out."""
    return (
        silver.filter(F.col("store_id").isNotNull() & F.col("date").isNotNull())
        .groupBy("store_id", "date")
        .agg(F.avg(TARGET_COLUMN).alias("store_day_units"))
    )


def store_history(silver: DataFrame) -> DataFrame:
    """Expanding, unweighted mean of a store's earlier daily means."""
    window = Window.partitionBy("store_id").orderBy("date")
    return store_daily(silver).withColumn("store_avg_units", expanding_mean(F.col("store_day_units"), window))


def join_many_to_one(left: DataFrame, right: DataFrame, keys: list[str], strict: bool = False) -> DataFrame:
    """Left join whose right side must be unique on the keys; `strict` verifies it at run time.

    The check is one aggregation with map-side combine, so a heavily repeated key cannot overload a task.
    """
    if strict:
        copies = right.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies")).agg(F.max("copies")).scalar()
        right = right.filter(ensure(copies == 1, f"right side is not unique on {keys}"))
    return left.join(right, keys, "left")


def add_store_history(frame: DataFrame, silver: DataFrame | None = None) -> DataFrame:
    history = store_history(frame if silver is None else silver).select("store_id", "date", "store_avg_units")
    return join_many_to_one(frame, history, ["store_id", "date"])


def entity_id() -> Column:
    return F.concat(F.col("store_id"), F.lit("::"), F.col("sku_id"))


def drop_incomplete(frame: DataFrame) -> DataFrame:
    """Drop rows without a store, a SKU, the target or any of the numeric features."""
    complete = frame.dropna(subset=list(dict.fromkeys(FEATURE_COLUMNS + (TARGET_COLUMN,))))
    return complete.filter(F.col("store_id").isNotNull() & F.col("sku_id").isNotNull())


def build_features(silver: DataFrame, check_days: bool = True) -> DataFrame:
    """The feature table: silver columns, the numeric features and `entity_id`."""
    require_columns(silver, SILVER_REQUIRED, "silver table")
    frame = silver.withColumn("date", F.to_date("date"))
    # Both aggregates join the narrow rows, so that the wide ones are shuffled once, by the window.
    joined = add_store_history(add_price_position(frame), frame)
    series = add_series_features(joined, check_days)
    local = series.withColumns({**cyclic_columns(), "promotion_price": F.col("promotion") * F.col("price")})
    return drop_incomplete(local.withColumn("entity_id", entity_id()))


def build_reduced_features(silver: DataFrame) -> DataFrame:
    """The smaller feature set: Sunday = 0, no minimum row counts, and every column must be present."""
    window = series_window()
    units = F.col(TARGET_COLUMN)
    lags = {name: column for name, column in lag_columns(window).items() if name != "lag_14_units"}
    frames = {days: window.rowsBetween(-days, -1) for days in (7, 14)}
    means = {f"rolling_{days}_mean_units": F.avg(units).over(frame) for days, frame in frames.items()}
    spread = {"rolling_7_std_units": F.stddev_samp(units).over(frames[7])}
    dated = silver.withColumn("date", F.to_date("date"))
    calendar = {"day_of_week": F.dayofweek("date") - 1, "month": F.month("date")}
    complete = dated.withColumns(calendar).withColumns({**lags, **means, **spread}).dropna()
    return complete.withColumns({**cyclic_columns(), "entity_id": entity_id()})
