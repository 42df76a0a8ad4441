"""Features of new days from small state tables instead of the history.

What a later row needs of a series are its last 28 rows and the sum and count of its units; of a store, the sum and count of
its daily means; of a SKU, the sum and count of its prices.  `advance` takes in a batch of whole days: it reads these tables
and the batch, and returns the features of the batch and the tables for the next one.  The result equals that of the batch
operators, with the mean price over earlier dates only.
"""

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from demandspark.functions.guards import ensure, require_columns
from demandspark.operators.features import (
    EXPANDING_MINIMUM,
    lag_columns,
    rolling_mean_columns,
    rolling_std_columns,
    series_window,
    store_daily,
)
from demandspark.schemas import KEY_COLUMNS, SERIES_COLUMNS, TARGET_COLUMN

TAIL_ROWS = 28  # the longest window
SERIES_STATE = "store_id string, sku_id string, tail array<struct<date: date, units_sold: bigint>>, total bigint, n bigint, last_date date"
STORE_STATE = "store_id string, total double, n bigint, last_date date"
PRICE_STATE = "sku_id string, total double, n bigint"


@dataclass(frozen=True)
class FeatureState:
    """A row per series with its tail, a row per store, a row per SKU."""

    series: DataFrame
    stores: DataFrame
    prices: DataFrame

    def write(self, path: str) -> "FeatureState":
        """Store the tables under `path` and read them back, which cuts them from the batches they came from."""
        for name in ("series", "stores", "prices"):
            getattr(self, name).write.parquet(f"{path}/{name}")
        return read_state(self.series.sparkSession, path)


def empty_state(spark: SparkSession) -> FeatureState:
    return FeatureState(*(spark.createDataFrame([], schema) for schema in (SERIES_STATE, STORE_STATE, PRICE_STATE)))


def read_state(spark: SparkSession, path: str) -> FeatureState:
    schemas = {"series": SERIES_STATE, "stores": STORE_STATE, "prices": PRICE_STATE}
    return FeatureState(*(spark.read.schema(schema).parquet(f"{path}/{name}") for name, schema in schemas.items()))


def _mean(total: Column, n: Column, minimum: int = 1) -> Column:
    return F.when(n >= minimum, F.try_divide(total, n))


def _later(last_date: Column) -> Column:
    return ensure(last_date.isNull() | (F.col("date") > last_date), "the batch has rows of days that were taken in before")


def _series_rows(rows: DataFrame, state: DataFrame) -> DataFrame:
    """The batch's rows and, with `__old`, the tails of their series; `__total` and `__n` stand for what lies before the tail."""
    touched = state.join(rows.select(*SERIES_COLUMNS).distinct(), list(SERIES_COLUMNS), "left_semi")
    inside = F.aggregate("tail", F.lit(0).cast("bigint"), lambda sum_, r: sum_ + F.coalesce(r["units_sold"], F.lit(0).cast("bigint")))
    counted = F.size(F.filter("tail", lambda r: r["units_sold"].isNotNull()))
    before = touched.select(
        *SERIES_COLUMNS, "last_date", (F.col("total") - inside).alias("__total"), (F.col("n") - counted).alias("__n"), F.inline("tail")
    )
    new = rows.withColumn("__old", F.lit(False))
    return new.unionByName(before.withColumn("__old", F.lit(True)), allowMissingColumns=True)


def _series_features(rows: DataFrame, state: DataFrame) -> DataFrame:
    window = series_window()
    prior = window.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*SERIES_COLUMNS)
    units = F.col(TARGET_COLUMN)
    carried = {c: F.coalesce(F.max(c).over(whole), F.lit(0)) for c in ("__total", "__n")}
    total = carried["__total"] + F.coalesce(F.sum(units).over(prior), F.lit(0))
    columns = {
        **lag_columns(window),
        **rolling_mean_columns(window),
        **rolling_std_columns(window),
        "sku_avg_units": _mean(total.cast("double"), carried["__n"] + F.count(units).over(prior), EXPANDING_MINIMUM),
        "__last": F.max("last_date").over(whole),
        "__copies": F.count("date").over(window.rangeBetween(Window.currentRow, Window.currentRow)),
    }
    frame = _series_rows(rows, state).withColumns(columns)
    sound = _later(F.col("__last")) & ensure(F.col("__copies") <= 1, "silver table has two rows for one date, store and SKU")
    found = frame.filter("not __old").filter(sound)
    delta = F.col("rolling_7_mean_units") - F.col("rolling_28_mean_units")
    return found.withColumn("rolling_mean_delta_7_28", delta).drop("__old", "__total", "__n", "__last", "__copies", "last_date")


def _next_series(rows: DataFrame, state: DataFrame) -> DataFrame:
    """Tails of at most 28 rows and sums, of the series in the batch and of those that are not."""
    units = F.col(TARGET_COLUMN)
    newest = Window.partitionBy(*SERIES_COLUMNS).orderBy(F.col("date").desc())
    kept = rows.withColumn("__place", F.row_number().over(newest)).filter(F.col("__place") <= TAIL_ROWS)
    tails = kept.groupBy(*SERIES_COLUMNS).agg(F.array_sort(F.collect_list(F.struct("date", TARGET_COLUMN))).alias("__tail"))
    sums = rows.groupBy(*SERIES_COLUMNS).agg(F.sum(units).alias("__total"), F.count(units).alias("__n"), F.max("date").alias("__last"))
    joined = state.join(tails.join(sums, list(SERIES_COLUMNS)), list(SERIES_COLUMNS), "full")
    none = F.array().cast("array<struct<date: date, units_sold: bigint>>")
    tail = F.concat(F.coalesce("tail", none), F.coalesce("__tail", none))
    add = lambda old, new: F.coalesce(F.col(old), F.lit(0)) + F.coalesce(F.col(new), F.lit(0))
    return joined.select(
        *SERIES_COLUMNS,
        F.slice(tail, F.greatest(F.size(tail) - TAIL_ROWS + 1, F.lit(1)), TAIL_ROWS).alias("tail"),
        add("total", "__total").cast("bigint").alias("total"),
        add("n", "__n").cast("bigint").alias("n"),
        F.greatest("last_date", "__last").alias("last_date"),
    )


def _running(daily: DataFrame, key: str, state: DataFrame, total: str, n: str) -> DataFrame:
    """(key, date, __total, __n): sums over all days before each day, those of the state included."""
    earlier = Window.partitionBy(key).orderBy("date").rowsBetween(Window.unboundedPreceding, -1)
    carried = state.select(key, F.col("total").alias("__t"), F.col("n").alias("__c"), *(["last_date"] if "last_date" in state.columns else []))
    joined = daily.join(carried, key, "left")
    if "last_date" in state.columns:
        joined = joined.filter(_later(F.col("last_date")))
    zero = F.lit(0)
    return joined.select(
        key,
        "date",
        (F.coalesce("__t", zero) + F.coalesce(F.sum(total).over(earlier), zero)).alias("__total"),
        (F.coalesce("__c", zero) + F.coalesce(F.sum(n).over(earlier), zero)).alias("__n"),
    )


def _next_sums(daily: DataFrame, key: str, state: DataFrame, total: str, n: str) -> DataFrame:
    wanted = [F.sum(total).alias("__t"), F.sum(n).alias("__c"), F.max("date").alias("__last")]
    joined = state.join(daily.groupBy(key).agg(*wanted), key, "full")
    add = lambda old, new: F.coalesce(F.col(old), F.lit(0)) + F.coalesce(F.col(new), F.lit(0))
    last = [F.greatest("last_date", "__last").alias("last_date")] if "last_date" in state.columns else []
    return joined.select(key, add("total", "__t").cast("double").alias("total"), add("n", "__c").cast("bigint").alias("n"), *last)


def advance(silver: DataFrame, state: FeatureState) -> tuple[DataFrame, FeatureState]:
    """Features of a batch of whole days later than any before, and the next state (not yet written).

    The features are the silver columns with lags, rolling means and deviations, sku_avg_units, store_avg_units and
    price_vs_sku_avg (earlier dates).  Rows that lack a part of the key are left out.  A day that was taken in before, for its
    series or its store, stops the job.
    """
    require_columns(silver, [*KEY_COLUMNS, "price", TARGET_COLUMN], "silver table")
    rows = silver.withColumn("date", F.to_date("date")).dropna(subset=list(KEY_COLUMNS))
    stores = store_daily(rows).select(
        "store_id", "date", F.col("store_day_units").alias("__sum"), F.col("store_day_units").isNotNull().cast("bigint").alias("__count")
    )
    prices = rows.groupBy("sku_id", "date").agg(F.sum("price").alias("__sum"), F.count("price").alias("__count"))
    by_store = _running(stores, "store_id", state.stores, "__sum", "__count").select(
        "store_id", "date", _mean(F.col("__total"), F.col("__n"), EXPANDING_MINIMUM).alias("store_avg_units")
    )
    by_price = _running(prices, "sku_id", state.prices, "__sum", "__count").select(
        "sku_id", "date", _mean(F.col("__total"), F.col("__n")).alias("__mean_price")
    )
    joined = rows.join(by_store, ["store_id", "date"], "left").join(by_price, ["sku_id", "date"], "left")
    placed = joined.withColumn("price_vs_sku_avg", F.col("price") - F.col("__mean_price")).drop("__mean_price")
    following = FeatureState(
        _next_series(rows, state.series),
        _next_sums(stores, "store_id", state.stores, "__sum", "__count"),
        _next_sums(prices, "sku_id", state.prices, "__sum", "__count"),
    )
    return _series_features(placed, state.series), following
