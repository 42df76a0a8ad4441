"""Batch scoring: predictions with version, time stamp, intervals and, if known, the actuals."""

from collections.abc import Callable, Mapping, Sequence
from urllib.parse import quote

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from demandspark.functions.guards import attach, ensure, join_on, require_columns
from demandspark.operators.conformal import add_intervals
from demandspark.operators.metrics import METRIC_COLUMNS, checked_aggregate, regression_metrics
from demandspark.operators.models import predict
from demandspark.operators.quantiles import quantiles
from demandspark.schemas import CATEGORICAL_COLUMNS, FEATURE_COLUMNS, TARGET_COLUMN

VERSION_COLUMNS = "version string, feature_columns array<string>, interval_radius double, coverage double"

Predictor = PipelineModel | Callable[[DataFrame], DataFrame]


def _forecast(predictor: Predictor, frame: DataFrame) -> DataFrame:
    raw = predict(predictor, frame) if isinstance(predictor, PipelineModel) else predictor(frame)
    return raw.withColumn("predicted_units", F.greatest(F.col("predicted_units"), F.lit(0.0)))


def batch_score(
    features: DataFrame,
    predictor: Predictor,
    model_version: str,
    scored_at: str,
    radius: DataFrame | float | None = None,
    coverage: float = 0.90,
) -> DataFrame:
    """Prediction log of a feature table.

    `scored_at` is the time stamp text to record, passed in so that a run can be repeated.  Forecasts are
    floored at zero; `actual_units` and `absolute_error` appear when the target column exists.
    """
    scored = _forecast(predictor, features)
    log = scored.select(
        "date",
        *CATEGORICAL_COLUMNS,
        *FEATURE_COLUMNS,
        F.lit(model_version).alias("model_version"),
        F.lit(scored_at).alias("prediction_timestamp"),
        "predicted_units",
        *([F.col(TARGET_COLUMN).cast("double").alias("actual_units")] if TARGET_COLUMN in features.columns else []),
    )
    if radius is not None:
        log = add_intervals(log, radius, coverage)
    if "actual_units" in log.columns:
        log = log.withColumn("absolute_error", F.abs(F.col("predicted_units") - F.col("actual_units")))
    return log


def _version_path(store: str, version: str) -> str:
    return f"{store}/{quote(version, safe='')}"


def save_version(
    spark: SparkSession,
    store: str,
    version: str,
    model: PipelineModel,
    feature_columns: Sequence[str],
    radius: float | None = None,
    coverage: float = 0.90,
) -> None:
    """Store a fitted model under its version, with the columns it reads and the radius of its calibration."""
    path = _version_path(store, version)
    model.write().overwrite().save(f"{path}/model")
    record = (version, list(feature_columns), None if radius is None else float(radius), coverage)
    spark.createDataFrame([record], VERSION_COLUMNS).coalesce(1).write.mode("overwrite").parquet(f"{path}/record")


def load_version(spark: SparkSession, store: str, version: str) -> tuple[PipelineModel, Row]:
    """The model of `save_version` and its record; an error that names the version where it is not stored."""
    path = _version_path(store, version)
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/record")
    if not place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(place):
        raise ValueError(f"no stored model for version {version}")
    record = spark.read.schema(VERSION_COLUMNS).parquet(f"{path}/record").first()
    return PipelineModel.load(f"{path}/model"), record


def champion_scores(features: DataFrame, champion: DataFrame, store: str) -> DataFrame:
    """Score a feature table with the stored model of the registered champion, with the bounds of its stored radius.

    `champion` is the one-row table of `current_champion`.  A version that is not stored, a column that its model reads and
    the table lacks, and a row without a forecast stop the job.
    """
    spark = features.sparkSession
    row = champion.first()
    if row is None:
        raise ValueError("no champion among the registered versions")
    model, record = load_version(spark, store, row["version"])
    require_columns(features, record["feature_columns"], f"feature table of version {record['version']}")
    raw = predict(model, features)
    given = raw.filter(ensure(F.col("predicted_units").isNotNull(), f"version {record['version']} gives no forecast for a row"))
    scored = given.withColumns(
        {"model_version": F.lit(record["version"]), "predicted_units": F.greatest(F.col("predicted_units"), F.lit(0.0))}
    )
    if TARGET_COLUMN in features.columns:
        scored = scored.withColumn("actual_units", F.col(TARGET_COLUMN).cast("double"))
    if record["interval_radius"] is None:
        return scored
    return add_intervals(scored, record["interval_radius"], record["coverage"])


def score_records(
    records: DataFrame,
    predictor: Predictor,
    model_version: str,
    radius: float | None = None,
    coverage: float = 0.90,
    keep: Sequence[str] = (),
) -> DataFrame:
    """Version, prediction and bounds of feature records; works on batch and streaming inputs."""
    scored = _forecast(predictor, records).select(
        *keep, F.lit(model_version).alias("model_version"), "predicted_units"
    )
    return scored if radius is None else add_intervals(scored, float(radius), coverage)


def test_predictions(test: DataFrame, radius: DataFrame | float | None = None, predicted: str = "predicted_units") -> DataFrame:
    """Keys, units, prediction, absolute error and bounds of the held-out rows."""
    output = test.select(
        "date",
        "store_id",
        "sku_id",
        TARGET_COLUMN,
        F.col(predicted).alias("prediction"),
        F.abs(F.col(predicted) - F.col(TARGET_COLUMN)).alias("absolute_error"),
    )
    if radius is None:
        return output
    return add_intervals(output, radius, predicted="prediction").drop("prediction_interval_coverage")


def _summary_of_cells(predictions: DataFrame, by: Sequence[str], keys: Mapping[str, str]) -> DataFrame:
    """Rows, extremes and distinct counts from one row per group, store and SKU; a value that is not finite is an extreme of its cell."""
    units = F.col("predicted_units")
    whole = F.count(units) == F.count(F.lit(1))  # a cell with a NULL has no extremes, which stops the job
    cells = predictions.groupBy(*dict.fromkeys([*by, *keys.values()])).agg(
        F.count(F.lit(1)).alias("__n"), F.when(whole, F.min(units)).alias("__low"), F.when(whole, F.max(units)).alias("__high")
    )
    measures = {"rows": F.sum("__n"), "min_predicted_units": F.min("__low"), "max_predicted_units": F.max("__high")}
    distinct = {f"unique_{label}": F.count_distinct(column) for label, column in keys.items()}
    return checked_aggregate(cells, ("__low", "__high"), measures | distinct, by)


def prediction_summary(
    predictions: DataFrame, by: Sequence[str] = (), method: str = "select", approximate: bool = False
) -> DataFrame:
    """Row, store and SKU counts and the spread of the predictions.

    The exact counts of distinct stores and SKUs expand a row per store and SKU, not the rows of the table; `approximate` uses a
    sketch and needs neither.
    """
    present = set(predictions.columns)
    keys = {label: column for label, column in (("stores", "store_id"), ("skus", "sku_id")) if column in present}
    if keys and not approximate:
        sums = _summary_of_cells(predictions, by, keys)
    else:
        measures = {"rows": F.count(F.lit(1)), "min_predicted_units": F.min("predicted_units"), "max_predicted_units": F.max("predicted_units")}
        distinct = {f"unique_{label}": F.approx_count_distinct(column) for label, column in keys.items()}
        sums = checked_aggregate(predictions, ("predicted_units",), measures | distinct, by)
    missing = {f"unique_{label}": F.lit(0).cast("bigint") for label in ("stores", "skus") if label not in keys}
    sums = sums.withColumns({**missing, "has_actuals": F.lit("actual_units" in present)})
    spread = quantiles(
        predictions, "predicted_units", {"p50_predicted_units": 0.5, "p90_predicted_units": 0.9}, by, method
    ).drop("value_count")
    return attach(sums, spread, by).select(
        *by,
        "rows",
        "unique_stores",
        "unique_skus",
        "has_actuals",
        "min_predicted_units",
        "p50_predicted_units",
        "p90_predicted_units",
        "max_predicted_units",
    )


def batch_metrics(predictions: DataFrame) -> DataFrame:
    """Scoring report per model version: prediction summary and error metrics side by side."""
    by = ["model_version"]
    return join_on(prediction_summary(predictions, by), regression_metrics(predictions, by=by), by).select(
        *by,
        "rows",
        "unique_stores",
        "unique_skus",
        "has_actuals",
        "min_predicted_units",
        "p50_predicted_units",
        "p90_predicted_units",
        "max_predicted_units",
        *METRIC_COLUMNS,
    )
