"""Forecasts: naive column forecasts, boosted trees, and their evaluation over time."""

from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark import inheritable_thread_target
from pyspark.ml import Model, Pipeline, PipelineModel
from pyspark.ml.feature import SQLTransformer
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from demandspark.functions.guards import group_window, join_on, require_columns
from demandspark.operators.encoding import encoder_stages
from demandspark.operators.metrics import regression_metrics
from demandspark.operators.splits import fold_summary, rolling_origin
from demandspark.schemas import TARGET_COLUMN

NAIVE_COLUMN = "rolling_7_mean_units"

# Boosting rounds, learning rate and seed of the default model.
DEFAULT_ROUNDS = 220
DEFAULT_RATE = 0.055
DEFAULT_SEED = 42


def column_forecast(features: DataFrame, column: str, output: str = "predicted_units") -> DataFrame:
    """Use a feature column as the forecast."""
    require_columns(features, [column], "feature table")
    return features.withColumn(output, F.col(column).cast("double"))


def naive_forecast(features: DataFrame, output: str = "predicted_units") -> DataFrame:
    """Forecast the mean of the previous seven rows."""
    return column_forecast(features, NAIVE_COLUMN, output)


def column_forecasts(features: DataFrame, models: Mapping[str, str]) -> DataFrame:
    """Long table with one row per input row and model: `model_version`, `predicted_units`, `actual_units`.

    `models` maps a model name to the feature column that serves as its forecast.
    """
    require_columns(features, [*models.values(), TARGET_COLUMN], "feature table")
    options = F.array(
        *[
            F.struct(F.lit(name).alias("model_version"), F.col(column).cast("double").alias("predicted_units"))
            for name, column in models.items()
        ]
    )
    return features.select(
        "*", F.inline(options), F.col(TARGET_COLUMN).cast("double").alias("actual_units")
    )


def boosted_trees(
    rounds: int = DEFAULT_ROUNDS,
    rate: float = DEFAULT_RATE,
    depth: int = 5,
    seed: int = DEFAULT_SEED,
    label: str = TARGET_COLUMN,
) -> Pipeline:
    """Encoders and a gradient-boosted tree regressor as one Spark ML pipeline."""
    return Pipeline(stages=[*encoder_stages(), tree_regressor(rounds, rate, depth, seed, label)])


def tree_regressor(
    rounds: int = DEFAULT_ROUNDS,
    rate: float = DEFAULT_RATE,
    depth: int = 5,
    seed: int = DEFAULT_SEED,
    label: str = TARGET_COLUMN,
) -> GBTRegressor:
    """The boosted trees alone, over a vector column `features`."""
    return GBTRegressor(
        featuresCol="features",
        labelCol=label,
        predictionCol="prediction",
        maxIter=rounds,
        stepSize=rate,
        maxDepth=depth,
        seed=seed,
    )


def fit(train: DataFrame, rounds: int = DEFAULT_ROUNDS, seed: int = DEFAULT_SEED, **options) -> PipelineModel:
    return boosted_trees(rounds=rounds, seed=seed, **options).fit(train)


def predict(model: PipelineModel, frame: DataFrame, output: str = "predicted_units") -> DataFrame:
    """Apply a fitted model and keep only its forecast next to the input columns."""
    return model.transform(frame).select(*frame.columns, F.col("prediction").cast("double").alias(output))


def column_model(column: str) -> PipelineModel:
    """A column forecast as a model that can be stored like a fitted one."""
    return PipelineModel([SQLTransformer(statement=f"SELECT *, CAST(`{column}` AS double) AS prediction FROM __THIS__")])


def model_mae(model: str, by: Sequence[str] = ()) -> Column:
    """MAE of one model, on every row of a metrics table (a few rows per `by` group)."""
    return F.max(F.when(F.col("model_version") == model, F.col("mae"))).over(group_window(by))


def compare_models(predictions: DataFrame, baseline: str, by: Sequence[str] = ("split",)) -> DataFrame:
    """Metrics per model and split, with the MAE ratio to the baseline model of the same split."""
    scored = regression_metrics(predictions, by=["model_version", *by])
    return scored.withColumn("mae_vs_baseline", F.col("mae") / model_mae(baseline, by))


def backtest_report(validation: DataFrame, frame: DataFrame, horizon_days: int, folds: int = 3) -> DataFrame:
    """One row per fold: dates, row counts and metrics of the fold's validation predictions."""
    metrics = regression_metrics(validation, by=["fold"])
    return join_on(fold_summary(frame, horizon_days, folds), metrics, ["fold"])


def backtest_summary(report: DataFrame) -> DataFrame:
    return report.agg(
        F.avg("mae").alias("mean_mae"), F.avg("wape").alias("mean_wape"), F.stddev_pop("mae").alias("mae_std")
    )


def backtest_forecast(
    features: DataFrame,
    forecast: Callable[[DataFrame], DataFrame],
    horizon_days: int = 21,
    folds: int = 3,
) -> DataFrame:
    """Rolling-origin backtest of a forecast that needs no fitting; each row is scored at most once."""
    rows = forecast(rolling_origin(features, horizon_days, folds, split="validation"))
    return backtest_report(
        rows.withColumn("actual_units", F.col(TARGET_COLUMN).cast("double")), features, horizon_days, folds
    )


def backtest_naive(features: DataFrame, horizon_days: int = 21, folds: int = 3) -> DataFrame:
    return backtest_forecast(features, naive_forecast, horizon_days, folds)


def encoded_matrix(frame: DataFrame, keep: Sequence[str], path: str | None = None) -> DataFrame:
    """The columns `keep`, the target and the vector `features` of every row, for fits that share one matrix.

    The matrix is written to `path` and read from there; without a path it stays a plan, encoded at each use.  The encoders
    see all rows of `frame`.  A category that occurs only outside a fit's own rows has a column that is zero in all of them, on
    which no tree splits, so that fit treats it like one it has never seen.
    """
    require_columns(frame, [*keep, TARGET_COLUMN], "feature table")
    encoded = Pipeline(stages=encoder_stages()).fit(frame).transform(frame)
    matrix = encoded.select(*dict.fromkeys([*keep, TARGET_COLUMN]), "features")
    if path is None:
        return matrix
    matrix.write.parquet(path)
    return frame.sparkSession.read.parquet(path)


def fit_matrix(matrix: DataFrame, rounds: int = DEFAULT_ROUNDS, seed: int = DEFAULT_SEED, **options) -> Model:
    """Boosted trees of the rows of an encoded matrix."""
    return tree_regressor(rounds=rounds, seed=seed, **options).fit(matrix)


def side_by_side(spark: SparkSession, jobs: Mapping[str, Callable[[], object]], parallel: int) -> list:
    """The results of the jobs, in their order; up to `parallel` run at a time, each in a scheduler pool of its name.

    The pools share the executors evenly where spark.scheduler.mode is FAIR.  An error of any job is raised.
    """

    def in_pool(name, job):
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", name)
        return job()

    with ThreadPoolExecutor(max_workers=parallel) as threads:
        started = [threads.submit(inheritable_thread_target(spark)(in_pool), name, job) for name, job in jobs.items()]
        return [future.result() for future in started]


def backtest_trees(
    features: DataFrame,
    horizon_days: int = 21,
    folds: int = 3,
    rounds: int = DEFAULT_ROUNDS,
    seed: int = DEFAULT_SEED,
    matrix_path: str | None = None,
    parallel: int = 3,
    **options,
) -> DataFrame:
    """Refit the boosted trees for every fold and score its validation rows.

    All folds read one encoded matrix, stored under `matrix_path` if given, each by a filter on its dates; the fits are
    distributed jobs, `parallel` at a time.
    """
    matrix = encoded_matrix(features.withColumn("date", F.to_date("date")), ["date"], matrix_path)
    dates = fold_summary(matrix, horizon_days, folds).orderBy("fold").collect()  # a row per fold

    def fold_of(bounds):
        return lambda: fit_matrix(matrix.filter(F.col("date") <= bounds["train_end"]), rounds, seed + bounds["fold"], **options)

    fitted = side_by_side(features.sparkSession, {f"fold {b['fold']}": fold_of(b) for b in dates}, parallel)
    parts = [
        predict(model, matrix.filter(F.col("date").between(b["validation_start"], b["validation_end"]))).withColumn("fold", F.lit(b["fold"]))
        for b, model in zip(dates, fitted)
    ]
    scored = reduce(DataFrame.unionByName, parts).withColumn("actual_units", F.col(TARGET_COLUMN).cast("double"))
    return backtest_report(scored, matrix, horizon_days, folds)


def candidate_report(
    labelled: DataFrame,
    rounds: int = DEFAULT_ROUNDS,
    seed: int = DEFAULT_SEED,
    matrix_path: str | None = None,
    **options,
) -> DataFrame:
    """Metrics of the boosted trees of the training rows and of the naive forecast, on the validation and the test rows.

    `labelled` is a feature table with its `split`.  A row per model and split, as `compare_models` gives, with
    `beats_baseline`: whether the model's MAE is below the naive one of the split.
    """
    require_columns(labelled, ["split", NAIVE_COLUMN], "labelled feature table")
    matrix = encoded_matrix(labelled, ["split", NAIVE_COLUMN], matrix_path)
    model = fit_matrix(matrix.filter(F.col("split") == "train"), rounds, seed, **options)
    held_out = predict(model, matrix.filter(F.col("split").isin("validation", "test")), "__trees").drop("features")
    compared = compare_models(column_forecasts(held_out, {"naive": NAIVE_COLUMN, "trees": "__trees"}), "naive")
    return compared.withColumn("beats_baseline", F.col("mae") < model_mae("naive", ["split"]))
