"""Reference profiles that later monitoring compares against."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from demandspark.functions import errors
from demandspark.functions.guards import attach, require_columns
from demandspark.functions.histogram import bin_shares, counts_at_least, repair_edges
from demandspark.operators.metrics import METRIC_COLUMNS, checked_aggregate, regression_metrics
from demandspark.operators.quantiles import quantiles
from demandspark.schemas import CATEGORICAL_COLUMNS, FEATURE_COLUMNS, TARGET_COLUMN

SPREAD = {"p10": 0.1, "p50": 0.5, "p90": 0.9}


def distribution(df: DataFrame, value: str, by: Sequence[str] = (), method: str = "select") -> DataFrame:
    """Rows, mean, population deviation and p10/p50/p90."""
    sums = checked_aggregate(
        df,
        (value,),
        {"rows": F.count(F.lit(1)), "mean": F.avg(value), "std": F.stddev_pop(value)},
        by,
    )
    return attach(sums, quantiles(df, value, SPREAD, by, method).drop("value_count"), by)


def prediction_profile(predictions: DataFrame, by: Sequence[str] = (), method: str = "select") -> DataFrame:
    """Distribution of the predictions, plus the error metrics when actuals are present."""
    require_columns(predictions, ["predicted_units"], "prediction log")
    profile = distribution(predictions, "predicted_units", by, method)
    if "actual_units" not in predictions.columns:
        return profile
    return attach(profile, regression_metrics(predictions, by=by, method=method), by).select(
        *by, "rows", "mean", "std", *SPREAD, *METRIC_COLUMNS
    )


def training_profile(train: DataFrame, target: str = TARGET_COLUMN, by: Sequence[str] = ()) -> DataFrame:
    return train.groupBy(*by).agg(
        F.count(F.lit(1)).alias("row_count"),
        F.min("date").alias("min_date"),
        F.max("date").alias("max_date"),
        F.avg(target).alias("target_mean"),
        F.stddev_samp(target).alias("target_std"),
    )


def numeric_profile(frame: DataFrame, features: Sequence[str] = FEATURE_COLUMNS) -> DataFrame:
    """(`position`, `feature`, `mean`, `std`) from one wide aggregation, turned into rows afterwards."""
    moments = [
        F.expr(f"{function}(`{c}`) AS {name}_{i}")
        for i, c in enumerate(features)
        for name, function in (("mean", "avg"), ("std", "stddev_samp"))
    ]
    rows = [
        f"struct({i} AS position, '{c}' AS feature, mean_{i} AS mean, std_{i} AS std)" for i, c in enumerate(features)
    ]
    return frame.agg(*moments).selectExpr(f"inline(array({', '.join(rows)}))")


def category_profile(
    frame: DataFrame,
    columns: Sequence[str] = CATEGORICAL_COLUMNS,
    where: Column | None = None,
) -> DataFrame:
    """Mean and sample deviation of every one-hot column, derived from value counts.

    No wide column is built, so any number of categories works: a 0/1 column with c ones in n rows has
    mean c/n and sample variance c(n-c)/(n(n-1)).  `where` restricts the statistics, not the vocabulary.
    """
    where = F.lit(True) if where is None else where
    total = frame.agg(F.count_if(where)).scalar()
    pairs = F.array(
        *[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in columns]
    )
    counts = (
        frame.withColumn("__in", where.cast("int"))
        .select("__in", F.inline(pairs))
        .filter(F.col("value").isNotNull())
        .groupBy("column", "value")
        .agg(F.sum("__in").alias("ones"))
        .withColumn("n", total)
    )
    ones, n = F.col("ones").cast("double"), F.col("n").cast("double")
    return counts.select(
        F.concat("column", F.lit("_"), "value").alias("feature"),
        F.try_divide(ones, n).alias("mean"),
        F.sqrt(F.try_divide(ones * (n - ones), n * (n - 1.0))).alias("std"),
    )


def feature_profile(
    frame: DataFrame,
    features: Sequence[str] = FEATURE_COLUMNS,
    columns: Sequence[str] = CATEGORICAL_COLUMNS,
    where: Column | None = None,
) -> DataFrame:
    """`feature`, `mean`, `std` of the numeric and the one-hot columns of the model matrix."""
    require_columns(frame, [*features, *columns], "feature table")
    numeric = numeric_profile(frame if where is None else frame.filter(where), features)
    return numeric.select("feature", "mean", "std").unionByName(category_profile(frame, columns, where))


def reference_distribution(
    df: DataFrame,
    value: str = "predicted_units",
    by: Sequence[str] = (),
    bins: int = 10,
    method: str = "select",
) -> DataFrame:
    """Distribution plus `bin_edges` (repaired quantile edges) and `expected_share` per bin."""
    step = 1.0 / bins
    steps = {f"edge_{i}": i * step if i < bins else 1.0 for i in range(bins + 1)}
    found = quantiles(df, value, {**SPREAD, **steps}, by, method).select(
        *by, *SPREAD, repair_edges(f"array({', '.join(steps)})").alias("bin_edges")
    )
    rows = attach(df.select(*by, F.col(value).cast("double").alias(value)), found.drop(*SPREAD), by)
    counts = checked_aggregate(
        rows,
        (value,),
        {
            "rows": F.count(F.lit(1)),
            "mean": F.avg(value),
            "std": F.stddev_pop(value),
            **counts_at_least(value, bins),
        },
        by,
    ).select(*by, "rows", "mean", "std", bin_shares("rows", bins).alias("expected_share"))
    return attach(counts, found, by).select(*by, "rows", "mean", "std", *SPREAD, "bin_edges", "expected_share")


def bin_rows(profile: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """One row per bin: `bin`, `lower_edge`, `upper_edge`, `expected_share`."""
    return profile.select(*by, "bin_edges", F.posexplode("expected_share").alias("bin", "expected_share")).select(
        *by,
        "bin",
        F.get("bin_edges", F.col("bin")).alias("lower_edge"),
        F.get("bin_edges", F.col("bin") + 1).alias("upper_edge"),
        "expected_share",
    )


def baseline_profile(
    train: DataFrame,
    reference_predictions: DataFrame,
    target_coverage: float,
    interval: DataFrame | None = None,
    by: Sequence[str] = ("model_version",),
    bins: int = 10,
) -> DataFrame:
    """One row per model with everything monitoring needs: target, prediction reference, MAE and coverage.

    `interval` is an optional conformal summary whose observed coverage and width are kept as well.
    """
    reference = reference_distribution(reference_predictions, by=by, bins=bins)
    error = checked_aggregate(
        reference_predictions,
        ("actual_units", "predicted_units"),
        {"reference_mae": errors.mae(F.col("actual_units"), F.col("predicted_units"))},
        by,
    )
    profile = attach(reference, error, by).withColumn("target_coverage", F.lit(target_coverage))
    if interval is not None:
        profile = attach(profile, interval.select(*by, "observed_coverage", "mean_interval_width"), by)
    return attach(profile, training_profile(train).select("target_mean", "target_std"))


def stored_baseline(profile: DataFrame, features: DataFrame, by: Sequence[str] = ("model_version",)) -> DataFrame:
    """`baseline_profile` in its stored form: structs per reference, and a map of the feature profile, which all rows share.

    Its fields are those of `schemas.BASELINE_SCHEMA`; the map is as long as the features are many.
    """
    target = F.struct(
        F.col("target_mean").alias("mean"),
        F.col("target_std").alias("std"),
        F.lit(None).cast("array<double>").alias("bin_edges"),
        F.lit(None).cast("array<double>").alias("expected_share"),
    )
    entries = features.agg(F.map_from_entries(F.collect_list(F.struct("feature", F.struct("mean", "std")))).alias("features"))
    return attach(profile, entries).select(
        *by,
        target.alias("target"),
        F.struct("mean", "std", "bin_edges", "expected_share").alias("prediction_reference"),
        "features",
        F.struct(F.col("reference_mae").alias("mae")).alias("reference_metrics"),
        F.struct("target_coverage").alias("prediction_interval"),
    )
