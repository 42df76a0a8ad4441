"""Split-conformal forecast intervals."""

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandspark.functions import errors
from demandspark.functions.guards import attach, ensure
from demandspark.operators.metrics import checked_aggregate
from demandspark.operators.quantiles import order_statistics


def _check_coverage(coverage: float) -> None:
    if not 0.0 < coverage < 1.0:
        raise ValueError("coverage is a share above 0 and below 1")


def radius_rank(coverage: float, rank: str = "higher") -> str:
    """Zero-based rank of the radius among the n errors of a group, as SQL.

    "higher" is the quantile of that kind at level ceil((n + 1) * coverage) / n, which may lie one above the
    "textbook" rank ceil((n + 1) * coverage) - 1.
    """
    if rank == "textbook":
        return f"least(value_count - 1, ceil((value_count + 1) * {coverage!r}D) - 1)"
    if rank != "higher":
        raise ValueError("rank is higher or textbook")
    return f"ceil((value_count - 1) * least(1D, ceil((value_count + 1) * {coverage!r}D) / value_count))"


def conformal_radius(
    calibration: DataFrame,
    coverage: float = 0.90,
    actual: str = "actual_units",
    predicted: str = "predicted_units",
    by: Sequence[str] = (),
    rank: str = "higher",
) -> DataFrame:
    """Half-width of a symmetric interval, from the absolute errors of the calibration rows."""
    _check_coverage(coverage)
    checked = checked_aggregate(calibration, (actual, predicted), {"calibration_rows": F.count(F.lit(1))}, by)
    found = order_statistics(
        calibration,
        errors.absolute_error(F.col(actual).cast("double"), F.col(predicted).cast("double")),
        {"interval_radius": radius_rank(coverage, rank)},
        by,
    ).drop("value_count")
    return attach(checked, found, by).select(*by, "calibration_rows", "interval_radius")


def conformal_summary(
    calibration: DataFrame,
    evaluation: DataFrame,
    coverage: float = 0.90,
    actual: str = "actual_units",
    predicted: str = "predicted_units",
    by: Sequence[str] = (),
) -> DataFrame:
    """Calibrate on one slice and report coverage, misses and interval score on another."""
    radius = conformal_radius(calibration, coverage, actual, predicted, by)
    return interval_summary(evaluation, radius, coverage, actual, predicted, by)


def interval_summary(
    evaluation: DataFrame,
    radius: DataFrame,
    coverage: float = 0.90,
    actual: str = "actual_units",
    predicted: str = "predicted_units",
    by: Sequence[str] = (),
) -> DataFrame:
    """Coverage, misses and interval score of calibrated radii (`conformal_radius`) on other rows.

    A radius table read from storage has a known size: Spark then broadcasts it when it is small enough
    instead of shuffling the evaluation rows.
    """
    _check_coverage(coverage)
    rows = attach(evaluation.select(*by, actual, predicted), radius, by, required="no calibrated radius for")
    a, p, r = F.col(actual), F.col(predicted), F.col("interval_radius")
    below, above = a < p - r, a > p + r
    penalty = 2.0 / (1.0 - coverage)
    score = (
        r * 2.0
        + F.when(below, (p - r - a) * penalty).otherwise(0.0)
        + F.when(above, (a - p - r) * penalty).otherwise(0.0)
    )
    report = checked_aggregate(
        rows,
        (actual, predicted),
        {
            "observed_coverage": errors.rate(~below & ~above),
            "interval_radius": F.max(r),
            "below_interval_rate": errors.rate(below),
            "above_interval_rate": errors.rate(above),
            "mean_interval_score": F.avg(score),
            "calibration_rows": F.max("calibration_rows"),
            "test_rows": F.count(F.lit(1)),
        },
        by,
    )
    return report.select(
        *by,
        F.lit(coverage).alias("target_coverage"),
        "observed_coverage",
        "interval_radius",
        (F.col("interval_radius") * 2.0).alias("mean_interval_width"),
        "below_interval_rate",
        "above_interval_rate",
        "mean_interval_score",
        "calibration_rows",
        "test_rows",
    )


def add_intervals(
    df: DataFrame,
    radius: DataFrame | float,
    coverage: float = 0.90,
    predicted: str = "predicted_units",
    by: Sequence[str] = (),
) -> DataFrame:
    """Attach `prediction_lower` (never negative), `prediction_upper` and the target coverage.

    `radius` is a number or a table of `interval_radius` per `by` key.  Rows of a key without a radius stay, with
    NULL bounds and NULL coverage.
    """
    _check_coverage(coverage)
    message = "an interval radius must be zero or more"
    if isinstance(radius, DataFrame):
        valid = radius.filter(ensure(F.col("interval_radius") >= 0, message))
        rows, r = attach(df, valid, by, {"interval_radius": "__radius"}), F.col("__radius")
    else:
        if radius < 0:
            raise ValueError(message)
        rows, r = df, F.lit(float(radius))
    return rows.withColumns(
        {
            "prediction_lower": F.when(r.isNotNull(), F.greatest(F.col(predicted) - r, F.lit(0.0))),
            "prediction_upper": F.col(predicted) + r,
            "prediction_interval_coverage": F.when(r.isNotNull(), F.lit(coverage)),
        }
    ).drop("__radius")
