"""Forecast quality per group: one row per `by` key, one column per metric.

Each evaluator makes one pass of partial and final aggregation; the exact quantiles come from
`quantiles`, which never holds a group in one task.  NULL, NaN or infinite inputs stop the job.
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from demandspark.functions import errors
from demandspark.functions.guards import attach, ensure, group_window, is_finite, require_columns
from demandspark.operators.quantiles import quantiles

MACHINE_EPSILON = 2.0**-52

METRIC_COLUMNS = (
    "mae",
    "median_absolute_error",
    "p90_absolute_error",
    "rmse",
    "mape",
    "wape",
    "smape",
    "r2",
    "bias",
    "under_forecast_rate",
    "over_forecast_rate",
    "rmsle",
)


def checked_aggregate(df: DataFrame, values: Sequence[str], aggregates: dict[str, Column], by: Sequence[str] = ()) -> DataFrame:
    """`groupBy(by).agg(...)` that stops the job on an empty input or on values that are not finite."""
    require_columns(df, [*values, *by], "forecast table")
    bad = F.lit(False)
    for name in values:
        bad = bad | ~is_finite(F.col(name))
    found = df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("__rows"),
        F.count_if(bad).alias("__bad"),
        *[expr.alias(name) for name, expr in aggregates.items()],
    )
    valid = ensure(F.col("__rows") > 0, "no rows to evaluate: the input is empty") & ensure(
        F.col("__bad") == 0, "NULL, NaN and infinite values cannot be evaluated, only finite ones"
    )
    return found.filter(valid).drop("__rows", "__bad")


def _double(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("double") for c in columns})


def regression_metrics(
    df: DataFrame,
    actual: str = "actual_units",
    predicted: str = "predicted_units",
    by: Sequence[str] = (),
    method: str = "select",
) -> DataFrame:
    """The twelve error metrics.  `method` chooses how the two quantiles are found (see `quantiles`)."""
    frame = _double(df.select(*by, actual, predicted), (actual, predicted))
    a, p = F.col(actual), F.col(predicted)
    sums = checked_aggregate(
        frame,
        (actual, predicted),
        {
            "mae": errors.mae(a, p),
            "rmse": errors.rmse(a, p),
            "mape": errors.mape(a, p),
            "wape": errors.wape(a, p),
            "smape": errors.smape(a, p),
            "r2": errors.r2(a, p),
            "bias": errors.bias(a, p),
            "under_forecast_rate": errors.rate(p < a),
            "over_forecast_rate": errors.rate(p > a),
            "rmsle": errors.rmsle(a, p),
        },
        by,
    )
    tails = quantiles(
        frame,
        errors.absolute_error(a, p),
        {"median_absolute_error": 0.5, "p90_absolute_error": 0.9},
        by,
        method,
    ).drop("value_count")
    return attach(sums, tails, by).select(*by, *METRIC_COLUMNS)


def pinball_loss(
    df: DataFrame,
    quantile: float,
    actual: str = "actual_units",
    predicted: str = "predicted_units",
    by: Sequence[str] = (),
) -> DataFrame:
    if not 0.0 < quantile < 1.0:
        raise ValueError("quantile is a share above 0 and below 1")
    return checked_aggregate(
        df, (actual, predicted), {"pinball_loss": errors.pinball(F.col(actual), F.col(predicted), quantile)}, by
    )


def inventory_cost(
    df: DataFrame,
    underage_cost: float = 2.0,
    overage_cost: float = 1.0,
    actual: str = "actual_units",
    predicted: str = "predicted_units",
    by: Sequence[str] = (),
) -> DataFrame:
    """Cost of shortages and excess stock under asymmetric unit costs."""
    if underage_cost < 0 or overage_cost < 0 or underage_cost + overage_cost == 0:
        raise ValueError("both unit costs are zero or more, and one of them is above zero")
    zero = F.lit(0.0)
    shortage = F.greatest(F.col(actual) - F.col(predicted), zero)
    excess = F.greatest(F.col(predicted) - F.col(actual), zero)
    cost = shortage * float(underage_cost) + excess * float(overage_cost)
    return checked_aggregate(
        df,
        (actual, predicted),
        {
            "mean_inventory_cost": F.avg(cost),
            "total_inventory_cost": F.sum(cost),
            "mean_shortage_units": F.avg(shortage),
            "mean_excess_units": F.avg(excess),
            "implied_service_quantile": F.lit(underage_cost / (underage_cost + overage_cost)),
        },
        by,
    )


def seasonal_scale(
    history: DataFrame,
    seasonality: int,
    value: str,
    series: Sequence[str],
    order: Sequence[str],
    strict: bool = True,
) -> DataFrame:
    """Mean absolute seasonal difference per series.

    A series that is too short, not finite or without seasonal change stops the job, or gets a NULL scale
    when `strict` is off.  A series is ordered by `order` and holds one row per time step, so a window partition is bounded by
    the calendar; without series keys the steps are counted first, and a repeated one stops the job.
    """
    if seasonality < 1:
        raise ValueError("seasonality is at least 1")
    if not series:
        steps = history.groupBy(*order).agg(F.count(F.lit(1)).alias("__copies"), F.max(value).alias(value))
        single = ensure(F.col("__copies") == 1, "a history without series keys needs one row for each time step")
        history = steps.filter(single).drop("__copies")
    window = group_window(series)
    step = F.abs(F.col(value) - F.lag(value, seasonality).over(window.orderBy(*order)))
    scaled = (
        history.withColumn(value, F.col(value).cast("double"))
        .withColumn("__step", step)
        .groupBy(*series)
        .agg(
            F.count(F.lit(1)).alias("__rows"),
            F.count_if(~is_finite(F.col(value))).alias("__bad"),
            F.avg("__step").alias("scale"),
        )
    )
    conditions = {
        "the history is not longer than its seasonal lag": F.col("__rows") > seasonality,
        "the history has values that are not finite": F.col("__bad") == 0,
        "the history has no seasonal change, so its scale is undefined": F.col("scale") > MACHINE_EPSILON,
    }
    if strict:
        for message, holds in conditions.items():
            scaled = scaled.filter(ensure(holds, message))
        return scaled.select(*series, "scale")
    defined = F.lit(True)
    for holds in conditions.values():
        defined = defined & holds
    return scaled.select(*series, F.when(defined, F.col("scale")).alias("scale"))


def mean_absolute_scaled_error(
    df: DataFrame,
    history: DataFrame,
    seasonality: int = 7,
    history_value: str = "units_sold",
    order: Sequence[str] = ("date",),
    actual: str = "actual_units",
    predicted: str = "predicted_units",
    by: Sequence[str] = (),
    strict: bool = True,
) -> DataFrame:
    """MAE divided by the in-sample error of the seasonal naive forecast, per series key `by`.

    With `strict` off, series whose scale is undefined, or that have no history at all, get a NULL instead of stopping the
    whole job.
    """
    errors_per_series = checked_aggregate(
        df, (actual, predicted), {"mae": errors.mae(F.col(actual), F.col(predicted))}, by
    )
    scale = seasonal_scale(history, seasonality, history_value, by, order, strict)
    required = "no training history for" if strict else None
    return attach(errors_per_series, scale, by, required=required).select(*by, (F.col("mae") / F.col("scale")).alias("mase"))


def residual_summary(
    df: DataFrame,
    actual: str = "actual_units",
    predicted: str = "predicted_units",
    by: Sequence[str] = (),
    method: str = "select",
) -> DataFrame:
    frame = _double(df.select(*by, actual, predicted), (actual, predicted))
    error = errors.residual(F.col(actual), F.col(predicted))
    sums = checked_aggregate(
        frame, (actual, predicted), {"mean": F.avg(error), "max_abs": F.max(F.abs(error))}, by
    )
    tails = quantiles(frame, error, {"median": 0.5, "p10": 0.1, "p90": 0.9}, by, method).drop("value_count")
    return attach(sums, tails, by).select(*by, "mean", "median", "p10", "p90", "max_abs")
