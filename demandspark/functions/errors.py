"""Forecast error measures as aggregate Columns over an actual and a predicted column."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def residual(actual: Column, predicted: Column) -> Column:
    return predicted - actual


def absolute_error(actual: Column, predicted: Column) -> Column:
    return F.abs(predicted - actual)


def mae(actual: Column, predicted: Column) -> Column:
    return F.avg(absolute_error(actual, predicted))


def mse(actual: Column, predicted: Column) -> Column:
    error = residual(actual, predicted)
    return F.avg(error * error)


def rmse(actual: Column, predicted: Column) -> Column:
    return F.sqrt(mse(actual, predicted))


def mape(actual: Column, predicted: Column) -> Column:
    return F.avg(absolute_error(actual, predicted) / F.greatest(F.abs(actual), F.lit(1.0)))


def wape(actual: Column, predicted: Column) -> Column:
    demand = F.sum(F.abs(actual))
    return F.when(demand > 0, F.try_divide(F.sum(absolute_error(actual, predicted)), demand)).otherwise(F.lit(0.0))


def smape(actual: Column, predicted: Column) -> Column:
    scale = F.greatest((F.abs(actual) + F.abs(predicted)) / 2.0, F.lit(1.0))
    return F.avg(absolute_error(actual, predicted) / scale)


def r2(actual: Column, predicted: Column) -> Column:
    """Without spread in the actuals: 1 for a perfect forecast, otherwise 0."""
    error = residual(actual, predicted)
    total = F.var_pop(actual) * F.count(F.lit(1))
    squared = F.sum(error * error)
    return (
        F.when(total > 0, 1.0 - F.try_divide(squared, total))
        .when(squared == 0, F.lit(1.0))
        .otherwise(F.lit(0.0))
    )


def bias(actual: Column, predicted: Column) -> Column:
    return F.avg(residual(actual, predicted))


def rate(condition: Column) -> Column:
    """Share of rows for which the condition holds."""
    return F.avg(condition.cast("double"))


def rmsle(actual: Column, predicted: Column) -> Column:
    zero = F.lit(0.0)
    gap = F.log1p(F.greatest(predicted, zero)) - F.log1p(F.greatest(actual, zero))
    return F.sqrt(F.avg(gap * gap))


def pinball(actual: Column, predicted: Column, quantile: float) -> Column:
    gap = actual - predicted
    return F.avg(F.greatest(gap * quantile, gap * (quantile - 1.0)))
