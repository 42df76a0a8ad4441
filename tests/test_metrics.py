"""Splits, quantiles, error metrics and conformal intervals."""

import datetime as dt
import random

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from demandspark.operators import conformal, metrics, quantiles, splits

START = dt.date(2025, 1, 1)


def pairs(spark, actual, predicted, **constants):
    frame = spark.createDataFrame(
        [(float(a), float(p)) for a, p in zip(actual, predicted)], "actual_units double, predicted_units double"
    )
    for name, value in constants.items():
        frame = frame.withColumn(name, F.lit(value))
    return frame


def dated(spark, days):
    return spark.createDataFrame([(START + dt.timedelta(i), i) for i in range(days)], "date date, value bigint")


def test_time_split_keeps_recent_days_for_the_test(spark):
    frame = splits.time_split(dated(spark, 30), 5, 5, strict=True)
    found = {r.split: (r["count"], r.first, r.last) for r in frame.groupBy("split").agg(
        F.count("*").alias("count"), F.min("value").alias("first"), F.max("value").alias("last")).collect()}
    assert found == {"train": (20, 0, 19), "validation": (5, 20, 24), "test": (5, 25, 29)}
    for name, (count, first, _) in found.items():
        part = splits.time_slice(dated(spark, 30), name, 5, 5).agg(F.count("*").alias("n"), F.min("value").alias("first")).first()
        assert (part.n, part.first) == (count, first)


def test_time_split_drops_missing_dates_and_reports_empty_slices(spark):
    frame = dated(spark, 30).unionByName(spark.sql("SELECT cast(NULL AS date) AS date, 1L AS value"))
    assert splits.time_split(frame, 5, 5).count() == 30
    with pytest.raises(Exception, match="has no rows"):
        splits.time_split(dated(spark, 8), 5, 5, strict=True).collect()
    with pytest.raises(ValueError, match="at least one"):
        splits.time_split(frame, 0, 5)
    with pytest.raises(ValueError, match="date"):
        splits.time_split(spark.range(1))


def test_rolling_origin_folds_expand(spark):
    rows = splits.rolling_origin(dated(spark, 40), 5, 3)
    sizes = {(r.fold, r.split): r["count"] for r in rows.groupBy("fold", "split").count().collect()}
    assert [sizes[k, "train"] for k in (1, 2, 3)] == [25, 30, 35]
    assert [sizes[k, "validation"] for k in (1, 2, 3)] == [5, 5, 5]
    summary = splits.fold_summary(dated(spark, 40), 5, 3).orderBy("fold").collect()
    assert all(r.train_end < r.validation_start <= r.validation_end for r in summary)
    assert [r.train_rows for r in summary] == [25, 30, 35]
    assert rows.filter("split = 'validation'").count() == splits.rolling_origin(dated(spark, 40), 5, 3, "validation").count()
    with pytest.raises(Exception, match="more dates than"):
        splits.rolling_origin(dated(spark, 15), 5, 3).collect()


def test_tagged_union_marks_its_parts(spark):
    both = splits.tagged_union({"a": spark.range(2), "b": spark.range(3)})
    assert {r.split: r["count"] for r in both.groupBy("split").count().collect()} == {"a": 2, "b": 3}


def test_demand_metrics(spark):
    row = metrics.regression_metrics(pairs(spark, [10, 20, 30], [12, 16, 33])).first()
    assert row.wape == pytest.approx(9 / 60)
    assert row.mae == pytest.approx(3.0)
    assert row.median_absolute_error == 3.0
    assert row.p90_absolute_error == pytest.approx(np.quantile([2, 4, 3], 0.9))
    assert row.under_forecast_rate == pytest.approx(1 / 3) and row.over_forecast_rate == pytest.approx(2 / 3)
    assert row.rmse == pytest.approx(np.sqrt(29 / 3)) and row.bias == pytest.approx(1 / 3)
    assert row.r2 == pytest.approx(1 - 29 / 200)
    assert row.smape == pytest.approx(np.mean([2 / 11, 4 / 18, 3 / 31.5]))
    assert row.rmsle == pytest.approx(np.sqrt(np.mean((np.log1p([12, 16, 33]) - np.log1p([10, 20, 30])) ** 2)))


def test_degenerate_metrics(spark):
    perfect = metrics.regression_metrics(pairs(spark, [0, 0], [0, 0])).first()
    assert (perfect.r2, perfect.wape) == (1.0, 0.0)
    flat = metrics.regression_metrics(pairs(spark, [3, 3], [3, 4])).first()
    assert flat.r2 == 0.0


@pytest.mark.parametrize("bad", [None, float("nan"), float("inf"), float("-inf")])
def test_metrics_reject_values_that_are_not_finite(spark, bad):
    frame = spark.createDataFrame([(1.0, 2.0), (1.0, bad)], "actual_units double, predicted_units double")
    with pytest.raises(Exception, match="finite"):
        metrics.regression_metrics(frame).collect()


def test_metrics_reject_empty_input(spark):
    with pytest.raises(Exception, match="empty"):
        metrics.regression_metrics(pairs(spark, [1], [1]).limit(0)).collect()


def test_grouped_metrics_equal_single_group_metrics(spark):
    rng = random.Random(3)
    rows = [(k, rng.uniform(0, 50), rng.uniform(0, 50)) for k in ("a", "b", None) for _ in range(40)]
    frame = spark.createDataFrame(rows, "k string, actual_units double, predicted_units double")
    grouped = {r.k: r for r in metrics.regression_metrics(frame, by=["k"]).collect()}
    inline = {r.k: r for r in metrics.regression_metrics(frame, by=["k"], method="inline").collect()}
    assert set(grouped) == {"a", "b", None}
    for k in ("a", "b"):
        alone = metrics.regression_metrics(frame.filter(F.col("k") == k)).first()
        for name in metrics.METRIC_COLUMNS:
            assert grouped[k][name] == pytest.approx(alone[name])
            assert inline[k][name] == pytest.approx(alone[name])


def test_inventory_cost_and_pinball(spark):
    row = metrics.inventory_cost(pairs(spark, [10, 10], [8, 12]), 3.0, 1.0).first()
    assert (row.total_inventory_cost, row.mean_shortage_units, row.mean_excess_units) == (8.0, 1.0, 1.0)
    assert row.implied_service_quantile == 0.75
    short = metrics.pinball_loss(pairs(spark, [10], [8]), 0.75).first().pinball_loss
    excess = metrics.pinball_loss(pairs(spark, [10], [12]), 0.75).first().pinball_loss
    assert short == pytest.approx(1.5) and excess == pytest.approx(0.5)
    with pytest.raises(ValueError, match="above 0 and below 1"):
        metrics.pinball_loss(pairs(spark, [1], [1]), 1.0)
    with pytest.raises(ValueError, match="zero or more"):
        metrics.inventory_cost(pairs(spark, [1], [1]), 0.0, 0.0)


def history(spark, values):
    return spark.createDataFrame([(START + dt.timedelta(i), float(v)) for i, v in enumerate(values)], "date date, units_sold double")


def test_scaled_error(spark):
    frame = pairs(spark, [16, 26], [15, 25])
    past = history(spark, [10, 20, 12, 22, 14, 24])
    assert metrics.mean_absolute_scaled_error(frame, past, 2).first().mase == pytest.approx(0.5)
    for values, seasonality, message in (([5, 5, 5], 1, "undefined"), ([5, 6], 2, "longer"), ([5, float("inf"), 6], 1, "finite")):
        with pytest.raises(Exception, match=message):
            metrics.mean_absolute_scaled_error(frame, history(spark, values), seasonality).collect()
    twice = history(spark, [1, 2, 3]).unionByName(history(spark, [1, 2, 3]))
    with pytest.raises(Exception, match="one row for each time step"):
        metrics.mean_absolute_scaled_error(frame, twice, 1).collect()
    quiet = metrics.mean_absolute_scaled_error(frame, history(spark, [5, 5, 5]), 1, strict=False).first()
    assert quiet.mase is None
    with pytest.raises(ValueError, match="seasonality"):
        metrics.mean_absolute_scaled_error(frame, past, 0)


def test_residual_summary(spark):
    actual, predicted = [10, 20, 30, 40], [12, 16, 33, 40]
    residuals = np.array(predicted) - np.array(actual)
    row = metrics.residual_summary(pairs(spark, actual, predicted)).first()
    assert row.asDict() == pytest.approx(
        {
            "mean": residuals.mean(),
            "median": np.median(residuals),
            "p10": np.percentile(residuals, 10),
            "p90": np.percentile(residuals, 90),
            "max_abs": 4.0,
        }
    )


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    st.lists(
        st.one_of(
            st.sampled_from([0.0, -0.0, 1.0, -1.0, 1e6, 1e6 + 1e-6, 5e-324, -1e300]),
            st.floats(-1e6, 1e6, allow_nan=False),
        ),
        min_size=1,
        max_size=60,
    ),
    st.floats(0.0, 1.0),
)
def test_quantiles_equal_a_sorted_array(spark, values, p):
    frame = spark.createDataFrame([(v,) for v in values], "v double")
    found = quantiles.quantiles(frame, "v", {"low": 0.0, "any": p, "high": 1.0}).first()
    assert found.value_count == len(values)
    assert found.low == min(values) and found.high == max(values)
    assert found.any == pytest.approx(float(np.quantile(values, p)), rel=1e-12, abs=1e-300)


def test_quantiles_of_concentrated_and_skewed_groups(spark):
    """Values far from zero in a narrow range, a long tail, and one group with most of the rows."""
    frame = spark.range(30_000).selectExpr(
        "CASE WHEN id % 10 < 8 THEN 'hot' ELSE concat('g', id % 7) END AS k",
        "CASE WHEN id % 5 = 0 THEN exp(id / 2000D) ELSE 1000000D + (id * 7919 % 30000) / 1e7 END AS v",
    )
    probabilities = {"p01": 0.01, "p50": 0.5, "p999": 0.999}
    found = {r.k: r for r in quantiles.quantiles(frame, "v", probabilities, ["k"]).collect()}
    local = {}
    for row in frame.collect():
        local.setdefault(row.k, []).append(row.v)
    for k, values in local.items():
        assert found[k].value_count == len(values)
        for name, p in probabilities.items():
            assert found[k][name] == pytest.approx(np.quantile(values, p), rel=1e-14)
    with pytest.raises(ValueError, match="method"):
        quantiles.quantiles(frame, "v", probabilities, method="guess")


def test_approximate_quantiles_stay_close(spark):
    found = quantiles.quantiles(spark.range(1001).selectExpr("cast(id AS double) AS v"), "v", {"m": 0.5}, method="approx").first()
    assert abs(found.m - 500) <= 1


def test_conformal_interval(spark):
    report = conformal.conformal_summary(
        pairs(spark, [10, 20, 30, 40], [10, 21, 32, 44]), pairs(spark, [15, 25, 35], [16, 28, 40]), 0.75
    ).first()
    assert report.interval_radius == 4.0
    assert report.observed_coverage == pytest.approx(2 / 3)
    assert report.below_interval_rate == pytest.approx(1 / 3) and report.above_interval_rate == 0.0
    assert report.mean_interval_score == pytest.approx(8 + 8 * 1 / 3)
    assert (report.calibration_rows, report.test_rows) == (4, 3)
    with pytest.raises(ValueError, match="coverage"):
        conformal.conformal_radius(pairs(spark, [1], [1]), 1.0)


def test_conformal_rank_for_many_sizes(spark):
    """One group per n in 1..400; the k-th smallest error of a group is k."""
    frame = spark.range(1, 401).selectExpr("id AS n", "explode(sequence(1L, id)) AS k").selectExpr(
        "n", "0D AS actual_units", "cast(k AS double) AS predicted_units"
    )
    for coverage in (0.5, 0.9):
        found = conformal.conformal_radius(frame, coverage, by=["n"]).collect()
        assert len(found) == 400
        for row in found:
            level = min(1.0, np.ceil((row.n + 1) * coverage) / row.n)
            assert row.interval_radius == np.quantile(np.arange(1, row.n + 1), level, method="higher")


def test_intervals_on_predictions(spark):
    frame = pairs(spark, [1, 2], [3, 30])
    found = conformal.add_intervals(frame, 10.0, 0.9).orderBy("predicted_units").collect()
    assert [(r.prediction_lower, r.prediction_upper) for r in found] == [(0.0, 13.0), (20.0, 40.0)]
    radius = conformal.conformal_radius(pairs(spark, [1, 2, 3], [2, 4, 6]))
    assert conformal.add_intervals(frame, radius).first().prediction_interval_coverage == 0.9
    with pytest.raises(ValueError, match="zero or more"):
        conformal.add_intervals(frame, -1.0)
    with pytest.raises(Exception, match="zero or more"):
        conformal.add_intervals(frame, spark.sql("SELECT -1D AS interval_radius")).collect()
