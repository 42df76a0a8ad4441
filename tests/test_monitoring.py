"""Profiles, drift, quality reports, alerts, governance, retraining plans, models and scoring."""

import datetime as dt
import json
import math
import random
import threading

import numpy as np
import pytest
from pyspark.sql import functions as F

from demandspark.functions.histogram import repair_edges, spread_shares
from demandspark.operators import alerts, conformal, drift, features, governance, models, profiles, quality, retraining, scoring, splits
from demandspark.schemas import FEATURE_COLUMNS
from demandspark.streaming.scoring import score_stream
from tests.test_layers_features import silver_table, raw_row, two_series

START = dt.date(2026, 1, 1)


def values(spark, numbers):
    return spark.createDataFrame([(float(v),) for v in numbers], "predicted_units double")


def bins(spark, edges, shares):
    return spark.createDataFrame([(edges, shares)], "bin_edges array<double>, expected_share array<double>")


def numpy_psi(edges, shares, data):
    """Plain recomputation: outer edges cover the data, shares are clipped and not rescaled."""
    edges = np.array(edges, dtype=float)
    edges[0], edges[-1] = min(edges[0], min(data)) - 1e-6, max(edges[-1], max(data)) + 1e-6
    observed = np.clip(np.histogram(data, edges)[0] / len(data), 1e-6, 1)
    expected = np.clip(np.array(shares) / np.sum(shares), 1e-6, 1)
    return float(np.sum((observed - expected) * np.log(observed / expected)))


def test_psi_from_bins(spark):
    profile = bins(spark, [0.0, 5.0, 10.0], [0.5, 0.5])
    near = drift.psi_from_bins(values(spark, [1, 2, 8, 9]), profile).first().psi
    far_values = [8, 9, 9.5, 9.8]
    far = drift.psi_from_bins(values(spark, far_values), profile).first().psi
    assert near == pytest.approx(0.0)
    assert far == pytest.approx(numpy_psi([0, 5, 10], [0.5, 0.5], far_values))
    assert far > near
    outside = [-50, 0, 5, 5, 10, 400]
    found = drift.psi_from_bins(values(spark, outside), bins(spark, [0.0, 5.0, 7.0, 10.0], [1.0, 1.0, 2.0]))
    assert found.first().psi == pytest.approx(numpy_psi([0, 5, 7, 10], [1, 1, 2], outside))


@pytest.mark.parametrize(
    "edges, shares, message",
    [
        ([0.0, 1.0, 2.0], [0.0, 0.0], "nor all zero"),
        ([0.0, 1.0, 2.0], [float("nan"), 1.0], "finite"),
        ([0.0, 1.0, 2.0], [-1.0, 2.0], "not be negative"),
        ([0.0, 1.0, 2.0], [1.0], "one share for each bin"),
        ([0.0, 1.0], [1.0], "two bins or more"),
        ([0.0, 1.0, 1.0], [0.5, 0.5], "rise from bin to bin"),
    ],
)
def test_psi_rejects_unusable_references(spark, edges, shares, message):
    with pytest.raises(Exception, match=message):
        drift.psi_from_bins(values(spark, [0.5, 1.5]), bins(spark, edges, shares)).collect()


def test_psi_rejects_unusable_values(spark):
    profile = bins(spark, [0.0, 5.0, 10.0], [0.5, 0.5])
    with pytest.raises(Exception, match="finite"):
        drift.psi_from_bins(values(spark, [1, float("nan")]), profile).collect()
    with pytest.raises(Exception, match="at least one prediction"):
        drift.psi_from_bins(values(spark, [1]).limit(0), profile).collect()
    with pytest.raises(ValueError, match="bins"):
        drift.psi_from_stats(values(spark, [1]), profile, bins=1)


def test_psi_from_stats_and_dispatch(spark):
    profile = spark.sql("SELECT 10D AS mean, 1D AS std")
    near, far = np.linspace(8.5, 11.5, 100), np.linspace(15, 18, 100)
    grid = np.linspace(7, 13, 400)
    edges = np.quantile(grid, np.linspace(0, 1, 11))
    for data in (near, far):
        found = drift.psi_from_stats(values(spark, data), profile).first().psi
        assert found == pytest.approx(numpy_psi(edges, [0.1] * 10, data))
        assert drift.psi(values(spark, data), profile).first().psi == pytest.approx(found)
    assert drift.psi_from_stats(values(spark, far), profile).first().psi > drift.psi_from_stats(values(spark, near), profile).first().psi
    assert [round(s * 200) for s in spark.sql(f"SELECT {spread_shares(3)}").first()[0]] == [67, 66, 67]


def test_edge_repair(spark):
    frame = spark.createDataFrame([([1.0, 1.0, 1.0, 2.0, 2.0],)], "e array<double>")
    assert frame.select(repair_edges("e")).first()[0] == pytest.approx(
        [1 - 1e-6, 1 + 1e-6, 1 + 2e-6, 2.0, 2 + 2e-6], abs=1e-12
    )


def test_reference_distribution_matches_numpy(spark):
    rng = random.Random(5)
    data = [float(rng.randint(0, 40)) for _ in range(300)]
    row = profiles.reference_distribution(values(spark, data)).first()
    edges = np.quantile(data, np.linspace(0, 1, 11))
    edges[0], edges[-1] = edges[0] - 1e-6, edges[-1] + 1e-6
    assert row.bin_edges == pytest.approx(list(edges), abs=1e-9)
    assert row.expected_share == pytest.approx(list(np.histogram(data, edges)[0] / 300))
    assert (row.rows, row.mean, row.std) == (300, pytest.approx(np.mean(data)), pytest.approx(np.std(data)))
    assert row.p10 == pytest.approx(np.percentile(data, 10)) and row.p90 == pytest.approx(np.percentile(data, 90))


def test_prediction_profile_has_quality_only_with_actuals(spark):
    frame = values(spark, [1, 2, 3])
    assert "mae" not in profiles.prediction_profile(frame).columns
    row = profiles.prediction_profile(frame.withColumn("actual_units", F.lit(2.0))).first()
    assert (row.rows, row.mean) == (3, 2.0) and row.mae == pytest.approx(2 / 3)
    with pytest.raises(ValueError, match="predicted_units"):
        profiles.prediction_profile(spark.range(1))


def test_category_profile_equals_wide_one_hot_statistics(spark):
    rows = [("a",)] * 3 + [("b",)] * 2 + [(None,)]
    frame = spark.createDataFrame(rows, "sku_id string").withColumn("train", F.lit(True))
    frame = frame.unionByName(spark.sql("SELECT 'c' AS sku_id, false AS train"))
    found = {r.feature: (r.mean, r.std) for r in profiles.category_profile(frame, ["sku_id"], F.col("train")).collect()}
    for name, ones in (("a", 3), ("b", 2), ("c", 0)):
        column = np.array([1.0] * ones + [0.0] * (6 - ones))
        assert found[f"sku_id_{name}"] == pytest.approx((column.mean(), column.std(ddof=1)))


def test_feature_mean_shift_ranks_movement(spark):
    profile = spark.createDataFrame(
        [("promotion", 0.2, 0.4), ("price", 10.0, 2.0), ("absent", 1.0, 1.0), ("flat", 1.0, 0.0)],
        "feature string, mean double, std double",
    )
    observed = spark.createDataFrame(
        [("20", 0.0, 1.0), ("22", 1.0, 1.0), ("n/a", float("inf"), 1.0)], "price string, promotion double, flat double"
    )
    names = ["promotion", "price", "absent", "flat"]
    rows = drift.feature_mean_shift(observed, profile, names).collect()
    assert [r.feature for r in rows] == ["price", "promotion", "flat"]
    assert rows[0].standardized_shift == pytest.approx(5.5) and rows[1].standardized_shift == pytest.approx(0.75)
    assert drift.feature_mean_shift(observed, profile, ["absent"]).count() == 0


def test_feature_schema_report(spark):
    observed = spark.createDataFrame([(10.0, "yes"), (11.0, "no")], "price double, promotion string")
    row = drift.feature_schema_report(observed, ["price", "promotion", "lag_7"]).first()
    assert row.coverage == pytest.approx(2 / 3)
    assert (row.missing_features, row.non_numeric_features, row.non_finite_features) == (["lag_7"], ["promotion"], [])
    assert not row.valid
    partly = spark.createDataFrame([(10.0,), (float("inf"),)], "price double")
    assert drift.feature_schema_report(partly, ["price"]).first().non_finite_features == ["price"]
    assert drift.feature_schema_report(partly, []).first().asDict() == {
        "expected_feature_count": 0, "present_feature_count": 0, "coverage": 1.0,
        "missing_features": [], "non_numeric_features": [], "non_finite_features": [], "valid": True,
    }


def test_interval_quality(spark):
    frame = spark.createDataFrame(
        [(8.0, 9.0, 11.0), (12.0, 10.0, 14.0), (20.0, 17.0, 22.0), (30.0, 24.0, 28.0)],
        "actual_units double, prediction_lower double, prediction_upper double",
    )
    row = quality.interval_quality(frame).first()
    assert (row.rows, row.observed_coverage, row.below_interval_rate, row.above_interval_rate) == (4, 0.5, 0.25, 0.25)
    assert row.mean_interval_width == pytest.approx((2 + 4 + 5 + 4) / 4)
    assert quality.interval_quality(frame.select("actual_units")) is None
    with pytest.raises(ValueError, match=r"\['actual_units', 'prediction_upper'\]"):
        quality.interval_quality(frame.select("prediction_lower"))
    with pytest.raises(Exception, match="above its upper bound"):
        quality.interval_quality(frame.withColumn("prediction_lower", F.lit(99.0))).collect()


def segments_frame(spark, rows):
    return spark.createDataFrame(rows, "store_id string, category string, predicted_units double, actual_units double")


def test_segment_quality_orders_and_skips(spark):
    rows = [("s1", "g", 10.0, 10.0), ("s1", "g", 11.0, 12.0), ("s2", "g", 25.0, 10.0), ("s2", "g", 30.0, 10.0)]
    rows += [("s3", "g", 1.0, 90.0), ("s4", "g", float("nan"), 1.0), ("s4", "g", 1.0, 1.0), (None, "g", 5.0, 5.0), (None, "g", 5.0, 5.0)]
    found = quality.segment_quality(segments_frame(spark, rows), ("store_id",), 2).collect()
    assert [r.segment for r in found] == ["store_id=s2", "store_id=s1", "store_id=nan"]
    assert found[0].mae == pytest.approx(17.5)
    both = quality.segment_quality(segments_frame(spark, rows), min_rows=2).first()
    assert both.segment == "store_id=s2 / category=g"
    assert quality.segment_quality(segments_frame(spark, rows).drop("actual_units")) is None
    assert quality.segment_quality(segments_frame(spark, rows), ("region",)) is None
    with pytest.raises(ValueError, match="min_rows"):
        quality.segment_quality(segments_frame(spark, rows), min_rows=0)


def test_segment_quality_keeps_the_ten_worst_per_group(spark):
    rows = [(f"s{i:02d}", "g", float(i), 0.0) for i in range(15)]
    frame = segments_frame(spark, rows).withColumn("m", F.lit("one"))
    frame = frame.unionByName(frame.withColumn("m", F.lit("two")))
    found = quality.segment_quality(frame, ("store_id",), 1, by=["m"]).groupBy("m").agg(F.count("*").alias("n"), F.min("mae").alias("low"))
    assert {(r.m, r.n, r.low) for r in found.collect()} == {("one", 10, 5.0), ("two", 10, 5.0)}


def test_rolling_quality_blocks(spark):
    rows = [(START + dt.timedelta(i), 10.0, p) for i, p in enumerate([10.0, 11.0, 10.0, 15.0, 16.0, 17.0])]
    frame = spark.createDataFrame(rows, "date date, actual_units double, predicted_units double")
    found = quality.rolling_quality(frame, 3, ["date"]).orderBy("window").collect()
    assert [(r.start_row, r.rows, r.start_date) for r in found] == [(0, 3, START), (3, 3, dt.date(2026, 1, 4))]
    assert found[1].mae == pytest.approx(6.0) and found[0].mae == pytest.approx(1 / 3)
    assert quality.rolling_quality(frame.drop("actual_units")) is None
    with pytest.raises(ValueError, match="window_size"):
        quality.rolling_quality(frame, 0)


def test_row_index_does_not_depend_on_partitions_or_hot_dates(spark):
    rng = random.Random(1)
    rows = sorted({(rng.choice("ab"), rng.choice([1, 1, 1, 2, 3]), rng.randint(0, 4), rng.randint(0, 9)) for _ in range(400)})
    frame = spark.createDataFrame(rows, "m string, date int, store_id int, sku_id int")
    expected = {}
    for m in "ab":
        for i, row in enumerate(r for r in rows if r[0] == m):
            expected[row] = i
    for parts in (1, 17):
        found = quality.row_index(frame.repartition(parts), ["date", "store_id", "sku_id"], ["m"]).collect()
        assert {tuple(r)[:4]: r.row_index for r in found} == expected


def signals(spark, **given):
    parts = ", ".join(f"{'cast(NULL AS double)' if v is None else repr(v)} AS {k}" for k, v in given.items())
    return spark.sql(f"SELECT {parts}").select(*[F.col(k).cast(alerts.SIGNALS[k]) for k in given])


def kinds(frame, limits):
    return [r.type for r in alerts.monitoring_alerts(frame, limits).orderBy("ordinal").collect()]


def test_alert_rules_and_their_order(spark):
    frame = signals(
        spark, psi=0.35, mae=2.5, reference_mae=1.0, bias=-0.8, segment_mae=2.3, worst_segment="category=frozen"
    )
    limits = alerts.Thresholds(mae_degradation_ratio=1.5)
    assert kinds(frame, limits) == ["prediction_drift", "error_degradation", "forecast_bias", "segment_error"]
    last = alerts.monitoring_alerts(frame, limits).orderBy(F.col("ordinal").desc()).first()
    assert (last.segment, last.severity, last.threshold) == ("category=frozen", "medium", pytest.approx(1.875))
    bias = signals(spark, psi=0.01, mae=1.1, reference_mae=1.0, bias=0.6)
    assert kinds(bias, alerts.Thresholds(bias_ratio=0.4)) == ["forecast_bias"]
    coverage = signals(spark, psi=0.01, mae=1.0, reference_mae=1.0, interval_coverage=0.70, target_coverage=0.90)
    assert kinds(coverage, alerts.Thresholds()) == ["interval_undercoverage"]
    assert kinds(signals(spark, psi=0.2, max_feature_shift=2.0), alerts.Thresholds()) == ["prediction_drift", "feature_drift"]
    assert kinds(signals(spark, mae=9.0, bias=9.0, segment_mae=9.0, reference_mae=0.0), alerts.Thresholds()) == []


@pytest.mark.parametrize(
    "name, value",
    [("psi", 0.0), ("mae_degradation_ratio", 1.0), ("bias_ratio", 0.0), ("feature_mean_shift", 0.0), ("interval_coverage_ratio", 1.1)],
)
def test_thresholds_are_checked(name, value):
    with pytest.raises(ValueError):
        alerts.Thresholds(**{name: value})


def test_monitoring_from_log_to_plan(spark, tmp_path):
    log = spark.createDataFrame(
        [("m1", p, p + 8.0, 0.1) for p in (10.0, 11.0, 12.0)] + [("m2", p, p, 0.1) for p in (9.0, 10.0, 11.0)],
        "model_version string, predicted_units double, actual_units double, price double",
    )
    baseline = spark.createDataFrame(
        [("m1", 10.0, 2.0, 1.0, 0.9), ("m2", 10.0, 2.0, 1.0, 0.9)],
        "model_version string, mean double, std double, reference_mae double, target_coverage double",
    )
    profile = spark.createDataFrame([("price", 0.1, 1.0)], "feature string, mean double, std double")
    limits = alerts.Thresholds(psi=50.0)
    report = alerts.monitor_report(alerts.monitoring_signals(log, baseline, profile, ["price"]), limits)
    rows = {r.model_version: r for r in report.collect()}
    assert rows["m1"].retrain_recommended and rows["m1"].reason == alerts.ALERTS["error_degradation"][1]
    assert [a.type for a in rows["m1"].alerts] == ["error_degradation", "forecast_bias"]
    assert not rows["m2"].retrain_recommended and rows["m2"].reason == alerts.QUIET_REASON
    plans = {r.model_version: r for r in retraining.retraining_plan(report, "report", "now", "retrain").collect()}
    assert (plans["m1"].priority, plans["m1"].status) == ("high", "ready_to_retrain")
    assert plans["m1"].alert_types == ["error_degradation", "forecast_bias"]
    assert plans["m1"].next_steps == [retraining.STEPS["error_degradation"], retraining.STEPS["forecast_bias"]]
    report.write.parquet(str(tmp_path / "report"))
    stored = retraining.plan_from_report(spark, str(tmp_path / "report"), "now", "retrain").filter("triggered").first()
    assert (stored.model_version, stored.source_report) == ("m1", str(tmp_path / "report"))
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        retraining.plan_from_report(spark, str(tmp_path / "missing"), "now", "retrain")
    assert (plans["m2"].priority, plans["m2"].status, plans["m2"].next_steps, plans["m2"].retrain_command) == ("low", "no_action", [], "")


def test_retraining_helpers(spark):
    table = spark.createDataFrame(
        [("m1", "segment_error", "medium"), ("m1", "prediction_drift", "HIGH"), ("m2", "other", "medium"), ("m3", "other", "info")],
        "model_version string, type string, severity string",
    )
    assert {tuple(r) for r in retraining.retraining_priority(table, ["model_version"]).collect()} == {
        ("m1", "high"), ("m2", "medium"), ("m3", "low"),
    }
    steps = {r.model_version: r.next_steps for r in retraining.retraining_steps(table, ["model_version"]).collect()}
    assert steps["m1"] == [retraining.STEPS["prediction_drift"], retraining.STEPS["segment_error"]]
    assert steps["m2"] == [retraining.FALLBACK_STEP]


def candidate(spark, r2=0.8, mae=2.0, baseline=4.0, champion=None):
    return spark.createDataFrame([(r2, mae, baseline, champion)], "r2 double, mae double, baseline_mae double, champion_mae double")


@pytest.mark.parametrize(
    "given, reason",
    [
        ({}, governance.PASSED),
        ({"champion": 1.5}, governance.OVER_CHAMPION),
        ({"champion": 1.5, "mae": 4.3}, governance.OVER_BASELINE),
        ({"champion": 1.5, "mae": 4.3, "r2": 0.1}, governance.LOW_R2),
        ({"champion": 2.0 / 1.02}, governance.PASSED),
    ],
)
def test_promotion_gate_reports_its_first_failure(spark, given, reason):
    row = governance.promotion_gate(candidate(spark, **given)).first()
    assert (row.reason, row.promoted) == (reason, reason == governance.PASSED)


def test_scorecard(spark):
    row = governance.promotion_scorecard(candidate(spark, champion=1.5)).first()
    assert (row.mae_improvement_vs_baseline, row.mae_ratio_vs_baseline, row.mae_delta_vs_champion) == (2.0, 0.5, 0.5)
    first = governance.promotion_scorecard(candidate(spark, baseline=0.0)).first()
    assert (first.mae_ratio_vs_baseline, first.champion_mae, first.mae_delta_vs_champion) == (None, None, None)
    for wrong in ({"min_validation_r2": -2.0}, {"max_baseline_mae_ratio": 0.0}, {"max_champion_mae_ratio": 0.9}):
        with pytest.raises(ValueError):
            governance.GateLimits(**wrong)


def test_current_champion(spark):
    gated = spark.createDataFrame(
        [("v1", True, 2.0, 0.5, "ok", "t1"), ("v2", True, 1.9, 0.6, "ok", "t2"), ("v3", False, 1.0, 0.1, "no", "t3")],
        "model_version string, promoted boolean, mae double, r2 double, reason string, registered_at string",
    )
    versions = governance.version_records(gated)
    assert governance.current_champion(versions).first().version == "v2"
    assert governance.require_champion(versions).first().version == "v2"
    none = versions.filter("stage = 'candidate'")
    assert governance.current_champion(none).count() == 0
    with pytest.raises(Exception, match="no champion"):
        governance.require_champion(none).collect()


def test_version_records_carry_their_scorecard(spark):
    gated = governance.promotion_gate(candidate(spark, champion=1.9)).withColumn("model_version", F.lit("v7"))
    row = governance.version_records(gated, "t", "runs/7", "models/7", ["price"], governance.GateLimits()).first()
    assert (row.version, row.stage, row.source_run, row.model_path) == ("v7", "candidate", "runs/7", "models/7")
    assert row.feature_columns == ["price"]
    assert row.promotion_scorecard.mae_delta_vs_champion == pytest.approx(0.1)


def test_run_records(spark):
    assert tuple(governance.run_record(spark, "r1", "demand", "now").first()) == ("r1", "demand", "now")
    with pytest.raises(ValueError, match="experiment"):
        governance.run_record(spark, "r1", " ", "now")
    counts = spark.sql("SELECT 12L AS train_rows")
    rows = governance.run_parameters(spark, "r1", {"a": {"b": 1, "c": {"d": "x"}}, "e": 0.5}, counts).collect()
    assert {(r.run_id, r.name, r.value) for r in rows} == {
        ("r1", "a.b", "1"), ("r1", "a.c.d", "x"), ("r1", "e", "0.5"), ("r1", "train_rows", "12"),
    }
    long = governance.run_metrics("r1", {"test": spark.sql("SELECT 1.5D AS mae, 3L AS rows, 'x' AS label")}).collect()
    assert {(r.name, r.value) for r in long} == {("test_mae", 1.5), ("test_rows", 3.0)}


def test_prediction_summary(spark):
    frame = spark.createDataFrame(
        [("s1", "a", 10.0, 12.0), ("s1", "b", 20.0, 18.0), ("s2", "a", 40.0, 39.0)],
        "store_id string, sku_id string, predicted_units double, actual_units double",
    )
    row = scoring.prediction_summary(frame).first()
    assert (row.rows, row.unique_stores, row.unique_skus, row.has_actuals) == (3, 2, 2, True)
    assert row.p90_predicted_units == pytest.approx(36.0)
    for bad in (None, float("nan"), float("inf"), float("-inf")):
        with pytest.raises(Exception, match="cannot be evaluated"):
            scoring.prediction_summary(frame.withColumn("predicted_units", F.when(F.col("sku_id") == "a", F.lit(bad)).otherwise(1.0))).collect()
    with pytest.raises(Exception, match="empty"):
        scoring.prediction_summary(frame.limit(0)).collect()
    by_store = {r.store_id: (r.rows, r.unique_stores, r.unique_skus) for r in scoring.prediction_summary(frame, ["store_id"]).collect()}
    assert by_store == {"s1": (2, 1, 2), "s2": (1, 1, 1)}
    bare = scoring.prediction_summary(frame.select("predicted_units")).first()
    assert (bare.unique_stores, bare.unique_skus, bare.has_actuals) == (0, 0, False)


def weekly_series(spark, days=120):
    """Demand with a weekly shape and a price effect, so that a model can beat the naive mean."""
    rng = random.Random(11)
    rows = []
    for store in ("s1", "s2"):
        for sku, base in (("a", 40), ("b", 80)):
            for i in range(days):
                promotion = int(rng.random() < 0.2)
                units = base + (25 if i % 7 in (2, 3) else 0) + 15 * promotion + rng.randint(-2, 2)
                rows.append(raw_row(i, store, sku, units, 5.0 - promotion, promotion))
    return features.build_features(silver_table(spark, rows))


def test_trees_beat_the_naive_forecast_and_survive_a_save(spark, tmp_path):
    frame = weekly_series(spark)
    cut = dt.date(2025, 1, 1) + dt.timedelta(100)
    train, test = frame.filter(F.col("date") < cut), frame.filter(F.col("date") >= cut)
    model = models.fit(train, rounds=15, rate=0.3)
    model.write().overwrite().save(str(tmp_path / "model"))
    from pyspark.ml import PipelineModel

    loaded = PipelineModel.load(str(tmp_path / "model"))
    scored = scoring.batch_score(test, loaded, "trees", "now", radius=5.0)
    naive = scoring.batch_score(test, models.naive_forecast, "naive", "now")
    assert scored.count() == test.count()
    assert scored.agg(F.avg("absolute_error")).first()[0] < 0.7 * naive.agg(F.avg("absolute_error")).first()[0]
    assert {"prediction_lower", "prediction_upper", "prediction_timestamp", *FEATURE_COLUMNS} <= set(scored.columns)
    compared = models.compare_models(
        scored.select("model_version", "actual_units", "predicted_units").unionByName(
            naive.select("model_version", "actual_units", "predicted_units")
        ),
        "naive",
        [],
    )
    ratio = {r.model_version: r.mae_vs_baseline for r in compared.collect()}
    assert ratio["naive"] == 1.0 and ratio["trees"] < 0.7


def test_registered_tree_champion_is_loaded_and_scored(spark, tmp_path):
    frame, store = weekly_series(spark, 60), str(tmp_path / "models")
    trees = models.fit(frame, rounds=3, rate=0.3)
    scoring.save_version(spark, store, "trees/1", trees, FEATURE_COLUMNS, 5.0, 0.8)
    scoring.save_version(spark, store, "lag", models.column_model("lag_1_units"), ["lag_1_units"])
    gated = spark.createDataFrame(
        [("lag", True, 2.0, 0.5, "ok", "t1"), ("trees/1", True, 1.9, 0.6, "ok", "t2")],
        "model_version string, promoted boolean, mae double, r2 double, reason string, registered_at string",
    )
    versions = governance.version_records(gated)
    key = ["date", "store_id", "sku_id", "model_version", "predicted_units", "prediction_lower", "prediction_upper", "prediction_interval_coverage"]
    rows = lambda df, columns: sorted(map(tuple, df.select(*columns).collect()))
    got = scoring.champion_scores(frame, governance.current_champion(versions), store)
    want = scoring.batch_score(frame, trees, "trees/1", "now", 5.0, 0.8)
    assert rows(got, key) == rows(want, key) and got.filter("predicted_units > 0").count() > 0
    first = governance.current_champion(versions.filter("version = 'lag'"))
    plain = scoring.champion_scores(frame, first, store)
    assert "prediction_lower" not in plain.columns and plain.filter("predicted_units <> lag_1_units").count() == 0
    with pytest.raises(ValueError, match="lag_1_units"):
        scoring.champion_scores(frame.drop("lag_1_units"), first, store)
    with pytest.raises(Exception, match="version lag gives no forecast"):
        scoring.champion_scores(frame.withColumn("lag_1_units", F.lit(None).cast("double")), first, store).collect()
    unknown = versions.withColumn("version", F.lit("v9"))
    with pytest.raises(ValueError, match="v9"):
        scoring.champion_scores(frame, governance.current_champion(unknown), store)


def test_backtests_report_every_fold(spark):
    frame = weekly_series(spark, 60)
    naive = models.backtest_naive(frame, 7, 3).orderBy("fold").collect()
    assert [r.fold for r in naive] == [1, 2, 3]
    assert all(r.train_end < r.validation_start and r.validation_rows == 28 for r in naive)
    report = models.backtest_summary(models.backtest_naive(frame, 7, 3)).first()
    assert report.mean_mae == pytest.approx(np.mean([r.mae for r in naive]))
    assert report.mae_std == pytest.approx(np.std([r.mae for r in naive]))
    trees = models.backtest_trees(frame, 7, 2, rounds=3).collect()
    assert sorted(r.fold for r in trees) == [1, 2]


def test_folds_share_a_stored_matrix_and_equal_fits_of_their_own(spark, tmp_path):
    """The report reads the matrix and no history; categories that a fold has not seen change nothing."""
    frame = weekly_series(spark, 60)
    late = frame.groupBy().agg(F.max("date")).first()[0] - dt.timedelta(8)
    frame = frame.withColumn("category", F.when(F.col("date") > late, "new").otherwise(F.col("category")))
    history = str(tmp_path / "history")
    frame.write.parquet(history)
    stored = spark.read.parquet(history)
    got = models.backtest_trees(stored, 7, 2, rounds=3, matrix_path=str(tmp_path / "matrix"), parallel=2)
    assert got.inputFiles() and all("/matrix/" in f for f in got.inputFiles())
    rows = splits.rolling_origin(frame, 7, 2)
    for row in got.collect():
        in_fold = rows.filter(F.col("fold") == row.fold)
        model = models.fit(in_fold.filter("split = 'train'"), 3, models.DEFAULT_SEED + row.fold)
        scored = models.predict(model, in_fold.filter("split = 'validation'"))
        assert row.mae == pytest.approx(scored.agg(F.avg(F.abs(F.col("predicted_units") - F.col("units_sold")))).first()[0])


def test_side_by_side_keeps_order_pools_and_errors(spark):
    pool = lambda: spark.sparkContext.getLocalProperty("spark.scheduler.pool")
    meeting = threading.Barrier(2)  # passes only if both run at once

    def job():
        meeting.wait(30)
        return pool(), spark.range(10).count()

    assert models.side_by_side(spark, {"a": job, "b": job}, 2) == [("a", 10), ("b", 10)]
    assert pool() is None
    with pytest.raises(ZeroDivisionError):
        models.side_by_side(spark, {"a": lambda: 1, "b": lambda: 1 / 0}, 2)


def test_a_candidate_is_compared_with_naive(spark):
    labelled = splits.time_split(weekly_series(spark), 21, 21)
    found = {(r.model_version, r.split): r for r in models.candidate_report(labelled, 15, rate=0.3).collect()}
    assert set(found) == {(m, s) for m in ("naive", "trees") for s in ("validation", "test")}
    assert all(r.beats_baseline == (r.model_version == "trees") for r in found.values())


def test_scores_without_target_and_empty_records(spark):
    frame = features.build_features(two_series(spark))
    log = scoring.batch_score(frame.drop("units_sold"), models.naive_forecast, "naive", "now")
    assert "actual_units" not in log.columns and "prediction_lower" not in log.columns
    empty = scoring.score_records(frame.limit(0), models.naive_forecast, "naive", 3.0)
    assert empty.count() == 0
    negative = frame.withColumn("rolling_7_mean_units", F.lit(-5.0))
    row = scoring.score_records(negative, models.naive_forecast, "naive", 3.0).first()
    assert (row.predicted_units, row.prediction_lower, row.prediction_upper) == (0.0, 0.0, 3.0)


def test_streamed_records_score_like_a_batch(spark, tmp_path):
    frame = features.build_features(two_series(spark))
    frame.repartition(3).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(frame.schema).parquet(str(tmp_path / "in"))
    query = score_stream(stream, models.naive_forecast, "naive", str(tmp_path / "out"), str(tmp_path / "cp"), radius=4.0)
    assert query.awaitTermination(120)
    streamed = spark.read.parquet(str(tmp_path / "out"))
    batch = scoring.score_records(frame, models.naive_forecast, "naive", 4.0, keep=["date", "store_id", "sku_id"])
    assert sorted(map(tuple, streamed.select(*batch.columns).collect())) == sorted(map(tuple, batch.collect()))
    with pytest.raises(ValueError, match="streaming"):
        score_stream(frame, models.naive_forecast, "naive", "x", "y")


def test_prediction_log_sink_is_split_by_version(spark, tmp_path):
    from demandspark.sources import writers

    frame = features.build_features(two_series(spark))
    path = str(tmp_path / "log")
    for version in ("v1", "v2"):
        writers.write_predictions(scoring.batch_score(frame, models.naive_forecast, version, "now"), path)
    log = writers.read_predictions(spark, path)
    assert {r.model_version: r["count"] for r in log.groupBy("model_version").count().collect()} == {"v1": 42, "v2": 42}


def test_baseline_profile_reads_from_json(spark, tmp_path):
    from demandspark.schemas import BASELINE_SCHEMA

    path = tmp_path / "profile.json"
    path.write_text(json.dumps({"target": {"mean": 10.0, "std": 2.0}, "reference_metrics": {"mae": 1.0}}))
    baseline = spark.read.schema(BASELINE_SCHEMA).json(str(path))
    reference = drift.coalesce_reference(baseline)
    assert reference.first().mean == 10.0
    assert drift.psi(values(spark, [10, 11, 12]), reference).first().psi > 0


# --- nothing is lost ------------------------------------------------------------------------------

LOG_COLUMNS = "model_version string, store_id string, category string, price double, predicted_units double, actual_units double"


def two_model_log(spark):
    rows = [(m, f"s{i % 2}", "c", 10.0 + i, 10.0 + i, 11.0 + i) for m in ("known", "new") for i in range(12)]
    return spark.createDataFrame(rows, LOG_COLUMNS)


def baseline_of_one(spark):
    edges = [0.0, 12.0, 15.0, 18.0, 40.0]
    return spark.createDataFrame(
        [("known", edges, [0.25] * 4, 1.0, 0.9)],
        "model_version string, bin_edges array<double>, expected_share array<double>, reference_mae double, target_coverage double",
    )


def test_rows_of_a_model_without_radius_stay(spark):
    radius = spark.createDataFrame([("known", 2.0)], "model_version string, interval_radius double")
    rows = conformal.add_intervals(two_model_log(spark), radius, by=["model_version"]).collect()
    assert len(rows) == 24
    for r in rows:
        known = r.model_version == "known"
        assert (r.prediction_lower is not None, r.prediction_upper is not None, r.prediction_interval_coverage is not None) == (known,) * 3
    with pytest.raises(Exception, match="no calibrated radius for: new"):
        conformal.interval_summary(two_model_log(spark), radius.withColumn("calibration_rows", F.lit(5)), by=["model_version"]).collect()


def test_a_model_without_baseline_is_reported(spark):
    profile = spark.createDataFrame([("price", 15.0, 2.0)], "feature string, mean double, std double")
    signals = alerts.monitoring_signals(two_model_log(spark), baseline_of_one(spark), profile, ["price"])
    found = {r.model_version: r for r in signals.collect()}
    assert set(found) == {"known", "new"}
    assert found["known"].psi is not None and found["known"].reference_mae == 1.0
    assert found["new"].psi is None and found["new"].reference_mae is None and found["new"].mae == 1.0
    assert found["new"].max_feature_shift is not None


def test_features_outside_the_log_do_not_empty_the_report(spark):
    profile = spark.createDataFrame([("humidity", 15.0, 2.0)], "feature string, mean double, std double")
    signals = alerts.monitoring_signals(two_model_log(spark), baseline_of_one(spark), profile, ["humidity"])
    assert signals.count() == 2 and signals.filter("max_feature_shift is not null").count() == 0


def test_minimal_and_unlabelled_logs(spark):
    minimal = spark.createDataFrame([(10.0, 12.0), (20.0, 19.0), (30.0, 33.0)], "predicted_units double, actual_units double")
    row = alerts.monitoring_signals(minimal, by=()).first()
    assert row.rows == 3 and row.mae == pytest.approx(2.0) and row.psi is None and row.worst_segment is None
    report = alerts.monitor_report(alerts.monitoring_signals(minimal, by=())).first()
    assert report.alert_count == 0 and report.retrain_recommended is False
    row = alerts.monitoring_signals(minimal.drop("actual_units"), by=()).first()
    assert row.rows == 3 and row.mae is None and row.interval_coverage is None


def test_full_report_has_its_members(spark):
    profile = spark.createDataFrame([("price", 15.0, 2.0)], "feature string, mean double, std double")
    log = two_model_log(spark).withColumn("date", F.lit("2026-01-01").cast("date")).withColumn("sku_id", F.monotonically_increasing_id())
    tables = alerts.monitoring_tables(log, baseline_of_one(spark), profile, ["price"])
    assert set(tables) == {"summary", "alerts", "schema", "features", "metrics", "segments", "blocks"}
    assert all(t.select("model_version").distinct().count() == 2 for n, t in tables.items() if n != "alerts")
    bare = alerts.monitoring_tables(log.select("model_version", "predicted_units"))
    assert set(bare) == {"summary", "alerts", "schema"} and bare["summary"].count() == 2


def test_target_profile_stands_in_for_the_prediction_reference(spark):
    baseline = spark.createDataFrame([(None, (10.0, 2.0, None, None))], f"prediction_reference {PROFILE}, target {PROFILE}")
    assert drift.psi(values(spark, [8, 9, 10, 11, 12]), drift.coalesce_reference(baseline)).first().psi > 0


PROFILE = "struct<mean: double, std: double, bin_edges: array<double>, expected_share: array<double>>"


def test_profiles_may_have_any_number_of_bins(spark):
    log = two_model_log(spark)
    profiles_now = spark.createDataFrame(
        [("known", [0.0, 12.0, 40.0], [0.5, 0.5]), ("new", [float(e) for e in range(9, 24)], [1.0 / 14] * 14)],
        "model_version string, bin_edges array<double>, expected_share array<double>",
    )
    found = {r.model_version: r.psi for r in drift.psi_from_bins(log, profiles_now, by=["model_version"]).collect()}
    share = 2 / 12
    assert found["known"] == pytest.approx((share - 0.5) * math.log(share / 0.5) + (0.5 - share) * math.log((1 - share) / 0.5))
    assert found["new"] > 0


@pytest.mark.parametrize("missing", ["r2", "mae", "baseline_mae"])
def test_gate_stops_on_missing_numbers(spark, missing):
    columns = {"r2": 0.9, "mae": 1.0, "baseline_mae": 4.0, "champion_mae": None}
    for bad in (None, float("nan"), float("inf")):
        row = {**columns, missing: bad}
        frame = spark.createDataFrame([tuple(row.values())], "r2 double, mae double, baseline_mae double, champion_mae double")
        with pytest.raises(Exception, match=f"finite {missing}"):
            governance.promotion_gate(frame).collect()


def test_limits_name_their_own_fields():
    for name in ("psi", "mae_degradation_ratio", "bias_ratio", "feature_mean_shift", "interval_coverage_ratio"):
        with pytest.raises(ValueError, match=name):
            alerts.Thresholds(**{name: 0.0})
    for name, value in (("min_validation_r2", -2.0), ("max_baseline_mae_ratio", 0.0), ("max_champion_mae_ratio", 0.9)):
        with pytest.raises(ValueError, match=name):
            governance.GateLimits(**{name: value})


@pytest.mark.parametrize("by", [[], ["g"]])
def test_row_index_by_one_column(spark, by):
    rows = [(i * 37 % 501, i % 3) for i in range(500)]
    frame = spark.createDataFrame(rows, "v int, g int").repartition(5)
    index = quality.row_index(frame, ["v"], by)
    seen: dict = {}
    for r in sorted(index.collect(), key=lambda r: r.v):
        key = r.g if by else 0
        assert r.row_index == seen.get(key, 0)
        seen[key] = seen.get(key, 0) + 1
    assert sum(seen.values()) == 500


def test_approximate_distinct_counts_agree_on_few_values(spark):
    log = two_model_log(spark).withColumn("sku_id", F.col("predicted_units").cast("string"))
    exact, rough = (scoring.prediction_summary(log, ["model_version"], approximate=a).orderBy("model_version").collect() for a in (False, True))
    assert exact == rough and exact[0].unique_skus == 12


def test_stored_baseline_is_monitored(spark):
    """A baseline with the target and the MAE alone, and one with a reference, features and a coverage."""
    log = spark.createDataFrame([(10.0, 12.0), (20.0, 19.0), (30.0, 33.0)], "predicted_units double, actual_units double")
    short = spark.sql("SELECT struct(20D AS mean, 5D AS std) AS target, struct(1.5D AS mae) AS reference_metrics")
    row = alerts.monitoring_signals(log, short, by=()).first()
    assert row.reference_mae == 1.5 and row.psi > 0 and row.target_coverage is None and row.mae == pytest.approx(2.0)
    assert row.psi == pytest.approx(drift.psi(log, spark.sql("SELECT 20D AS mean, 5D AS std")).first().psi)
    full = spark.sql(
        "SELECT struct(0D AS mean, 1D AS std) AS target, struct(array(0D, 15D, 40D) AS bin_edges, array(0.5D, 0.5D) AS expected_share) AS prediction_reference,"
        " map('price', struct(2D AS mean, 0.5D AS std), 'gone', struct(1D AS mean, 1D AS std)) AS features,"
        " struct(1D AS mae) AS reference_metrics, struct(0.9D AS target_coverage) AS prediction_interval"
    )
    priced = log.withColumn("price", F.lit(3.0))
    row = alerts.monitoring_signals(priced, full, feature_names=["price"], by=()).first()
    assert row.max_feature_shift == pytest.approx(2.0) and row.target_coverage == 0.9 and row.reference_mae == 1.0
    bins = spark.sql("SELECT array(0D, 15D, 40D) AS bin_edges, array(0.5D, 0.5D) AS expected_share")
    assert row.psi == pytest.approx(drift.psi_from_bins(log, bins).first().psi)
