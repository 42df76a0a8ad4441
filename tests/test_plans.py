"""Physical plans of the operators that matter at scale."""

import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from demandspark.operators import alerts, conformal, cube, drift, metrics, quality, quantiles, splits

START = dt.date(2025, 1, 1)


def executed(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def final_part(plan):
    return plan.split("== Initial Plan ==")[0]


def metric_values(df, node):
    """Output rows of the plan's nodes of a name, after a run that keeps its metrics."""
    execution = df._jdf.queryExecution()
    execution.toRdd().count()
    found, left = [], [execution.executedPlan()]
    while left:
        plan = left.pop()
        name = plan.nodeName()
        if name.startswith("AdaptiveSparkPlan"):
            left.append(plan.executedPlan())
            continue
        if "QueryStage" in name:
            left.append(plan.plan())
            continue
        children = plan.children()
        left += [children.apply(i) for i in range(children.size())]
        if name == node:
            below = plan.child()
            while "numOutputRows" not in str(below.metrics().keys().toString()) and below.children().size():
                below = below.children().apply(0)
                if "QueryStage" in below.nodeName():
                    below = below.plan()
            if below.metrics().contains("numOutputRows"):
                found.append(below.metrics().apply("numOutputRows").value())
            elif below.metrics().contains("shuffleRecordsWritten"):
                found.append(below.metrics().apply("shuffleRecordsWritten").value())
    return found


@pytest.fixture(scope="module")
def stored_log(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("log") / "rows")
    spark.range(4000).selectExpr(
        "concat('m', id % 2) AS model_version",
        "date_add(date'2025-01-01', cast(id % 100 AS int)) AS date",
        "concat('s', id % 5) AS store_id",
        "concat('k', id) AS sku_id",
        "cast(id * 7919 % 1000 AS double) / 7 AS predicted_units",
        "cast(id * 104729 % 1000 AS double) / 7 AS actual_units",
        "'unused' AS other",
    ).write.parquet(path)
    return spark.read.parquet(path)


def test_rank_search_shuffles_no_values(stored_log):
    """Four narrow passes; counts are keyed by group and digit prefix, and what holds the ranks is broadcast."""
    plan = final_part(executed(quantiles.quantiles(stored_log, "predicted_units", {"p50": 0.5}, ["model_version"])))
    assert plan.count("FileScan parquet") == len(quantiles.SHIFTS)
    keys = re.findall(r"Exchange hashpartitioning\(([^)]*)\)", plan)
    assert keys and not any(re.search(r"__v#|__value|predicted_units|__image", k) for k in keys)
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert "SortAggregate" not in plan and "store_id" not in plan


def test_rank_search_is_bounded_beside_a_far_outlier(spark):
    """A million crowded values and one far away: no running count covers more rows than a digit has values."""
    values = spark.range(0, 1_000_000, 1, 8).selectExpr("1e9D + id / 1e7D AS v").unionByName(spark.range(1).selectExpr("1e300D AS v"))
    frame = quantiles.quantiles(values, "v", {"low": 0.0, "p50": 0.5, "p90": 0.9, "high": 1.0})
    row = frame.first()
    assert (row.low, row.high, row.value_count) == (1e9, 1e300, 1_000_001)
    assert row.p50 == pytest.approx(1e9 + 500_000 / 1e7, rel=1e-15) and row.p90 == pytest.approx(1e9 + 900_000 / 1e7, rel=1e-15)
    metrics_of = [m for m in metric_values(frame, "Window") if m]
    assert metrics_of and max(metrics_of) <= len(quantiles.SHIFTS) * 65536


def test_many_groups_join_by_key(spark, monkeypatch):
    monkeypatch.setattr(quantiles, "MOST_SENT_GROUPS", 10)
    frame = spark.range(3000).selectExpr("id % 300 AS k", "cast(id AS double) AS v")
    found = quantiles.quantiles(frame, "v", {"p50": 0.5}, ["k"])
    assert "broadcast" not in found._jdf.queryExecution().optimizedPlan().toString().lower()
    assert {r.k: r.p50 for r in found.collect()} == {k: k + 300 * 4.5 for k in range(300)}


def test_metrics_read_only_their_columns(stored_log):
    plan = executed(metrics.regression_metrics(stored_log, by=["model_version"]))
    assert "other" not in plan and "sku_id" not in plan
    assert "Python" not in plan and "ObjectHashAggregate" not in plan and "SortAggregate" not in plan


def test_slices_push_their_date_bound_into_the_scan(stored_log):
    plan = executed(splits.time_slice(stored_log, "test", 5, 5))
    assert "GreaterThanOrEqual(date" in plan


def test_splits_add_no_shuffle_of_the_rows(stored_log):
    plan = splits.time_split(stored_log, 5, 5)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" not in plan and "Join" not in plan


def test_radius_table_from_storage_is_broadcast_by_size(spark, stored_log, tmp_path):
    radius = conformal.conformal_radius(stored_log, by=["model_version"])
    radius.write.parquet(str(tmp_path / "radius"))
    plan = executed(conformal.add_intervals(stored_log, spark.read.parquet(str(tmp_path / "radius")), by=["model_version"]))
    assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan


def test_stability_index_is_one_hash_aggregation(stored_log, spark):
    profile = spark.sql("SELECT array(0D, 50D, 100D, 150D) AS bin_edges, array(0.3D, 0.4D, 0.3D) AS expected_share")
    plan = final_part(executed(drift.psi_from_bins(stored_log, profile)))
    assert "SortAggregate" not in plan and "Join" not in plan


def test_row_blocks_never_number_a_whole_date(stored_log):
    plan = final_part(executed(quality.rolling_quality(stored_log, by=["model_version"])))
    windows = [line for line in plan.splitlines() if "row_number()" in line and "Window" in line]
    assert windows and all("store_id" in line for line in windows)


def test_error_checks_do_not_leak_into_callers_filters(stored_log):
    report = metrics.regression_metrics(stored_log, by=["model_version"]).filter(F.col("model_version") == "m1")
    assert report.count() == 1


def test_signals_read_the_log_once(spark, stored_log):
    """Errors, coverage, bins, feature means and segments come from one scan and one aggregation of the rows."""
    log = stored_log.selectExpr("*", "predicted_units - 3 AS prediction_lower", "predicted_units + 3 AS prediction_upper", "1.5D AS price")
    baseline = spark.sql(
        "SELECT inline(array(struct('m0' AS model_version, array(0D, 50D, 100D, 150D) AS bin_edges, array(0.3D, 0.4D, 0.3D) AS expected_share,"
        " 2D AS reference_mae, 0.9D AS target_coverage)))"
    )
    profile = spark.sql("SELECT explode(array('m0', 'm1')) AS model_version, 'price' AS feature, 1D AS mean, 0.5D AS std")
    signals = alerts.monitoring_signals(log, baseline, profile, ["price"])
    plan = final_part(executed(signals))
    assert plan.count("FileScan parquet") == 1
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    rows = {r.model_version: r for r in signals.collect()}
    assert rows["m0"].psi is not None and rows["m1"].psi is None and rows["m0"].max_feature_shift == 1.0
    assert rows["m0"].worst_segment.startswith("store_id=") and rows["m0"].interval_coverage is not None


def test_rolling_drift_reads_only_the_cells(spark, stored_log, tmp_path):
    baseline = spark.sql("SELECT array(0D, 50D, 100D, 150D) AS bin_edges, array(0.3D, 0.4D, 0.3D) AS expected_share")
    path = str(tmp_path / "cells")
    cube.log_cube(stored_log, baseline, by=(), segments=(), keep=["date"]).write.parquet(path)
    cells = spark.read.parquet(path)
    found = {r.date: r for r in cube.rolling_psi(cells, baseline, 7, by=()).collect()}
    assert len(found) == 100
    for end in (START, START + dt.timedelta(20)):
        some = stored_log.filter(F.col("date").between(end - dt.timedelta(6), end))
        want = drift.psi_from_bins(some, baseline).first().psi
        assert found[end].psi == pytest.approx(want, rel=1e-12) and found[end].rows == some.count()
