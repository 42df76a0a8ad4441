"""Retraining plans from monitoring alerts."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The step each alert type asks for, in the order steps are listed.
STEPS = {
    "prediction_drift": "refresh the recent scoring window and compare demand distribution against training",
    "feature_drift": "inspect shifted input features and verify upstream data contracts",
    "error_degradation": "retrain the candidate model and compare it against the current champion gate",
    "forecast_bias": "inspect systematic over/under-forecasting before promotion",
    "segment_error": "review the worst store/category segments and add segment-specific diagnostics",
    "interval_undercoverage": "recalibrate forecast intervals on a recent labeled validation window",
}
FALLBACK_STEP = "review the drift report before starting a retraining run"


def priority_of(severities: Column) -> Column:
    """high, medium or low, by the most severe entry of an array."""
    names = F.transform(severities, lambda s: F.lower(s))
    return F.when(F.array_contains(names, "high"), "high").when(F.array_contains(names, "medium"), "medium").otherwise("low")


def steps_of(types: Column) -> Column:
    """The steps an array of alert types asks for, or the fallback when none is known."""
    steps = F.array_compact(
        F.array(*[F.when(F.array_contains(types, kind), F.lit(step)) for kind, step in STEPS.items()])
    )
    return F.when(F.size(steps) > 0, steps).otherwise(F.array(F.lit(FALLBACK_STEP)))


def retraining_priority(alerts: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """`priority` per group of a long alert table."""
    found = alerts.groupBy(*by).agg(F.collect_set("severity").alias("severities"))
    return found.select(*by, priority_of(F.col("severities")).alias("priority"))


def retraining_steps(alerts: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """`next_steps` per group of a long alert table."""
    found = alerts.groupBy(*by).agg(F.collect_set("type").alias("types"))
    return found.select(*by, steps_of(F.col("types")).alias("next_steps"))


def plan_from_report(
    spark: SparkSession, path: str, created_at: str, command: str, by: Sequence[str] = ("model_version",)
) -> DataFrame:
    """Plan of a monitoring report written as a table; a missing report is an error."""
    return retraining_plan(spark.read.parquet(path), path, created_at, command, by)


def retraining_plan(
    report: DataFrame,
    source_report: str,
    created_at: str,
    command: str,
    by: Sequence[str] = ("model_version",),
) -> DataFrame:
    """One plan per row of a monitoring report; rows without alerts get `no_action` and priority low.

    `command` is what the caller's deployment runs to retrain.
    """
    triggered = F.col("retrain_recommended")
    empty = F.array().cast("array<string>")
    return report.select(
        *by,
        F.lit(created_at).alias("created_at"),
        triggered.alias("triggered"),
        F.when(triggered, "ready_to_retrain").otherwise("no_action").alias("status"),
        "reason",
        priority_of(F.col("alerts.severity")).alias("priority"),
        F.col("alerts.type").alias("alert_types"),
        F.when(triggered, steps_of(F.col("alerts.type"))).otherwise(empty).alias("next_steps"),
        F.when(triggered, F.lit(command)).otherwise(F.lit("")).alias("retrain_command"),
        F.lit(source_report).alias("source_report"),
    )
