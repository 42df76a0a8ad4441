"""Prediction drift, feature drift and the feature schema of a prediction log."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from demandspark.functions.guards import attach, ensure, is_finite, join_on
from demandspark.functions.histogram import (
    bin_of,
    checked_edges,
    shares_of,
    spread_edges,
    spread_shares,
    stability_index,
)

SMALLEST_STD = 1e-6


def _psi(df: DataFrame, profile: DataFrame, value: str, by: Sequence[str]) -> DataFrame:
    """`psi` per group; the profile holds one row per group with `bin_edges` and `expected_share`, in any number of bins.

    A group without a profile gets NULL.
    """
    edges = profile.select(*by, checked_edges().alias("bin_edges"), "expected_share")
    rows = attach(df.select(*by, F.col(value).cast("double").alias("__value")), edges.drop("expected_share"), by)
    binned = rows.groupBy(*by, bin_of("__value").alias("__bin")).agg(
        F.count(F.lit(1)).alias("__n"), F.count_if(~is_finite(F.col("__value"))).alias("__bad")
    )
    counts = binned.groupBy(*by).agg(
        F.sum("__n").alias("__rows"),
        F.sum("__bad").alias("__bad"),
        F.collect_list(F.struct("__bin", "__n")).alias("__counts"),  # one entry per bin
    )
    valid = ensure(F.coalesce("__rows", F.lit(0)) > 0, "PSI needs at least one prediction") & ensure(
        F.col("__bad") == 0, "PSI needs finite predictions"
    )
    known = attach(counts.filter(valid), edges, by, {"expected_share": "__expected"})
    return known.withColumn("__observed", shares_of("__counts", "__rows", "__expected")).select(
        *by, stability_index("__expected", "__observed").alias("psi")
    )


def _check_bins(bins: int) -> None:
    if bins < 2:
        raise ValueError("bins must be at least 2")


def psi_from_bins(
    df: DataFrame, profile: DataFrame, value: str = "predicted_units", by: Sequence[str] = ()
) -> DataFrame:
    """Population stability index against stored bin edges and shares."""
    return _psi(df, profile.select(*by, "bin_edges", "expected_share"), value, by)


def psi_from_stats(
    df: DataFrame, profile: DataFrame, value: str = "predicted_units", by: Sequence[str] = (), bins: int = 10
) -> DataFrame:
    """Population stability index against an even spread over mean +/- 3 deviations."""
    _check_bins(bins)
    spread = profile.selectExpr(
        *by, f"{spread_edges(bins)} AS bin_edges", f"{spread_shares(bins)} AS expected_share"
    )
    return _psi(df, spread, value, by)


def psi(
    df: DataFrame, profile: DataFrame, value: str = "predicted_units", by: Sequence[str] = (), bins: int = 10
) -> DataFrame:
    """Use the stored bins of a group where both arrays exist, otherwise its mean and deviation."""
    return _psi(df, _chosen_bins(profile, by, bins), value, by)


def _chosen_bins(profile: DataFrame, by: Sequence[str], bins: int = 10) -> DataFrame:
    """(by, bin_edges, expected_share): the stored bins, or an even spread where there are none."""
    _check_bins(bins)
    present = set(profile.columns)
    spread = {"bin_edges": spread_edges(bins), "expected_share": spread_shares(bins)}
    if not {"bin_edges", "expected_share"} <= present:
        return profile.selectExpr(*by, *[f"{value} AS {name}" for name, value in spread.items()])
    if not {"mean", "std"} <= present:
        return profile.select(*by, *spread)
    stored = "bin_edges IS NOT NULL AND expected_share IS NOT NULL"
    return profile.selectExpr(*by, *[f"CASE WHEN {stored} THEN {n} ELSE {value} END AS {n}" for n, value in spread.items()])


def reference_bins(profile: DataFrame, by: Sequence[str] = (), bins: int = 10) -> DataFrame:
    """`_chosen_bins` with edges that stop the job where the stored reference cannot be used."""
    chosen = _chosen_bins(profile, by, bins)
    return chosen.select(*by, checked_edges().alias("bin_edges"), "expected_share")


def is_nested(baseline: DataFrame) -> bool:
    """Whether a baseline is in its stored form: structs `target` and `prediction_reference`, a map of features."""
    kinds = {f.name: f.dataType for f in baseline.schema.fields}
    return any(isinstance(kinds.get(name), StructType) for name in ("target", "prediction_reference"))


def flat_baseline(baseline: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """A stored baseline as (by, mean, std, bin_edges, expected_share, reference_mae, target_coverage).

    The reference is `prediction_reference`, or `target` in a row where that is NULL; fields that the stored form
    lacks are NULL.
    """
    kinds = {f.name: f.dataType for f in baseline.schema.fields}

    def field(struct: str, name: str, kind: str = "double") -> Column:
        there = isinstance(kinds.get(struct), StructType) and name in kinds[struct].names
        return F.col(f"{struct}.{name}").cast(kind) if there else F.lit(None).cast(kind)

    stored = F.col("prediction_reference").isNotNull() if "prediction_reference" in kinds else F.lit(False)
    wanted = {"mean": "double", "std": "double", "bin_edges": "array<double>", "expected_share": "array<double>"}
    chosen = [
        F.when(stored, field("prediction_reference", n, kind)).otherwise(field("target", n, kind)).alias(n)
        for n, kind in wanted.items()
    ]
    return baseline.select(
        *by,
        *chosen,
        field("reference_metrics", "mae").alias("reference_mae"),
        field("prediction_interval", "target_coverage").alias("target_coverage"),
    )


def baseline_features(baseline: DataFrame, by: Sequence[str] = ()) -> DataFrame | None:
    """The feature map of a stored baseline as rows (by, feature, mean, std); None where it has no map."""
    if "features" not in baseline.columns:
        return None
    entries = baseline.select(*by, F.explode("features").alias("feature", "profile"))
    return entries.select(*by, "feature", F.col("profile.mean").alias("mean"), F.col("profile.std").alias("std"))


def coalesce_reference(baseline: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Profile to compare predictions with: `prediction_reference`, or `target` where it is missing.

    `psi` accepts the result: a target profile has a mean and a deviation but no bins.
    """
    chosen = F.coalesce("prediction_reference", "target") if "prediction_reference" in baseline.columns else F.col("target")
    return baseline.select(*by, chosen.alias("chosen")).select(*by, "chosen.*")


def finite_number(name: str) -> str:
    """SQL of a column as a finite number; text that is no number counts as missing."""
    value = f"try_cast(`{name}` AS double)"
    return f"CASE WHEN NOT isnan({value}) AND abs({value}) < double('inf') THEN {value} END"


def feature_mean_shift(
    observed: DataFrame, profile: DataFrame, features: Sequence[str], by: Sequence[str] = ()
) -> DataFrame:
    """Standardised movement of every feature mean, largest first.

    `profile` has `feature`, `mean`, `std` (and optionally `position`, which breaks ties).  Features that
    are absent from the log or have no finite value are left out.  The log is aggregated once, wide; the
    few result rows are then turned into a long table and joined with the profile.
    """
    present = [c for c in features if c in observed.columns]
    if not present:
        observed, present = observed.limit(0).withColumn("__none", F.lit(None).cast("double")), ["__none"]
    wide = observed.groupBy(*by).agg(*[F.expr(f"avg({finite_number(c)}) AS __mean_{i}") for i, c in enumerate(present)])
    pairs = ", ".join(f"struct('{c}' AS feature, __mean_{i} AS observed_mean)" for i, c in enumerate(present))
    means = wide.selectExpr(*by, f"inline(array({pairs}))").filter("observed_mean IS NOT NULL")
    order = ["position"] if "position" in profile.columns else []
    keys = [c for c in by if c in profile.columns] + ["feature"]
    reference = profile.select(*keys, *order, F.col("mean").alias("reference_mean"), F.col("std").alias("reference_std"))
    shift = (F.col("observed_mean") - F.col("reference_mean")) / F.greatest(
        F.abs(F.col("reference_std")), F.lit(SMALLEST_STD)
    )
    return (
        join_on(means, reference, keys)
        .withColumn("standardized_shift", shift)
        .withColumn("absolute_standardized_shift", F.abs("standardized_shift"))
        .orderBy(*by, F.col("absolute_standardized_shift").desc(), *order)
        .select(
            *by,
            "feature",
            "observed_mean",
            "reference_mean",
            "standardized_shift",
            "absolute_standardized_shift",
        )
    )


def feature_schema_report(observed: DataFrame, features: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Which expected features are missing, hold no numbers, or hold some values that are not finite."""
    expected = sorted(set(features))
    present = [c for c in expected if c in observed.columns]
    missing = [c for c in expected if c not in observed.columns]
    value = {c: F.col(c).try_cast("double") for c in present}
    counted = observed.groupBy(*by).agg(
        F.count(F.lit(1)).alias("__rows"),
        *[F.count_if(value[c].isNotNull() & ~F.isnan(value[c])).alias(f"__number_{i}") for i, c in enumerate(present)],
        *[F.count_if(is_finite(value[c])).alias(f"__finite_{i}") for i, c in enumerate(present)],
    )
    rows = F.col("__rows")
    empty = F.array().cast("array<string>")

    def listed(condition) -> Column:
        if not present:
            return empty
        marks = F.array(*[F.when(condition(i), F.lit(c)) for i, c in enumerate(present)])
        return F.array_compact(marks)

    def no_number(i: int) -> Column:
        return (rows > 0) & (F.col(f"__number_{i}") == 0)

    report = counted.select(
        *by,
        F.lit(len(expected)).cast("bigint").alias("expected_feature_count"),
        F.lit(len(present)).cast("bigint").alias("present_feature_count"),
        F.lit(len(present) / len(expected) if expected else 1.0).alias("coverage"),
        (F.array(*[F.lit(c) for c in missing]) if missing else empty).alias("missing_features"),
        listed(no_number).alias("non_numeric_features"),
        listed(lambda i: ~no_number(i) & (F.col(f"__finite_{i}") < rows)).alias("non_finite_features"),
    )
    lists = ("missing_features", "non_numeric_features", "non_finite_features")
    valid = F.lit(True)
    for name in lists:
        valid = valid & (F.size(name) == 0)
    return report.withColumn("valid", valid)


def largest_shift(shifts: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    return shifts.groupBy(*by).agg(F.max("absolute_standardized_shift").alias("max_feature_shift"))
