"""Registered queries: name -> function of (session, data folder)."""

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from demandspark.functions.guards import is_finite
from demandspark.functions.histogram import repair_edges
from demandspark.operators import (
    alerts,
    conformal,
    cube,
    drift,
    encoding,
    governance,
    incremental,
    layers,
    metrics,
    models,
    profiles,
    quality,
    retraining,
    scoring,
    splits,
)
from demandspark.operators import features as feature_ops
from demandspark.operators.quantiles import quantiles
from demandspark.plans import tables
from demandspark.schemas import (
    CALENDAR_COLUMNS,
    FEATURE_COLUMNS,
    KEY_COLUMNS,
    SERIES_COLUMNS,
)
from demandspark.sources import arrivals, commits, dated, demand, writers
from demandspark.streaming import quality as log_quality
from demandspark.streaming.scoring import score_stream as score_records_stream

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
KEY = list(KEY_COLUMNS)
MODEL = ["model_version"]

ROUNDING_SHIFT = 1e-9
CANDIDATE_ROUNDS = 40  # enough for the seasons that `tree_candidate` lays over the rows
ARRIVAL_BATCHES = 3
BRONZE_BUCKETS = 8

# What `operators.incremental` keeps up to date.
INCREMENTAL_COLUMNS = [
    *[c for c in FEATURE_COLUMNS if c.startswith(("lag_", "rolling_"))],
    "sku_avg_units",
    "store_avg_units",
    "price_vs_sku_avg",
]

# Gate limits loose enough for the test data, whose demand carries no learnable signal (r2 is below zero).
OPEN_GATE = governance.GateLimits(min_validation_r2=-1.0)


def presented(df: DataFrame) -> DataFrame:
    """Round numbers to six places and render dates, so that results compare across engines.

    Means over 128 or 256 rows often end exactly on half a unit of the sixth place, where the last bit
    of a sum decides the rounding; the small shift moves the rounding border off those values.
    """
    columns = []
    for field in df.schema.fields:
        kind, column = field.dataType.typeName(), F.col(f"`{field.name}`")
        if kind == "double":
            column = F.round(column + ROUNDING_SHIFT, 6)
        elif kind == "timestamp":
            column = F.date_format(column, "yyyy-MM-dd HH:mm:ss")
        elif kind == "date":
            column = F.date_format(column, "yyyy-MM-dd")
        elif kind == "integer":
            column = column.cast("bigint")
        columns.append(column.alias(field.name))
    return df.select(*columns)


def query(function: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return presented(function(spark, sf_dir))

    QUERIES[function.__name__] = run
    return function


def joined(columns: Sequence[str]) -> list:
    """Array columns as text."""
    return [F.concat_ws("; ", c).alias(c) for c in columns]


# --- sources and layers -------------------------------------------------------------------------


@query
def raw_scan(spark, sf_dir):
    return demand.conform(tables.raw(spark, sf_dir))


@query
def bronze_dedup(spark, sf_dir):
    return tables.bronze(spark, sf_dir)


@query
def bronze_arrivals(spark, sf_dir):
    """Bronze of batches in ingest order, each of which brings the rows of the batch before it once more."""
    name = tables.new_bronze(spark, BRONZE_BUCKETS)
    raw = tables.raw(spark, sf_dir)
    last = raw.agg(F.max("l_orderkey")).scalar()
    number = F.floor(F.col("l_orderkey") * ARRIVAL_BATCHES / (last + 1))
    for batch in range(ARRIVAL_BATCHES):
        arrivals.take_in(raw.filter(number.between(batch - 1, batch)), name, demand.INGEST_ORDER)
    return arrivals.read_bronze(spark, name)


@query
def bronze_sorted(spark, sf_dir):
    return layers.sort_bronze(tables.bronze(spark, sf_dir))


@query
def bronze_checks(spark, sf_dir):
    return layers.bronze_checks(tables.raw(spark, sf_dir))


@query
def silver_clip(spark, sf_dir):
    return layers.clip_values(tables.bronze(spark, sf_dir)).select(*KEY, "price", "units_sold")


@query
def silver_calendar(spark, sf_dir):
    return layers.add_calendar(tables.bronze(spark, sf_dir).select(*KEY)).select(*KEY, *CALENDAR_COLUMNS)


@query
def silver_table(spark, sf_dir):
    return layers.silver(tables.bronze(spark, sf_dir))


@query
def silver_checks(spark, sf_dir):
    return layers.silver_checks(tables.silver(spark, sf_dir))


@query
def layer_manifest(spark, sf_dir):
    return layers.layer_manifest(tables.raw(spark, sf_dir), tables.silver(spark, sf_dir))


# --- features -----------------------------------------------------------------------------------


@query
def lag_features(spark, sf_dir):
    return tables.silver(spark, sf_dir).select(
        *KEY, *[c.alias(n) for n, c in feature_ops.lag_columns().items()]
    )


@query
def rolling_mean(spark, sf_dir):
    means = tables.silver(spark, sf_dir).select(
        *KEY, *[c.alias(n) for n, c in feature_ops.rolling_mean_columns().items()]
    )
    return means.withColumn(
        "rolling_mean_delta_7_28", F.col("rolling_7_mean_units") - F.col("rolling_28_mean_units")
    )


@query
def rolling_std(spark, sf_dir):
    return tables.silver(spark, sf_dir).select(
        *KEY, *[c.alias(n) for n, c in feature_ops.rolling_std_columns().items()]
    )


@query
def cyclic_features(spark, sf_dir):
    return tables.silver(spark, sf_dir).select(
        *KEY, *[c.alias(n) for n, c in feature_ops.cyclic_columns().items()]
    )


@query
def price_vs_sku_avg(spark, sf_dir):
    return feature_ops.add_price_position(tables.silver(spark, sf_dir).select(*KEY, "price"))


@query
def price_vs_prior_avg(spark, sf_dir):
    return feature_ops.add_price_position(tables.silver(spark, sf_dir).select(*KEY, "price"), prior_only=True)


@query
def conformal_radius_textbook(spark, sf_dir):
    return conformal.conformal_radius(tables.naive(spark, sf_dir, "validation"), by=["store_id"], rank="textbook")


@query
def interaction_features(spark, sf_dir):
    return tables.silver(spark, sf_dir).select(
        *KEY, (F.col("promotion") * F.col("price")).alias("promotion_price")
    )


@query
def expanding_sku_mean(spark, sf_dir):
    mean = feature_ops.expanding_mean(F.col("units_sold"), feature_ops.series_window())
    return tables.silver(spark, sf_dir).select(*KEY, mean.alias("sku_avg_units"))


@query
def store_daily_mean(spark, sf_dir):
    return feature_ops.store_daily(tables.silver(spark, sf_dir))


@query
def expanding_store_mean(spark, sf_dir):
    return feature_ops.store_history(tables.silver(spark, sf_dir))


@query
def store_mean_join(spark, sf_dir):
    silver = tables.silver(spark, sf_dir).select(*KEY, "units_sold")
    return feature_ops.add_store_history(silver).select(*KEY, "store_avg_units")


@query
def entity_id(spark, sf_dir):
    return tables.silver(spark, sf_dir).select(*KEY, feature_ops.entity_id().alias("entity_id"))


@query
def feature_table(spark, sf_dir):
    return feature_ops.build_features(tables.silver(spark, sf_dir))


@query
def features_by_batches(spark, sf_dir):
    """Series, store and price features taken in batch by batch: each one reads the state tables and its own days."""
    silver = tables.silver(spark, sf_dir)
    state, found = incremental.empty_state(spark), None
    cuts = ["1992-01-01", "1994-01-01", "1996-07-01", "1996-07-02", "2100-01-01"]
    for first, end in zip(cuts, cuts[1:]):
        batch = silver.filter((F.col("date") >= F.lit(first).cast("date")) & (F.col("date") < F.lit(end).cast("date")))
        features, following = incremental.advance(batch, state)
        state = following.write(tables.new_path(spark, "feature_state"))
        found = features if found is None else found.unionByName(features)
    return found.select(*KEY, *INCREMENTAL_COLUMNS)


@query
def feature_table_reduced(spark, sf_dir):
    return feature_ops.build_reduced_features(tables.silver(spark, sf_dir))


# --- encoding and splits ------------------------------------------------------------------------


@query
def one_hot_wide(spark, sf_dir):
    """In sparse form, which has room for any number of categories: a row per category that is set."""
    known = encoding.category_features(tables.slice_of(spark, sf_dir, "train"))
    return encoding.one_hot_long(tables.features(spark, sf_dir), known, keep=KEY)


@query
def align_columns(spark, sf_dir):
    trained = [*FEATURE_COLUMNS, "sku_id_never_seen"]
    return encoding.align_columns(tables.features(spark, sf_dir), trained, keep=KEY)


@query
def model_matrix(spark, sf_dir):
    matrix, names, _ = encoding.model_matrix(tables.features(spark, sf_dir))
    values = vector_to_array("features")
    return matrix.select(
        *KEY,
        F.lit(len(names)).alias("width"),
        F.size(values).alias("vector_size"),
        F.aggregate(values, F.lit(0.0), lambda total, x: total + x).alias("checksum"),
    )


@query
def time_split(spark, sf_dir):
    return splits.time_split(tables.features(spark, sf_dir), 21, 21).select(*KEY, "split")


@query
def rolling_origin(spark, sf_dir):
    return splits.rolling_origin(tables.features(spark, sf_dir).select(*KEY), 21, 3)


@query
def distinct_dates(spark, sf_dir):
    return splits.distinct_dates(tables.silver(spark, sf_dir)).orderBy("date")


@query
def tagged_union(spark, sf_dir):
    keys = [*KEY, "units_sold"]
    return splits.tagged_union(
        {name: tables.slice_of(spark, sf_dir, name).select(*keys) for name in ("train", "validation", "test")}
    )


# --- metrics and intervals ----------------------------------------------------------------------


@query
def regression_metrics(spark, sf_dir):
    return metrics.regression_metrics(tables.naive(spark, sf_dir))


@query
def regression_metrics_by_store(spark, sf_dir):
    return metrics.regression_metrics(tables.naive(spark, sf_dir), by=["store_id"])


@query
def pinball_loss(spark, sf_dir):
    return metrics.pinball_loss(tables.naive(spark, sf_dir), 0.75, by=["store_id"])


@query
def inventory_cost(spark, sf_dir):
    return metrics.inventory_cost(tables.naive(spark, sf_dir), by=["store_id"])


@query
def mase_by_series(spark, sf_dir):
    return metrics.mean_absolute_scaled_error(
        tables.naive(spark, sf_dir, "test"),
        tables.slice_of(spark, sf_dir, "train"),
        7,
        by=list(SERIES_COLUMNS),
        strict=False,
    )


@query
def mase_without_history(spark, sf_dir):
    """Series of which some have no training history: those get NULL."""
    history = tables.slice_of(spark, sf_dir, "train").filter(F.col("sku_id") > "Brand#2")
    return metrics.mean_absolute_scaled_error(
        tables.naive(spark, sf_dir, "test"), history, 7, by=list(SERIES_COLUMNS), strict=False
    )


@query
def residual_summary(spark, sf_dir):
    return metrics.residual_summary(tables.forecasts(spark, sf_dir), by=MODEL)


@query
def conformal_radius(spark, sf_dir):
    return conformal.conformal_radius(tables.naive(spark, sf_dir, "validation"))


@query
def conformal_radius_by_store(spark, sf_dir):
    return conformal.conformal_radius(tables.naive(spark, sf_dir, "validation"), by=["store_id"])


@query
def conformal_summary(spark, sf_dir):
    return conformal.interval_summary(
        tables.forecasts(spark, sf_dir, "test"), tables.radius(spark, sf_dir), tables.COVERAGE, by=MODEL
    )


@query
def prediction_intervals(spark, sf_dir):
    return tables.prediction_log(spark, sf_dir).select(
        *KEY,
        *MODEL,
        "predicted_units",
        "prediction_lower",
        "prediction_upper",
        "prediction_interval_coverage",
    )


@query
def test_predictions(spark, sf_dir):
    own = tables.radius(spark, sf_dir).filter(F.col("model_version") == "naive").select("interval_radius")
    return scoring.test_predictions(tables.naive(spark, sf_dir, "test"), own)


# --- models and scoring -------------------------------------------------------------------------


@query
def naive_forecast(spark, sf_dir):
    return models.naive_forecast(tables.features(spark, sf_dir)).select(*KEY, "predicted_units")


@query
def model_vs_baseline(spark, sf_dir):
    held_out = tables.forecasts(spark, sf_dir).filter(F.col("split") != "train")
    return models.compare_models(held_out, "naive")


@query
def backtest_naive(spark, sf_dir):
    history = tables.history(spark, sf_dir)
    return models.backtest_naive(history, 21, 3)


def _finite(*names: str):
    """Whether all of the columns hold numbers."""
    return reduce(lambda a, b: a & b, [is_finite(F.col(n)) for n in names])


@query
def gbt_forecast(spark, sf_dir):
    """The forecasts of the full model, by what any SQL engine can state of them; their quality is a unit test."""
    scored = models.predict(tables.tree_model(spark, sf_dir), tables.slice_of(spark, sf_dir, "test"))
    return scored.select(*KEY, "units_sold", _finite("predicted_units").alias("is_number"))


@query
def backtest_gbt(spark, sf_dir):
    """Folds of the full model: dates, rows, and the relations that hold between any metrics."""
    history = tables.history(spark, sf_dir).drop("split")
    report = models.backtest_trees(history, 21, 3, matrix_path=tables.new_path(spark, "matrix"))
    share = [F.col(c).between(0.0, 1.0) for c in ("under_forecast_rate", "over_forecast_rate")]
    return report.select(
        "fold",
        "train_end",
        "validation_start",
        "validation_end",
        "train_rows",
        "validation_rows",
        _finite(*metrics.METRIC_COLUMNS).alias("all_numbers"),
        ((F.col("mae") <= F.col("rmse")) & (F.abs("bias") <= F.col("mae"))).alias("errors_ordered"),
        (F.col("median_absolute_error") <= F.col("p90_absolute_error")).alias("quantiles_ordered"),
        (share[0] & share[1]).alias("rates_are_shares"),
    )


@query
def tree_candidate(spark, sf_dir):
    """The boosted trees against the naive forecast on demand with a weekly and a yearly season, laid over the given rows."""
    region = F.substring("store_id", 7, 2).cast("bigint")
    units = 20 + F.when(F.weekday("date") >= 5, 30).otherwise(0) + 2 * F.month("date") + 5 * region
    labelled = splits.time_split(tables.relabelled_features(spark, sf_dir, "seasonal", units), tables.VALIDATION_DAYS, tables.TEST_DAYS)
    report = models.candidate_report(labelled, CANDIDATE_ROUNDS, matrix_path=tables.new_path(spark, "matrix"))
    return report.select(*MODEL, "split", models.model_mae("naive", ["split"]).alias("baseline_mae"), "beats_baseline")


@query
def batch_score_naive(spark, sf_dir):
    return tables.naive_scores(spark, sf_dir)


@query
def batch_score(spark, sf_dir):
    """The log of the full model over the feature table: keys, actuals, and the relations of its numbers."""
    model = tables.tree_model(spark, sf_dir)
    calibration = models.predict(model, tables.slice_of(spark, sf_dir, "validation")).withColumn(
        "actual_units", F.col("units_sold").cast("double")
    )
    log = scoring.batch_score(
        tables.features(spark, sf_dir), model, "trees", tables.SCORED_AT, conformal.conformal_radius(calibration)
    )
    forecast, low, high = F.col("predicted_units"), F.col("prediction_lower"), F.col("prediction_upper")
    return log.select(
        *KEY,
        "category",
        *MODEL,
        "prediction_timestamp",
        "actual_units",
        "prediction_interval_coverage",
        _finite("predicted_units", "prediction_lower", "prediction_upper").alias("all_numbers"),
        ((forecast >= 0) & (low >= 0)).alias("not_negative"),
        forecast.between(low, high).alias("inside_interval"),
        (F.col("absolute_error") == F.abs(forecast - F.col("actual_units"))).alias("error_agrees"),
    )


@query
def score_records(spark, sf_dir):
    radius = tables.naive_radius(spark, sf_dir)
    return scoring.score_records(tables.features(spark, sf_dir), models.naive_forecast, "naive", radius, keep=KEY)


@query
def score_stream(spark, sf_dir):
    """Stream the feature table through the scorer into a prediction log, then read the log."""
    path = tables.new_path(spark, "scored_stream")
    stream = tables.feature_stream(spark, sf_dir)
    score_records_stream(
        stream,
        models.naive_forecast,
        "naive",
        path,
        tables.new_path(spark, "stream_checkpoint"),
        tables.naive_radius(spark, sf_dir),
    ).awaitTermination()
    return spark.read.parquet(path)


@query
def prediction_summary(spark, sf_dir):
    return scoring.prediction_summary(tables.prediction_log(spark, sf_dir), by=MODEL)


@query
def batch_metrics(spark, sf_dir):
    return scoring.batch_metrics(tables.prediction_log(spark, sf_dir))


# --- profiles and drift -------------------------------------------------------------------------


@query
def prediction_profile(spark, sf_dir):
    return profiles.prediction_profile(tables.prediction_log(spark, sf_dir), by=MODEL)


@query
def training_profile(spark, sf_dir):
    return profiles.training_profile(tables.slice_of(spark, sf_dir, "train"))


@query
def feature_profile(spark, sf_dir):
    return profiles.feature_profile(tables.labelled(spark, sf_dir), where=F.col("split") == "train")


@query
def reference_bins(spark, sf_dir):
    reference = profiles.reference_distribution(tables.forecasts(spark, sf_dir, "validation"), by=MODEL)
    return profiles.bin_rows(reference, MODEL)


@query
def edge_repair(spark, sf_dir):
    """Twentieths of each SKU's units as edges; whole units tie often."""
    steps = {f"edge_{i}": i / 20 for i in range(21)}
    found = quantiles(tables.silver(spark, sf_dir), "units_sold", steps, ["sku_id"])
    edges = found.select("sku_id", F.array(*steps).alias("edges"))
    repaired = edges.select("sku_id", F.posexplode(repair_edges("edges")).alias("position", "edge"))
    return repaired.select("sku_id", "position", "edge")


@query
def psi_from_bins(spark, sf_dir):
    return drift.psi_from_bins(tables.forecasts(spark, sf_dir, "test"), tables.baseline(spark, sf_dir), by=MODEL)


@query
def psi_from_stats(spark, sf_dir):
    return drift.psi_from_stats(tables.forecasts(spark, sf_dir, "test"), tables.baseline(spark, sf_dir), by=MODEL)


@query
def psi_dispatch(spark, sf_dir):
    """The naive model keeps its stored bins; the other one has only mean and deviation."""
    keep = F.col("model_version") == "naive"
    mixed = tables.baseline(spark, sf_dir).withColumns(
        {
            "bin_edges": F.when(keep, F.col("bin_edges")),
            "expected_share": F.when(keep, F.col("expected_share")),
        }
    )
    return drift.psi(tables.forecasts(spark, sf_dir, "test"), mixed, by=MODEL)


@query
def feature_mean_shift(spark, sf_dir):
    reference = profiles.numeric_profile(tables.slice_of(spark, sf_dir, "train"))
    return drift.feature_mean_shift(tables.slice_of(spark, sf_dir, "test"), reference, FEATURE_COLUMNS)


@query
def feature_schema_report(spark, sf_dir):
    observed = tables.features(spark, sf_dir)
    report = drift.feature_schema_report(observed, [*FEATURE_COLUMNS, "category", "humidity"])
    lists = ["missing_features", "non_numeric_features", "non_finite_features"]
    return report.select(
        "expected_feature_count", "present_feature_count", "coverage", *joined(lists), "valid"
    )


@query
def log_round_trip(spark, sf_dir):
    """The prediction log appended to a store, one folder per model, and read back."""
    path = tables.new_path(spark, "log")
    writers.write_predictions(tables.naive_scores(spark, sf_dir), path)
    return writers.read_predictions(spark, path).select(*KEY, *MODEL, "predicted_units", "actual_units")


@query
def dated_slice(spark, sf_dir):
    """The test slice of a feature table in month partitions, of which the last month was written a second time."""
    path = tables.new_path(spark, "dated")
    rows = tables.features(spark, sf_dir)
    dated.write_dated(rows, path)
    last = dated.read_manifest(spark, path).agg(F.date_trunc("month", F.max("max_date")).cast("date").alias("day")).scalar()
    dated.write_dated(rows.filter(F.col("date") >= last), path)
    return dated.read_slice(spark, path, "test", tables.VALIDATION_DAYS, tables.TEST_DAYS).select(*KEY, "units_sold", "lag_1_units")


@query
def dated_manifest(spark, sf_dir):
    path = tables.new_path(spark, "dated")
    dated.write_dated(tables.silver(spark, sf_dir), path)
    return dated.read_manifest(spark, path)


@query
def committed_log(spark, sf_dir):
    """The prediction log appended in two batches, one of them twice, beside a write that failed before its commit."""
    path = tables.new_path(spark, "committed_log")
    scores = tables.naive_scores(spark, sf_dir)
    early = F.col("date") < F.lit("1995-01-01").cast("date")
    commits.append(scores.filter(early), path, "until 1994")
    commits.write_attempt(scores, path)  # nobody commits this one
    commits.append(scores.filter(early), path, "until 1994")
    commits.append(scores.filter(~early), path, "from 1995")
    return commits.read(spark, path, scores.schema).select(*KEY, *MODEL, "predicted_units", "actual_units")


@query
def csv_round_trip(spark, sf_dir):
    """Raw demand as CSV files, scanned by the contract reader."""
    path = tables.new_path(spark, "raw_csv")
    demand.conform(tables.raw(spark, sf_dir)).write.option("header", True).csv(path)
    return demand.read_raw(spark, path, fmt="csv", strict=True)


# --- quality and alerts -------------------------------------------------------------------------


@query
def interval_quality(spark, sf_dir):
    return quality.interval_quality(tables.prediction_log(spark, sf_dir), MODEL)


@query
def segment_quality(spark, sf_dir):
    return quality.segment_quality(tables.prediction_log(spark, sf_dir), min_rows=5, by=MODEL)


@query
def rolling_quality(spark, sf_dir):
    return quality.rolling_quality(tables.forecasts(spark, sf_dir), 50, KEY, MODEL)


@query
def quality_stream(spark, sf_dir):
    """Quality per model and 28 days of event time, by a stream over the files of the prediction log that then ends."""
    log = tables.prediction_log(spark, sf_dir)
    columns = [*MODEL, "date", "actual_units", "predicted_units", *quality.BOUNDS]
    source, path = tables.new_path(spark, "log_stream"), tables.new_path(spark, "window_quality")
    narrow = log.select(*columns)
    narrow.write.parquet(source)
    log_quality.closing_row(spark, narrow.schema).write.mode("append").parquet(source)
    stream = spark.readStream.schema(narrow.schema).parquet(source)
    log_quality.quality_stream(stream, path, tables.new_path(spark, "stream_checkpoint")).awaitTermination()
    return spark.read.schema(log_quality.window_quality(narrow).schema).parquet(path)


@query
def row_positions(spark, sf_dir):
    """Position of every raw row by one column, its line number over the whole table."""
    raw = tables.raw(spark, sf_dir)
    number = (F.col("l_orderkey") * 1000 + F.col("l_linenumber")) * 1000000 + F.col("l_partkey")
    rows = raw.select(number.alias("line")).distinct()
    return quality.row_index(rows, ["line"])


def _signals(spark, sf_dir) -> DataFrame:
    reference = profiles.numeric_profile(tables.slice_of(spark, sf_dir, "train"))
    return alerts.monitoring_signals(
        tables.prediction_log(spark, sf_dir), tables.baseline(spark, sf_dir), reference, FEATURE_COLUMNS
    )


RETRAIN_COMMAND = "spark-submit retrain.py"

# Tight limits, so that the steady test data raises alerts of several kinds.
TIGHT = alerts.Thresholds(
    psi=0.01, mae_degradation_ratio=1.01, bias_ratio=0.01, feature_mean_shift=0.05, interval_coverage_ratio=1.0
)


@query
def monitoring_alerts(spark, sf_dir):
    return alerts.monitoring_alerts(_signals(spark, sf_dir), TIGHT, MODEL)


@query
def monitor_metrics(spark, sf_dir):
    """The twelve metrics of the full monitoring report."""
    return _monitoring(spark, sf_dir)["metrics"]


@query
def monitor_blocks(spark, sf_dir):
    return _monitoring(spark, sf_dir)["blocks"]


def _monitoring(spark, sf_dir) -> dict[str, DataFrame]:
    reference = profiles.numeric_profile(tables.slice_of(spark, sf_dir, "train"))
    return alerts.monitoring_tables(
        tables.prediction_log(spark, sf_dir), tables.baseline(spark, sf_dir), reference, FEATURE_COLUMNS, limits=TIGHT
    )


@query
def monitor_unlabelled(spark, sf_dir):
    """Signals of a log that has no actuals yet."""
    log = tables.prediction_log(spark, sf_dir).drop("actual_units", "units_sold")
    reference = profiles.numeric_profile(tables.slice_of(spark, sf_dir, "train"))
    return alerts.monitoring_signals(log, tables.baseline(spark, sf_dir), reference, FEATURE_COLUMNS)


@query
def monitor_stored_baseline(spark, sf_dir):
    """Signals against the baseline in its stored form, written as a report and read back; it brings the feature profile."""
    path = tables.new_path(spark, "baseline")
    reference = profiles.numeric_profile(tables.slice_of(spark, sf_dir, "train"))
    writers.write_report(profiles.stored_baseline(tables.baseline(spark, sf_dir), reference), path)
    stored = demand.read_baseline(spark, path)
    return alerts.monitoring_signals(tables.prediction_log(spark, sf_dir), stored, feature_names=FEATURE_COLUMNS)


@query
def drift_over_time(spark, sf_dir):
    """PSI of the 28 days up to each date, from the stored cells; the log is not read again."""
    return cube.rolling_psi(tables.drift_cube(spark, sf_dir), tables.baseline(spark, sf_dir), 28, MODEL)


@query
def monitor_new_model(spark, sf_dir):
    """Signals of a log in which one model has neither a radius nor a baseline."""
    return alerts.monitoring_signals(tables.wider_log(spark, sf_dir), tables.baseline(spark, sf_dir))


@query
def intervals_new_model(spark, sf_dir):
    """Rows and bounded rows per model of that log: no row is lost."""
    log = tables.wider_log(spark, sf_dir)
    return log.groupBy(*MODEL).agg(F.count("*").alias("rows"), F.count("prediction_upper").alias("bounded_rows"))


@query
def monitor_summary(spark, sf_dir):
    report = alerts.monitor_report(_signals(spark, sf_dir), TIGHT)
    return report.withColumn("alert_types", F.concat_ws(",", "alerts.type")).drop("alerts")


@query
def retraining_priority(spark, sf_dir):
    fired = alerts.monitoring_alerts(_signals(spark, sf_dir), TIGHT, MODEL)
    return retraining.retraining_priority(fired, MODEL)


@query
def retraining_steps(spark, sf_dir):
    fired = alerts.monitoring_alerts(_signals(spark, sf_dir), TIGHT, MODEL)
    return retraining.retraining_steps(fired, MODEL).select(*MODEL, F.posexplode("next_steps").alias("position", "step"))


@query
def retraining_plan(spark, sf_dir):
    report = alerts.monitor_report(_signals(spark, sf_dir), TIGHT)
    plan = retraining.retraining_plan(report, "monitor_summary", tables.SCORED_AT, RETRAIN_COMMAND)
    lists = ["alert_types", "next_steps"]
    return plan.select(*[c for c in plan.columns if c not in lists], *joined(lists))


# --- governance ---------------------------------------------------------------------------------

# Column forecasts registered as model versions, oldest first; the second one is the incumbent champion.
VERSIONS = {
    "v1_rolling_7": "rolling_7_mean_units",
    "v2_rolling_28": "rolling_28_mean_units",
    "v3_lag_1": "lag_1_units",
    "v4_series_mean": "sku_avg_units",
}


def _candidates(spark, sf_dir) -> DataFrame:
    predictions = models.column_forecasts(tables.slice_of(spark, sf_dir, "validation"), VERSIONS)
    scored = metrics.regression_metrics(predictions, by=MODEL).select(*MODEL, "r2", "mae")

    return scored.withColumns(
        {"baseline_mae": models.model_mae("v1_rolling_7"), "champion_mae": models.model_mae("v2_rolling_28")}
    )


@query
def promotion_gate(spark, sf_dir):
    return governance.promotion_gate(_candidates(spark, sf_dir), OPEN_GATE)


@query
def promotion_scorecard(spark, sf_dir):
    return governance.promotion_scorecard(_candidates(spark, sf_dir), OPEN_GATE, keep=MODEL)


def _versions(spark, sf_dir) -> DataFrame:
    gated = governance.promotion_gate(_candidates(spark, sf_dir), OPEN_GATE)
    day = F.concat(F.lit("2026-01-0"), F.substring("model_version", 2, 1))  # one version a day, in their order
    stamped = gated.withColumn("registered_at", F.to_timestamp(F.concat(day, F.lit(" 06:00:00"))))
    return governance.version_records(stamped)


@query
def model_versions(spark, sf_dir):
    return _versions(spark, sf_dir)


def _stored_versions(spark, sf_dir) -> DataFrame:
    """The version records appended to a store one by one, each twice, and read back."""
    path = tables.new_path(spark, "versions")
    versions = _versions(spark, sf_dir)
    for version in VERSIONS:
        for _ in range(2):
            commits.append(versions.filter(F.col("version") == version), path, version)
    return commits.read(spark, path, versions.schema)


@query
def stored_versions(spark, sf_dir):
    return _stored_versions(spark, sf_dir)


@query
def stored_champion_scores(spark, sf_dir):
    """From the gate through the stored records to the champion's scores."""
    champion = governance.require_champion(_stored_versions(spark, sf_dir))
    store = tables.column_store(spark, sf_dir, VERSIONS)
    return scoring.champion_scores(tables.features(spark, sf_dir), champion, store).select(
        *KEY, *MODEL, "predicted_units", "actual_units", "prediction_lower", "prediction_upper"
    )


@query
def current_champion(spark, sf_dir):
    return governance.current_champion(_versions(spark, sf_dir))


@query
def champion_scores(spark, sf_dir):
    """The feature table scored by the stored model of the registered champion, with the bounds of its own calibration."""
    champion = governance.require_champion(_versions(spark, sf_dir))
    store = tables.column_store(spark, sf_dir, VERSIONS)
    return scoring.champion_scores(tables.features(spark, sf_dir), champion, store).select(
        *KEY, *MODEL, "predicted_units", "actual_units", "prediction_lower", "prediction_upper"
    )


@query
def run_params_long(spark, sf_dir):
    counts = tables.labelled(spark, sf_dir).agg(
        *[F.count_if(F.col("split") == s).alias(f"{s}_rows") for s in ("train", "validation", "test")]
    )
    settings = {
        "model_type": "naive",
        "feature_count": len(encoding.model_matrix(tables.slice_of(spark, sf_dir, "train"))[1]),
        "training": {"validation_days": tables.VALIDATION_DAYS, "test_days": tables.TEST_DAYS},
    }
    return governance.run_parameters(spark, "run-1", settings, counts)


@query
def run_metrics_long(spark, sf_dir):
    """The lag-7 forecast is the candidate, the naive one its baseline."""
    held_out = tables.forecasts(spark, sf_dir).filter(F.col("split") != "train")
    is_baseline = F.col("model_version") == "naive"
    compared = models.compare_models(held_out, "naive").select(
        F.concat(F.when(is_baseline, "baseline_").otherwise(""), "split").alias("metric_group"),
        *metrics.METRIC_COLUMNS,
        F.when(~is_baseline & (F.col("split") == "validation"), F.col("mae_vs_baseline")).alias("mae_vs_baseline"),
    )
    candidate = F.col("model_version") == "lag_7"
    tested = tables.forecasts(spark, sf_dir, "test").filter(candidate)
    radius = tables.radius(spark, sf_dir).filter(candidate).drop("model_version")
    folds = models.backtest_forecast(
        tables.history(spark, sf_dir), lambda rows: models.column_forecast(rows, tables.MODELS["lag_7"]), 21, 3
    )
    return governance.run_metrics(
        "run-1",
        {
            "residuals": metrics.residual_summary(tested),
            "prediction_interval": conformal.interval_summary(tested, radius, tables.COVERAGE),
            "rolling_origin": models.backtest_summary(folds),
        },
        compared,
    )
