"""The layer tables of one data folder, built once per session and shared by the queries.

Silver, features, calibration radii, the prediction log and the baseline profile are read by several
queries that follow them, so each is a written table, as in any layered store.  They are written as Parquet to
the shared folder that `spark.checkpoint.dir` names and read back, which cuts the lineage and survives
lost executors.  Where the setting is absent, a local session uses a temporary folder and a cluster
session persists the table instead.
"""

from collections.abc import Callable, Mapping, Sequence
from uuid import uuid4

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from demandspark.functions.storage import shared_folder as _folder, shuffles_removed
from demandspark.operators import conformal, cube, features as feature_ops, layers, models, profiles, scoring, splits
from demandspark.schemas import CATEGORICAL_COLUMNS, FEATURE_COLUMNS, KEY_COLUMNS, TARGET_COLUMN
from demandspark.sources import arrivals, demand
from demandspark.sources.writers import write_table

VALIDATION_DAYS = 21
TEST_DAYS = 21
COVERAGE = 0.90
SCORED_AT = "2026-01-01T00:00:00+00:00"

# The naive model and a second column forecast, so that every report covers more than one model.
MODELS = {"naive": "rolling_7_mean_units", "lag_7": "lag_7_units"}

_shared: dict[tuple[str, str, str], DataFrame] = {}
_paths: dict[tuple[str, str, str], str] = {}
_names: dict[tuple[str, str], str] = {}


def new_path(spark: SparkSession, name: str) -> str:
    """An unused path in the shared folder."""
    folder = _folder(spark)
    if folder is None:
        raise ValueError("spark.checkpoint.dir must name a shared folder")
    return f"{folder}/demandspark/{spark.sparkContext.applicationId}/{name}-{uuid4().hex}"


def _share(
    spark: SparkSession,
    sf_dir: str,
    name: str,
    build: Callable[[], DataFrame],
    partition_by: Sequence[str] = (),
) -> DataFrame:
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _shared:
        table = build()
        if _folder(spark):
            _paths[key] = new_path(spark, name)
            with shuffles_removed(spark):  # the written table is read from now on
                write_table(table, _paths[key], mode="errorifexists", partition_by=partition_by)
            table = spark.read.parquet(_paths[key])
        else:
            table = table.persist()
        _shared[key] = table
    return _shared[key]


def release(spark: SparkSession) -> None:
    """Forget the shared tables, models and stores, and delete all that this session wrote to the shared folder."""
    session = spark.sparkContext.applicationId
    for key in [k for k in _shared if k[0] == session]:
        _shared.pop(key).unpersist()
    for key in [k for k in _paths if k[0] == session]:
        del _paths[key]
    for key in [k for k in _names if k[0] == session]:
        spark.sql(f"DROP TABLE IF EXISTS {_names.pop(key)}")
    folder = _folder(spark)
    if folder is not None:
        place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{folder}/demandspark/{session}")
        place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)


def new_bronze(spark: SparkSession, buckets: int) -> str:
    """The name of an empty bucketed bronze table in the shared folder."""
    name = f"bronze_{uuid4().hex}"
    _names[spark.sparkContext.applicationId, name] = name
    arrivals.open_bronze(spark, name, new_path(spark, name), buckets)
    return name


def by_date(table: DataFrame) -> DataFrame:
    """Rows in date ranges, sorted, so that the files and row groups of a written table cover few dates each."""
    return table.repartitionByRange("date").sortWithinPartitions("date", "store_id", "sku_id")


def raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return demand.demand_rows(spark, sf_dir)


def bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    return layers.bronze(raw(spark, sf_dir), demand.INGEST_ORDER)


def silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _share(spark, sf_dir, "silver", lambda: by_date(layers.silver(bronze(spark, sf_dir))))


def features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _share(spark, sf_dir, "features", lambda: by_date(feature_ops.build_features(silver(spark, sf_dir))))


def relabelled_features(spark: SparkSession, sf_dir: str, name: str, units: Column) -> DataFrame:
    """The model columns of the feature table of demand whose units are `units`, a function of the silver columns; stored.

    It starts from the stored silver rows, so no raw row is shuffled again for it, and every reader has the columns from the store.
    """

    def build() -> DataFrame:
        rows = layers.silver(silver(spark, sf_dir).withColumn(TARGET_COLUMN, units))
        return feature_ops.build_features(rows).select(*dict.fromkeys(KEY_COLUMNS + CATEGORICAL_COLUMNS + FEATURE_COLUMNS), TARGET_COLUMN)

    return _share(spark, sf_dir, f"{name}_features", build)


def feature_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The files of the feature table as a stream."""
    schema = features(spark, sf_dir).schema
    path = _paths.get((spark.sparkContext.applicationId, sf_dir, "features"))
    if path is None:
        raise ValueError("streaming the feature table needs spark.checkpoint.dir")
    return spark.readStream.schema(schema).parquet(path)


def labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Feature table with its `split` column."""
    return splits.time_split(features(spark, sf_dir), VALIDATION_DAYS, TEST_DAYS)


def slice_of(spark: SparkSession, sf_dir: str, split: str) -> DataFrame:
    """One split of the feature table, with its `split` column."""
    rows = splits.time_slice(features(spark, sf_dir), split, VALIDATION_DAYS, TEST_DAYS)
    return rows.withColumn("split", F.lit(split))


def history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Training and validation rows."""
    return labelled(spark, sf_dir).filter(F.col("split") != "test")


def forecasts(spark: SparkSession, sf_dir: str, split: str | None = None) -> DataFrame:
    """Predictions of every model, long; optionally of one split."""
    frame = labelled(spark, sf_dir) if split is None else slice_of(spark, sf_dir, split)
    return models.column_forecasts(frame, MODELS)


def naive(spark: SparkSession, sf_dir: str, split: str | None = None) -> DataFrame:
    frame = labelled(spark, sf_dir) if split is None else slice_of(spark, sf_dir, split)
    return models.naive_forecast(frame).withColumn("actual_units", F.col("units_sold").cast("double"))


def radius(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conformal radius per model, calibrated on the validation slice."""
    return _share(
        spark,
        sf_dir,
        "radius",
        lambda: conformal.conformal_radius(forecasts(spark, sf_dir, "validation"), COVERAGE, by=["model_version"]),
    )


def prediction_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole feature table scored by every model, with calibrated bounds, stored by model version."""
    return _share(
        spark,
        sf_dir,
        "prediction_log",
        lambda: conformal.add_intervals(
            forecasts(spark, sf_dir), radius(spark, sf_dir), COVERAGE, by=["model_version"]
        ),
        ["model_version"],
    )


def baseline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Baseline profile per model: the validation slice is the reference."""
    return _share(
        spark,
        sf_dir,
        "baseline",
        lambda: profiles.baseline_profile(
            slice_of(spark, sf_dir, "train"), forecasts(spark, sf_dir, "validation"), COVERAGE
        ),
    )


def drift_cube(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the prediction log per model, date and bin of the model's baseline, stored once."""
    return _share(
        spark,
        sf_dir,
        "drift_cube",
        lambda: cube.log_cube(prediction_log(spark, sf_dir), baseline(spark, sf_dir), segments=(), keep=["date"]),
    )


def naive_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batch scoring of the feature table with the naive model."""
    own = radius(spark, sf_dir).filter(F.col("model_version") == "naive").select("interval_radius")
    return scoring.batch_score(features(spark, sf_dir), models.naive_forecast, "naive", SCORED_AT, own, COVERAGE)


def wider_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log with a third model that has neither a radius nor a baseline."""
    models_now = {**MODELS, "lag_14": "lag_14_units"}
    scored = models.column_forecasts(labelled(spark, sf_dir), models_now)
    return conformal.add_intervals(scored, radius(spark, sf_dir), COVERAGE, by=["model_version"])


def naive_radius(spark: SparkSession, sf_dir: str) -> float:
    """The naive model's calibrated radius, one number."""
    return radius(spark, sf_dir).filter(F.col("model_version") == "naive").first()["interval_radius"]


def tree_model(spark: SparkSession, sf_dir: str) -> PipelineModel:
    """The boosted trees of the training slice, fitted once, stored, and loaded from the store."""
    key = (spark.sparkContext.applicationId, sf_dir, "trees")
    if key not in _paths:
        _paths[key] = new_path(spark, "trees")
        models.fit(slice_of(spark, sf_dir, "train")).write().overwrite().save(_paths[key])
    return PipelineModel.load(_paths[key])


def column_store(spark: SparkSession, sf_dir: str, versions: Mapping[str, str]) -> str:
    """Folder of stored column models, each with its column and the radius calibrated on the validation slice."""
    key = (spark.sparkContext.applicationId, sf_dir, "models " + " ".join(f"{v}={c}" for v, c in versions.items()))
    if key not in _paths:
        store = new_path(spark, "models")
        calibration = models.column_forecasts(slice_of(spark, sf_dir, "validation"), versions)
        radii = conformal.conformal_radius(calibration, COVERAGE, by=["model_version"]).collect()
        own = {r["model_version"]: r["interval_radius"] for r in radii}
        for version, column in versions.items():
            scoring.save_version(spark, store, version, models.column_model(column), [column], own[version], COVERAGE)
        _paths[key] = store
    return _paths[key]
