"""Table and report sinks."""

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, DoubleType, FloatType, MapType, StructType

from demandspark.functions.guards import ensure, is_finite
from demandspark.operators.layers import bronze


def write_table(
    df: DataFrame,
    path: str,
    fmt: str = "parquet",
    mode: str = "overwrite",
    partition_by: Sequence[str] = (),
) -> None:
    """Write a layer or feature table as Parquet, or as Delta where that source is installed."""
    if fmt not in ("delta", "parquet"):
        raise ValueError("fmt must be delta or parquet")
    writer = df.write.mode(mode).format(fmt)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)


def write_layer(df: DataFrame, path: str, layer: str, source: str, checks: dict, fmt: str = "parquet") -> DataFrame:
    """Write one layer and return its manifest row.

    `checks` maps a check name to an aggregate Column.  The checks are observed by the tasks that write
    the table, so the data is not read twice, and a retried task is not counted twice.
    """
    return _manifest(df, layer, source, path, _observed_write(df, path, checks, fmt))


def write_bronze(raw: DataFrame, path: str, source: str, ingest_order: Sequence[str], fmt: str = "parquet") -> DataFrame:
    """Deduplicate and write the bronze layer and return its manifest row.

    The raw rows are counted by their own job: an observation before the shuffle would count the rows of
    a stage again when lost executors make Spark repeat it.
    """
    kept = bronze(raw, ingest_order)
    rows = _observed_write(kept, path, {"rows": F.count(F.lit(1))}, fmt)["rows"]
    checks = {"rows": rows, "columns": ",".join(kept.columns), "duplicates_removed": raw.count() - rows}
    return _manifest(raw, "bronze", source, path, checks)


def _observed_write(df: DataFrame, path: str, checks: dict, fmt: str) -> dict:
    observation = Observation()
    write_table(df.observe(observation, *[expr.alias(name) for name, expr in checks.items()]), path, fmt)
    return observation.get


def _manifest(df: DataFrame, layer: str, source: str, path: str, checks: dict) -> DataFrame:
    entries = [F.lit(part) for name, value in checks.items() for part in (name, None if value is None else str(value))]
    return df.sparkSession.range(1).select(
        F.lit(layer).alias("layer"),
        F.lit(source).alias("source"),
        F.lit(path).alias("path"),
        F.create_map(*entries).alias("checks"),
    )


def append_manifest(manifest: DataFrame, path: str) -> None:
    manifest.write.mode("append").parquet(path)


def all_finite(value: Column, kind: DataType) -> Column | None:
    """Whether every number in a value is NULL or finite, in structs, arrays and maps too; None where there are none."""
    if isinstance(kind, (DoubleType, FloatType)):
        return value.isNull() | is_finite(value)
    if isinstance(kind, StructType):
        parts = [all_finite(value[f.name], f.dataType) for f in kind.fields]
        parts = [p for p in parts if p is not None]
        return reduce(lambda a, b: a & b, parts) if parts else None
    if isinstance(kind, MapType):
        return all_finite(F.map_values(value), ArrayType(kind.valueType))
    if isinstance(kind, ArrayType) and all_finite(F.lit(None), kind.elementType) is not None:
        return F.coalesce(F.forall(value, lambda x: all_finite(x, kind.elementType)), F.lit(True))
    return None


def write_report(df: DataFrame, path: str) -> None:
    """Write report rows as JSON lines; NULL fields are kept and non-finite numbers stop the job."""
    checked = df
    for field in df.schema.fields:
        finite = all_finite(F.col(f"`{field.name}`"), field.dataType)
        if finite is not None:
            checked = checked.filter(ensure(finite, f"report column {field.name} is not finite"))
    checked.write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def write_predictions(df: DataFrame, path: str) -> None:
    """Append scored rows to the prediction log, one folder per model version."""
    write_table(df, path, mode="append", partition_by=("model_version",))


def read_predictions(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)
