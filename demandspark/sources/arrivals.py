"""Bronze as a stored table that takes in batches of raw rows without shuffling what it holds.

The table is partitioned by month and bucketed by a hash of the key.  A batch loses its own repeated keys first; what is left
meets the stored rows of the batch's months, bucket to bucket, and the keys that are new are appended.  Batches come in
ingest order, so a stored row always precedes an arriving one of its key and stays.  A batch that is taken in again, whole or
after a failure half way through its write, adds what is missing and nothing else.
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from demandspark.functions.guards import require_columns
from demandspark.operators import layers
from demandspark.schemas import KEY_COLUMNS, RAW_COLUMNS, RAW_SCHEMA

MONTH = "date_bucket"
HASH = "key_hash"
NO_DATE = "none"


def open_bronze(spark: SparkSession, name: str, path: str, buckets: int) -> None:
    """Make the table `name` over the folder `path`, or find the months that the folder already holds.

    A task of `take_in` reads one bucket of the months that a batch touches, so `buckets` is chosen for the rows of a month.
    A folder keeps its number of buckets for good.
    """
    if buckets < 1:
        raise ValueError("a bucketed table has at least one bucket")
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in RAW_SCHEMA.fields)
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).mkdirs(folder)
    place = path.replace("'", "\\'")
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({columns}, {HASH} bigint, {MONTH} string) USING parquet "
        f"PARTITIONED BY ({MONTH}) CLUSTERED BY ({HASH}) INTO {buckets} BUCKETS LOCATION '{place}'"
    )
    spark.sql(f"MSCK REPAIR TABLE {name}")


def read_bronze(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name).select(*RAW_COLUMNS)


def _month(date: Column) -> Column:
    return F.coalesce(F.date_format(date, "yyyy-MM"), F.lit(NO_DATE))


def _same(a: Column, b: Column) -> Column:
    """Equality that holds for two NULLs, as a plain condition: `<=>` would become a join key, which the buckets do not have."""
    return F.coalesce(a == b, a.isNull() & b.isNull())


def new_rows(batch: DataFrame, name: str, ingest_order: Sequence[str]) -> DataFrame:
    """The rows of a batch whose key the table does not hold: the first per key in ingest order, with hash and month.

    NULL is a value like others in a key.  The months of the batch, a list bounded by the calendar, prune the stored side; the
    merge hint keeps the join bucket to bucket at every size, which also leaves the result dealt like the table.
    """
    require_columns(batch, RAW_COLUMNS + tuple(ingest_order), "batch of raw rows")
    typed = batch.select(
        *[(F.to_date(f.name) if f.name == "date" else F.col(f.name).cast(f.dataType)).alias(f.name) for f in RAW_SCHEMA.fields],
        *[F.col(c).alias(f"__order_{i}") for i, c in enumerate(ingest_order)],
    )
    order = [f"__order_{i}" for i in range(len(ingest_order))]
    first = layers.bronze(typed, order).withColumns({HASH: F.xxhash64(*KEY_COLUMNS), MONTH: _month(F.col("date"))})
    months = typed.agg(F.collect_set(_month(F.col("date"))).alias("months")).scalar()
    stored = batch.sparkSession.table(name).filter(F.array_contains(months, F.col(MONTH)))
    held = stored.select(F.col(HASH).alias("__hash"), *[F.col(c).alias(f"__{c}") for c in KEY_COLUMNS]).hint("merge")
    condition = F.col(HASH) == F.col("__hash")
    for column in KEY_COLUMNS:
        condition &= _same(F.col(column), F.col(f"__{column}"))
    return first.join(held, condition, "left_anti").select(*RAW_COLUMNS, HASH, MONTH)


def take_in(batch: DataFrame, name: str, ingest_order: Sequence[str]) -> None:
    """Append the batch's new keys; one writer at a time."""
    new_rows(batch, name, ingest_order).write.insertInto(name)
