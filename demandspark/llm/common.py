"""Helpers that the operators of this subpackage share."""

import tempfile
from collections.abc import Iterable, Iterator
from functools import cache
from uuid import uuid4

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# White space of the word rule [^\x20\x09-\x0D]+: blank, tab, line feed, vertical tab, form feed, return.
BLANKS = "[\\x20\\x09-\\x0D]"

# Most rows that Spark hands to Python in one Arrow batch, so that a batch of long texts stays small.
BATCH_ROWS = 1000


@cache
def _test_folder() -> tempfile.TemporaryDirectory:
    return tempfile.TemporaryDirectory(prefix="demandspark-llm-")


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share; a temporary one only where a local session names none."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local["):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    return _test_folder().name


def new_path(spark: SparkSession, name: str) -> str:
    """An unused path in the shared folder."""
    return f"{shared_folder(spark)}/demandspark-llm/{spark.sparkContext.applicationId}/{name}-{uuid4().hex}"


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write `df` as Parquet to the shared folder and read it back: cuts the lineage, outlives executors."""
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bound_batches(spark: SparkSession) -> None:
    """Keep the Arrow batches of this session at BATCH_ROWS rows or fewer."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key, "10000") or 10000) <= BATCH_ROWS:
        spark.conf.set(key, str(BATCH_ROWS))


def text_bytes(column: str = "text") -> Column:
    """A text column as UTF-8 bytes; NULL counts as empty."""
    return F.coalesce(F.col(column).cast("binary"), F.lit(b"").cast("binary"))


def word_array(text: Column) -> Column:
    """Words between white space as an array; NULL and empty texts have none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), f"{BLANKS}+"), "")


def records(columns: dict[str, Iterable], schema: pa.Schema) -> pa.RecordBatch:
    """An Arrow batch from a list or NumPy array per column."""
    return pa.RecordBatch.from_arrays(
        [
            pa.array(columns[field.name], type=field.type, from_pandas=isinstance(columns[field.name], np.ndarray))
            for field in schema
        ],
        schema=schema,
    )


def whole_groups(batches: Iterable[pa.RecordBatch], key: list[str], rows: int) -> Iterator[pa.Table]:
    """Tables of about `rows` rows that never cut a group, from batches that arrive sorted by `key`.

    The caller bounds the groups; what is held back is one table and one group.
    """
    held: list[pa.Table] = []
    count = 0
    for batch in batches:
        if batch.num_rows == 0:
            continue
        held.append(pa.Table.from_batches([batch]))
        count += batch.num_rows
        if count < rows:
            continue
        whole = pa.concat_tables(held).combine_chunks()
        same = np.ones(whole.num_rows, bool)
        for name in key:
            values = whole.column(name).to_numpy()
            same &= values == values[-1]
        cut = int(whole.num_rows - np.argmin(same[::-1])) if not same.all() else 0
        if cut:
            yield whole.slice(0, cut)
        held, count = [whole.slice(cut)], whole.num_rows - cut
    if count:
        yield pa.concat_tables(held).combine_chunks()
