"""How filters interact: what each one removes in every order, from one incremental pass over the files.

Files arrive as available-now micro-batches of a stream.  A text becomes a mask with a bit per filter that it fails.  Whether it
also fails the duplicate filter, because a smaller doc_id has the same text, is not known before the last file: on arrival a text
counts as the first of its kind, and the state of its key holds the smallest doc_id so far.  When a smaller one
arrives, the state retracts the earlier mask from the counters of its part and adds it again with the duplicate bit.  The
sink holds these signed changes; their sums are the part counters.  Text keys share a state row in buckets of bounded size, since
a call of the state function costs far more than an entry.

A counter per mask is all that the report needs: what a filter removes at a step of an order are the masks that have its
bit and none of the earlier ones.
"""

import hashlib
import math
import struct
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from itertools import permutations

import pandas as pd
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from demandspark.llm.common import records, text_bytes

# A filter is a condition for failure on (words, distinct words, A-Z characters, code points, marks).
TextFilter = Callable[[int, int, int, int, int], bool]
FILTERS: dict[str, TextFilter] = {
    "A": lambda words, distinct, upper, points, marks: words < 50,
    "B": lambda words, distinct, upper, points, marks: 100 * distinct < 65 * words,
    "C": lambda words, distinct, upper, points, marks: 100 * upper > 5 * points,
    "D": lambda words, distinct, upper, points, marks: marks > 0,
}
DUPLICATE = "E"

HELD_ROWS = 1 << 16  # rows of a task among which repeated texts are summed up before the shuffle
BUCKET_TEXTS = 256  # rows for each key of the state: one call of the state function serves a bucket of texts

_UPPER = bytes(range(ord("A"), ord("Z") + 1))
_INNER = bytes(range(0x80, 0xC0))  # bytes inside a UTF-8 character
_MARKS = b"#$%&*|"

ARRIVALS = pa.schema(
    [
        ("bucket", pa.int64()),
        ("key", pa.binary()),
        ("part", pa.string()),
        ("doc_id", pa.int64()),
        ("named", pa.bool_()),  # false where doc_id is NULL; 0 stands for it, for pandas would turn the others into floats
        ("mask", pa.int32()),
        ("n", pa.int64()),
    ]
)
ARRIVAL_COLUMNS = "bucket bigint, key binary, part string, doc_id bigint, named boolean, mask int, n bigint"
CHANGE_COLUMNS = "part string, doc_id bigint, named boolean, mask int, n bigint"
CHANGES = ["part", "doc_id", "named", "mask", "n"]
# The texts of a bucket: part names, and per text and part an entry of key, smallest doc_id, place of the name, rows.
STATE_COLUMNS = "parts array<string>, entries binary"
_ENTRY = struct.Struct("<16sqiq")


def measure(text: bytes) -> tuple[int, int, int, int, int]:
    words = text.split()  # bytes: ASCII white space alone parts words
    without = lambda some: len(text.translate(None, some))
    return len(words), len(set(words)), len(text) - without(_UPPER), without(_INNER), len(text) - without(_MARKS)


def failures(text: bytes, filters: dict[str, TextFilter]) -> int:
    """Bit k is set if the text fails the k-th filter."""
    measured = measure(text)
    return sum(1 << k for k, fails in enumerate(filters.values()) if fails(*measured))


class _Arrivals:
    """The rows of a task since the last flush, summed up by text."""

    def __init__(self, duplicate: int):
        self.duplicate = duplicate
        self.held = 0
        self.least: dict[bytes, tuple[int, int, dict[str, int]]] = {}  # smallest doc_id, mask, rows by part
        self.settled: dict[tuple[str, int | None, int], int] = {}  # (part, doc_id, mask): rows whose mask is final

    def _settle(self, part: str, doc_id: int | None, mask: int, n: int) -> None:
        at = (part, doc_id, mask)
        self.settled[at] = self.settled.get(at, 0) + n

    def add(self, key: bytes, doc_id: int | None, part: str, mask: int) -> None:
        self.held += 1
        if doc_id is None:  # no smaller doc_id, and none that it is smaller than
            return self._settle(part, None, mask, 1)
        known = self.least.get(key)
        if known is not None and doc_id > known[0]:
            return self._settle(part, doc_id, mask | self.duplicate, 1)
        if known is None or doc_id < known[0]:
            for other, n in known[2].items() if known else ():
                self._settle(other, known[0], mask | self.duplicate, n)
            known = self.least[key] = (doc_id, mask, {})
        known[2][part] = known[2].get(part, 0) + 1

    def flush(self, buckets: int) -> pa.RecordBatch:
        """The changes, in any bucket and without a key; and the first rows of each text for the state of its bucket.

        The first rows are among the changes too, as if no other file had a smaller doc_id.
        """
        rows: list[tuple] = []
        for key, (doc_id, mask, parts) in self.least.items():
            bucket = int.from_bytes(key[:8]) % buckets
            for part, n in parts.items():
                rows.append((bucket, key, part, doc_id, True, mask, n))
                self._settle(part, doc_id, mask, n)
        for (part, doc_id, mask), n in self.settled.items():
            rows.append(((doc_id or 0) * 0x9E3779B1 % buckets, None, part, doc_id or 0, doc_id is not None, mask, n))
        self.__init__(self.duplicate)
        return records(dict(zip(ARRIVALS.names, map(list, zip(*rows)))), ARRIVALS)


def arrivals(docs: DataFrame, filters: dict[str, TextFilter], buckets: int, doc_id: str, text: str, part: str) -> DataFrame:
    """The changes that rows make on arrival, and (with a key) the first rows of each text for its state."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = _Arrivals(1 << len(filters))
        for batch in batches:
            for owner, body, place in zip(*(column.to_pylist() for column in batch.columns)):
                held.add(hashlib.blake2b(body, digest_size=16).digest(), owner, place, failures(body, filters))
            if held.held >= HELD_ROWS:
                yield held.flush(buckets)
        if held.held:
            yield held.flush(buckets)

    plain = docs.select(F.col(doc_id).cast("bigint"), text_bytes(text), F.coalesce(F.col(part).cast("string"), F.lit("")))
    return plain.mapInArrow(run, ARRIVAL_COLUMNS)


Texts = dict[bytes, tuple[int, dict[str, int]]]  # key: smallest doc_id so far, its rows by part


def retract(texts: Texts, key: bytes, part: str, doc_id: int, mask: int, n: int, duplicate: int) -> list[tuple]:
    """Takes an arrival into `texts`, and returns the changes that make the counters right again."""
    least, parts = texts.get(key, (None, {}))
    if least is not None and doc_id > least:
        wrong = [(part, doc_id, n)]
    else:
        wrong = []
        if least != doc_id:
            wrong, least, parts = [(other, least, count) for other, count in parts.items()], doc_id, {}
        texts[key] = (least, parts | {part: parts.get(part, 0) + n})
    return [change for p, d, c in wrong for change in ((p, d, True, mask, -c), (p, d, True, mask | duplicate, c))]


def _unpacked(names: list[str], entries: bytes) -> Texts:
    texts: Texts = {}
    for key, least, place, n in _ENTRY.iter_unpack(entries):
        texts.setdefault(key, (least, {}))[1][names[place]] = n
    return texts


def _packed(texts: Texts) -> tuple[list[str], bytes]:
    places: dict[str, int] = {}
    entries = [
        _ENTRY.pack(key, least, places.setdefault(part, len(places)), n)
        for key, (least, parts) in texts.items()
        for part, n in parts.items()
    ]
    return list(places), b"".join(entries)


def _state_function(duplicate: int) -> Callable:
    def run(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        arrival = ["key", "part", "doc_id", "mask", "n"]
        texts = _unpacked(*state.get) if state.exists else {}
        for frame in frames:
            first = frame["key"].notna()
            moved = [
                change
                for body, part, doc_id, mask, n in zip(*(frame.loc[first, c].tolist() for c in arrival))
                for change in retract(texts, bytes(body), part, doc_id, mask, n, duplicate)
            ]
            yield frame.loc[~first, CHANGES]
            if moved:
                yield pd.DataFrame(moved, columns=CHANGES)
        state.update(_packed(texts))

    return run


@contextmanager
def _settings(spark: SparkSession, wanted: dict[str, str]) -> Iterator[None]:
    """Session settings for the length of a query's start; afterwards as they were."""
    before = {key: spark.conf.get(key, None) for key in wanted}
    for key, value in wanted.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


# Session settings that keep the state on the executors' disks, a few megabytes for each partition, instead of in their memory.
STATE_ON_DISK = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def _pattern(path: str) -> str:
    """A pattern that only `path` matches: as a plain path the file source takes folders alone, as a pattern single files too."""
    whole = path.rstrip("/")
    return f"{whole[:-1]}[{whole[-1]}]"


def _buckets(spark: SparkSession, path: str, folder: str) -> int:
    """Keys of the state, by the rows that are there at the first call; a number that later calls have to keep."""
    try:
        return spark.read.parquet(f"{folder}/buckets").first().n
    except AnalysisException:
        count = max(1, -(-spark.read.parquet(path).count() // BUCKET_TEXTS))
        spark.range(1).select(F.lit(count).cast("bigint").alias("n")).write.parquet(f"{folder}/buckets")
        return count


def changes(
    spark: SparkSession,
    path: str,
    folder: str,
    files: int | None = None,
    filters: dict[str, TextFilter] | None = None,
    settings: dict[str, str] | None = None,
    doc_id: str = "doc_id",
    text: str = "text",
    part: str = "source",
) -> DataFrame:
    """(part, doc_id, named, mask, n): the signed changes of all files under `path` that are there now.

    `folder`, in a storage that all executors share, holds the stream's checkpoint and its sink; a later call with the same
    folder takes in only the files that are new since.  `files` is the number of files of a micro-batch, by default eight for
    each core.  A stream that was broken off goes on where it stopped.  The state, 36 bytes for a text and part, lies in the executors'
    memory and in the checkpoint; `settings` such as `STATE_ON_DISK` choose another state store.
    """
    filters = FILTERS if filters is None else filters
    files = files or 8 * spark.sparkContext.defaultParallelism
    schema = spark.read.parquet(path).schema
    docs = spark.readStream.schema(schema).option("maxFilesPerTrigger", files).parquet(_pattern(path))
    arrived = arrivals(docs, filters, _buckets(spark, path, folder), doc_id, text, part)
    moved = arrived.groupBy("bucket").applyInPandasWithState(
        _state_function(1 << len(filters)), CHANGE_COLUMNS, STATE_COLUMNS, "append", GroupStateTimeout.NoTimeout
    )
    writer = moved.writeStream.format("parquet").outputMode("append").trigger(availableNow=True)
    with _settings(spark, settings or {}):
        writer.option("checkpointLocation", f"{folder}/state").start(f"{folder}/changes").awaitTermination()
    return spark.read.schema(CHANGE_COLUMNS).parquet(f"{folder}/changes")


def counters(changed: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, mask, n, good, toxic): documents, and those among them that `labels` marks, per part and mask.

    A document is good (toxic) if any of its label rows says quality = 1 (toxic = 1); without a label it is neither.
    """
    marked = labels.groupBy("doc_id").agg(F.max(F.col("quality") == 1).alias("q"), F.max(F.col("toxic") == 1).alias("t"))
    count = lambda flag: F.sum(F.when(flag, F.col("n")).otherwise(0))
    return (
        changed.withColumn("doc_id", F.when(F.col("named"), F.col("doc_id")))
        .join(marked, "doc_id", "left")
        .groupBy("part", "mask")
        .agg(F.sum("n").alias("n"), count(F.col("q")).alias("good"), count(F.col("t")).alias("toxic"))
    )


def interactions(counted: DataFrame, names: str = "ABCDE") -> DataFrame:
    """Per part, order of the filters and step, what the step's filter does; `counted` as `counters` has it.

    kept, removed, redundant (fails it, removed earlier), unique_fails (fails it alone), good_lost, toxic_lost and shapley (its
    removals over all orders).  A part has at most one row per mask, so its list is bounded by the number of filters.
    """
    bit = {name: 1 << k for k, name in enumerate(names)}
    steps = [
        F.struct(
            F.lit("".join(order)).alias("filter_order"),
            F.lit(k + 1).alias("step"),
            F.lit(sum(bit[x] for x in order[:k])).alias("earlier"),
            F.lit(bit[order[k]]).alias("own"),
        )
        for order in permutations(names)
        for k in range(len(names))
    ]
    cells = counted.groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("cells"))
    each = cells.select("part", "cells", F.explode(F.array(*steps)).alias("s")).select("part", "cells", "s.*")
    earlier, own = F.col("earlier"), F.col("own")
    orders = math.factorial(len(names))

    def total(value: Callable[[Column], Column]) -> Column:
        return F.aggregate("cells", F.lit(0).cast("bigint"), lambda sum_, c: sum_ + value(c).cast("bigint"))

    def where(condition: Callable[[Column], Column], field: str = "n") -> Column:
        return total(lambda c: F.when(condition(c["mask"]), c[field]).otherwise(0))

    fails = lambda m: m.bitwiseAND(own) != 0
    before = lambda m: m.bitwiseAND(earlier) != 0
    here = lambda m: fails(m) & ~before(m)
    share = lambda c: F.when(fails(c["mask"]), (c["n"] * orders / F.bit_count(c["mask"]))).otherwise(0)
    return each.select(
        "part",
        "filter_order",
        "step",
        where(lambda m: ~before(m) & ~fails(m)).alias("kept"),
        where(here).alias("removed"),
        where(lambda m: fails(m) & before(m)).alias("redundant"),
        where(lambda m: m == own).alias("unique_fails"),
        where(here, "good").alias("good_lost"),
        where(here, "toxic").alias("toxic_lost"),
        total(share).alias("shapley"),
    )


def audit(
    spark: SparkSession,
    path: str,
    labels: DataFrame,
    folder: str,
    files: int | None = None,
    filters: dict[str, TextFilter] | None = None,
    settings: dict[str, str] | None = None,
    **columns: str,
) -> DataFrame:
    """`interactions` of the text filters and the duplicate filter over the Parquet files under `path`.

    NULL texts count as empty, and empty texts are equal to each other.  A NULL part is the empty one.  A document without
    doc_id is no duplicate and makes none.  Rows that repeat a doc_id and its text are documents of their own, none of which is the other's
    duplicate.  Other columns are ignored; without rows the result is empty.
    """
    filters = FILTERS if filters is None else filters
    changed = changes(spark, path, folder, files, filters, settings, **columns)
    return interactions(counters(changed, labels), "".join(filters) + DUPLICATE)
