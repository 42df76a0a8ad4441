"""Token ids in files of patched frame-of-reference blocks.

A written folder holds Parquet files with one row per segment: (part, segment, start, n_docs, n_tokens, data).  Parts follow
each other in document order, and so do the segments of a part; `start` counts the ids before the segment in its part.
`data` is, in little-endian bytes:

    magic "PFB1" | u8 bytes of an id | u8 0 | u16 block size | u64 ids | u64 blocks | u64 start of each block
    blocks: u32 minimum | u8 width | u8 0 | u16 exceptions | packed offsets, `width` bits each
            | u16 place of each exception | u32 offset of each exception
    documents: u64 lengths | u8 flags, 1 where doc_id is NULL | i64 doc_ids | u64 count, the last eight bytes

A block keeps offsets from its smallest id.  Its width is the one that holds the `quantile` of its offsets; larger
offsets are exceptions, stored whole, and leave their low bits in the packed part.
The block starts let a reader decode any range of ids without the blocks before it (`decode(..., begin, end)`).
"""

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from demandspark.llm.common import new_path, records
from demandspark.llm.tokenization import TEXTS_AT_ONCE, PieceTokenizer, SharedTokenizer

MAGIC = b"PFB1"
BLOCK = 1024
SEGMENT_IDS = 1 << 19
END_ID = 1
_HEAD = np.dtype([("magic", "S4"), ("bytes", "u1"), ("zero", "u1"), ("block", "<u2"), ("ids", "<u8"), ("blocks", "<u8")])
_BLOCK_HEAD = np.dtype([("minimum", "<u4"), ("width", "u1"), ("zero", "u1"), ("exceptions", "<u2")])

SEGMENTS = pa.schema(
    [
        ("part", pa.int32()),
        ("segment", pa.int32()),
        ("start", pa.int64()),
        ("n_docs", pa.int64()),
        ("n_tokens", pa.int64()),
        ("data", pa.binary()),
    ]
)
TOKENS = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])


def _widths(values: np.ndarray) -> np.ndarray:
    """Bits that each non-negative value below 2**32 needs."""
    return np.frexp(values.astype(np.float64))[1].astype(np.int64)


def _lanes(bits: int) -> Iterator[tuple[int, int, int]]:
    """Of 64 values that fill `bits` words of 64 bits: each one's number, first word and place in it."""
    for number in range(64):
        yield number, *divmod(number * bits, 64)


def _packed(values: np.ndarray, bits: int) -> np.ndarray:
    """The low `bits` bits of each row's values, one after the other, as bytes; rows are multiples of 64 long."""
    lanes = np.ascontiguousarray(values.reshape(-1, 64).T).astype(np.uint64) & np.uint64((1 << bits) - 1)
    words = np.zeros((bits, lanes.shape[1]), np.uint64)
    for number, word, place in _lanes(bits):
        if bits:
            words[word] |= lanes[number] << np.uint64(place)
        if place + bits > 64:
            words[word + 1] |= lanes[number] >> np.uint64(64 - place)
    return np.ascontiguousarray(words.T).astype("<u8").view(np.uint8).reshape(len(values), values.shape[1] * bits // 8)


def _unpacked(lines: np.ndarray, bits: int, size: int) -> np.ndarray:
    """Rows of `size` values from what `_packed` made of them."""
    words = np.ascontiguousarray(np.ascontiguousarray(lines).view("<u8").reshape(-1, bits).T).astype(np.uint64)
    lanes = np.empty((64, words.shape[1]), np.uint64)
    for number, word, place in _lanes(bits):
        lanes[number] = words[word] >> np.uint64(place)
        if place + bits > 64:
            lanes[number] |= words[word + 1] << np.uint64(64 - place)
    lanes &= np.uint64((1 << bits) - 1)
    return np.ascontiguousarray(lanes.T).astype(np.uint32).reshape(len(lines), size)


def encode(ids: np.ndarray, quantile: float = 0.9) -> bytes:
    """Header, block index and blocks of a sequence of ids below 2**32."""
    ids = np.ascontiguousarray(ids, "<u4")
    blocks = -(-len(ids) // BLOCK)
    head = np.array((MAGIC, 4, 0, BLOCK, len(ids), blocks), _HEAD).tobytes()
    if not blocks:
        return head
    grid = np.full(blocks * BLOCK, ids[-1], np.uint32)  # the last block is filled up with its last id
    grid[: len(ids)] = ids
    grid = grid.reshape(blocks, BLOCK)
    least = grid.min(axis=1)
    grid -= least[:, None]
    place = min(BLOCK - 1, int(quantile * BLOCK))
    width = _widths(np.partition(grid, place, axis=1)[:, place])
    packed: list[bytes] = [b""] * blocks
    for bits in np.unique(width).tolist():
        rows = np.flatnonzero(width == bits)
        for some in np.array_split(rows, -(-len(rows) // 256)):
            lines = _packed(grid[some], bits)
            large = grid[some] >= (1 << bits)
            for row, line, mark in zip(some.tolist(), lines, large):
                where = np.flatnonzero(mark)
                front = np.array((least[row], bits, 0, len(where)), _BLOCK_HEAD).tobytes()
                packed[row] = front + line.tobytes() + where.astype("<u2").tobytes() + grid[row, where].astype("<u4").tobytes()
    sizes = np.array([len(b) for b in packed], np.uint64)
    starts = np.uint64(len(head) + 8 * blocks) + np.cumsum(sizes) - sizes
    return head + starts.astype("<u8").tobytes() + b"".join(packed)


def decode(data: bytes | pa.Buffer, begin: int = 0, end: int | None = None) -> np.ndarray:
    """The ids from place `begin` to before `end`, from the blocks that hold them."""
    head = np.frombuffer(data, _HEAD, 1)[0]
    if bytes(head["magic"]) != MAGIC:
        raise ValueError("not a block file")
    size, total, blocks = int(head["block"]), int(head["ids"]), int(head["blocks"])
    end = total if end is None else min(end, total)
    if begin >= end:
        return np.zeros(0, np.uint32)
    first, last = begin // size, -(-end // size)
    starts = np.frombuffer(data, "<u8", blocks, _HEAD.itemsize)[first:last].astype(np.int64)
    raw = np.frombuffer(data, np.uint8)
    fronts = raw[starts[:, None] + np.arange(_BLOCK_HEAD.itemsize)].copy().view(_BLOCK_HEAD)[:, 0]
    out = np.zeros((last - first, size), np.uint32)
    starts = starts + _BLOCK_HEAD.itemsize
    for bits in np.unique(fronts["width"]).tolist():
        rows = np.flatnonzero(fronts["width"] == bits)
        for some in np.array_split(rows, -(-len(rows) // 256)) if bits else ():
            out[some] = _unpacked(raw[starts[some][:, None] + np.arange(size * bits // 8)], bits, size)
    for row in np.flatnonzero(fronts["exceptions"]).tolist():
        count, at = int(fronts["exceptions"][row]), int(starts[row]) + size * int(fronts["width"][row]) // 8
        where = np.frombuffer(data, "<u2", count, at)
        out[row, where] = np.frombuffer(data, "<u4", count, at + 2 * count)
    out += fronts["minimum"][:, None]
    return out.reshape(-1)[begin - first * size : end - first * size]


def _segment(owners: list, parts: list[np.ndarray]) -> bytes:
    """One segment's bytes: the encoded ids, then the document table."""
    body = encode(np.concatenate(parts))
    lengths = np.array([len(p) for p in parts], "<u8")
    flags = np.array([o is None for o in owners], np.uint8)
    names = np.array([0 if o is None else o for o in owners], "<i8")
    front = np.array([len(owners)], "<u8")
    table = b"".join(x.tobytes() for x in (lengths, flags, names, front))
    return body + table


def _documents(data: bytes | pa.Buffer) -> tuple[list, np.ndarray]:
    """Owners and lengths from the table at the end of a segment, whose last field is its count."""
    count = int(np.frombuffer(data, "<u8", 1, len(data) - 8)[0])
    at = len(data) - 8 - 17 * count
    lengths = np.frombuffer(data, "<u8", count, at).astype(np.int64)
    flags = np.frombuffer(data, np.uint8, count, at + 8 * count)
    names = np.frombuffer(data, "<i8", count, at + 9 * count)
    return [None if f else n for f, n in zip(flags.tolist(), names.tolist())], lengths


def encoded(batches: Iterator[pa.RecordBatch], coder: PieceTokenizer) -> Iterator[tuple[int | None, np.ndarray]]:
    """Owner and ids of each document; beyond the batch that Spark sends, only `TEXTS_AT_ONCE` texts and their ids are held."""
    for batch in batches:
        for some in (batch.slice(at, TEXTS_AT_ONCE) for at in range(0, batch.num_rows, TEXTS_AT_ONCE)):
            yield from zip(some.column(0).to_pylist(), coder.encode(some.column(1).to_pylist()))


def write_tokens(
    docs: DataFrame, tokenizer: SharedTokenizer, path: str, doc_id: str = "doc_id", text: str = "text", end_id: int = END_ID
) -> None:
    """Write the ids of all documents, each closed by `end_id`, in ascending doc_id order.

    NULL and empty texts have the end id alone.  Rows without doc_id come first; rows that repeat one lie next
    to each other.  Other columns are ignored.  Whole files are committed by Spark, so a lost task leaves none behind.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, part = tokenizer.get(), TaskContext.get().partitionId()
        segment = start = held = 0
        owners: list = []
        parts: list[np.ndarray] = []

        def flush() -> pa.RecordBatch:
            return records(
                {
                    "part": [part],
                    "segment": [segment],
                    "start": [start],
                    "n_docs": [len(owners)],
                    "n_tokens": [held],
                    "data": [_segment(owners, parts)],
                },
                SEGMENTS,
            )

        for owner, ids in encoded(batches, coder):
            owners.append(owner)
            parts.append(np.append(ids.astype("<u4"), np.uint32(end_id)))
            held += len(parts[-1])
            if held >= SEGMENT_IDS:
                yield flush()
                segment, start, held, owners, parts = segment + 1, start + held, 0, [], []
        if owners:
            yield flush()

    plain = docs.select(F.col(doc_id).cast("bigint").alias("id"), F.coalesce(F.col(text), F.lit("")).alias("body"))
    keyed = plain.withColumn("tie", F.xxhash64("body"))
    ordered = keyed.repartitionByRange("id", "tie").sortWithinPartitions("id", "tie", "body")
    segments = ordered.select("id", "body").mapInArrow(
        run, "part int, segment int, start bigint, n_docs bigint, n_tokens bigint, data binary"
    )
    segments.write.option("compression", "none").parquet(path)


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of every document in a written folder.

    The totals of the parts come to the driver: one row per task of the writer.
    """
    segments = spark.read.parquet(path)
    totals = segments.groupBy("part").agg(F.sum("n_tokens").alias("n")).orderBy("part").collect()
    bases, total = {}, 0
    for row in totals:
        bases[row.part], total = total, total + row.n

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, start, value in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                data = value.as_buffer()  # the bytes of the batch itself: a batch holds all segments of a split
                owners, lengths = _documents(data)
                ids = decode(data)
                ends = np.cumsum(lengths)
                begins = ends - lengths
                yield records(
                    {
                        "doc_id": owners,
                        "start": bases[part] + start + begins,
                        "n_tokens": lengths,
                        "ids_crc32": [zlib.crc32(ids[a:b].tobytes()) for a, b in zip(begins.tolist(), ends.tolist())],
                    },
                    TOKENS,
                )

    return segments.select("part", "start", "data").mapInArrow(
        run, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint"
    )


def round_trip(docs: DataFrame, tokenizer: SharedTokenizer) -> DataFrame:
    """Write the documents to a new folder and describe what reading it back gives."""
    path = new_path(docs.sparkSession, "tokens")
    write_tokens(docs, tokenizer, path)
    return read_tokens(docs.sparkSession, path)
