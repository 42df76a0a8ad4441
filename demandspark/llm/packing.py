"""Best-fit packing of documents into sequences under several capacities.

A piece asks for tokens, one document slot, and attention cost (its length squared, since attention stays inside a
piece).  Pieces go in order of falling length.  Among the open bins with room in every dimension the piece takes the one
with the best score: the largest weighted dot product of request and residual, or the smallest weighted norm
of what would be left.  Without such a bin a new one opens.

Pieces that fill a sequence alone need no search.  The others are dealt by a hash of their row number into groups of about `group_pieces`,
so any number of pieces is packed in parallel; what the split costs is the last, partly filled bins of each group.
"""

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandspark.llm.common import materialise, records, whole_groups
from demandspark.llm.tokenization import SharedTokenizer

END_ID = 0
PIECES = pa.schema(
    [("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())]
)
PIECE_COLUMNS = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"


@dataclass(frozen=True)
class Capacity:
    """What one sequence holds; None leaves a dimension unbounded."""

    tokens: int = 2048
    documents: int | None = None
    attention: int | None = None
    weights: tuple[float, float, float] = (1.0, 0.05, 0.05)
    score: str = "norm"  # or "dot"

    def __post_init__(self) -> None:
        if self.tokens < 1 or (self.documents or 1) < 1 or self.score not in ("norm", "dot"):
            raise ValueError("a sequence needs room for a token and a document, and a score of norm or dot")
        if self.attention is not None and self.attention < self.tokens**2:
            raise ValueError("the attention capacity must admit a full piece")

    def limits(self) -> np.ndarray:
        """Capacities of (tokens, documents, attention); what is unbounded gets a bound that never binds."""
        documents = self.tokens if self.documents is None else self.documents
        attention = self.tokens**2 if self.attention is None else self.attention
        return np.array([self.tokens, documents, attention], np.int64)


def pieces(docs: DataFrame, tokenizer: SharedTokenizer, longest: int, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, piece, start, length and ids_crc32 of every piece: a document's ids with the end id, cut from its end."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = tokenizer.get()
        for batch in batches:
            out: dict[str, list] = {name: [] for name in PIECES.names}
            for owner, ids in zip(batch.column(0).to_pylist(), coder.encode(batch.column(1).to_pylist())):
                ids = np.append(ids.astype("<u4"), np.uint32(END_ID))
                begin, end = 0, len(ids) % longest or longest
                number = 0
                while begin < len(ids):
                    for name, value in zip(
                        PIECES.names, (owner, number, begin, end - begin, zlib.crc32(ids[begin:end].tobytes()))
                    ):
                        out[name].append(value)
                    begin, end, number = end, end + longest, number + 1
            yield records(out, PIECES)

    plain = docs.select(F.col(doc_id).cast("bigint"), F.coalesce(F.col(text), F.lit("")))
    return plain.mapInArrow(run, PIECE_COLUMNS)


def best_fit(lengths: np.ndarray, capacity: Capacity) -> tuple[np.ndarray, np.ndarray]:
    """Bin number and offset of each piece, for pieces in any order."""
    limits = capacity.limits()
    weight = np.array(capacity.weights) / limits
    order = np.argsort(-lengths, kind="stable")
    room = np.zeros((len(lengths), 3), np.int64)  # residual capacities of the open bins
    names = np.zeros(len(lengths), np.int64)  # the open bins' numbers
    bins, offsets = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    least = int(lengths.min()) if len(lengths) else 0
    opened = live = 0
    for at in order:
        size = int(lengths[at])
        need = np.array([size, 1, size * size])
        fits = np.flatnonzero((room[:live, 0] >= size) & (room[:live, 1] >= 1) & (room[:live, 2] >= need[2]))
        if len(fits):
            left = room[fits]
            if capacity.score == "dot":
                chosen = int(fits[np.argmax((left * need * weight**2).sum(axis=1))])
            else:
                chosen = int(fits[np.argmin((((left - need) * weight) ** 2).sum(axis=1))])
        else:
            chosen, live = live, live + 1
            room[chosen], names[chosen] = limits, opened
            opened += 1
        bins[at], offsets[at] = names[chosen], limits[0] - room[chosen, 0]
        room[chosen] -= need
        if room[chosen, 0] < least or room[chosen, 1] < 1 or room[chosen, 2] < least * least:  # nothing fits any more
            live -= 1
            room[chosen], names[chosen] = room[live], names[live]
    return bins, offsets


def pack(cut: DataFrame, capacity: Capacity, group_pieces: int = 4096) -> DataFrame:
    """Pieces with sequence_id and offset; `cut` has the columns of `pieces` and is a written table, whose rows keep their order.

    Repeated pieces are packed once per row.  Without pieces the result is empty.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for groups in whole_groups(batches, ["lot"], 1 << 15):
            lot, length = groups.column("lot").to_numpy(), groups.column("length").to_numpy()
            sequence, offset = np.zeros(len(lot), np.int64), np.zeros(len(lot), np.int64)
            edges = np.flatnonzero(np.r_[True, lot[1:] != lot[:-1], True])
            for begin, end in zip(edges[:-1], edges[1:]):
                number, offset[begin:end] = best_fit(length[begin:end], capacity)
                sequence[begin:end] = (lot[begin] << 32) + number
            whole = groups.drop_columns(["lot"]).append_column("sequence_id", pa.array(sequence))
            yield from whole.append_column("offset", pa.array(offset)).to_batches()

    total = cut.count()
    lots = max(1, round(total / group_pieces))
    # By the row's number in the written pieces: rows that agree in everything are spread like any others.
    dealt = cut.withColumn("lot", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(lots)))
    ordered = dealt.repartition("lot").sortWithinPartitions("lot", F.desc("length"), "doc_id", "piece")
    return ordered.mapInArrow(run, PIECE_COLUMNS + ", sequence_id bigint, offset bigint")


def pack_documents(docs: DataFrame, tokenizer: SharedTokenizer, capacity: Capacity | None = None) -> DataFrame:
    """One row per piece with its sequence and place.

    NULL and empty texts are one end id.  A NULL doc_id is packed like any other.  Rows that repeat a doc_id are
    packed each.  Other columns are ignored; an empty table gives an empty result.
    """
    capacity = capacity or Capacity()
    cut = materialise(pieces(docs, tokenizer, capacity.tokens), "pieces")
    return pack(cut, capacity)
