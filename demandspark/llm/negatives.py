"""Hard negatives by exact scores from subset-sum tables (the method of the Four Russians).

Vectors are whole numbers.  A score is the inner product of an anchor and a candidate.  Eight dimensions at a time, an anchor
has a table with the sum of its components over each of the 256 subsets; a candidate is cut into bit planes, whose
eight bits of a group form a byte.  The byte indexes the table, so one look-up stands for eight products; the planes are added up
from the highest one down, shifted by one bit each time, the sign plane being negative.

Rows are dealt into a grid: stripes of candidates by stripes of anchors, both of bounded size.  A task holds one stripe of
candidates and streams its anchors past them.  What leaves a cell for an anchor is its best few, so the shuffle carries
a bounded number of rows per anchor and stripe.  Positives come from a first pass over rows of the same label, negatives from a second
one that knows the positives' scores.
"""

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from demandspark.llm.common import materialise, records

GROUP = 8
STRIPE = 1 << 16  # most candidates of a task, and most anchors that it sees
LEAST_STRIPE = 1 << 10
ANCHORS_AT_ONCE = 64
CANDIDATES_AT_ONCE = 1 << 11


@dataclass(frozen=True)
class Mining:
    """What to mine: `positives` per anchor and `negatives` per positive, within `low` and `high` percent of its score."""

    positives: int = 5
    negatives: int = 3
    low: int = 50
    high: int = 95


# --- scores -------------------------------------------------------------------------------------


def grouped(vectors: np.ndarray) -> np.ndarray:
    """Whole numbers (rows, dimensions) with the dimensions in groups of eight, filled up with zeros."""
    rows, dimensions = vectors.shape
    groups = -(-dimensions // GROUP)
    padded = np.zeros((rows, groups * GROUP), np.int64)
    padded[:, :dimensions] = vectors
    return padded.reshape(rows, groups, GROUP)


def subset_tables(anchors: np.ndarray, kind: type) -> np.ndarray:
    """(groups, 256, anchors): for each group and byte the sum of the components whose bits are set."""
    parts = grouped(anchors).transpose(1, 2, 0).astype(kind)
    tables = np.zeros((len(parts), 256, len(anchors)), kind)
    for bit in range(GROUP):
        size = 1 << bit
        tables[:, size : 2 * size] = tables[:, :size] + parts[:, bit, None]
    return tables


def bit_planes(candidates: np.ndarray) -> np.ndarray:
    """(planes, groups, candidates) bytes of the two's complement, lowest plane first, sign plane last."""
    parts = grouped(candidates)
    width = max(1, int(max(parts.max(initial=0), -1 - parts.min(initial=0))).bit_length()) + 1
    planes = [np.packbits((parts >> p) & 1, axis=2, bitorder="little")[:, :, 0].T for p in range(width)]
    return np.stack([p.astype(np.uint8) for p in planes])


def scores(tables: np.ndarray, planes: np.ndarray) -> np.ndarray:
    """(candidates, anchors): the full inner products."""
    highest = len(planes) - 1
    total = np.zeros((planes.shape[2], tables.shape[2]), tables.dtype)
    looked = np.empty_like(total)
    for plane in range(highest, -1, -1):
        if plane != highest:
            total <<= 1
        for table, places in zip(tables, planes[plane]):
            np.take(table, places, axis=0, out=looked, mode="clip")
            if plane == highest:
                total -= looked
            else:
                total += looked
    return total


def score_kind(anchors: np.ndarray, candidates: np.ndarray) -> type:
    """The smallest integer type for every partial sum; scores beyond 63 bits stop the job."""
    size = lambda v: max(int(v.max(initial=0)), -int(v.min(initial=0)))
    bound = 2 * max(1, anchors.shape[1]) * size(anchors) * (size(candidates) + 1)
    if bound >= 1 << 63:
        raise ValueError("inner products of these vectors do not fit in 63 bits")
    return np.int32 if bound < 1 << 31 else np.int64


class _Tables:
    """The tables of a block of anchors, in the integer types that its candidates ask for."""

    def __init__(self, anchors: np.ndarray):
        self.anchors = anchors
        self.made: dict[type, np.ndarray] = {}

    def scores(self, candidates: np.ndarray, planes: np.ndarray | None = None) -> np.ndarray:
        kind = score_kind(self.anchors, candidates)
        if kind not in self.made:
            self.made[kind] = subset_tables(self.anchors, kind)
        return scores(self.made[kind], bit_planes(candidates) if planes is None else planes)


# --- rows ---------------------------------------------------------------------------------------


def whole_vectors(
    rows: DataFrame, scale: int = 256, vec_id: str = "vec_id", embedding: str = "embedding", label: str = "label"
) -> DataFrame:
    """(row, vec_id, label, v) with v = floor(scale * x), of the rows that take part; `row` numbers them.

    Rows with a NULL label, a NULL vector, or a NULL or non-finite component take no part.
    """
    value = F.col(embedding).cast("array<double>")
    fine = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    plain = rows.select(
        F.col(vec_id).cast("bigint").alias("vec_id"), F.col(label).cast("bigint").alias("label"), value.alias("x")
    ).filter(F.col("label").isNotNull() & F.col("x").isNotNull() & F.forall("x", fine))
    whole = F.transform("x", lambda x: F.floor(F.lit(float(scale)) * x))
    return plain.select(F.monotonically_increasing_id().alias("row"), "vec_id", "label", whole.alias("v"))


def _matrix(column: pa.Array, dimensions: int) -> np.ndarray:
    """Vectors as a matrix; what a shorter vector lacks is zero."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    lengths = column.value_lengths().to_numpy(zero_copy_only=False)
    values = column.flatten().to_numpy(zero_copy_only=False)
    if len(lengths) and (lengths == dimensions).all():
        return values.reshape(len(lengths), dimensions)
    out = np.zeros((len(lengths), dimensions), np.int64)
    out[np.arange(dimensions) < lengths[:, None]] = values
    return out


def _grid(rows: DataFrame, anchors: DataFrame, stripe: int) -> tuple[DataFrame, int, int]:
    """Candidates and anchors by cell, candidates first; the number of dimensions and of cells."""
    size = rows.agg(F.count("*").alias("n"), F.max(F.size("v")).alias("d")).first()
    asked = anchors.count()
    workers = 2 * rows.sparkSession.sparkContext.defaultParallelism
    columns = max(1, math.ceil(size.n / stripe), min(workers, size.n // LEAST_STRIPE))
    lines = max(1, math.ceil(asked / stripe))
    place = lambda seed, parts: F.pmod(F.xxhash64("row", F.lit(seed)), F.lit(parts))
    each = lambda parts: F.explode(F.sequence(F.lit(0), F.lit(parts - 1)))
    left = rows.select("*", place(1, columns).alias("across"), each(lines).alias("down"), F.lit(False).alias("asks"))
    right = anchors.select("*", each(columns).alias("across"), place(2, lines).alias("down"), F.lit(True).alias("asks"))
    cells = left.unionByName(right, allowMissingColumns=True).withColumn("cell", F.col("across") * lines + F.col("down"))
    dealt = cells.drop("across", "down").repartitionByRange(columns * lines, "cell")
    return dealt.sortWithinPartitions("cell", "asks", "label"), size.d or 0, columns * lines


class _Stripe:
    """The candidates of a cell, sorted by label, in blocks of bit planes."""

    def __init__(self, tables: list[pa.Table], dimensions: int):
        whole = pa.concat_tables(tables)
        self.row, self.label = whole.column("row").to_numpy(), whole.column("label").to_numpy()
        given = whole.column("vec_id")
        self.unnamed = given.is_null().to_numpy(zero_copy_only=False)
        self.vec_id = given.fill_null(0).to_numpy()
        self.vectors = _matrix(whole.column("v"), dimensions)
        self.blocks: list[tuple[int, int, np.ndarray]] = []
        for begin in range(0, len(self.row), CANDIDATES_AT_ONCE):
            end = min(begin + CANDIDATES_AT_ONCE, len(self.row))
            self.blocks.append((begin, end, bit_planes(self.vectors[begin:end])))

    def better(self, who: np.ndarray, at: np.ndarray, score: np.ndarray) -> np.ndarray:
        """Order of pairs (asker, candidate): by asker, higher scores first, then smaller ids, those without one last."""
        return np.lexsort((self.row[at], self.vec_id[at], self.unnamed[at], -score, who))

    def first(self, who: np.ndarray, at: np.ndarray, score: np.ndarray, most: int) -> tuple[np.ndarray, ...]:
        """The first `most` candidates of each asker, in order."""
        order = self.better(who, at, score)
        order = order[_first_of_each(who[order], most)]
        return who[order], at[order], score[order]


def _asked(batches: Iterator[pa.RecordBatch], dimensions: int) -> Iterator[tuple["_Stripe | None", pa.Table]]:
    """For each block of anchors of a cell, the cell's candidates and the block; cells arrive whole, candidates first."""
    held: list[pa.Table] = []
    stripe: _Stripe | None = None
    cell = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        number, asks = table.column("cell").to_numpy(), table.column("asks").to_numpy()
        edges = np.flatnonzero(np.r_[True, (number[1:] != number[:-1]) | (asks[1:] != asks[:-1]), True]) if len(number) else []
        for begin, end in zip(edges[:-1], edges[1:]):
            if number[begin] != cell:
                cell, held, stripe = number[begin], [], None
            part = table.slice(begin, end - begin)
            if not asks[begin]:
                held.append(part)
                continue
            if held:
                stripe, held = _Stripe(held, dimensions), []
            for at in range(0, part.num_rows, ANCHORS_AT_ONCE):
                yield stripe, part.slice(at, ANCHORS_AT_ONCE)


def _first_of_each(key: np.ndarray, most: int) -> np.ndarray:
    """Places of the first `most` rows of each run of equal keys."""
    if not len(key):
        return np.zeros(0, np.int64)
    starts = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
    place = np.arange(len(key)) - np.repeat(starts, np.diff(np.r_[starts, len(key)]))
    return np.flatnonzero(place < most)


def _banded(who: np.ndarray, score: np.ndarray, owner: np.ndarray, least: np.ndarray, greatest: np.ndarray, most: int):
    """Band and place of the first `most` scores inside each band (owner, least, greatest); scores fall within an anchor."""
    if not len(score):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    begin, last = np.searchsorted(who, owner, "left"), np.searchsorted(who, owner, "right")
    end = last.copy()
    for _ in range(int(len(who)).bit_length()):  # skip to the first score that the upper bound admits
        middle = np.minimum((begin + end) // 2, len(score) - 1)
        active = begin < end
        above = active & (score[middle] > greatest)
        begin = np.where(above, middle + 1, begin)
        end = np.where(active & ~above, middle, end)
    spot = begin[:, None] + np.arange(most)
    fits = (spot < last[:, None]) & (score[np.minimum(spot, len(score) - 1)] >= least[:, None])
    band, step = np.nonzero(fits)
    return band, spot[band, step]


POSITIVES = pa.schema([(n, pa.int64()) for n in ("anchor_row", "anchor_id", "label", "positive_row", "positive_id", "score")])
NEGATIVES = pa.schema(
    [(n, pa.int64()) for n in ("anchor_row", "place", "anchor_id", "positive_id", "positive_score", "negative_id", "score", "negative_row")]
)


def _columns(schema: pa.Schema) -> str:
    return ", ".join(f"{name} bigint" for name in schema.names)


def _best(rows: DataFrame, key: list[str], other: str, most: int) -> DataFrame:
    """`rank` of the first rows of each key, by falling score, then the id `other`, NULL last."""
    order = Window.partitionBy(*key).orderBy(F.desc("score"), F.asc_nulls_last(f"{other}_id"), f"{other}_row")
    return rows.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= most)


def positives(rows: DataFrame, anchors: DataFrame, most: int, stripe: int = STRIPE) -> DataFrame:
    """Per anchor its first `most` other rows of the same label, with `rank`."""
    cells, dimensions, _ = _grid(rows, anchors, stripe)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for stripe, block in _asked(batches, dimensions):
            if stripe is None:
                continue
            vectors, label, row = _matrix(block.column("v"), dimensions), block.column("label").to_numpy(), block.column("row").to_numpy()
            found = []
            for value in np.unique(label):  # only candidates of this label are scored
                mine = np.flatnonzero(label == value)
                tables = _Tables(vectors[mine])
                low, high = np.searchsorted(stripe.label, [value, value + 1])
                for begin in range(low, high, CANDIDATES_AT_ONCE):
                    end = min(begin + CANDIDATES_AT_ONCE, high)
                    got = tables.scores(stripe.vectors[begin:end])
                    fit = stripe.row[begin:end, None] != row[mine]
                    if end - begin > 4 * most:  # below the last of the best few no row can count
                        last = end - begin - most
                        fit &= got >= np.partition(np.where(fit, got, np.iinfo(got.dtype).min), last, axis=0)[last]
                    there, whose = np.nonzero(fit)
                    found.append(stripe.first(mine[whose], there + begin, got[there, whose].astype(np.int64), most))
            if not found:
                continue
            who, at, got = stripe.first(*map(np.concatenate, zip(*found)), most)
            yield records(
                {
                    "anchor_row": row[who],
                    "anchor_id": block.column("vec_id").to_numpy()[who],
                    "label": label[who],
                    "positive_row": stripe.row[at],
                    "positive_id": pa.array(stripe.vec_id[at], mask=stripe.unnamed[at]),
                    "score": got,
                },
                POSITIVES,
            )

    met = cells.select("cell", "asks", "row", "vec_id", "label", "v").mapInArrow(run, _columns(POSITIVES))
    return _best(met, ["anchor_row"], "positive", most)


def negatives(rows: DataFrame, anchors: DataFrame, found: DataFrame, mining: Mining, stripe: int = STRIPE) -> DataFrame:
    """Per anchor and positive the first rows of other labels within the band of the positive's score, with `rank`."""
    bands = found.groupBy(F.col("anchor_row").alias("row")).agg(
        F.array_sort(F.collect_list(F.struct(F.col("rank").cast("bigint").alias("place"), "positive_id", "score"))).alias("bands")
    )
    asking = anchors.join(bands, "row")  # as many bands as positives at most
    cells, dimensions, _ = _grid(rows, asking, stripe)
    low, high = mining.low, mining.high

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for stripe, block in _asked(batches, dimensions):
            if stripe is None:
                continue
            vectors, label = _matrix(block.column("v"), dimensions), block.column("label").to_numpy()
            lists = block.column("bands").combine_chunks()
            owner = np.repeat(np.arange(block.num_rows), lists.value_lengths().to_numpy(zero_copy_only=False))
            place, positive, score = (lists.flatten().field(i) for i in range(3))
            score = score.to_numpy(zero_copy_only=False)
            # Whole bounds: 100 * s >= low * p and 100 * s <= high * p.
            least, greatest = -(-(low * score) // 100), (high * score) // 100
            floor, ceiling = np.full(block.num_rows, np.iinfo(np.int64).max), np.full(block.num_rows, np.iinfo(np.int64).min)
            np.minimum.at(floor, owner, least)
            np.maximum.at(ceiling, owner, greatest)
            tables, found = _Tables(vectors), []
            for begin, end, planes in stripe.blocks:
                all_scores = tables.scores(stripe.vectors[begin:end], planes)
                there, whose = np.nonzero((all_scores >= floor) & (all_scores <= ceiling))
                other = stripe.label[begin + there] != label[whose]
                there, whose = there[other], whose[other]
                got = all_scores[there, whose].astype(np.int64)
                order = stripe.better(whose, there + begin, got)
                whose, there, got = whose[order], there[order], got[order]
                band, spot = _banded(whose, got, owner, least, greatest, mining.negatives)
                found.append((band, there[spot] + begin, got[spot]))
            band, at, got = stripe.first(*map(np.concatenate, zip(*found)), mining.negatives)
            if not len(band):
                continue
            yield records(
                {
                    "anchor_row": block.column("row").to_numpy()[owner[band]],
                    "place": place.to_numpy(zero_copy_only=False)[band],
                    "anchor_id": block.column("vec_id").to_numpy()[owner[band]],
                    "positive_id": positive.take(pa.array(band)),
                    "positive_score": score[band],
                    "negative_id": pa.array(stripe.vec_id[at], mask=stripe.unnamed[at]),
                    "score": got,
                    "negative_row": stripe.row[at],
                },
                NEGATIVES,
            )

    columns = ["cell", "asks", "row", "vec_id", "label", "v", "bands"]
    met = cells.select(*columns).mapInArrow(run, _columns(NEGATIVES))
    return _best(met, ["anchor_row", "place"], "negative", mining.negatives)


def mine(rows: DataFrame, every: int = 50, mining: Mining | None = None, stripe: int = STRIPE) -> DataFrame:
    """Hard negatives of the anchors among `whole_vectors`, those whose vec_id is divisible by `every`.

    anchor_id, positive_id, rank, negative_id, positive_score, negative_score.  Higher scores come first, then smaller ids, NULL
    last, then the row number.  Rows that repeat a vec_id are rows of their own: each is an anchor, and each can be the positive
    or negative of another.  A row without vec_id is no anchor.  Vectors may differ in length; what one lacks counts as zero.
    Anchors without a positive, and positives without a row in their band, have no result; so has an empty table.
    """
    mining = mining or Mining()
    rows = materialise(rows, "vectors")
    anchors = rows.filter(F.col("vec_id") % every == 0)
    found = materialise(positives(rows, anchors, mining.positives, stripe), "positives")
    best = negatives(rows, anchors, found, mining, stripe)
    return best.select(
        "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score", F.col("score").alias("negative_score")
    )


def hard_negatives(embeddings: DataFrame, every: int = 50, mining: Mining | None = None) -> DataFrame:
    """`mine` over a table (vec_id, embedding, label) in which the label of each seventh id is set to the next one of ten.

    Other columns are ignored.
    """
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine(whole_vectors(embeddings.withColumn("label", moved)), every, mining)
