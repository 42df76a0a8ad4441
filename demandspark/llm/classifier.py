"""Text quality by a factorisation machine over hashed words, structure statistics and metadata.

A document's features are its words by hash bucket (damped counts, scaled to length one), statistics of its structure in
bins, and metadata columns in bins.  The score is the logistic of

    bias + sum_i w_i x_i + 1/2 sum_f [ (sum_i v_if x_i)^2 - sum_i v_if^2 x_i^2 ],

which has all pairwise interactions of rank `RANK` at a cost linear in the features present.

The model is fitted on at most SAMPLE_ROWS labelled rows, those with the smallest hash of their doc_id, in one task;
its size is fixed by the buckets.  Scoring is a map over all rows.
"""

import io
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from demandspark.llm.common import records, text_bytes

BUCKETS = 1 << 15
BINS = 16
RANK = 8
SAMPLE_ROWS = 8192
EPOCHS = 12
BATCH = 128
RATE = 0.05
DECAY = 1e-4
THRESHOLD = 0.7

STATISTICS = (
    "length",
    "word_length",
    "symbols",
    "marks",
    "digits",
    "capitals",
    "high_bytes",
    "unique_words",
    "unique_windows",
    "unique_lines",
    "words_per_line",
    "end_marks",
)
_UPPER = bytes(range(0x41, 0x5B))
_DIGITS = bytes(range(0x30, 0x3A))
_HIGH = bytes(range(0x80, 0x100))


def held_out(doc_id: Column) -> Column:
    """Rows that never teach: crc32 of the id as text, modulo 4, is 2."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def _log_bin(value: float, scale: float) -> int:
    return min(BINS - 1, int(np.log2(1 + value) * scale))


def statistics(text: bytes, words: list[bytes], codes: np.ndarray, distinct: int) -> list[int]:
    """The bin of each structure statistic."""
    n, size = max(1, len(words)), max(1, len(text))
    share = lambda chars: (len(text) - len(text.translate(None, chars))) / size
    lines = [line for line in text.split(b"\n") if line.strip()]
    windows = codes[:-2] * np.uint64(0x9E3779B97F4A7C15) + codes[1:-1] * np.uint64(0xC2B2AE3D27D4EB4F) + codes[2:]
    ratios = (
        20 * share(b"#*$%&|<>~^_=+@\\{}[]"),
        20 * share(b"!?"),
        8 * share(_DIGITS),
        3 * share(_UPPER),
        3 * share(_HIGH),
        distinct / n,
        len(np.unique(windows)) / max(1, len(windows)) if len(windows) else 1.0,
        len(set(lines)) / max(1, len(lines)),
    )
    bins = [min(BINS - 1, int(r * BINS)) for r in ratios]
    ends = text.count(b". ") + text.count(b".\n")
    return [
        _log_bin(len(words), 1),
        _log_bin(sum(map(len, words)) / n, 3),
        *bins,
        _log_bin(len(words) / max(1, len(lines)), 2),
        min(BINS - 1, int(BINS * 4 * ends / n)),
    ]


def featurise(text: bytes, metadata: list[float | None]) -> tuple[np.ndarray, np.ndarray]:
    """Indices and values of a document's features."""
    words = text.lower().split()
    codes = np.fromiter(map(zlib.crc32, words), np.uint64, len(words))
    found, counts = np.unique(codes & np.uint64(BUCKETS - 1), return_counts=True)
    weight = np.sqrt(counts)
    if len(weight):
        weight /= np.sqrt((weight**2).sum())
    bins = statistics(text, words, codes, len(found))
    bins += [0 if m is None or not np.isfinite(m) else 1 + min(BINS - 2, _log_bin(max(m, 0.0), 0.8)) for m in metadata]
    structure = BUCKETS + BINS * np.arange(len(bins)) + np.array(bins)
    return np.r_[found.astype(np.int64), structure], np.r_[weight, np.full(len(bins), 0.5)].astype(np.float32)


class Machine:
    """Parameters of a factorisation machine with logistic output."""

    def __init__(self, fields: int, seed: int = 1):
        size = BUCKETS + BINS * fields
        self.bias = np.zeros(1, np.float32)
        self.linear = np.zeros(size, np.float32)
        self.factors = np.random.default_rng(seed).normal(0, 0.02, (size, RANK)).astype(np.float32)

    def margin(self, index: np.ndarray, value: np.ndarray) -> float:
        weighted = self.factors[index] * value[:, None]
        pairs = (weighted.sum(axis=0) ** 2).sum() - (weighted**2).sum()
        return float(self.bias[0] + self.linear[index] @ value + 0.5 * pairs)

    def score(self, index: np.ndarray, value: np.ndarray) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.margin(index, value), -30, 30))))

    def fit(self, features: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, seed: int = 2) -> "Machine":
        """Stochastic gradient descent with per-parameter rates (AdaGrad) on the logistic loss, classes weighted evenly."""
        if not len(labels):
            return self
        ones = max(1, int(labels.sum()))
        weight = np.where(labels == 1, len(labels) / (2 * ones), len(labels) / (2 * max(1, len(labels) - ones)))
        rng = np.random.default_rng(seed)
        seen = [np.full_like(p, 1e-6) for p in (self.bias, self.linear, self.factors)]
        for _ in range(EPOCHS):
            order = rng.permutation(len(labels))
            for begin in range(0, len(order), BATCH):
                self._step([features[i] for i in order[begin : begin + BATCH]], *(a[order[begin : begin + BATCH]] for a in (labels, weight)), seen)
        return self

    def _step(self, batch: list, labels: np.ndarray, weight: np.ndarray, seen: list[np.ndarray]) -> None:
        index = np.concatenate([i for i, _ in batch])
        value = np.concatenate([v for _, v in batch])
        lengths = np.array([len(i) for i, _ in batch])
        starts = np.cumsum(lengths) - lengths
        factors = self.factors[index]
        weighted = factors * value[:, None]
        sums = np.add.reduceat(weighted, starts)
        pairs = (sums**2).sum(axis=1) - np.add.reduceat((weighted**2).sum(axis=1), starts)
        margin = self.bias[0] + np.add.reduceat(self.linear[index] * value, starts) + 0.5 * pairs
        slope = (1 / (1 + np.exp(-np.clip(margin, -30, 30))) - labels) * weight / len(labels)
        each = np.repeat(slope, lengths).astype(np.float32) * value
        # Gradients of one parameter from several documents add up.
        order = np.argsort(index, kind="stable")
        first = np.flatnonzero(np.r_[True, index[order][1:] != index[order][:-1]])
        rows = index[order][first]
        linear = np.add.reduceat(each[order], first) + DECAY * self.linear[rows]
        pull = each[:, None] * (np.repeat(sums, lengths, axis=0) - weighted)
        pull = np.add.reduceat(pull[order], first) + DECAY * self.factors[rows]
        for parameter, where, gradient, past in (
            (self.bias, slice(None), np.array([slope.sum()], np.float32), seen[0]),
            (self.linear, rows, linear, seen[1]),
            (self.factors, rows, pull, seen[2]),
        ):
            past[where] += gradient**2
            parameter[where] -= RATE * gradient / np.sqrt(past[where])

    def dump(self) -> bytes:
        out = io.BytesIO()
        np.savez(out, bias=self.bias, linear=self.linear, factors=self.factors)
        return out.getvalue()

    @classmethod
    def load(cls, data: bytes) -> "Machine":
        machine = cls.__new__(cls)
        with np.load(io.BytesIO(data), allow_pickle=False) as stored:
            machine.bias, machine.linear, machine.factors = (stored[n] for n in ("bias", "linear", "factors"))
        return machine


SCORES = pa.schema([("doc_id", pa.int64()), ("score", pa.float64())])


def _inputs(docs: DataFrame, metadata: list[str], *more: Column) -> DataFrame:
    columns = [F.col(m).cast("double").alias(f"meta{i}") for i, m in enumerate(metadata)]
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_bytes().alias("body"), *more, *columns)


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", metadata: list[str] = (), rows: int = SAMPLE_ROWS) -> Machine:
    """A machine fitted on at most `rows` labelled rows that are not held out.

    Labels that are NULL or without doc_id teach nothing; without any label every score is one half.
    """
    named = labels.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col(label).cast("int").alias("label"))
    usable = named.filter(F.col("label").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    sample = usable.withColumn("key", F.xxhash64("doc_id")).orderBy("key", "doc_id", "label").limit(rows)
    fields = len(STATISTICS) + len(metadata)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features, marks = [], []
        for batch in batches:
            for _, body, mark, _, *meta in zip(*(c.to_pylist() for c in batch.columns)):
                if len(marks) < rows:
                    features.append(featurise(body, meta))
                    marks.append(mark)
        machine = Machine(fields).fit(features, np.array(marks, np.float32))
        yield pa.RecordBatch.from_pydict({"model": [machine.dump()]})

    taught = docs.join(F.broadcast(sample), "doc_id")  # at most `rows` rows of 20 bytes
    ordered = _inputs(taught, list(metadata), F.col("label"), F.col("key")).repartition(1)
    ordered = ordered.sortWithinPartitions("key", "doc_id", "label", F.xxhash64("body"))
    found = ordered.mapInArrow(run, "model binary").collect()
    return Machine.load(bytes(found[0].model)) if found else Machine(fields)


def score(docs: DataFrame, machine: Machine, metadata: list[str] = ()) -> DataFrame:
    """doc_id and score of every row; NULL and empty texts are scored by their structure alone."""
    sent = docs.sparkSession.sparkContext.broadcast(machine.dump())  # fixed size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        loaded = Machine.load(sent.value)
        for batch in batches:
            columns = [c.to_pylist() for c in batch.columns]
            scores = [loaded.score(*featurise(body, meta)) for _, body, *meta in zip(*columns)]
            yield records({"doc_id": columns[0], "score": scores}, SCORES)

    return _inputs(docs, list(metadata)).mapInArrow(run, "doc_id bigint, score double")


def classify(docs: DataFrame, labels: DataFrame, metadata: list[str] = ("n_chars",), threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score, predicted of every row.

    Labels, language, source and doc_id are no features.  A NULL doc_id is not held out and has no label; rows that
    repeat a doc_id each get a row; a metadata column that is missing is left out and a NULL in one has a bin of its own.
    An empty table gives an empty result.
    """
    present = [m for m in metadata if m in docs.columns]
    machine = train(docs, labels, metadata=present)
    return score(docs, machine, present).select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )
