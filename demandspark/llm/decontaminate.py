"""Benchmark decontamination with suffix arrays over the training texts.

Each Spark task sorts the suffixes of its documents, shard by shard, and looks every suffix of the benchmark up by binary
search.  A look-up gives the longest verbatim match with its places, and the interval of training suffixes that begin with
the benchmark window; the words inside those occurrences are hit.

Benchmark items are the stated query set: they are sent in blocks of bounded size, one pass over the documents
for each block.  The training texts never leave their task.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from demandspark.llm.common import materialise, records, text_bytes

WINDOW = 10
SHARD_WORDS = 1 << 19
BLOCK_WORDS = 1 << 20
PIECE_WORDS = BLOCK_WORDS

# Every byte that is no letter, digit or part of a longer UTF-8 character becomes a blank; A-Z become a-z.
_FOLD = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256)
)


def words_of(text: bytes) -> list[bytes]:
    return text.translate(_FOLD).split()


class Index:
    """Suffixes of one block of items in word ids."""

    def __init__(self, block: list[tuple[int | None, list[bytes]]], window: int):
        self.window = window
        self.vocabulary: dict[bytes, int] = {}
        ids: list[int] = []
        self.items = [item for item, _ in block]  # None for an item without an id
        owner, left, depth = [], [], []
        for number, (_, words) in enumerate(block):
            size = min(window, len(words))
            ids += [self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in words] + [0]
            owner += [number] * (len(words) + 1)
            left += range(len(words), -1, -1)
            depth += [size if n >= size else 0 for n in range(len(words), -1, -1)]
        self.owner, self.left, depth = np.array(owner, np.int64), np.array(left, np.int64), np.array(depth, np.int64)
        self.bits = max(1, len(self.vocabulary).bit_length())
        self.per = max(1, 63 // self.bits)
        self.deepest = int(self.left.max(initial=0))
        self.ids = np.array(ids, np.int64)
        self.keys = packed(self.ids, self.bits, self.per)
        self.order = suffix_array(self.keys, self.ids, self.per, self.deepest)
        # Equal windows are looked up once; `window_items` lists the items of each.
        at = np.flatnonzero(depth > 0)
        seen: dict[tuple, int] = {}
        first, pairs = [], set()
        for place in at.tolist():
            key = (*ids[place : place + depth[place]],)
            if key not in seen:
                seen[key] = len(seen)
                first.append(place)
            pairs.add((seen[key], int(self.owner[place])))
        self.window_at = np.array(first, np.int64)
        self.window_size = depth[self.window_at] if first else np.zeros(0, np.int64)
        self.window_items = np.array(sorted(pairs), np.int64).reshape(-1, 2)


def packed(ids: np.ndarray, bits: int, per: int) -> np.ndarray:
    """For every place the next `per` ids in one integer, so that integer order is word order."""
    padded = np.r_[ids, np.zeros(per, np.int64)]
    keys = np.zeros(len(ids), np.int64)
    for step in range(per):
        keys = (keys << bits) | padded[step : step + len(ids)]
    return keys


def suffix_array(keys: np.ndarray, first_ids: np.ndarray, per: int, depth: int) -> np.ndarray:
    """Places of suffixes in the order of their first `depth` words, by rank doubling; those at id 0 are left out."""
    places = np.flatnonzero(first_ids)
    order = places[np.argsort(keys[places], kind="stable")]
    rank = np.zeros(len(keys), np.int64)
    sorted_keys = keys[order]
    fresh = np.r_[True, sorted_keys[1:] != sorted_keys[:-1]] if len(order) else np.zeros(0, bool)
    rank[order] = np.maximum.accumulate(np.where(fresh, np.arange(1, len(order) + 1), 0))
    known = per
    tied = np.flatnonzero(~(fresh & np.r_[fresh[1:], True])) if len(order) else np.zeros(0, np.int64)
    while known < depth and len(tied):
        who = order[tied]
        ahead = who + known
        after = np.where(ahead < len(keys), rank[np.minimum(ahead, len(keys) - 1)], 0)
        group = rank[who]
        inner = np.lexsort((after, group))
        order[tied] = who[inner]
        group, after = group[inner], after[inner]
        begins = np.r_[True, (group[1:] != group[:-1]) | (after[1:] != after[:-1])]
        rank[order[tied]] = np.maximum.accumulate(np.where(begins, tied + 1, 0))
        tied = tied[~(begins & np.r_[begins[1:], True])]
        known *= 2
    return order


def below(index: Index, keys: np.ndarray, test: np.ndarray, place: np.ndarray, depth: np.ndarray, or_equal: bool) -> np.ndarray:
    """Whether the training suffix at `place` sorts before the first `depth` words of each test suffix (or equals them)."""
    result = np.full(len(test), or_equal)
    open_ = np.arange(len(test))
    done = 0
    while len(open_):
        a = place[open_] + done
        left = np.where(a < len(keys), keys[np.minimum(a, len(keys) - 1)], 0)
        right = index.keys[np.minimum(test[open_] + done, len(index.keys) - 1)]
        spare = np.clip(index.per - (depth[open_] - done), 0, index.per) * index.bits
        left, right = left >> spare, right >> spare
        differ = left != right
        result[open_[differ]] = left[differ] < right[differ]
        done += index.per
        open_ = open_[~differ & (depth[open_] > done)]
    return result


def insertion(index: Index, keys: np.ndarray, array: np.ndarray, test: np.ndarray, depth: np.ndarray, right: bool) -> np.ndarray:
    """Binary search of all test suffixes at once: the first place in `array` that is not below (not above) each."""
    low, high = np.zeros(len(test), np.int64), np.full(len(test), len(array), np.int64)
    for _ in range(int(len(array)).bit_length()):
        middle = (low + high) // 2
        active = low < high
        down = below(index, keys, test[active], array[middle[active]], depth[active], right)
        low[active] = np.where(down, middle[active] + 1, low[active])
        high[active] = np.where(down, high[active], middle[active])
    return low


def common_words(index: Index, ids: np.ndarray, place: np.ndarray, test: np.ndarray) -> np.ndarray:
    """Words that each training suffix shares with the test suffix beside it."""
    length = np.zeros(len(test), np.int64)
    open_ = np.arange(len(test))
    while len(open_):
        a, b = place[open_] + length[open_], test[open_] + length[open_]
        open_ = open_[(index.ids[b] > 0) & (a < len(ids)) & (ids[np.minimum(a, len(ids) - 1)] == index.ids[b])]
        length[open_] += 1
    return length


def search_shard(index: Index, ids: np.ndarray, inner: int) -> tuple[np.ndarray, ...]:
    """Occurrences of benchmark windows that begin before `inner`: place, window, longest match there, its test place."""
    keys = packed(ids, index.bits, index.per)
    array = suffix_array(keys, ids, index.per, index.deepest)
    array = array[array < inner]
    if not len(array) or not len(index.window_at):
        return (np.zeros(0, np.int64),) * 4
    low = insertion(index, keys, array, index.window_at, index.window_size, False)
    high = insertion(index, keys, array, index.window_at, index.window_size, True)
    counts = high - low
    which = np.repeat(np.arange(len(low)), counts)
    ranks = np.repeat(low, counts) + np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
    # The longest match of a training suffix is with one of the two test suffixes that it lies between.
    between = insertion(index, keys, array, index.order, index.left[index.order], False) if len(ranks) else ranks
    after = np.searchsorted(between, ranks, side="right")
    longest, best = np.zeros(len(ranks), np.int64), np.zeros(len(ranks), np.int64)
    for near in (after - 1, after):
        test = index.order[np.clip(near, 0, len(index.order) - 1)]
        length = common_words(index, ids, array[ranks], test)
        best = np.where(length > longest, test, best)
        longest = np.maximum(longest, length)
    return array[ranks], which, longest, best


RESULT = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("mark", pa.int64()),
        ("n_words", pa.int64()),
        ("n_hit", pa.int64()),
        ("items", pa.list_(pa.int64())),
        ("longest", pa.int64()),
        ("longest_item", pa.int64()),
        ("longest_place", pa.int64()),
    ]
)
RESULT_COLUMNS = (
    "doc_id bigint, mark bigint, n_words bigint, n_hit bigint, items array<bigint>, longest bigint, longest_item bigint,"
    " longest_place bigint"
)
COVERED = pa.field("covered", pa.binary())


def _search(index: Index, lengths: np.ndarray, ids: np.ndarray, covered: np.ndarray) -> dict[str, list]:
    """What one block of items finds in some documents; marks the words it hits in `covered`."""
    starts = np.cumsum(lengths + 1) - (lengths + 1)
    spots, which, longest, test = [], [], [], []
    for begin in range(0, len(ids), SHARD_WORDS):
        shard = ids[begin : begin + SHARD_WORDS + index.deepest]
        found = search_shard(index, shard, SHARD_WORDS)
        for store, values in zip((spots, which, longest, test), (found[0] + begin, *found[1:])):
            store.append(values)
    spot, window, length, place = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (spots, which, longest, test))
    edges = np.bincount(spot, minlength=len(ids) + 1) - np.bincount(
        spot + index.window_size[window], minlength=len(ids) + 1
    )
    covered |= np.cumsum(edges[: len(ids)]) > 0
    doc = np.searchsorted(starts, spot, side="right") - 1
    items: list[list[int]] = [[] for _ in lengths]
    owners = np.searchsorted(index.window_items[:, 0], np.arange(len(index.window_at) + 1))
    for d, w in np.unique(np.stack([doc, window], axis=1), axis=0).tolist() if len(doc) else ():
        items[d] += index.window_items[owners[w] : owners[w + 1], 1].tolist()
    order = np.lexsort((spot, -length, doc))
    top = order[np.flatnonzero(np.r_[True, doc[order][1:] != doc[order][:-1]])] if len(order) else order
    best: list[tuple] = [(0, None, None)] * len(lengths)
    for t in top.tolist():
        best[doc[t]] = (int(length[t]), index.items[index.owner[place[t]]], int(spot[t] - starts[doc[t]]))
    named = [sorted({index.items[i] for i in set(found)} - {None}) for found in items]
    return {"items": named, "best": best}


def _hits(docs: DataFrame, index, last: bool) -> DataFrame:
    """One pass: adds what the block `index` finds to each row of (doc_id, text, items, longest..., covered)."""
    columns = [*RESULT.names]
    schema = pa.schema([*RESULT, COVERED, pa.field("text", pa.binary())]) if not last else RESULT

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block: Index = index.value

        def flush(rows: list[dict]) -> pa.RecordBatch:
            get = block.vocabulary.get
            split = [words_of(r["text"]) for r in rows]
            lengths = np.array([len(w) for w in split], np.int64)
            ids = np.zeros(int(lengths.sum()) + len(split), np.int64)
            covered = np.zeros(len(ids), bool)
            at = 0
            for row, words in zip(rows, split):
                ids[at : at + len(words)] = np.fromiter((get(w, 0) for w in words), np.int64, len(words))
                if row.get("covered"):
                    covered[at : at + len(words)] = np.unpackbits(np.frombuffer(row["covered"], np.uint8), count=len(words))
                at += len(words) + 1
            found = _search(block, lengths, ids, covered)
            out: dict[str, list] = {name: [] for name in schema.names}
            at = 0
            for row, words, items, best in zip(rows, split, found["items"], found["best"]):
                mine = covered[at : at + len(words)]
                at += len(words) + 1
                before = row.get("items") or []
                if (row.get("longest") or 0) >= best[0] and row.get("n_hit"):
                    best = (row["longest"], row["longest_item"], row["longest_place"])
                values = (row["doc_id"], row["mark"], len(words), int(mine.sum()), sorted({*before, *items}), *best)
                for name, value in zip(columns, values):
                    out[name].append(value)
                if not last:
                    out["covered"].append(np.packbits(mine).tobytes())
                    out["text"].append(row["text"])
            return records(out, schema)

        rows: list[dict] = []
        size = 0
        for batch in batches:
            for row in batch.to_pylist():
                rows.append(row)
                size += len(row["text"])
                if size >= SHARD_WORDS * 8:
                    yield flush(rows)
                    rows, size = [], 0
        if rows:
            yield flush(rows)

    return docs.mapInArrow(run, RESULT_COLUMNS + ("" if last else ", covered binary, text binary"))


def _blocks(benchmark: DataFrame, item_id: str, text: str, window: int, block_words: int) -> Iterator[Index]:
    """The items in blocks of about `block_words` words; a longer item is cut into pieces that share window - 1 words."""
    held: list[tuple[int | None, list[bytes]]] = []
    count = 0
    plain = benchmark.select(F.col(item_id).cast("bigint").alias("item_id"), text_bytes(text).alias("text"))
    for row in plain.toLocalIterator():
        words = words_of(bytes(row.text))
        for begin in range(0, max(1, len(words) - window + 1), PIECE_WORDS):
            piece = words[begin : begin + PIECE_WORDS + window - 1]
            if piece:
                held.append((row.item_id, piece))
                count += len(piece)
            if count >= block_words:
                yield Index(held, window)
                held, count = [], 0
    yield Index(held, window)


def benchmark_hits(
    docs: DataFrame,
    benchmark: DataFrame,
    window: int = WINDOW,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """doc_id, mark, n_words, n_hit, items, longest, longest_item, longest_place of every row.

    A word is hit if it lies in an occurrence of `window` consecutive words of an item (or of a whole shorter item).
    `longest` is the longest verbatim match of the hits in words, 0 without one; its item is the one that the
    look-up met first, and its place counts words from 0.  NULL and empty texts have no words and no hits; rows that
    repeat a doc_id each get a row; a NULL doc_id stays NULL.  An item without an id hits words like any other, and no list
    names it; items without words never occur.  `mark` is a hash of the text.  Items of more than `PIECE_WORDS` words are cut into
    pieces that share window - 1 words, and `longest` ends with the piece.  Other columns are ignored.  An empty table of
    documents gives an empty result, an empty benchmark no hits.
    """
    rows = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), _mark(text).alias("mark"), text_bytes(text).alias("text"))
    indexes = _blocks(benchmark, item_id, item_text, window, block_words)
    index = next(indexes)
    for following in indexes:
        if len(following.items):
            rows = materialise(_hits(rows, docs.sparkSession.sparkContext.broadcast(index), False), "hits")
            index = following
    return _hits(rows, docs.sparkSession.sparkContext.broadcast(index), True)


def contamination(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """`benchmark_hits` with the digest of the item ids and the verdict."""
    found = benchmark_hits(docs, benchmark, **options)
    names = F.concat_ws(",", F.array_sort(F.transform("items", lambda i: i.cast("string"))))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(names, 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
        "longest",
        "longest_item",
        "longest_place",
    )


def _mark(text: str) -> Column:
    return F.xxhash64(F.lit("mark"), F.col(text))


def remove_contaminated(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """Documents in which no benchmark window occurs, each row judged by its own text.

    A row is found again by two 64-bit hashes of its text and never by its id, which may be NULL or shared with other texts.  Rows
    with equal texts stay or go together.
    """
    columns = docs.columns
    named = docs.select(F.struct(*columns).alias("row"), F.col("text").alias("body"))
    named = named.withColumns({"hash": F.xxhash64("body"), "mark": _mark("body")})
    found = benchmark_hits(named, benchmark, window, doc_id="hash", text="body").filter("n_hit > 0")
    affected = materialise(found.select(F.col("doc_id").alias("hash"), "mark").distinct(), "affected")
    return named.join(affected, ["hash", "mark"], "left_anti").select("row.*")
