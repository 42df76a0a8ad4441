"""SimHash near-duplicates through a hierarchical index in Gray order.

A fingerprint has one bit per position that is set in over half of the hashes of the text's word shingles.
Two fingerprints link at `distance` or fewer differing bits.

The index has shared bit patterns at its upper nodes.  Fingerprints within distance d agree on at least one
of d + 1 slices of their bits, so the top nodes are (slice, pattern): what hangs under one of them
agrees there and has accumulated no difference.  A top node with more than `group_limit` fingerprints is opened again
by slicing its other bits, until the free bits alone bound the node.  So no task meets an unbounded group, and no
fingerprint is dropped.  Under a top node the fingerprints lie in Gray order; runs of neighbours form nodes that factor
out the bits they share beyond their parent's.  A search adds up differences from the top and drops a whole node as soon
as the sum passes `distance`.

What leaves a top node is one link per member to the smallest member it reaches there, never all pairs.
"""

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from demandspark.llm.common import materialise, records, text_bytes, whole_groups
from demandspark.llm.components import components

SEED = 42
FAN_OUT = 8
LINKS = pa.schema([("first", pa.int64()), ("second", pa.int64())])


def fingerprint(text: bytes, shingle: int) -> int:
    """SimHash of one text as an unsigned integer; 0 for a text without words."""
    words = text.lower().split()  # bytes: only A-Z change, and only ASCII white space parts
    if not words:
        return 0
    if len(words) < shingle:
        grams = [b" ".join(words)]
    else:
        grams = list(map(b" ".join, zip(*(words[i:] for i in range(shingle)))))
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, grams, repeat(SEED)), np.uint64, len(grams))
    ones = np.zeros(64, np.int64)
    for start in range(0, len(hashes), 8192):
        bits = np.unpackbits(hashes[start : start + 8192].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int, doc_id: str = "doc_id", text: str = "text", keep: str | None = None) -> DataFrame:
    """(doc_id, fingerprint) of every row, or (keep, fingerprint); the fingerprint is the signed form of the 64 bits."""
    name = F.col(keep) if keep else F.col(doc_id).cast("bigint").alias("doc_id")
    plain = docs.select(name, text_bytes(text).alias("text"))
    kind = plain.schema[0]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = np.array([fingerprint(t, shingle) for t in batch.column(1).to_pylist()], np.uint64)
            fields = [batch.schema.field(0), pa.field("fingerprint", pa.int64())]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(prints.view(np.int64))], schema=pa.schema(fields))

    return plain.mapInArrow(run, f"{kind.name} {kind.dataType.simpleString()}, fingerprint bigint")


# --- the index under the top nodes --------------------------------------------------------------


def gray_rank(values: np.ndarray) -> np.ndarray:
    """Position of each bit pattern in the reflected Gray sequence."""
    rank = values.astype(np.uint64)
    for shift in (1, 2, 4, 8, 16, 32):
        rank = rank ^ (rank >> np.uint64(shift))
    return rank


def build_index(values: np.ndarray, top: np.ndarray) -> list[tuple[np.ndarray, ...]]:
    """Levels of the index, leaves first, each as (own mask, pattern, first child, children).

    `values` are sorted by top node and Gray rank; `top` numbers the top nodes 0, 1, ...
    The last level has one node per top node.
    """
    low, high = values.copy(), values.copy()  # bits set in all leaves below, bits set in any of them
    owner, levels = top, []
    first = np.arange(len(values))
    count = np.ones(len(values), np.int64)
    while True:
        levels.append([~(low ^ high), low, first, count])
        starts = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
        if len(starts) == len(owner):
            break
        sizes = np.diff(np.r_[starts, len(owner)])
        place = np.arange(len(owner)) - np.repeat(starts, sizes)
        first = np.flatnonzero(place % FAN_OUT == 0)
        count = np.diff(np.r_[first, len(owner)])
        low, high, owner = np.bitwise_and.reduceat(low, first), np.bitwise_or.reduceat(high, first), owner[first]
    # What a parent shares is accounted for there: a node keeps the bits it shares beyond that.
    for below, above in zip(levels, levels[1:]):
        below[0] = below[0] & ~np.repeat(above[0], above[3])
    return [tuple(level) for level in levels]


def search(levels: list[tuple[np.ndarray, ...]], values: np.ndarray, top: np.ndarray, distance: int) -> Iterator[tuple]:
    """Pairs (i, j), i < j, of leaves of one top node within `distance`, in pieces."""
    step = 1 << 15
    for begin in range(0, len(values), step):
        who = np.arange(begin, min(begin + step, len(values)))
        node, sum_ = top[who].astype(np.int64), np.zeros(len(who), np.int64)
        for depth in range(len(levels) - 1, -1, -1):
            mask, pattern, first, count = levels[depth]
            sum_ = sum_ + np.bitwise_count((values[who] ^ pattern[node]) & mask[node])
            keep = sum_ <= distance
            who, node, sum_ = who[keep], node[keep], sum_[keep]
            if depth:
                children = count[node]
                within = np.arange(children.sum()) - np.repeat(np.cumsum(children) - children, children)
                node = np.repeat(first[node], children) + within
                who, sum_ = np.repeat(who, children), np.repeat(sum_, children)
        forward = node > who
        yield who[forward], node[forward]


def star_links(values: np.ndarray, top: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """For every value that reaches a smaller one inside its top node, the link to the smallest."""
    order = np.lexsort((gray_rank(values), top))
    values, top = values[order], top[order]
    levels = build_index(values, top)
    root = np.arange(len(values))

    def find(nodes: np.ndarray) -> np.ndarray:
        while True:
            above = root[nodes]
            if (above == nodes).all():
                return nodes
            nodes = above

    for left, right in search(levels, values, top, distance):
        while len(left):
            left, right = find(left), find(right)
            apart = left != right
            left, right = left[apart], right[apart]
            np.minimum.at(root, np.maximum(left, right), np.minimum(left, right))
        root = find(np.arange(len(values)))
    order = np.argsort(root, kind="stable")
    starts = np.flatnonzero(np.r_[True, root[order][1:] != root[order][:-1]])
    signed = values.view(np.int64)
    least = np.repeat(np.minimum.reduceat(signed[order], starts), np.diff(np.r_[starts, len(order)]))
    linked = least != signed[order]
    return signed[order][linked], least[linked]


# --- top nodes ----------------------------------------------------------------------------------


def slices(distance: int, group_limit: int) -> list[list[int]]:
    """Masks of the top nodes per opening, each mask with distance + 1 masks below it, in order."""
    parts = distance + 1
    rounds, masks = [], [0]
    while 1 << (64 - min(m.bit_count() for m in masks)) > group_limit or not rounds:
        deeper = []
        for mask in masks:
            free = [b for b in range(64) if not mask >> b & 1]
            cuts = [len(free) * i // parts for i in range(parts + 1)]
            deeper += [mask | sum(1 << b for b in free[cuts[i] : cuts[i + 1]]) for i in range(parts)]
        if deeper == [m for m in masks for _ in range(parts)]:
            break
        rounds.append(deeper)
        masks = deeper
    return rounds


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def _slot(rows: DataFrame, masks: list[int], parts: int) -> DataFrame:
    """Rows under their `parts` next top nodes."""
    table = F.array(*[F.lit(_signed(m)) for m in masks])
    base = F.col("slot") * parts
    opened = rows.withColumn("slot", F.explode(F.transform(F.sequence(F.lit(0), F.lit(parts - 1)), lambda i: base + i)))
    return opened.withColumn("pattern", F.col("fingerprint").bitwiseAND(F.get(table, F.col("slot"))))


def links(prints: DataFrame, distance: int, group_limit: int = 1024) -> DataFrame:
    """(first, second): links that connect whatever distinct fingerprints are connected within `distance`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for groups in whole_groups(batches, ["slot", "pattern"], 1 << 16):
            slot, pattern = groups.column("slot").to_numpy(), groups.column("pattern").to_numpy()
            values = groups.column("fingerprint").to_numpy().view(np.uint64)
            top = np.cumsum(np.r_[False, (slot[1:] != slot[:-1]) | (pattern[1:] != pattern[:-1])])
            first, second = star_links(values, top, distance)
            yield records({"first": first, "second": second}, LINKS)

    parts = distance + 1
    rows, found = prints.select("fingerprint").withColumn("slot", F.lit(0)), []
    rounds = slices(distance, group_limit)
    for depth, masks in enumerate(rounds):
        rows = _slot(rows, masks, parts)
        large = None
        if depth + 1 < len(rounds):
            sizes = rows.groupBy("slot", "pattern").count()
            large = materialise(sizes.filter(F.col("count") > group_limit).drop("count"), "simhash-large")
            if large.isEmpty():
                large = None
        small = rows if large is None else rows.join(large, ["slot", "pattern"], "left_anti")
        ordered = small.repartition("slot", "pattern").sortWithinPartitions("slot", "pattern")
        found.append(ordered.select("slot", "pattern", "fingerprint").mapInArrow(run, "first bigint, second bigint"))
        if large is None:
            break
        rows = rows.join(large, ["slot", "pattern"], "left_semi").select("fingerprint", "slot")
    whole = found[0]
    for more in found[1:]:
        whole = whole.unionByName(more)
    return whole


def _rooted(prints: DataFrame, distance: int, rank: Column) -> DataFrame:
    """(fingerprint, root, first): the root of each fingerprint's component, and the smallest `rank` of the fingerprint's rows."""
    owners = materialise(prints.groupBy("fingerprint").agg(F.min(rank).alias("first")), "simhash-owners")
    roots = components(links(owners, distance), "first", "second", "simhash-links")
    joined = owners.join(roots, owners.fingerprint == roots.node, "left")
    return joined.select("fingerprint", F.coalesce("root", "fingerprint").alias("root"), owners["first"])


def near_duplicates(
    docs: DataFrame, shingle: int = 3, distance: int = 2, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id of every row.

    component_id is the smallest doc_id that links reach, the row's own included.  NULL and empty texts have the
    fingerprint zero and link like any other.  Rows that repeat a doc_id each get a row.  A NULL doc_id is no candidate
    for component_id unless the whole component has none.  Other columns are ignored; an empty table gives an
    empty result.
    """
    prints = materialise(fingerprints(docs, shingle, doc_id, text), "simhash-prints")
    rooted = _rooted(prints, distance, F.col("doc_id"))
    smallest = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    members = rooted.join(smallest, "root").select("fingerprint", "component_id")
    return prints.join(members, "fingerprint").select(
        "doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id"
    )


def keep_one_of_each(docs: DataFrame, shingle: int = 3, distance: int = 2) -> DataFrame:
    """One document of each near-duplicate component: the one with the smallest doc_id, NULL last, then by a hash of the text.

    A document is known by its doc_id and two 64-bit hashes of its text, so different texts that share a doc_id, or have
    none, are documents of their own.  Of rows that agree in all three, one stays.
    """
    columns = docs.columns
    name = [F.col("doc_id").isNull().alias("unnamed"), F.coalesce(F.col("doc_id").cast("bigint"), F.lit(0)).alias("id")]
    hashes = [F.xxhash64("text").alias("hash"), F.xxhash64(F.lit("mark"), F.col("text")).alias("mark")]
    named = docs.select(F.struct(*columns).alias("row"), F.struct(*name, *hashes).alias("name"), F.col("text").alias("body"))
    printed = fingerprints(named.select("name", "body"), shingle, "name", "body", keep="name")
    prints = materialise(printed, "simhash-prints")
    rooted = _rooted(prints, distance, F.col("name"))
    ahead = rooted.groupBy("root").agg(F.min("first").alias("name")).select("name.*")
    found = materialise(ahead, "simhash-kept")
    repeated = prints.groupBy("name").agg(F.count("*").alias("n")).filter("n > 1").select("name.*")
    again = materialise(repeated.join(found, ["unnamed", "id", "hash", "mark"], "left_semi"), "simhash-again")
    # As many ids stay as documents do, so they are never a side to broadcast; hashed by partition, they spare the
    # texts a sort.
    keyed = named.select("row", "name.*")
    kept = keyed.join(found.hint("shuffle_hash"), ["unnamed", "id", "hash", "mark"], "left_semi")
    if not again.isEmpty():
        kept = kept.dropDuplicates(["unnamed", "id", "hash", "mark"])
    return kept.select("row.*")
