"""Exact deduplication of long byte strings with sharded suffix arrays.

A byte goes if it lies in a string of `size` bytes that also starts earlier: in a smaller document, or earlier in the same.

Equal strings must meet in one shard, and only strings that may repeat are worth sorting:

1.  Each window of `size` bytes names its anchor, the smallest hashed `GRAM`-byte string in it, leftmost on ties.  Equal windows
    have equal anchors at equal places.  The windows of one anchor occurrence are consecutive; the bytes they
    span are its region.  A row (anchor, hash of the region, owner, place) travels, not the bytes.  Of equal regions that meet in
    one buffer of a task, all but the first are repeats already; so a passage with any number of copies sends few rows.
2.  Rows meet by anchor in sorted streams.  All but the first of equal regions repeat in full.  Anchors with a single region have
    no repeats.  What is left are the first ones of several different regions under an anchor, which may share strings.
3.  Those regions are fetched and dealt into shards by anchor.  Each shard is sorted by induced sorting; runs of common
    prefixes of `size` bytes or more hold equal strings, of which all but the earliest repeat.
    An anchor with more than `anchor_limit` different regions is not put into one shard: its windows meet by their hash.

Regions are compared by 64-bit hashes under 64-bit anchors, windows of large anchors by 128-bit hashes.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandspark.llm.common import materialise, records, text_bytes, whole_groups
from demandspark.llm.sais import common_prefixes, suffix_array

SIZE = 100
GRAM = 32
BUFFER_BYTES = 4 << 20
SHARD_BYTES = 4 << 20
ANCHOR_LIMIT = 2048

OCCURRENCES = pa.schema(
    [
        ("anchor", pa.int64()),
        ("region", pa.int64()),
        ("owner", pa.int64()),
        ("first", pa.int64()),
        ("last", pa.int64()),
        ("repeated", pa.bool_()),
    ]
)
OCCURRENCE_COLUMNS = "anchor bigint, region bigint, owner bigint, first bigint, last bigint, repeated boolean"
SPANS = pa.schema([("owner", pa.int64()), ("first", pa.int64()), ("last", pa.int64())])
SPAN_COLUMNS = "owner bigint, first bigint, last bigint"


def _mixed(values: np.ndarray) -> np.ndarray:
    values = values ^ (values >> np.uint64(32))
    values = values * np.uint64(0x9E3779B97F4A7C15)
    return values ^ (values >> np.uint64(29))


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """Hash of the GRAM = 32 bytes from every place that has so many."""
    n = len(data) - GRAM + 1
    padded = np.r_[data, np.zeros(16 - len(data) % 8, np.uint8)]
    words = np.lib.stride_tricks.as_strided(padded.view("<u8")[:1], (n + GRAM - 8,), (1,))
    words = _mixed(np.ascontiguousarray(words))
    total = words[:n] * np.uint64(0xC2B2AE3D27D4EB4F)
    total += words[8 : 8 + n]
    total *= np.uint64(0x165667B19E3779F9)
    total += words[16 : 16 + n]
    total *= np.uint64(0x27D4EB2F165667C5)
    total += words[24 : 24 + n]
    return _mixed(total)


def anchors(data: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """For every window of `size` bytes: the place of its anchor; and the hashes of all grams."""
    hashes = gram_hashes(data)
    low = np.uint64((1 << 24) - 1)
    least = (hashes & ~low) | np.arange(len(hashes), dtype=np.uint64)  # leftmost on ties of the upper 40 bits
    wide, span = size - GRAM + 1, 1
    while 2 * span <= wide:
        least = np.minimum(least[: len(least) - span], least[span:])
        span *= 2
    count = len(data) - size + 1
    return (np.minimum(least[:count], least[wide - span : wide - span + count]) & low).astype(np.int64), hashes


def occurrences(data: np.ndarray, owners: np.ndarray, starts: np.ndarray, lengths: np.ndarray, size: int, offset: np.ndarray) -> dict:
    """Anchor occurrences of texts laid end to end in `data`, equal regions past the first marked as repeated.

    `offset` is the place in its document of each text's first byte.
    """
    if len(data) < size:
        return {name: np.zeros(0, np.int64) for name in OCCURRENCES.names[:-1]} | {"repeated": np.zeros(0, bool)}
    place, hashes = anchors(data, size)
    text = np.repeat(np.arange(len(starts)), lengths)[: len(place)]
    inside = np.arange(len(place)) + size <= (starts + lengths)[text]
    change = np.r_[True, (place[1:] != place[:-1]) | (text[1:] != text[:-1])] | ~inside | np.r_[True, ~inside[:-1]]
    first = np.flatnonzero(change & inside)
    ends = np.flatnonzero(np.r_[change[1:], True] & inside)
    raw = data.tobytes()
    digest = xxhash.xxh3_64_intdigest
    region = np.fromiter(
        (digest(raw[a : b + size]) for a, b in zip(first.tolist(), ends.tolist())), np.uint64, len(first)
    ).view(np.int64)
    anchor = hashes[place[first]].view(np.int64)
    owner, where = owners[text[first]], first - starts[text[first]] + offset[text[first]]
    order = np.lexsort((where, owner, region, anchor))
    anchor, region, owner, where = anchor[order], region[order], owner[order], where[order]
    last = where + (ends - first)[order]
    repeated = np.zeros(len(anchor), bool)  # without any window too
    repeated[1:] = (anchor[1:] == anchor[:-1]) & (region[1:] == region[:-1])
    return {"anchor": anchor, "region": region, "owner": owner, "first": where, "last": last, "repeated": repeated}


def _joined(repeats: dict, keep: np.ndarray) -> dict:
    """Repeated windows of one owner that follow each other, as one row."""
    owner, first, last = repeats["owner"][keep], repeats["first"][keep], repeats["last"][keep]
    order = np.lexsort((first, owner))
    owner, first, last = owner[order], first[order], last[order]
    begin = np.flatnonzero(np.r_[True, (owner[1:] != owner[:-1]) | (first[1:] > last[:-1] + 1)]) if len(owner) else order
    return {"owner": owner[begin], "first": first[begin], "last": last[np.r_[begin[1:] - 1, len(last) - 1]] if len(owner) else last}


def scan(docs: DataFrame, size: int) -> DataFrame:
    """Anchor occurrences of all rows (owner, body)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def flush(owners: list, texts: list[bytes], offsets: list[int]) -> pa.RecordBatch:
            lengths = np.array([len(t) for t in texts], np.int64)
            data = np.frombuffer(b"".join(texts), np.uint8)
            found = occurrences(data, np.array(owners, np.int64), np.cumsum(lengths) - lengths, lengths, size, np.array(offsets, np.int64))
            joined = _joined(found, found["repeated"])
            single = ~found["repeated"]
            n, m = int(single.sum()), len(joined["owner"])
            spread = joined["owner"] * 31 + joined["first"]  # repeats need no partner; spread them out
            columns = {
                "anchor": np.r_[found["anchor"][single], spread],
                "region": np.r_[found["region"][single], np.zeros(m, np.int64)],
                "repeated": np.r_[np.zeros(n, bool), np.ones(m, bool)],
            } | {name: np.r_[found[name][single], joined[name]] for name in ("owner", "first", "last")}
            return records(columns, OCCURRENCES)

        owners, texts, offsets, held = [], [], [], 0
        for batch in batches:
            for owner, body in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                # A long text goes through in stretches that share size - 1 bytes.
                for begin in range(0, max(1, len(body) - size + 1), BUFFER_BYTES):
                    stretch = body[begin : begin + BUFFER_BYTES + size - 1]
                    owners.append(owner)
                    texts.append(stretch)
                    offsets.append(begin)
                    held += len(stretch)
                    if held >= BUFFER_BYTES:
                        yield flush(owners, texts, offsets)
                        owners, texts, offsets, held = [], [], [], 0
        if held:
            yield flush(owners, texts, offsets)

    return docs.select("owner", "body").mapInArrow(run, OCCURRENCE_COLUMNS)


def meet(found: DataFrame) -> DataFrame:
    """Occurrences that repeat, and (`repeated` false) first ones of regions that share their anchor with another region."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None  # the last first occurrence, until its anchor's next region is known
        shared = False  # whether the held row's anchor has shown another region before it
        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([batch])
            if held is not None:
                table = pa.concat_tables([held, table])
            anchor, region = table.column("anchor").to_numpy(), table.column("region").to_numpy()
            given = table.column("repeated").to_numpy()
            live = np.flatnonzero(~given)
            a, r = anchor[live], region[live]
            # A batch may hold repeated rows only; then there are no heads and all its rows go on.
            new_region = np.ones(len(a), bool)
            new_region[1:] = (a[1:] != a[:-1]) | (r[1:] != r[:-1])
            heads = np.flatnonzero(new_region)
            next_same, before_same = np.zeros(len(heads), bool), np.zeros(len(heads), bool)
            next_same[:-1] = before_same[1:] = a[heads][1:] == a[heads][:-1]
            if len(heads) and held is not None:
                before_same[0] = shared
            several = next_same | before_same
            out = np.ones(table.num_rows, bool)
            repeated = given.copy()
            repeated[live[~new_region]] = True
            drop = live[heads[~several]]
            out[drop] = False
            held = None
            if len(heads):
                tail = int(live[heads[-1]])
                out[tail], shared = False, bool(before_same[-1])
                held = table.slice(tail, 1)
            table = table.set_column(table.schema.get_field_index("repeated"), "repeated", pa.array(repeated))
            yield from table.filter(pa.array(out)).cast(OCCURRENCES).to_batches()
        if held is not None and shared:
            yield from held.cast(OCCURRENCES).to_batches()

    order = ["anchor", "region", "owner", "first"]
    return found.repartition("anchor").sortWithinPartitions(*order).mapInArrow(run, OCCURRENCE_COLUMNS)


def _regions(docs: DataFrame, wanted: DataFrame, size: int) -> DataFrame:
    """anchor, owner, first and the bytes of each wanted occurrence."""
    lists = wanted.groupBy("owner").agg(F.collect_list(F.struct("anchor", "first", "last")).alias("wanted"))

    def cut(w):
        piece = F.substring(F.col("body"), (w["first"] + 1).cast("int"), (w["last"] - w["first"] + size).cast("int"))
        return F.struct(w["anchor"].alias("anchor"), w["first"].alias("first"), piece.alias("bytes"))

    regions = docs.join(lists, "owner").select("owner", F.explode(F.transform("wanted", cut)).alias("r"))
    return regions.select("r.anchor", "owner", "r.first", "r.bytes")


def repeats_in_shard(owner: np.ndarray, first: np.ndarray, parts: list[bytes], size: int) -> dict:
    """Windows inside the regions that equal an earlier window inside them, as (owner, first, last)."""
    lengths = np.array([len(p) for p in parts], np.int64)
    data = np.frombuffer(b"".join(parts), np.uint8)
    starts = np.cumsum(lengths) - lengths
    array = suffix_array(data)
    prefix = common_prefixes(data, array)
    part = np.repeat(np.arange(len(parts)), lengths)
    fits = np.arange(len(data)) + size <= (starts + lengths)[part]
    group = np.cumsum(prefix[array] < size)  # suffixes that share their first bytes
    keep = fits[array]
    place, group = array[keep].astype(np.int64), group[keep]
    who, where = owner[part[place]], first[part[place]] + place - starts[part[place]]
    order = np.lexsort((where, who, group))
    group, who, where = group[order], who[order], where[order]
    later = np.r_[False, group[1:] == group[:-1]] if len(group) else np.zeros(0, bool)
    # Equal windows at the very same place (regions may overlap) are one window.
    twin = np.r_[False, (who[1:] == who[:-1]) & (where[1:] == where[:-1])] if len(group) else later
    head = np.flatnonzero(~later)
    size_of = np.diff(np.r_[head, len(group)])
    lead_who, lead_where = np.repeat(who[head], size_of), np.repeat(where[head], size_of)
    later &= (who != lead_who) | (where != lead_where)
    return _joined({"owner": who, "first": where, "last": where}, later & ~twin)


def sort_shards(regions: DataFrame, size: int) -> DataFrame:
    """Spans of windows that repeat an earlier one within a shard of whole anchors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for shard in whole_groups(batches, ["anchor"], SHARD_BYTES // (size + size // 2)):
            owner, first = shard.column("owner").to_numpy(), shard.column("first").to_numpy()
            yield records(repeats_in_shard(owner, first, shard.column("bytes").to_pylist(), size), SPANS)

    ordered = regions.repartition("anchor").sortWithinPartitions("anchor")
    return ordered.select("anchor", "owner", "first", "bytes").mapInArrow(run, SPAN_COLUMNS)


def meet_windows(regions: DataFrame, size: int) -> DataFrame:
    """The same for anchors of any size: every window by its hash, all but the earliest of a kind."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: dict[str, list] = {"window": [], "owner": [], "first": []}
            for owner, first, data in zip(*(batch.column(i).to_pylist() for i in range(3))):
                for step in range(len(data) - size + 1):
                    out["window"].append(xxhash.xxh3_128_digest(data[step : step + size]))
                    out["owner"].append(owner)
                    out["first"].append(first + step)
            yield pa.RecordBatch.from_pydict(
                out, pa.schema([("window", pa.binary()), ("owner", pa.int64()), ("first", pa.int64())])
            )

    windows = regions.select("owner", "first", "bytes").mapInArrow(run, "window binary, owner bigint, first bigint")
    lead = windows.groupBy("window").agg(F.min(F.struct("owner", "first")).alias("lead"))
    later = windows.join(lead, "window").filter(F.struct("owner", "first") > F.col("lead"))
    return later.select("owner", "first", F.col("first").alias("last"))


def repeated_spans(docs: DataFrame, size: int = SIZE, anchor_limit: int = ANCHOR_LIMIT) -> DataFrame:
    """owner, first, last: places of windows that start earlier too; `docs` has unique owners and bodies (bytes)."""
    met = materialise(meet(scan(docs, size)), "anchors")
    first_ones = met.filter(~F.col("repeated")).select("anchor", "owner", "first", "last")
    large = materialise(
        first_ones.groupBy("anchor").count().filter(F.col("count") > anchor_limit).select("anchor"), "large-anchors"
    )
    spans = met.filter("repeated").select("owner", "first", "last")
    if large.isEmpty():
        return spans.unionByName(sort_shards(_regions(docs, first_ones, size), size))
    small = first_ones.join(large, "anchor", "left_anti")
    many = first_ones.join(large, "anchor", "left_semi")
    return spans.unionByName(sort_shards(_regions(docs, small, size), size)).unionByName(
        meet_windows(_regions(docs, many, size), size)
    )


def _owned(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """owner, doc_id, body; the owner is doc_id where that names every row, else the row's number in (doc_id, text) order."""
    plain = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), text_bytes(text).alias("body"))
    ids = plain.groupBy("doc_id").count().filter("count > 1 or doc_id is null")
    if ids.isEmpty():
        return plain.withColumn("owner", F.col("doc_id"))
    ordered = plain.repartitionByRange("doc_id", F.xxhash64("body")).sortWithinPartitions("doc_id", F.xxhash64("body"), "body")
    return materialise(ordered.withColumn("owner", F.monotonically_increasing_id()), "numbered")


RESULT = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("n_bytes", pa.int64()),
        ("n_removed", pa.int64()),
        ("n_spans", pa.int64()),
        ("kept", pa.binary()),
    ]
)


def remove_repeats(
    docs: DataFrame, size: int = SIZE, doc_id: str = "doc_id", text: str = "text", anchor_limit: int = ANCHOR_LIMIT
) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and kept (the remaining bytes) of every row.

    NULL counts as an empty text, from which nothing goes.  Rows that repeat a doc_id, or have none (NULL, before
    all others), are documents of their own, ordered by a hash of their text and then the text.  Other columns are ignored; an empty
    table gives an empty result.
    """
    if size < GRAM:
        raise ValueError(f"size must be {GRAM} or more")
    owned = _owned(docs, doc_id, text)
    spans = repeated_spans(owned.select("owner", "body"), size, anchor_limit)
    lists = spans.groupBy("owner").agg(F.collect_list(F.struct("first", "last")).alias("spans"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: dict[str, list] = {name: [] for name in RESULT.names}
            for owner, body, found in zip(*(batch.column(i).to_pylist() for i in range(3))):
                edges = np.zeros(len(body) + 1, np.int64)
                if found:
                    pairs = np.array([(s["first"], s["last"] + size) for s in found], np.int64)
                    np.add.at(edges, pairs[:, 0], 1)
                    np.add.at(edges, pairs[:, 1], -1)
                gone = np.cumsum(edges[:-1]) > 0
                runs = int((gone & ~np.r_[False, gone[:-1]]).sum()) if len(gone) else 0
                kept = np.frombuffer(body, np.uint8)[~gone].tobytes() if runs else body
                for name, value in zip(RESULT.names, (owner, len(body), int(gone.sum()), runs, kept)):
                    out[name].append(value)
            yield records(out, RESULT)

    whole = owned.join(lists, "owner", "left").select("doc_id", "body", "spans")
    return whole.mapInArrow(run, "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept binary")


def removal_report(docs: DataFrame, size: int = SIZE) -> DataFrame:
    """`remove_repeats` with the digest of the remaining bytes in place of them."""
    return remove_repeats(docs, size).select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
