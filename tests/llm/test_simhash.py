import random
import re

import numpy as np
import pytest
import xxhash

from demandspark.llm import simhash
from demandspark.llm.components import components
from tests.llm import samples


def brute_print(text, size=3):
    lower = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lower)
    grams = [" ".join(words[i : i + size]) for i in range(len(words) - size + 1)] if len(words) >= size else [" ".join(words)] * bool(words)
    hashes = [xxhash.xxh64_intdigest(g.encode(), seed=42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute(rows, distance=2):
    prints = [brute_print(r[1]) for r in rows]
    root = list(range(len(rows)))
    changed = True
    while changed:
        changed = False
        for i in range(len(rows)):
            for j in range(i):
                if (prints[i] ^ prints[j]).bit_count() <= distance and root[i] != root[j]:
                    root[i] = root[j] = min(root[i], root[j])
                    changed = True
    out = []
    for i, row in enumerate(rows):
        ids = [r[0] for r, k in zip(rows, root) if k == root[i] and r[0] is not None]
        out.append((row[0], f"{prints[i]:016x}", min(ids, default=None)))
    return sorted(out, key=repr)


def test_gray_ranks_follow_the_gray_sequence():
    codes = np.array([i ^ (i >> 1) for i in range(512)], np.uint64)
    assert simhash.gray_rank(codes).tolist() == list(range(512))


@pytest.mark.parametrize("distance", [0, 1, 2, 3])
def test_index_finds_exactly_the_pairs_within_the_distance(distance):
    rng = np.random.default_rng(distance)
    seeds = rng.integers(0, 2**64, 40, dtype=np.uint64)
    values = np.unique(np.array([int(s) ^ (1 << int(b)) ^ (1 << int(c)) for s in seeds for b, c in rng.integers(0, 64, (6, 2))], np.uint64))
    top = np.sort(rng.integers(0, 3, len(values)))
    order = np.lexsort((simhash.gray_rank(values), top))
    values, top = values[order], top[order]
    found = set()
    for left, right in simhash.search(simhash.build_index(values, top), values, top, distance):
        found |= set(zip(left.tolist(), right.tolist()))
    close = np.bitwise_count(values[:, None] ^ values[None, :]) <= distance
    want = {(i, j) for i, j in np.argwhere(close).tolist() if i < j and top[i] == top[j]}
    assert found == want


def test_top_nodes_are_bounded_and_cover_every_close_pair():
    rounds = simhash.slices(2, 1024)
    assert max(64 - m.bit_count() for m in rounds[-1]) <= 10
    rng = random.Random(3)
    for _ in range(500):
        differ = 0
        for bit in rng.sample(range(64), rng.randint(0, 2)):
            differ |= 1 << bit
        for masks in rounds:
            assert any(not m & differ for m in masks)


def test_near_duplicates_match_brute_force(spark):
    rows = samples.near_copies(60, 5)
    got = samples.collected(simhash.near_duplicates(samples.documents(spark, rows)))
    assert got == brute(rows)
    assert len({c for _, _, c in got}) < len(rows)


def test_large_top_nodes_are_opened_without_losing_links(spark):
    rng = random.Random(9)
    values = {rng.getrandbits(64) for _ in range(10)}
    for value in list(values):
        values |= {value ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)) for _ in range(20)}
    prints = spark.createDataFrame([(v - (1 << 64) if v >> 63 else v,) for v in values], "fingerprint bigint")
    ways = []
    for limit in (4, 4096):
        roots = components(simhash.links(prints, 2, group_limit=limit), "first", "second")
        ways.append(samples.collected(roots))
    assert ways[0] == ways[1] and len(ways[0]) > 100


def test_awkward_rows_and_clashing_columns(spark):
    want = brute(samples.awkward())
    assert samples.collected(simhash.near_duplicates(samples.documents(spark, clashing=True))) == want


def test_empty_table(spark):
    assert simhash.near_duplicates(samples.documents(spark, [])).count() == 0
    assert simhash.keep_one_of_each(samples.documents(spark, [])).count() == 0


def groups(rows, distance=2):
    """Row numbers by near-duplicate component, by comparing all fingerprints."""
    prints = [simhash.fingerprint((r[1] or "").encode(), 3) for r in rows]
    root = list(range(len(rows)))
    find = lambda i: i if root[i] == i else find(root[i])
    for i in range(len(rows)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= distance:
                root[find(i)] = find(j)
    found = {}
    for i in range(len(rows)):
        found.setdefault(find(i), []).append(i)
    return list(found.values())


def test_one_document_of_each_group_stays(spark):
    rows = samples.awkward() + [(r[0] + 100, *r[1:]) for r in samples.near_copies(30, 6)]
    other = samples.prose(77, 90)
    # Ids that different texts share, and copies without an id.
    rows += [(0, other, "en", "z", 1), (0, other + " x", "en", "z", 1), (None, samples.prose(78, 90), "en", "z", 1), (None, samples.prose(78, 90), "fr", "y", 2), (None, other, "en", "z", 1)]
    docs = samples.documents(spark, rows, clashing=True)
    kept = simhash.keep_one_of_each(docs)
    assert kept.columns == docs.columns
    got = sorted(((r.doc_id, r.text) for r in kept.collect()), key=repr)
    components_ = groups(rows)
    assert len(got) == len(components_) < len(rows)
    for members in components_:
        ids = [rows[i][0] for i in members if rows[i][0] is not None]
        first = min(ids) if ids else None
        mine = [g for g in got if g in {(rows[i][0], rows[i][1]) for i in members}]
        assert len(mine) == 1 and mine[0][0] == first


def test_components_of_chains_stars_and_cycles(spark):
    links = [(i, i + 1) for i in range(20)] + [(100, 100 + i) for i in range(1, 30)] + [(201, 202), (202, 203), (203, 201), (5, 5), (None, 7)]
    got = dict(samples.collected(components(spark.createDataFrame(links, "a bigint, b bigint"), "a", "b")))
    assert got == {**{i: 0 for i in range(21)}, **{100 + i: 100 for i in range(30)}, 201: 201, 202: 201, 203: 201}
    assert components(spark.createDataFrame([], "a bigint, b bigint"), "a", "b").count() == 0
