import hashlib
import random

import numpy as np
import pytest

from demandspark.llm import suffixes
from demandspark.llm.sais import common_prefixes, suffix_array
from tests.llm import samples


def brute(rows, size):
    """Rows in document order; each is its own document."""
    seen, out = set(), []
    for doc_id, body in rows:
        gone = np.zeros(len(body) + 1, bool)
        for i in range(len(body) - size + 1):
            if body[i : i + size] in seen:
                gone[i : i + size] = True
            seen.add(body[i : i + size])
        gone = gone[: len(body)]
        runs = int((gone & ~np.r_[False, gone[:-1]]).sum()) if len(body) else 0
        kept = np.frombuffer(body, np.uint8)[~gone].tobytes()
        out.append((doc_id, len(body), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def plain(rows):
    return sorted((r[0], (r[1] or "").encode()) for r in rows)


def test_suffix_array_and_prefixes():
    rng = random.Random(0)
    for _ in range(400):
        letters = rng.choice(["a", "ab", "abc", "abcdefgh", "\x00\xff"])
        text = ("".join(rng.choice(letters) for _ in range(rng.randint(0, 40))) * rng.choice([1, 1, 2, 3])).encode("latin1")
        data = np.frombuffer(text, np.uint8)
        array = suffix_array(data)
        assert array.tolist() == sorted(range(len(text)), key=lambda i: text[i:])
        prefix = common_prefixes(data, array)
        for before, place in zip(array[:-1].tolist(), array[1:].tolist()):
            n = 0
            while max(before, place) + n < len(text) and text[before + n] == text[place + n]:
                n += 1
            assert prefix[place] == n


def overlapping(seed):
    rng = random.Random(seed)
    parts = ["ab", "cde", "f", "ghij", "é"]
    base = ["".join(rng.choice(parts) + " " for _ in range(200)) for _ in range(5)]
    rows = []
    for i in range(50):
        text = ""
        for _ in range(rng.randint(0, 6)):
            kind, source = rng.random(), rng.choice(base)
            begin = rng.randrange(len(source))
            text += source[begin : begin + rng.randint(1, 300)] if kind < 0.6 else rng.choice("ab") * rng.randint(1, 90)
        rows.append((i, text, "en", "s", 1))
    return rows


@pytest.mark.parametrize("seed, size, limit, buffer, shard", [(1, 40, 2048, 4 << 20, 4 << 20), (2, 32, 2, 4 << 20, 4 << 20), (3, 50, 2048, 500, 600)])
def test_removed_bytes_match_brute_force(spark, monkeypatch, seed, size, limit, buffer, shard):
    monkeypatch.setattr(suffixes, "BUFFER_BYTES", buffer)
    monkeypatch.setattr(suffixes, "SHARD_BYTES", shard)
    rows = overlapping(seed)
    docs = samples.documents(spark, rows).repartition(3)
    got = suffixes.remove_repeats(docs, size, anchor_limit=limit).selectExpr("doc_id", "n_bytes", "n_removed", "n_spans", "sha2(kept, 256)")
    want = brute(plain(rows), size)
    assert sum(w[2] for w in want) > 0
    assert samples.collected(got) == want


@pytest.mark.parametrize("seed", range(4))
def test_copies_of_one_short_text_only(spark, seed):
    """Batches of `meet` with repeated rows alone: they sort before every positive anchor, so several texts are tried."""
    rng = random.Random(seed)
    text = "".join(rng.choice("abcdefgh") for _ in range(100))
    limit = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "100")
    try:
        rows = [(i, text, "en", "s", 1) for i in range(3000)]
        got = suffixes.remove_repeats(samples.documents(spark, rows)).selectExpr("doc_id", "n_removed").collect()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", limit)
    assert sorted(map(tuple, got)) == [(i, 100 * (i > 0)) for i in range(3000)]


def test_buffer_of_short_texts_only(spark):
    rows = [(i, "x" * (i % 60), "en", "s", 1) for i in range(200)]
    got = suffixes.removal_report(samples.documents(spark, rows))
    assert sorted(tuple(r)[:3] for r in got.collect()) == [(i, i % 60, 0) for i in range(200)]


def test_rows_without_or_with_a_repeated_id(spark):
    docs = samples.documents(spark, clashing=True)
    got = samples.collected(suffixes.removal_report(docs))
    ids = sorted((r[0] for r in samples.awkward()), key=repr)
    assert sorted((g[0] for g in got), key=repr) == ids
    by_id = {g[0]: g for g in got if g[0] is not None}
    # The earliest document with the shared text is -5, whose copy in 0 and 1 goes whole.
    assert by_id[-5][2] == 0 and by_id[0][2] == by_id[0][1] == by_id[1][2]
    long = [g for g in got if g[0] == 6]
    assert sorted(g[2] for g in long) == [0, long[0][1]]
    assert by_id[3][1] == by_id[4][1] == 0 and by_id[3][4] == hashlib.sha256(b"").hexdigest()


def test_empty_table_and_small_size(spark):
    assert suffixes.removal_report(samples.documents(spark, [])).count() == 0
    with pytest.raises(ValueError):
        suffixes.remove_repeats(samples.documents(spark, []), 10)
