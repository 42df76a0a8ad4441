import hashlib
import random
import re

import pytest

from demandspark.llm import decontaminate
from tests.llm import samples

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))


def brute(rows, items, window):
    windows = {}
    for item, text in items:
        parts = words(text)
        size = min(window, len(parts))
        for k in range(len(parts) - size + 1) if size else ():
            windows.setdefault(tuple(parts[k : k + size]), set()).add(item)
    sizes = {len(w) for w in windows}
    out = []
    for row in rows:
        parts, hit, found, begins = words(row[1]), set(), set(), set()
        for size in sizes:
            for k in range(len(parts) - size + 1):
                items_here = windows.get(tuple(parts[k : k + size]))
                if items_here:
                    begins.add(k)
                    hit.update(range(k, k + size))
                    found |= items_here
        longest = 0
        for _, text in items if found else ():
            test = words(text)
            for i in begins:
                for j in range(len(test)):
                    n = 0
                    while i + n < len(parts) and j + n < len(test) and parts[i + n] == test[j + n]:
                        n += 1
                    longest = max(longest, n)
        digest = hashlib.sha256(",".join(sorted(map(str, found))).encode()).hexdigest()
        out.append((row[0], len(parts), len(hit), len(found), digest, bool(hit), longest))
    return sorted(out, key=repr)


COLUMNS = ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated", "longest"]


def leaking(seed):
    rng = random.Random(seed)
    items = [(i, " ".join(rng.choice("abcd") for _ in range(rng.randint(0, 14)))) for i in range(8)] + [(50, None), (51, "..."), (3, "a b a b a b")]
    rows = []
    for i in range(40):
        parts = [rng.choice("abcde") for _ in range(rng.randint(0, 30))]
        if rng.random() < 0.5:
            parts += (rng.choice(items)[1] or "").upper().split()
        rows.append((i, ", ".join(parts), "en", "s", 1))
    return rows, items


@pytest.mark.parametrize("seed, window, shard, block", [(1, 4, 1 << 19, 1 << 20), (2, 3, 16, 1 << 20), (3, 5, 40, 12)])
def test_hits_match_brute_force(spark, monkeypatch, seed, window, shard, block):
    rows, items = leaking(seed)
    monkeypatch.setattr(decontaminate, "SHARD_WORDS", shard)
    docs = samples.documents(spark, rows).repartition(3)
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    got = decontaminate.contamination(docs, bench, window=window, block_words=block).select(*COLUMNS)
    want = brute(rows, items, window)
    assert any(w[5] for w in want) and not all(w[5] for w in want)
    if block > 1000:
        assert samples.collected(got) == want
    else:  # several passes: the longest match is the longest of each block's
        assert samples.collected(got.drop("longest")) == sorted((w[:-1] for w in want), key=repr)


def test_long_items_are_cut_without_losing_windows(spark, monkeypatch):
    text = samples.prose(7, 400)
    monkeypatch.setattr(decontaminate, "PIECE_WORDS", 50)
    rows = [(i, " ".join(text.split()[i * 20 : i * 20 + 15]), "en", "s", 1) for i in range(18)]
    bench = spark.createDataFrame([(1, text)], "item_id bigint, text string")
    got = decontaminate.contamination(samples.documents(spark, rows), bench)
    assert got.filter("not contaminated").count() == 0


def test_awkward_rows_and_clashing_columns(spark):
    items = [(1, " ".join(samples.prose(2, 120).split()[20:45])), (2, "One"), (3, "")]
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    got = decontaminate.contamination(samples.documents(spark, clashing=True), bench).select(*COLUMNS)
    assert samples.collected(got) == brute(samples.awkward(), items, 10)


def test_affected_documents_go_and_the_rest_stays(spark):
    """By text, not by id: one of two texts that share an id goes, and so do texts without an id."""
    passage = " ".join(samples.prose(2, 120).split()[20:45])
    bench = spark.createDataFrame([(1, passage), (None, samples.prose(5, 30))], "item_id bigint, text string")
    more = [(4, passage, "en", "z", 1), (None, passage, "en", "z", 1), (77, "a " + samples.prose(5, 30), "en", "z", 1), (4, "clean", "en", "z", 1)]
    docs = samples.documents(spark, samples.awkward() + more, clashing=True)
    kept = decontaminate.remove_contaminated(docs, bench)
    assert kept.columns == docs.columns
    got = sorted(((r.doc_id, r.text) for r in kept.collect()), key=repr)
    want = [(r[0], r[1]) for r in samples.awkward() if r[0] not in (0, 1, 2, -5)] + [(4, "clean")]
    assert got == sorted(want, key=repr)


def test_items_without_an_id_hit_words(spark):
    text = " ".join(f"w{i}" for i in range(12))
    bench = spark.createDataFrame([(None, text), (3, "other words")], "item_id bigint, text string")
    rows = [(1, text + " z", "en", "s", 1), (2, "z", "en", "s", 1), (3, text + " other words", "en", "s", 1)]
    got = {r.doc_id: r for r in decontaminate.contamination(samples.documents(spark, rows), bench).collect()}
    assert [(got[i].n_hit, got[i].n_items, got[i].contaminated) for i in (1, 2, 3)] == [(12, 0, True), (0, 0, False), (14, 1, True)]
    assert got[1].longest == 12 and got[1].longest_item is None


def test_longest_match_of_a_long_item_is_whole(spark):
    text = " ".join(f"w{i}" for i in range(40000))
    bench = spark.createDataFrame([(1, text)], "item_id bigint, text string")
    rows = [(1, "x " + text, "en", "s", 1)]
    row = decontaminate.contamination(samples.documents(spark, rows), bench).first()
    assert (row.n_hit, row.longest, row.longest_place) == (40000, 40000, 1)


def test_empty_tables(spark):
    bench = spark.createDataFrame([], "item_id bigint, text string")
    assert decontaminate.contamination(samples.documents(spark, []), bench).count() == 0
    found = decontaminate.contamination(samples.documents(spark), bench)
    assert found.filter("contaminated").count() == 0 and found.count() == len(samples.awkward())
