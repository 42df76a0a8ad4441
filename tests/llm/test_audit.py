import re
from itertools import permutations

import pytest

from demandspark.llm import audit
from demandspark.llm.common import new_path
from tests.llm import samples

COLUMNS = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]


def fails(rows):
    """Names of the failed filters of each row, by plain counting."""
    out = []
    for doc_id, text, _, _, _ in rows:
        text = text or ""
        words = [w for w in re.split("[\x20\x09-\x0d]+", text) if w]
        found = ""
        found += "A" * (len(words) < 50)
        found += "B" * (100 * len(set(words)) < 65 * len(words))
        found += "C" * (100 * sum("A" <= c <= "Z" for c in text) > 5 * len(text))
        found += "D" * any(c in "#$%&*|" for c in text)
        found += "E" * (doc_id is not None and any((o[1] or "") == text and o[0] is not None and o[0] < doc_id for o in rows))
        out.append(found)
    return out


def brute(rows, labels):
    """part, order, step and the seven counts."""
    failed = fails(rows)
    good = {d for d, q, _ in labels if q == 1}
    toxic = {d for d, _, t in labels if t == 1}
    out = {}
    for part in {r[3] or "" for r in rows}:
        mine = [(r[0], f) for r, f in zip(rows, failed) if (r[3] or "") == part]
        shapley = dict.fromkeys("ABCDE", 0)
        for order in permutations("ABCDE"):
            left = mine
            for step, name in enumerate(order):
                gone = [(d, f) for d, f in left if name in f]
                left = [(d, f) for d, f in left if name not in f]
                shapley[name] += len(gone)
                failing = sum(name in f for _, f in mine)
                out[part, "".join(order), step + 1] = [
                    len(left),
                    len(gone),
                    failing - len(gone),
                    sum(f == name for _, f in mine),
                    sum(d is not None and d in good for d, _ in gone),
                    sum(d is not None and d in toxic for d, _ in gone),
                ]
        for (p, order, step), values in out.items():
            if p == part:
                values.append(shapley[order[step - 1]])
    return out


def as_dict(df):
    return {(r.part, r.filter_order, r.step): [r[c] for c in COLUMNS] for r in df.collect()}


def write(spark, path, rows, files=1, clashing=False):
    samples.documents(spark, rows, clashing).repartition(files).write.mode("append").parquet(path)


LABELS = [(0, 1, 0), (1, 1, 1), (2, 0, 1), (6, 1, None), (6, None, 1), (None, 1, 1), (7, 1, 0), (50, 1, 1)]


@pytest.fixture
def labels(spark):
    return spark.createDataFrame(LABELS, "doc_id bigint, quality int, toxic int")


def test_matches_brute_force_in_many_batches(spark, labels):
    path, folder = new_path(spark, "docs"), new_path(spark, "audit")
    base = samples.awkward()
    copies = [(100 - i, base[0][1], "en", f"s{i % 3}", 1) for i in range(30)] + [(2**60 + 1, "x", "en", None, 1), (2**60, "x", "en", "a", 1)]
    rows = base + copies
    write(spark, path, rows, 4, clashing=True)
    got = as_dict(audit.audit(spark, path, labels, folder, files=1))
    assert got == brute(rows, LABELS)
    assert spark.read.parquet(f"{folder}/changes").filter("n < 0").count() > 0  # something was retracted


def test_later_files_retract_earlier_masks(spark, labels):
    path, folder = new_path(spark, "docs"), new_path(spark, "audit")
    text = samples.prose(1, 60)
    first = [(10, text, "en", "a", 1), (11, text, "en", "b", 1), (11, text, "en", "a", 1)]
    later = [(7, text, "en", "b", 1), (12, text, "en", "b", 1), (7, text, "en", "b", 1)]
    write(spark, path, first)
    assert as_dict(audit.audit(spark, path, labels, folder)) == brute(first, LABELS)
    before = spark.read.parquet(f"{folder}/changes").count()
    write(spark, path, later)
    assert as_dict(audit.audit(spark, path, labels, folder)) == brute(first + later, LABELS)
    new = spark.read.parquet(f"{folder}/changes")
    assert new.count() > before and new.filter("n < 0 and part = 'a'").count() > 0
    assert as_dict(audit.audit(spark, path, labels, folder)) == brute(first + later, LABELS)  # nothing new, nothing changes
    assert new.groupBy().sum("n").first()[0] == 6


def test_state_on_disk_gives_the_same_and_settings_are_restored(spark, labels):
    path = new_path(spark, "docs")
    write(spark, path, samples.awkward())
    keys = list(audit.STATE_ON_DISK)
    before = [spark.conf.get(k, None) for k in keys]
    got = as_dict(audit.audit(spark, path, labels, new_path(spark, "audit"), settings=audit.STATE_ON_DISK))
    assert got == brute(samples.awkward(), LABELS)
    assert [spark.conf.get(k, None) for k in keys] == before


def test_empty_tables(spark, labels):
    path = new_path(spark, "docs")
    write(spark, path, [])
    assert audit.audit(spark, path, labels, new_path(spark, "audit")).count() == 0
    some = new_path(spark, "docs")
    write(spark, some, samples.awkward()[:3])
    assert as_dict(audit.audit(spark, some, labels.limit(0), new_path(spark, "audit"))) == brute(samples.awkward()[:3], [])


def test_a_text_moves_when_a_smaller_id_arrives():
    texts = {}
    assert audit.retract(texts, b"k", "p", 5, 1, 2, 16) == []
    assert audit.retract(texts, b"k", "p", 9, 1, 1, 16) == [("p", 9, True, 1, -1), ("p", 9, True, 17, 1)]
    assert audit.retract(texts, b"k", "q", 3, 1, 1, 16) == [("p", 5, True, 1, -2), ("p", 5, True, 17, 2)]
    assert audit.retract(texts, b"k", "p", 3, 1, 4, 16) == []
    assert texts == {b"k": (3, {"q": 1, "p": 4})}
    assert audit._unpacked(*audit._packed({b"k" * 16: (3, {"q": 1, "p": 4})})) == {b"k" * 16: (3, {"q": 1, "p": 4})}
