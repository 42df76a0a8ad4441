import hashlib
from collections import Counter

import pytest

from demandspark.llm import lines
from tests.llm import samples


def brute(rows, ratio, least):
    pages = Counter(r[3] for r in rows)
    seen = Counter()
    for r in rows:
        for line in {x.strip(" \t\x0b\x0c\r") for x in (r[1] or "").split("\n")} - {""}:
            seen[r[3], line] += 1
    common = {k for k, n in seen.items() if n >= least and n / pages[k[0]] > ratio}
    out = []
    for r in rows:
        parts = [] if r[1] is None else r[1].split("\n")
        kept = [x for x in parts if (r[3], x.strip(" \t\x0b\x0c\r")) not in common]
        out.append((r[0], len(parts), len(parts) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    return sorted(out, key=repr)


def pages():
    rows = []
    for i in range(40):
        own = [f"line {i} {k}" for k in range(i % 4)]
        text = "\n".join(["  Menu | Home\t", *own, "", "(c) us" if i % 3 else "(c) them", *own[:1]])
        rows.append((i, text, "en", ["x", "y", None][i % 3], 1))
    return rows + [(100, "Menu | Home", "en", "z", 1), (101, "(c) us\n(c) us", "en", "x", 2)]


@pytest.mark.parametrize("ratio, least", [(0.05, 3), (0.5, 2), (0.0, 1), (1.0, 1)])
def test_report_matches_brute_force(spark, ratio, least):
    rows = pages() + samples.awkward()
    got = lines.line_report(samples.documents(spark, rows, clashing=True), "source", ratio, least)
    assert samples.collected(got) == brute(rows, ratio, least)


def test_join_by_host_gives_the_same(spark, monkeypatch):
    rows = pages()
    monkeypatch.setattr(lines, "BROADCAST_LINES", 0)
    got = lines.line_report(samples.documents(spark, rows), "source", 0.05, 3)
    assert samples.collected(got) == brute(rows, 0.05, 3)


def test_cleaned_documents_keep_columns_and_count_characters(spark):
    docs = samples.documents(spark, pages() + samples.awkward(), clashing=True)
    cut = lines.clean_documents(docs)
    assert cut.columns == docs.columns and cut.count() == docs.count()
    assert cut.filter("text is not null and n_chars <> length(text)").count() == 0
    assert cut.filter("text like '%Home%'").select("doc_id").collect() == [(100,)]


def test_copies_of_a_text_do_not_make_its_lines_boilerplate(spark):
    own = [(i, f"Menu\nfirst {i}\nsecond {i}", "en", "big", 1) for i in range(40)]
    copies = [(100 + i, "Menu\nalpha\nbeta", "en", "big", 1) for i in range(20)]  # a third of the host
    few = [(200 + i, f"gamma {i // 3}\ndelta {i // 3}", "en", "small", 1) for i in range(9)]  # three copies of three texts
    got = lines.clean_documents(samples.documents(spark, own + copies + few)).collect()
    texts = {r.doc_id: r.text for r in got}
    assert texts == {r[0]: r[1].replace("Menu\n", "") for r in own + copies + few}


def test_empty_table(spark):
    assert lines.line_report(samples.documents(spark, [])).count() == 0
