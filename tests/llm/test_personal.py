import hashlib
import random
import re

import pytest

from demandspark.llm import personal
from tests.llm import samples

BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def passes_luhn(digits):
    total = 0
    for place, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + place % 2)
        total += value - 9 * (value > 9)
    return total % 10 == 0


def brute(text):
    """(kind, first, end) of the base spans of a text."""
    spans = []
    for kind, pattern in BASE.items():
        for match in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", match[0])
            if kind == "ip" and any(int(x) > 255 for x in match[0].split(".")):
                continue
            if kind == "card" and not (16 <= len(digits) <= 19 and passes_luhn(digits)):
                continue
            if kind == "phone" and not 8 <= len(digits) <= 15:
                continue
            spans.append((kind, *match.span()))
    return spans


def check(spark, texts):
    rows = [(i, t, "en", "s", 1) for i, t in enumerate(texts)]
    got = {r.doc_id: r for r in personal.report(samples.documents(spark, rows, clashing=True)).collect()}
    assert len(got) == len(texts)
    for i, text in enumerate(texts):
        want = brute(text)
        joined = ",".join(f"{k}:{a}:{b}" for k, a, b in want)
        assert got[i].base_sha256 == hashlib.sha256(joined.encode()).hexdigest(), text[:200]
        assert [getattr(got[i], f"n_{k}") for k in BASE] == [sum(s[0] == k for s in want) for k in BASE]
        assert set(joined.split(",")) - {""} <= set(got[i].spans.split(","))
    return got


def test_base_spans_match_brute_force(spark):
    rng = random.Random(5)
    bits = ["a@b.c", "@", ".", "a", "Z9", "1.2.3.4", "256.1.1.1", "4111111111111111", "4111 1111 1111 1111", "-", " ", "+1 (171) 555-2028", "+", "(",
            ")", "7", "0012", "x_y%z", "\n", "é", "\U0001f600", "\x01", "\x02", "5500-0000-0000-0004", "378282246310005", "ß@ü.de", "q.r@s-t.u.v", "٣"]
    check(spark, ["".join(rng.choice(bits) for _ in range(rng.randint(0, 25))) for _ in range(3000)] + [r[1] or "" for r in samples.awkward()])


def test_very_long_texts(spark):
    runs = ["9" * 6000, "a" * 6000 + "@", "+" + "(" * 60000, "1.1.1." * 1000, "A1" * 3000, "a@b.cd " * 8000 + "é", "4111111111111111 x " * 4000]
    got = check(spark, runs)
    assert got[5].n_email == 8000 and got[6].n_card == 4000


def test_checksums_and_context(spark):
    texts = {
        "IBAN DE89 3704 0044 0532 0130 00 ok": "iban:5:32",
        "IBAN DE89 3704 0044 0532 0130 01 ok": "",
        "xDE89370400440532013000": "",
        "GB82WEST12345698765432.": "iban:0:22",
        "card 378282246310005": "card:5:20",
        "at 378282246310005": "",
        "order id 378282246310005 card": "",
        'token = "d5190bd7c06284de91015a36974748794293dd8a"': "secret:9:49",
        "sha1 token d5190bd7c06284de91015a36974748794293dd8a": "",
        "see d5190bd7c06284de91015a36974748794293dd8a": "",
        "token aaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaa": "",
        "v 1.2.3.4567": "",
    }
    rows = [(i, t, "en", "s", 1) for i, t in enumerate(texts)]
    got = {r.doc_id: r.spans for r in personal.report(samples.documents(spark, rows)).collect()}
    assert [got[i] for i in range(len(texts))] == list(texts.values())
    scores = [s.score for r in personal.find(samples.documents(spark, rows)).collect() for s in r.spans]
    assert scores and all(0 <= s <= 100 for s in scores)


def test_context_moves_the_score_of_base_spans(spark):
    rows = [(0, "call +1 (171) 555-2028", "", "", 1), (1, "see +1 (171) 555-2028", "", "", 1), (2, "release 1.2.3.4", "", "", 1), (3, "host 1.2.3.4", "", "", 1)]
    got = {r.doc_id: r.spans for r in personal.find(samples.documents(spark, rows)).collect()}
    score = {i: spans[0].score for i, spans in got.items()}
    assert score[0] > score[1] and score[2] < personal.THRESHOLD < score[3]
    assert all(spans[0].base for spans in got.values())


def test_awkward_rows_and_empty_tables(spark):
    got = personal.find(samples.documents(spark, clashing=True)).collect()
    assert sorted(str(r.doc_id) for r in got) == sorted(str(r[0]) for r in samples.awkward())
    assert personal.report(samples.documents(spark, [])).count() == 0


def test_mask_replaces_spans(spark):
    rows = [(1, "mail a@b.cd, card 4111 1111 1111 1111.", "en", "s", 1), (2, None, None, None, None), (3, "é nothing", "", "", 1), (4, "a@b.cd" * 3, "", "", 1)]
    docs = samples.documents(spark, rows, clashing=True)
    masked = personal.mask(docs)
    assert masked.columns == docs.columns
    assert {r.doc_id: r.text for r in masked.collect()} == {1: "mail [email], card [card].", 2: None, 3: "é nothing", 4: "[email]@[email]"}


def test_main_path_is_native(spark):
    plan = personal.report(samples.documents(spark, [])) ._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas", plan)


@pytest.mark.parametrize("digits, good", [("4111111111111111", True), ("4111111111111112", False), ("0", True), ("18", True)])
def test_luhn(spark, digits, good):
    from pyspark.sql import functions as F

    assert spark.range(1).select(personal.luhn(F.lit(digits)).alias("x")).first().x is good
