import re

import pytest

from demandspark.llm import quality
from tests.llm import samples

BLANK = re.compile(r"[\x20\x09-\x0D]+")


def brute(rows):
    out = []
    for row in rows:
        text = row[1] or ""
        words = [w for w in BLANK.split(text) if w]
        lines = [line for line in text.split("\n") if BLANK.sub("", line)]
        windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
        covered = set()
        for i, window in enumerate(windows):
            if windows.count(window) > 1:
                covered |= {i, i + 1, i + 2}
        n = len(words)
        chars = sum(map(len, words))
        symbols, dup, upper = sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), sum("A" <= c <= "Z" for c in text)
        base = n < 50 or 100 * len(covered) > 50 * n
        fails = [n < 50, 100 * len(covered) > 50 * n, 10 * symbols > n, len(lines) >= 4 and 2 * dup > len(lines),
                 chars < 2 * n, chars > 20 * n, 2 * upper > chars]
        bits = sum(f << k for k, f in enumerate(fails))
        out.append((row[0], n, chars, symbols, dup, len(covered), bits, base, not base and not any(fails)))
    return sorted(out, key=repr)


COLUMNS = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "failures", "base_failed", "kept"]


def junk():
    good = samples.prose(11, 90)
    texts = [good, good.upper(), good + " # $ % & |" * 8, "same line here\n" * 30, "a b c a b c " * 20, "x y z " + good + " x y z",
             "a " * 80, "antidisestablishmentarianism" * 3 + " " + "w" * 2000 + " q" * 60, "a a a", "a a a a", good[:100]]
    return samples.awkward()[:6] + samples.awkward()[7:] + [(100 + i, t, "en", "s", 1) for i, t in enumerate(texts)]


def test_ledger_matches_brute_force(spark):
    got = quality.verdicts(samples.documents(spark, junk(), clashing=True)).select(*COLUMNS)
    assert samples.collected(got) == brute(junk())


def test_kept_documents_keep_their_columns(spark):
    docs = samples.documents(spark, junk(), clashing=True)
    kept = quality.keep_good(docs)
    assert kept.columns == docs.columns
    want = sorted((r[0] for r in brute(junk()) if r[-1]), key=repr)
    assert sorted((r.doc_id for r in kept.collect()), key=repr) == want


def test_measurements_are_made_once(spark):
    """The filter must not pull the word windows into itself, where they would be built per word."""
    plan = quality.keep_good(samples.documents(spark))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("xxhash64(") == 1


def test_policies_and_ablations_from_the_ledger(spark):
    ledger = quality.ledger(samples.documents(spark, junk())).cache()
    bits = [r.failures for r in ledger.collect()]
    for policy in quality.POLICIES.values():
        mask = policy.mask()
        assert ledger.filter(quality.passes(policy)).count() == sum(not b & mask for b in bits)
        rows = {r.rule: r for r in quality.ablations(ledger, policy).collect()}
        assert set(rows) == set(policy.rules)
        for rule, row in rows.items():
            bit = 1 << list(quality.RULES).index(rule)
            assert row.failing == sum(bool(b & bit) for b in bits)
            assert row.failing_alone == sum(b & mask == bit for b in bits)
            assert row.kept == sum(not b & mask for b in bits)
            assert row.kept_without_rule == sum(not b & mask & ~bit for b in bits)


def test_unknown_rule_has_no_mask():
    with pytest.raises(ValueError):
        quality.Policy("x", ("no such rule",)).mask()


def test_empty_table(spark):
    assert quality.verdicts(samples.documents(spark, [])).count() == 0
    assert quality.ablations(quality.ledger(samples.documents(spark, [])), quality.POLICIES["v2"]).count() == 0
