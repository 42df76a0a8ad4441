import pytest
from pyspark.sql import functions as F

from demandspark.llm import urls
from demandspark.llm.catalog import URL_RULES

PAGES = [
    (0, "HTTP://WWW.Example.ORG/es/1?x#y"),
    (1, "http://example.org/es"),
    (2, "http://notexample.org/es/1"),
    (3, "https://a.com/de/x"),
    (4, "https://a.com/fr/x://b.org/"),
    (5, "http://x.example.org/en/12"),
    (6, "http://org"),
    (7, "ftp://h.net?q=/p"),
    (8, None),
    (9, "no scheme"),
    (10, ""),
    (None, "http://h.net/#f"),
    (11, "http://spam.net/a"),
    (11, "http://spam.net/a"),
    (12, "http://good.net/a"),
    (13, "http://new.spam.co.uk/x"),
    (14, "://"),
]
WANT = {
    0: ("www.example.org", "/es/1", "example.org/es/", "block"),
    1: ("example.org", "/es", "org/", "allow"),
    2: ("notexample.org", "/es/1", "org/", "allow"),
    3: ("a.com", "/de/x", "com/de/", "block"),
    4: ("a.com", "/fr/x://b.org/", "com/fr/", "allow"),
    5: ("x.example.org", "/en/12", "example.org/en/1", "block"),
    6: ("org", "", None, "allow"),
    7: ("h.net", "", None, "allow"),
    8: ("", "", None, "allow"),
    9: ("", "", None, "allow"),
    10: ("", "", None, "allow"),
    11: ("spam.net", "/a", None, "block"),
    12: ("good.net", "/a", None, "allow"),
    14: ("", "", None, "allow"),
}


def outcomes(spark):
    rows = [("http://spam.net/a", 0)] * 40 + [("http://good.net/b", 1)] * 40 + [("http://h.net/", 1)] * 20 + [(None, None)]
    return spark.createDataFrame(rows, "url string, good int")


def test_parsing_rules_and_verdicts(spark):
    pages = spark.createDataFrame(PAGES, "page_id bigint, url string").selectExpr("*", "'c' as host", "'c' as verdict", "'c' as n")
    got = urls.judge(pages, outcomes(spark), URL_RULES).collect()
    assert len(got) == len(PAGES)
    for r in got:
        if r.page_id in WANT:
            assert (r.host, r.path, r.rule, r.verdict) == WANT[r.page_id], r


def test_longest_rule_wins_and_first_among_equals(spark):
    pages = spark.createDataFrame([(1, "http://a.b/cd/e")], "page_id bigint, url string")
    rules = [urls.Rule("allow", "b", "/"), urls.Rule("block", "a.b", "/c"), urls.Rule("allow", "b", "/cd/")]
    row = urls.judge(pages, outcomes(spark), rules).first()
    assert row.rule in ("a.b/c", "b/cd/") and len("a.b/c") == len("b/cd/")
    assert (row.rule, row.verdict) == ("a.b/c", "block")


@pytest.mark.parametrize(
    "host, domain, suffix",
    [("a.b.example.com", "example.com", "com"), ("example.com", "example.com", "com"), ("x.y.co.uk", "y.co.uk", "co.uk"), ("co.uk", "co.uk", "uk"), ("localhost", "localhost", "localhost"), ("", "", "")],
)
def test_registered_domains(spark, host, domain, suffix):
    row = spark.createDataFrame([(host,)], "host string").select(urls.domain_of(F.col("host")).alias("d")).withColumn("s", urls.suffix_of(F.col("d"))).first()
    assert (row.d, row.s) == (domain, suffix)


def test_estimates_shrink_towards_the_level_above(spark):
    known = spark.createDataFrame(
        [("a.spam.net", 0)] * 30 + [("b.spam.net", 0)] * 30 + [("c.fine.net", 1)] * 30 + [("d.fine.net", 1)] * 30 + [("e.spam.net", 1)],
        "host string, good int",
    )
    hosts = spark.createDataFrame([("new.spam.net",), ("new.fine.net",), ("e.spam.net",), ("a.spam.net",), ("far.org",)], "host string")
    found = {r.host: r for r in urls.reputation(known, hosts).collect()}
    assert found["new.spam.net"].mean < found["far.org"].mean < found["new.fine.net"].mean
    assert found["a.spam.net"].mean < found["new.spam.net"].mean < found["e.spam.net"].mean < 0.9
    width = lambda h: found[h].upper - found[h].lower
    assert width("a.spam.net") < width("new.spam.net")
    assert all(r.lower <= r.mean <= r.upper for r in found.values())


def test_without_labels_or_rows(spark):
    none = spark.createDataFrame([], "url string, good int")
    pages = spark.createDataFrame(PAGES, "page_id bigint, url string")
    assert urls.judge(pages, none, []).filter("verdict = 'allow'").count() == len(PAGES)
    assert urls.judge(pages.limit(0), none, URL_RULES).count() == 0


def test_everything_is_built_in(spark):
    plan = urls.judge(spark.createDataFrame(PAGES, "page_id bigint, url string"), outcomes(spark), URL_RULES)
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in text and "Arrow" not in text and "Cartesian" not in text and "NestedLoop" not in text
