"""URL filter: fixed rules first, else the host's reputation under an empirical-Bayes hierarchy.

Labelled page outcomes (good or not) are binomial counts per host.  The good rate of a host has a beta prior around the rate
of its registered domain, the domain's one around its public suffix, the suffix's one around the whole.  How tightly a
level holds together is estimated from the counts (the moment estimate of the intra-class correlation).  A host is blocked
if even the upper bound of its posterior good rate stays below `min_good`.  All of it is built-in SQL functions.
"""

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from demandspark.llm.common import materialise

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
MIN_GOOD = 0.7
Z = 1.0
# Correlation kept inside these bounds, so that a level neither ignores nor copies the one above; the
# highest, hence the weakest prior, where the counts cannot tell.
LOWEST_RHO, HIGHEST_RHO = 0.01, 0.5
# Labels that make a two-letter country domain part of the public suffix, as in co.uk.
SECOND_LEVEL = ("ac", "co", "com", "edu", "gov", "net", "org")


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path

    def fits(self, host: Column, path: Column) -> Column:
        return ((host == self.host) | host.endswith("." + self.host)) & path.startswith(self.path)


def host_of(url: Column) -> Column:
    """What follows the first :// up to /, ? or #, with A-Z lowered; empty without ://."""
    return F.translate(F.coalesce(F.regexp_extract(url, "://([^/?#]*)", 1), F.lit("")), UPPER, UPPER.lower())


def path_of(url: Column) -> Column:
    """What follows the host up to ? or #."""
    return F.coalesce(F.regexp_extract(url, "://[^/?#]*([^?#]*)", 1), F.lit(""))


def domain_of(host: Column) -> Column:
    """The registered domain: the public suffix and one label before it, or the whole host."""
    long_suffix = f"(?:[^.]+\\.)?(?:{'|'.join(SECOND_LEVEL)})\\.[a-z]{{2}}$"
    longer = F.regexp_extract(host, long_suffix, 0)
    return F.when(F.length(longer) > 0, longer).otherwise(F.regexp_extract(host, "(?:[^.]+\\.)?[^.]*$", 0))


def suffix_of(domain: Column) -> Column:
    """The registered domain without its first label."""
    return F.when(F.contains(domain, F.lit(".")), F.regexp_replace(domain, "^[^.]*\\.", "")).otherwise(domain)


def _strength(counts: DataFrame) -> DataFrame:
    """One row: prior observations k of a level whose groups have counts `good` and `n`."""
    seen = counts.filter("n > 0")
    rates = seen.agg(F.sum("good").alias("g"), F.sum("n").alias("t"), F.count("*").alias("groups"),
                     F.sum(F.col("n") * F.col("n")).alias("squares"), F.sum(F.col("good") * F.col("good") / F.col("n")).alias("q"))
    mean = F.col("g") / F.col("t")
    spread = mean * (1 - mean)
    # sum n (p - m)^2 = sum good^2 / n - t m^2
    excess = F.col("q") - F.col("t") * mean * mean - spread * (F.col("groups") - 1)
    room = spread * (F.col("t") - F.col("squares") / F.col("t") - F.col("groups") + 1)
    rho = F.when((F.col("t") > 0) & (room > 0), excess / room).otherwise(F.lit(HIGHEST_RHO))
    rho = F.least(F.greatest(F.coalesce(rho, F.lit(HIGHEST_RHO)), F.lit(LOWEST_RHO)), F.lit(HIGHEST_RHO))
    return rates.select(((1 - rho) / rho).alias("k"))


def reputation(outcomes: DataFrame, hosts: DataFrame, z: float = Z) -> DataFrame:
    """host, posterior mean and its lower and upper bound for every distinct host of `hosts`.

    `outcomes` has one row per labelled page: host and good (0 or 1); NULL counts as unlabelled.  Without any label the
    whole has a good rate of one half.
    """
    labelled = outcomes.select("host", F.col("good").cast("bigint").alias("good")).unionByName(
        hosts.select("host", F.lit(None).cast("bigint").alias("good"))
    )
    per_host = labelled.groupBy("host").agg(F.coalesce(F.sum("good"), F.lit(0)).alias("good"), F.count("good").alias("n"))
    per_host = per_host.withColumn("domain", domain_of(F.col("host"))).withColumn("suffix", suffix_of(F.col("domain")))
    per_host = materialise(per_host, "hosts")  # every level and strength below is a sum over it
    per_domain = per_host.groupBy("domain", "suffix").agg(F.sum("good").alias("good"), F.sum("n").alias("n"))
    per_suffix = per_domain.groupBy("suffix").agg(F.sum("good").alias("good"), F.sum("n").alias("n"))
    whole = per_suffix.agg(((F.sum("good") + 1) / (F.sum("n") + 2)).alias("m"))
    suffixes = per_suffix.withColumn("k", _strength(per_suffix).scalar()).withColumn("m", whole.scalar())
    suffixes = suffixes.select("suffix", ((F.col("m") * F.col("k") + F.col("good")) / (F.col("k") + F.col("n"))).alias("m"))
    domains = per_domain.withColumn("k", _strength(per_domain).scalar()).join(suffixes, "suffix")
    domains = domains.select("domain", ((F.col("m") * F.col("k") + F.col("good")) / (F.col("k") + F.col("n"))).alias("m"))
    judged = per_host.withColumn("k", _strength(per_host).scalar()).join(domains, "domain")
    judged = judged.withColumn("mean", (F.col("m") * F.col("k") + F.col("good")) / (F.col("k") + F.col("n")))
    spread = z * F.sqrt(F.col("mean") * (1 - F.col("mean")) / (F.col("k") + F.col("n") + 1))
    return judged.select("host", "n", "mean", (F.col("mean") - spread).alias("lower"), (F.col("mean") + spread).alias("upper"))


def judge(
    pages: DataFrame, outcomes: DataFrame, rules: list[Rule], page_id: str = "page_id", url: str = "url",
    min_good: float = MIN_GOOD, z: float = Z,
) -> DataFrame:
    """page_id, host, path, rule, verdict, good_upper of every row of `pages`.

    `outcomes` has url and good.  The longest rule that fits decides; among equally long ones the first.  A NULL url, or one
    without ://, has an empty host and path, and is judged as the host "".  Repeated rows each get a row, a NULL page_id
    stays NULL, other columns are ignored, and an empty table gives an empty result.
    """
    parsed = pages.select(F.col(page_id).alias("page_id"), host_of(F.col(url)).alias("host"), path_of(F.col(url)).alias("path"))
    known = outcomes.select(host_of(F.col("url")).alias("host"), F.col("good"))
    scores = reputation(known, parsed.select("host").distinct(), z)
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for r in sorted(reversed(rules), key=lambda r: len(r.text)):
        fits = r.fits(F.col("host"), F.col("path"))
        rule, verdict = F.when(fits, F.lit(r.text)).otherwise(rule), F.when(fits, F.lit(r.verdict)).otherwise(verdict)
    ruled = parsed.withColumns({"rule": rule, "ruled": verdict}).join(scores.select("host", "upper"), "host", "left")
    by_host = F.when(F.col("upper") < min_good, F.lit("block")).otherwise(F.lit("allow"))
    return ruled.select(
        "page_id", "host", "path", "rule", F.coalesce("ruled", by_host).alias("verdict"), F.round("upper", 9).alias("good_upper")
    )
