"""Quality rules as a ledger of failure bits, with versioned policies over it.

`ledger` measures a text once and evaluates every rule once.  A row keeps the measurements and one integer in which
bit k is set if rule k fails.  A policy is a set of rules, hence a mask: applying another version is a bitwise AND on the
stored integer, and ablations are counts per distinct integer.  All of it is built-in SQL functions.
"""

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from demandspark.llm.common import BLANKS, word_array

# Rule k fails where its condition is true; whole numbers only, so that no rounding decides.
RULES: dict[str, str] = {
    "few_words": "n_words < 50",
    "repeated_words": "100 * n_repeat_words > 50 * n_words",
    "symbols": "10 * n_symbols > n_words",
    "repeated_lines": "n_lines >= 4 and 2 * n_dup_lines > n_lines",
    "short_words": "word_chars < 2 * n_words",
    "long_words": "word_chars > 20 * n_words",
    "shouting": "2 * n_upper > word_chars",
}
BASE = ("few_words", "repeated_words")
MEASURES = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_upper")


@dataclass(frozen=True)
class Policy:
    """A version of the policy: the names of the rules that reject a document."""

    version: str
    rules: tuple[str, ...]

    def mask(self) -> int:
        return sum(1 << list(RULES).index(name) for name in self.rules)


POLICIES = {
    "base": Policy("base", BASE),
    "v1": Policy("v1", (*BASE, "symbols", "repeated_lines", "shouting")),
    "v2": Policy("v2", tuple(RULES)),
}
CURRENT = "v2"


def _count(text: Column, kept: str) -> Column:
    """Characters of `text` that remain without everything that `kept` matches."""
    return F.length(F.regexp_replace(text, kept, "")).cast("bigint")


def measure(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id and the measurements of every row; NULL counts as an empty text."""
    plain = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("body"))
    lines = F.filter(F.split("body", "\n"), lambda line: line.rlike("[^\\x20\\x09-\\x0D]"))
    split = plain.select(
        "doc_id",
        word_array(F.col("body")).alias("words"),
        lines.alias("lines"),
        _count(F.col("body"), f"{BLANKS}+").alias("word_chars"),
        _count(F.col("body"), "[^#*$%&|<>]+").alias("n_symbols"),
        _count(F.col("body"), "[^A-Z]+").alias("n_upper"),
    )
    # Windows by hash and place; equal windows end up side by side.
    word = lambda at: F.get("words", at)
    window = lambda i: F.struct(F.xxhash64(word(i), word(i + 1), word(i + 2)).alias("h"), i.alias("i"))
    count = F.size("words")
    windows = split.select(
        "doc_id",
        count.cast("bigint").alias("n_words"),
        "word_chars",
        "n_symbols",
        F.size("lines").cast("bigint").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("bigint").alias("n_dup_lines"),
        "n_upper",
        F.sort_array(
            F.when(count >= 3, F.transform(F.sequence(F.lit(0), F.greatest(count - 3, F.lit(0))), window))
        ).alias("windows"),
    )
    hash_at = lambda k: F.get("windows", k)["h"]
    twin = lambda x, k: (x["h"] == hash_at(k - 1)) | (x["h"] == hash_at(k + 1))
    repeated = windows.withColumn("at", F.sort_array(F.filter("windows", twin)["i"])).drop("windows")
    # A repeated window adds the words that the next one does not start with: three at most.
    step = lambda i, k: F.least(F.lit(3), F.coalesce(F.get("at", k + 1) - i, F.lit(3)))
    total = F.aggregate(F.transform("at", step), F.lit(0).cast("bigint"), lambda a, b: a + b)
    return repeated.withColumn("n_repeat_words", F.coalesce(total, F.lit(0).cast("bigint"))).select("doc_id", *MEASURES)


def ledger(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, the measurements and `failures`, the integer of failure bits."""
    bits = [F.when(F.expr(rule), F.lit(1 << k)).otherwise(0).cast("bigint") for k, rule in enumerate(RULES.values())]
    failures = bits[0]
    for bit in bits[1:]:
        failures = failures.bitwiseOR(bit)
    return measure(docs, doc_id, text).withColumn("failures", failures)


def passes(policy: Policy, failures: str = "failures") -> Column:
    return F.col(failures).bitwiseAND(F.lit(policy.mask())) == 0


def ablations(ledgers: DataFrame, policy: Policy) -> DataFrame:
    """Per rule of the policy: documents failing it, rejected by it alone, and kept with and without it.

    The ledger shrinks to one row per distinct failure integer before any rule is looked at.
    """
    counts = ledgers.groupBy("failures").agg(F.count("*").alias("n"))
    rules = F.array(*[F.struct(F.lit(r).alias("rule"), F.lit(1 << list(RULES).index(r)).alias("bit")) for r in policy.rules])
    failed = F.col("failures").bitwiseAND(F.lit(policy.mask()))
    each = counts.withColumn("r", F.explode(rules)).withColumn("failed", failed)
    hit = F.col("failed").bitwiseAND(F.col("r.bit")) != 0
    alone = F.col("failed") == F.col("r.bit")
    total = lambda condition: F.coalesce(F.sum(F.when(condition, F.col("n"))), F.lit(0))
    return each.groupBy(F.col("r.rule").alias("rule")).agg(
        total(hit).alias("failing"),
        total(alone).alias("failing_alone"),
        total(F.col("failed") == 0).alias("kept"),
        total((F.col("failed") == 0) | alone).alias("kept_without_rule"),
    )


def verdicts(docs: DataFrame, policy: Policy | None = None) -> DataFrame:
    """The ledger with base_failed and kept under `policy`, one row per row.

    NULL and empty texts have no words and fail `few_words`.  A NULL doc_id stays NULL, repeated rows each get a row, other
    columns are ignored, and an empty table gives an empty result.
    """
    policy = policy or POLICIES[CURRENT]
    base = passes(POLICIES["base"])
    return ledger(docs).withColumns({"base_failed": ~base, "kept": base & passes(policy)})


def keep_good(docs: DataFrame, policy: Policy | None = None) -> DataFrame:
    """Documents that `policy` and the base rules keep, with their columns."""
    policy = policy or POLICIES[CURRENT]
    whole = docs.select(F.struct(*docs.columns).alias("doc"), F.col("text").alias("body"))
    judged = verdicts(whole.select(F.col("doc").alias("doc_id"), F.col("body").alias("text")), policy)
    # A filter on the row number stays above the measurements; pushed below them, it would repeat them per word.
    return judged.withColumn("row", F.monotonically_increasing_id()).filter("kept and row >= 0").select("doc_id.*")
