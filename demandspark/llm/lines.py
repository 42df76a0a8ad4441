"""Line deduplication by site-relative frequency.

The ratio of a line is the share of its host's pages that contain it.  Lines above `max_ratio` on at least `min_pages` pages
are boilerplate of that host and go from all its pages.  Lines are compared without blanks at their ends, by a 64-bit hash
within one host; blank lines stay.  A page is a row (`op4_line_dedup`, as its SQL has it), or with `distinct_pages` a
different text of the host: copies then add nothing to a line's share, so a text with many copies keeps its lines.

Counts are pre-aggregated per (host, line), so a host or line of any size is spread out.  The boilerplate lines of
a host number at most its mean lines per page divided by `max_ratio`, which bounds the one array that each host gets.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from demandspark.llm.common import materialise

MAX_RATIO = 0.05
MIN_PAGES = 3
BROADCAST_LINES = 500_000  # 8 bytes each; more boilerplate lines than this are joined by host instead
_ENDS = " \t\x0b\x0c\r"


def _lines(text: Column) -> Column:
    return F.split(text, "\n")


def _keys(lines: Column) -> Column:
    """Hash of each line without its outer blanks; NULL for a blank line."""
    def key(line: Column) -> Column:
        bare = F.btrim(line, F.lit(_ENDS))
        return F.when(F.length(bare) > 0, F.xxhash64(bare))

    return F.transform(lines, key)


def _host(column: Column) -> Column:
    """Hosts as plain strings, so that rows without one form a host of their own."""
    return F.coalesce(F.concat(F.lit("h"), column.cast("string")), F.lit(""))


def boilerplate(
    docs: DataFrame, host: str = "source", text: str = "text", max_ratio: float = MAX_RATIO, min_pages: int = MIN_PAGES,
    distinct_pages: bool = False,
) -> DataFrame:
    """host key and the hashes of its boilerplate lines, for hosts that have any.

    With `distinct_pages` a (host, hash of the text) counts once; its line hashes travel, not the text.
    """
    pages = docs.select(_host(F.col(host)).alias("host"), F.col(text).alias("body"))
    keys = F.array_distinct(_keys(_lines(F.col("body")))).alias("keys")
    if distinct_pages:
        page = pages.select("host", F.xxhash64("body").alias("page"), keys)
        totals = page.groupBy("host", "page").agg(F.lit(1)).groupBy("host").agg(F.count("*").alias("pages"))
        pages = page.dropDuplicates(["host", "page"]).select("host", "keys")
    else:
        totals = pages.groupBy("host").agg(F.count("*").alias("pages"))
        pages = pages.select("host", keys)
    keys = pages.select("host", F.explode("keys").alias("line"))
    counts = keys.filter(F.col("line").isNotNull()).groupBy("host", "line").agg(F.count("*").alias("n"))
    common = counts.filter(F.col("n") >= min_pages).join(totals, "host").filter(F.col("n") / F.col("pages") > max_ratio)
    return common.groupBy("host").agg(F.collect_list("line").alias("common"))


def drop_boilerplate(
    docs: DataFrame, host: str = "source", text: str = "text", max_ratio: float = MAX_RATIO, min_pages: int = MIN_PAGES,
    distinct_pages: bool = False,
) -> DataFrame:
    """The rows with their columns, boilerplate lines cut from `text`, plus n_lines and n_dropped.

    A NULL text has no lines and stays NULL; an empty one has one blank line.  Rows without a host count as one host.
    Repeated rows each get a row, and count as a page each unless `distinct_pages` is set.  Other columns, whatever their names, are passed on.  An empty
    table gives an empty result.
    """
    common = materialise(boilerplate(docs, host, text, max_ratio, min_pages, distinct_pages), "boilerplate")
    size = common.agg(F.coalesce(F.sum(F.size("common")), F.lit(0))).first()[0]
    if size <= BROADCAST_LINES:
        common = F.broadcast(common)
    whole = docs.select(F.struct(*docs.columns).alias("doc"), _host(F.col(host)).alias("host"), F.col(text).alias("body"))
    found = whole.join(common, "host", "left").select("doc", "body", "common", _lines(F.col("body")).alias("lines"))
    found = found.withColumn("present", F.array_intersect(_keys(F.col("lines")), "common"))
    bare = lambda line: F.btrim(line, F.lit(_ENDS))
    drops = lambda line: (F.length(bare(line)) > 0) & F.array_contains("present", F.xxhash64(bare(line)))
    none = F.coalesce(F.size("present"), F.lit(0)) <= 0
    kept = found.withColumn("kept", F.when(none, F.col("lines")).otherwise(F.filter("lines", lambda line: ~drops(line))))
    count = lambda c: F.greatest(F.coalesce(F.size(c), F.lit(0)), F.lit(0)).cast("bigint")
    new_text = F.when(none, F.col("body")).otherwise(F.array_join("kept", "\n"))
    out = kept.select("doc", new_text.alias("body"), count("lines").alias("n_lines"), (count("lines") - count("kept")).alias("n_dropped"))
    columns = [F.col("body").alias(text) if c == text else F.col(f"doc.`{c}`").alias(c) for c in docs.columns]
    extra = [F.col(c).alias(c if c not in docs.columns else f"line_{c}") for c in ("n_lines", "n_dropped")]
    return out.select(*columns, *extra)


def line_report(docs: DataFrame, host: str = "source", max_ratio: float = MAX_RATIO, min_pages: int = MIN_PAGES) -> DataFrame:
    """doc_id, n_lines, n_dropped and the digest of the remaining text of every row (NULL counts as empty there)."""
    plain = docs.select("doc_id", host, "text")
    cut = drop_boilerplate(plain, host, "text", max_ratio, min_pages)
    return cut.select("doc_id", "n_lines", "n_dropped", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


def clean_documents(docs: DataFrame, host: str = "source", max_ratio: float = MAX_RATIO, min_pages: int = MIN_PAGES) -> DataFrame:
    """The rows with their own columns only and `text` without boilerplate lines; n_chars, where present, follows it.

    Shares are those of different texts: copies are left to a later stage, which needs one of them whole.
    """
    cut = drop_boilerplate(docs, host, "text", max_ratio, min_pages, distinct_pages=True).select(*docs.columns)
    if "n_chars" in docs.columns:
        length = F.length("text").cast(docs.schema["n_chars"].dataType)
        cut = cut.withColumn("n_chars", length)
    return cut
