"""Exact order statistics and quantiles of very large groups.

A built-in exact percentile keeps all distinct values of a group in one task.  `order_statistics` finds the
value at any rank by radix selection instead.  A double has an order-preserving 64-bit image, and the image
is read from its highest digit down, 16 bits in a pass:

    pass 1   (group, highest digit) counts, combined before the shuffle; running counts tell the digit of each rank
    pass 2   the same for the next digit, of the values whose leading digits hold a rank
    pass 3, 4   likewise; after the last digit the value itself is known

No pass shuffles values.  What it shuffles are at most 65,536 counts for each group, task and prefix that holds a rank,
and a running count covers at most 65,536 rows, however the values lie.  The input is read once per pass, two columns wide.
"""

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from demandspark.functions.guards import group_window, is_finite, join_on

DIGIT_BITS = 16
SHIFTS = (48, 32, 16, 0)  # bits below each pass's digit

# The prefixes that hold a rank are sent to every task while there are no more groups than this; they join the values
# like any other table beyond it.
MOST_SENT_GROUPS = 10_000


def order_image(value: Column) -> Column:
    """The bits of a finite double as a number of the same order, negative for negative values.

    Exponent and fraction come from exact steps: the logarithm is only a guess that is set right by comparing, and
    scaling by a power of two loses nothing.
    """
    size = F.abs(value)
    guess = F.floor(F.log2(size)).cast("int")
    exponent = guess + F.when(size >= F.pow(F.lit(2.0), guess + 1), 1).otherwise(0) - F.when(size < F.pow(F.lit(2.0), guess), 1).otherwise(0)
    exponent = F.greatest(exponent, F.lit(-1022))  # below it, doubles lose leading digits instead
    fraction = (size / F.pow(F.lit(2.0), exponent) * F.lit(float(1 << 52))).cast("bigint")
    image = F.shiftleft((exponent + 1022).cast("bigint"), 52) + fraction
    return F.when(value == 0, F.lit(0).cast("bigint")).when(value < 0, -image).otherwise(image)


def _few_groups(df: DataFrame, by: Sequence[str]) -> bool:
    """Whether the groups are few enough to send a row for each of them to every task; a job over the `by` columns."""
    return not by or df.select(*by).distinct().limit(MOST_SENT_GROUPS + 1).count() <= MOST_SENT_GROUPS


def _running(by: Sequence[str], order: str) -> Column:
    """Counts up to and including each row; the order column is unique within a group."""
    return F.sum("__n").over(group_window(by, F.col(order)).rowsBetween(Window.unboundedPreceding, 0))


def order_statistics(
    df: DataFrame, value: Column | str, ranks: Mapping[str, str], by: Sequence[str] = ()
) -> DataFrame:
    """One row per group: `value_count` and, for each name, the value at a zero-based rank.

    `ranks` maps an output name to the rank as a SQL expression of `value_count`.  Values that
    are not finite are left out.
    """
    by = list(by)
    value = F.col(value) if isinstance(value, str) else value
    finite = df.select(*by, value.cast("double").alias("__v")).filter(is_finite(F.col("__v")))
    values = finite.select(*by, "__v", order_image(F.col("__v")).alias("__image"))
    send = F.broadcast if _few_groups(df, by) else lambda table: table
    wanted = ", ".join(f"named_struct('name', '{name}', 'rank', cast({rank} AS bigint))" for name, rank in ranks.items())
    # The ranks that fall on a row, given the counts up to and including it: however many they are, the row is one.
    held = f"filter(array({wanted}), r -> r.rank >= __upto - __n AND r.rank < __upto)"
    found = None
    for shift in SHIFTS:
        prefix = F.shiftright("__image", shift).alias("__prefix")
        counts = {"__n": F.count(F.lit(1)), "__value": F.min("__v")}
        if found is None:
            counted = values.groupBy(*by, prefix).agg(*[c.alias(n) for n, c in counts.items()])
            whole = group_window(by).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
            counted = counted.withColumn("value_count", F.sum("__n").over(whole)).withColumn("__before", F.lit(0).cast("bigint"))
            inside = by
        else:
            parent = found.select(*by, F.col("__prefix").alias("__parent"), "value_count", "__before")
            inside = [*by, "__parent"]
            digits = join_on(values.withColumn("__parent", F.shiftright("__image", shift + DIGIT_BITS)), send(parent), inside)
            counts |= {c: F.max(c) for c in ("value_count", "__before")}  # one value for all rows of a parent
            counted = digits.groupBy(*inside, prefix).agg(*[c.alias(n) for n, c in counts.items()])
        ranked = counted.withColumn("__upto", F.col("__before") + _running(inside, "__prefix"))
        found = ranked.filter(f"size({held}) > 0").withColumn("__before", F.col("__upto") - F.col("__n"))
    picked = found.selectExpr(*by, "__value", "value_count", f"inline({held})")
    return picked.groupBy(*by).agg(
        F.max("value_count").alias("value_count"),
        *[F.expr(f"max(CASE WHEN name = '{name}' THEN __value END) AS `{name}`") for name in ranks],
    )


def quantiles(
    df: DataFrame,
    value: Column | str,
    probabilities: Mapping[str, float],
    by: Sequence[str] = (),
    method: str = "select",
    accuracy: int = 10000,
) -> DataFrame:
    """One row per group: `value_count` and the linearly interpolated quantiles.

    method "select"   exact, for groups of any size (see `order_statistics`)
           "inline"   exact, the built-in `percentile`: for groups known to be small
           "approx"   the built-in bounded-memory sketch
    """
    by = list(by)
    value = F.col(value) if isinstance(value, str) else value
    if method in ("inline", "approx"):
        finite = df.select(*by, value.cast("double").alias("__v")).filter(is_finite(F.col("__v")))
        function = F.percentile if method == "inline" else lambda c, p: F.percentile_approx(c, p, accuracy)
        return finite.groupBy(*by).agg(
            F.count(F.lit(1)).alias("value_count"),
            *[function(F.col("__v"), F.lit(p)).alias(name) for name, p in probabilities.items()],
        )
    if method != "select":
        raise ValueError("method must be select, inline or approx")
    ranks, columns = {}, []
    for name, p in probabilities.items():
        position = f"((value_count - 1) * {p!r}D)"
        ranks[f"{name}__low"], ranks[f"{name}__high"] = f"floor({position})", f"ceil({position})"
        # Interpolate from the nearer end, which keeps equal neighbours exact at both ends.
        low, high, share = f"`{name}__low`", f"`{name}__high`", f"({position} - floor({position}))"
        columns.append(
            f"CASE WHEN {share} >= 0.5D THEN {high} - ({high} - {low}) * (1D - {share}) "
            f"ELSE {low} + ({high} - {low}) * {share} END AS `{name}`"
        )
    return order_statistics(df, value, ranks, by).selectExpr(*by, "value_count", *columns)
