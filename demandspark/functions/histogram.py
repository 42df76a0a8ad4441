"""Histogram bins and the population stability index as Columns.

A bin is closed on the left; the outer edges always cover the data, so only the inner edges decide the
bin of a value.  Counting the values at or above each inner edge gives all bins from one aggregation,
with empty bins included.
"""

from pyspark.sql import Column
from pyspark.sql import functions as F

EDGE_STEP = 1e-6
SMALLEST_SHARE = 1e-6


def repair_edges(edges: str) -> Column:
    """Make an array of edges strictly increasing from left to right, then widen both ends."""
    raised = (
        f"aggregate({edges}, cast(array() AS array<double>), (done, edge) -> array_append(done, "
        f"CASE WHEN size(done) > 0 AND edge <= try_element_at(done, -1) THEN try_element_at(done, -1) + {EDGE_STEP!r}D "
        "ELSE edge END))"
    )
    return F.expr(
        f"transform({raised}, (edge, i) -> CASE WHEN i = 0 THEN edge - {EDGE_STEP!r}D "
        f"WHEN i = size({edges}) - 1 THEN edge + {EDGE_STEP!r}D ELSE edge END)"
    )


def counts_at_least(value: str, bins: int, edges: str = "bin_edges") -> dict[str, Column]:
    """For every inner edge, the aggregate count of values at or above it."""
    return {f"__above_{i}": F.expr(f"count_if(`{value}` >= {edges}[{i}])") for i in range(1, bins)}


def bin_shares(total: str, bins: int) -> Column:
    """Array with the share of values in each bin, from the counts of `counts_at_least`."""
    above = [f"`{total}`", *[f"__above_{i}" for i in range(1, bins)], "0"]
    return F.expr(f"array({', '.join(f'({above[i]} - {above[i + 1]}) / `{total}`' for i in range(bins))})")


def bin_of(value: str, edges: str = "bin_edges") -> Column:
    """Zero-based bin of a value: the number of inner edges at or below it; NULL without edges."""
    inner = f"slice({edges}, 2, greatest(size({edges}) - 2, 0))"
    return F.expr(f"CASE WHEN {edges} IS NOT NULL THEN size(filter({inner}, e -> `{value}` >= e)) END")


def shares_of(counts: str, total: str, like: str) -> Column:
    """Share of each bin, for as many bins as the array `like` has, from (bin, count) structs; NULL without `like`."""
    one = f"aggregate({counts}, 0D, (sum, c) -> sum + CASE WHEN c.__bin = i THEN c.__n ELSE 0 END)"
    return F.expr(f"CASE WHEN {like} IS NOT NULL THEN transform({like}, (e, i) -> {one} / `{total}`) END")


def stability_index(expected: str, observed: str) -> Column:
    """Sum of (o - e) ln(o / e) over two arrays of shares.

    Expected shares are scaled to a sum of one; all shares are then clipped, and not scaled again.
    """
    def clip(share: str) -> str:
        return f"least(greatest({share}, {SMALLEST_SHARE!r}D), 1D)"

    total = f"aggregate({expected}, 0D, (a, b) -> a + b)"
    pairs = f"zip_with({expected}, {observed}, (e, o) -> struct({clip(f'e / {total}')} AS e, {clip('o')} AS o))"
    return F.expr(f"aggregate({pairs}, 0D, (sum, s) -> sum + (s.o - s.e) * ln(s.o / s.e))")


def spread_edges(bins: int, mean: str = "mean", std: str = "std") -> str:
    """SQL array of edges of an even grid over mean +/- 3 deviations, the shape assumed without stored bins."""
    width = f"(6D * greatest({std}, {EDGE_STEP!r}D))"
    return f"array({', '.join(f'{mean} - {width} / 2D + {width} * {i / bins!r}D' for i in range(bins + 1))})"


def spread_shares(bins: int) -> str:
    """SQL array with the share of grid points per bin: the grid has max(200, 40 * bins) even points."""
    points = max(200, 40 * bins)
    first = [0] + [-(-(points - 1) * i // bins) for i in range(1, bins)] + [points]
    return f"array({', '.join(f'{(first[i + 1] - first[i]) / points!r}D' for i in range(bins))})"


def checked_edges(edges: str = "bin_edges", shares: str = "expected_share") -> Column:
    """The stored edges; computing them stops the job when the stored reference cannot be used.

    This is a value rather than a filter, because a filter would be pushed into the expression that
    computes the edges and repeat it in every condition.
    """
    finite = "x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) < double('inf')"
    conditions = {
        "a stored profile needs two bins or more": f"size({edges}) >= 3",
        "a stored profile needs one share for each bin": f"size({shares}) = size({edges}) - 1",
        "a stored profile has a number that is not finite": f"forall({edges}, {finite}) AND forall({shares}, {finite})",
        "stored shares must not be negative, nor all zero": f"forall({shares}, x -> x >= 0) "
        f"AND aggregate({shares}, 0D, (a, b) -> a + b) > 0",
        "stored edges must rise from bin to bin": f"forall(sequence(1, size({edges}) - 1), i -> {edges}[i] > {edges}[i - 1])",
    }
    failures = [
        f"WHEN NOT coalesce({condition}, false) THEN cast(raise_error('{message}') AS array<double>)"
        for message, condition in conditions.items()
    ]
    return F.expr(f"CASE {' '.join(failures)} ELSE {edges} END")
