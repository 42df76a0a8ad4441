import math
import random

import numpy as np
import pytest

from demandspark.llm import negatives

COLUMNS = "vec_id bigint, embedding array<float>, label int"


def brute(rows, every=50, mining=negatives.Mining()):
    """Contract rows of (vec_id, embedding, label) by plain products."""
    fit = []
    for row, (i, v, label) in enumerate(rows):
        if label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        label = (label + 1) % 10 if i is not None and i % 7 == 0 else label
        fit.append((row, i, label, [math.floor(256 * float(np.float32(x))) for x in v]))
    out = []
    for a in fit:
        if a[1] is None or a[1] % every:
            continue
        scored = [(sum(x * y for x, y in zip(a[3], c[3])), c) for c in fit]
        scored.sort(key=lambda s: (-s[0], s[1][1] is None, s[1][1] or 0, s[1][0]))
        for score, p in [s for s in scored if s[1][2] == a[2] and s[1][0] != a[0]][: mining.positives]:
            band = [s for s in scored if s[1][2] != a[2] and mining.low * score <= 100 * s[0] <= mining.high * score]
            for rank, (other, n) in enumerate(band[: mining.negatives]):
                out.append((a[1], p[1], rank + 1, n[1], score, other))
    return sorted(out, key=repr)


def mined(spark, rows, stripe=negatives.STRIPE):
    df = spark.createDataFrame(rows, COLUMNS).coalesce(1).selectExpr("*", "'clash' as row", "1 as v", "2 as cell")
    moved = df.selectExpr("vec_id", "embedding", "case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label")
    a = sorted((tuple(r) for r in negatives.hard_negatives(df).collect()), key=repr)
    b = sorted((tuple(r) for r in negatives.mine(negatives.whole_vectors(moved), stripe=stripe).collect()), key=repr)
    assert a == b
    return a


def vectors(seed, count, dimensions=20, labels=3, size=0.5):
    rng = random.Random(seed)
    return [(i, [rng.uniform(-size, size) + 0.1 for _ in range(dimensions)], rng.randrange(labels)) for i in range(count)]


def test_grid_of_small_stripes_matches_brute_force(spark):
    rows = vectors(1, 700)
    want = brute(rows)
    assert len(want) > 100 and mined(spark, rows, stripe=150) == want


def test_ties_repeats_and_rows_that_take_no_part(spark):
    rows = vectors(2, 120, 5)
    rows += [(i, [0.3] * 5, i % 4) for i in range(200, 330)]  # one very common vector
    rows += [rows[50], rows[50], rows[51], (None, [0.4] * 5, 1), (None, [0.4] * 5, 2)]
    rows += [(1000, None, 1), (1050, [0.1, None, 0.2], 1), (1100, [float("nan")] * 5, 1), (1150, [float("inf")] * 5, 1), (1200, [0.1] * 5, None)]
    rows += [(1250, [], 1), (1300, [0.5, 0.5], 1), (-50, [0.2] * 9, 2)]
    assert mined(spark, rows, stripe=64) == brute(rows)


def test_empty_tables(spark):
    assert mined(spark, []) == []
    assert mined(spark, [(1, [0.1], 1)]) == []
    assert mined(spark, [(50, [0.1], 1)]) == []


@pytest.mark.parametrize("size", [1, 100, 2**20, 2**27])
def test_scores_equal_products(size):
    rng = np.random.default_rng(size)
    a, c = rng.integers(-size, size, (7, 19)), rng.integers(-size, size, (300, 19))
    c[0] = -size
    found = negatives.scores(negatives.subset_tables(a, negatives.score_kind(a, c)), negatives.bit_planes(c))
    assert (found == c @ a.T).all()


def test_too_large_scores_are_refused():
    huge = np.full((1, 4), 2**40)
    with pytest.raises(ValueError):
        negatives.score_kind(huge, huge)
