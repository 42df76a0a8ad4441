"""Features taken in day by day against the batch operators."""

import datetime as dt
import random
import re

import pytest
from pyspark.sql import functions as F

from demandspark.operators import features, incremental
from demandspark.plans.catalog import INCREMENTAL_COLUMNS

START = dt.date(2025, 1, 1)
COLUMNS = "date date, store_id string, sku_id string, price double, units_sold bigint"


def silver(spark, days=40):
    """Series that start late, skip days, or miss units."""
    rng = random.Random(3)
    rows = []
    for store, sku, first, share in (("a", "x", 0, 1.0), ("a", "y", 20, 1.0), ("b", "x", 0, 0.6), ("c", "z", 35, 1.0)):
        for i in range(first, days):
            if rng.random() < share:
                units = None if rng.random() < 0.1 else rng.randint(0, 50)
                price = None if rng.random() < 0.1 else rng.randint(100, 999) / 100
                rows.append((START + dt.timedelta(i), store, sku, price, units))
    return spark.createDataFrame(rows, COLUMNS)


def batch_features(rows):
    placed = features.add_store_history(features.add_price_position(rows, prior_only=True), rows)
    return features.add_series_features(placed)


def plain(df):
    """Rows by key, numbers rounded."""
    found = df.select("date", "store_id", "sku_id", *INCREMENTAL_COLUMNS).collect()
    return {tuple(r)[:3]: [None if v is None else round(float(v), 9) for v in tuple(r)[3:]] for r in found}


def test_batches_of_days_equal_the_batch_table(spark, tmp_path):
    rows = silver(spark).cache()
    state, got = incremental.empty_state(spark), {}
    for number, (first, end) in enumerate([(0, 1), (1, 2), (2, 9), (9, 10), (10, 36), (36, 37), (37, 40)]):
        low, high = START + dt.timedelta(first), START + dt.timedelta(end)
        found, following = incremental.advance(rows.filter((F.col("date") >= low) & (F.col("date") < high)), state)
        got |= plain(found)
        state = following.write(str(tmp_path / str(number)))
    assert got == plain(batch_features(rows)) and len(got) == rows.count()
    assert state.series.count() == 4 and state.series.agg(F.max(F.size("tail"))).first()[0] == 28


def test_a_new_day_reads_tails_and_not_history(spark, tmp_path):
    rows = silver(spark)
    rows.filter(F.col("date") < START + dt.timedelta(39)).write.parquet(str(tmp_path / "history"))
    history = spark.read.parquet(str(tmp_path / "history"))
    _, following = incremental.advance(history, incremental.empty_state(spark))
    state = following.write(str(tmp_path / "state"))
    rows.filter(F.col("date") == START + dt.timedelta(39)).write.parquet(str(tmp_path / "day"))
    found, _ = incremental.advance(spark.read.parquet(str(tmp_path / "day")), state)
    found.collect()
    plan = found._jdf.queryExecution().executedPlan().toString()
    read = {name[:3] for name in re.findall(r"reads_tails_and0/(\w+)", plan)}  # the plan's text may cut a long path
    assert read == {"sta", "day"}
    assert plain(found) == {k: v for k, v in plain(batch_features(rows)).items() if k[0] == START + dt.timedelta(39)}


def test_days_are_taken_in_once_and_in_order(spark, tmp_path):
    rows = silver(spark, 10)
    _, following = incremental.advance(rows, incremental.empty_state(spark))
    state = following.write(str(tmp_path / "state"))
    with pytest.raises(Exception, match="taken in before"):
        incremental.advance(rows.filter(F.col("date") == START + dt.timedelta(5)), state)[0].collect()
    day = spark.createDataFrame([(START + dt.timedelta(20), "a", "x", 1.0, 1)] * 2, COLUMNS)
    with pytest.raises(Exception, match="two rows"):
        incremental.advance(day, state)[0].collect()


def test_empty_batches_change_nothing(spark, tmp_path):
    rows = silver(spark, 5)
    _, following = incremental.advance(rows, incremental.empty_state(spark))
    state = following.write(str(tmp_path / "one"))
    found, after = incremental.advance(rows.limit(0), state)
    assert found.count() == 0
    for name in ("series", "stores", "prices"):
        old, new = getattr(state, name), getattr(after, name)
        assert sorted(map(str, old.collect())) == sorted(map(str, new.select(*old.columns).collect()))
