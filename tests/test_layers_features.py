"""Sources, layers, features and encoding on small tables with known values."""

import datetime as dt
import math
import re

import pytest
from pyspark.sql import functions as F

from demandspark.operators import encoding, features, layers
from demandspark.schemas import FEATURE_COLUMNS, RAW_COLUMNS, RAW_SCHEMA
from demandspark.sources import demand, writers

START = dt.date(2025, 1, 1)
RAW_TYPES = RAW_SCHEMA.simpleString().removeprefix("struct<").removesuffix(">").replace(":", " ")


def raw_row(day=0, store="s1", sku="a", units=10, price=5.0, promotion=0, category="grocery"):
    date = None if day is None else START + dt.timedelta(days=day)
    return (date, store, sku, category, price, promotion, 0, 60.0, units)


def raw_table(spark, rows):
    return spark.createDataFrame(rows, RAW_TYPES)


def silver_table(spark, rows):
    return layers.silver(raw_table(spark, rows))


def two_series(spark, days=35, bump=0, bump_day=None):
    rows = [
        raw_row(i, sku=sku, units=base + i + (bump if i == bump_day else 0), promotion=int(i % 2 == 0))
        for sku, base in (("a", 10), ("b", 100))
        for i in range(days)
    ]
    return silver_table(spark, rows)


def test_bronze_keeps_first_row_of_each_key(spark):
    rows = [raw_row(units=u) + (n,) for n, u in ((3, 30), (1, 10), (2, 20))] + [raw_row(day=1, units=7) + (9,)]
    rows += [raw_row(store=None, units=u) + (n,) for n, u in ((5, 50), (4, 40))]
    raw = spark.createDataFrame(rows, f"{RAW_TYPES}, line int")
    for parts in (1, 17):
        kept = {(r.date, r.store_id): r.units_sold for r in layers.bronze(raw.repartition(parts), ["line"]).collect()}
        assert kept == {(START, "s1"): 10, (START + dt.timedelta(1), "s1"): 7, (START, None): 40}
    checks = layers.bronze_checks(raw).first()
    assert (checks.rows, checks.duplicates_removed) == (3, 3)
    assert checks.columns == ",".join(RAW_COLUMNS)


def test_bronze_limits_rows_before_the_shuffle(spark):
    raw = spark.createDataFrame([raw_row() + (1,)], f"{RAW_TYPES}, line int")
    plan = layers.bronze(raw, ["line"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_bronze_of_one_heavily_repeated_key(spark):
    """A third of the rows share one key; the result equals a plain per-key minimum."""
    raw = spark.range(30_000).selectExpr(
        "date_add(date'2025-01-01', cast(CASE WHEN id % 3 = 0 THEN 0 ELSE id % 97 END AS int)) AS date",
        "CASE WHEN id % 3 = 0 THEN 's0' ELSE concat('s', id % 5) END AS store_id",
        "CASE WHEN id % 3 = 0 THEN 'a' ELSE concat('k', id % 11) END AS sku_id",
        "'g' AS category", "1D AS price", "0 AS promotion", "0 AS stockout", "60D AS temperature",
        "id AS units_sold", "(id * 7919) % 30000 AS line",
    )
    expected = {}
    for row in raw.collect():
        key = (row.date, row.store_id, row.sku_id)
        expected[key] = min(expected.get(key, (10**9, None)), (row.line, row.units_sold))
    found = {(r.date, r.store_id, r.sku_id): r.units_sold for r in layers.bronze(raw, ["line"]).collect()}
    assert found == {key: units for key, (_, units) in expected.items()}


def test_bronze_sorts_partitions_of_the_advisory_size(spark):
    """Rows, most of them of one key, are dealt out and cut before any sort, so a task's sort is bounded."""
    raw = spark.range(0, 60_000, 1, 8).selectExpr(
        "date_add(date'2025-01-01', cast(CASE WHEN id % 3 > 0 THEN 0 ELSE id % 97 END AS int)) AS date",
        "'s0' AS store_id", "'a' AS sku_id", "'g' AS category", "sqrt(id) AS price", "0 AS promotion", "0 AS stockout",
        "60D AS temperature", "id AS units_sold", "60000 - id AS line",
    )
    name, before = "spark.sql.adaptive.advisoryPartitionSizeInBytes", spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set(name, "64k")
    try:
        kept = layers.bronze(raw, ["line"])
        execution = kept._jdf.queryExecution()
        assert execution.toRdd().count() == 97
        plan = execution.executedPlan().toString()
    finally:
        spark.conf.set(name, before)
    final, first = plan.split("== Initial Plan ==")
    assert re.search(r"WindowGroupLimit[^\n]*Partial.*REBALANCE_PARTITIONS_BY_COL", first, re.S)
    assert re.search(r"WindowGroupLimit[^\n]*Partial.*AQEShuffleRead[^\n]*skewed", final, re.S)
    assert max(r.units_sold for r in kept.collect()) == 59_999


def test_lines_are_not_shuffled_to_meet_small_tables(spark, tmp_path):
    """1,000 suppliers and 25 nations are small, though the product of their sizes is not."""
    tables = {
        "nation": spark.range(25).selectExpr("cast(id AS int) AS n_nationkey", "cast(id % 5 AS int) AS n_regionkey"),
        "supplier": spark.range(1000).selectExpr("id AS s_suppkey", "cast(id % 25 AS int) AS s_nationkey"),
        "part": spark.range(100).selectExpr("id AS p_partkey", "concat('Brand#', 11 + id % 5) AS p_brand", "1D AS p_retailprice"),
        "lineitem": spark.range(5000).selectExpr(
            "id AS l_orderkey", "id % 100 AS l_partkey", "id % 1001 AS l_suppkey", "1 AS l_linenumber", "5D AS l_quantity",
            "1D AS l_extendedprice", "0D AS l_discount", "timestamp'2025-01-01' AS l_shipdate",
        ),
    }
    for name, rows in tables.items():
        rows.coalesce(1).write.parquet(str(tmp_path / f"{name}.parquet"))
    name, before = "spark.sql.autoBroadcastJoinThreshold", spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set(name, "16k")
    try:
        raw = demand.demand_rows(spark, str(tmp_path))
        plan = raw._jdf.queryExecution().executedPlan().toString()
        found = {r.store_id: r["count"] for r in raw.groupBy("store_id").count().collect()}
    finally:
        spark.conf.set(name, before)
    assert "Exchange hashpartitioning" not in plan and plan.count("BroadcastHashJoin") == 3
    assert found == {f"store_0{k}": sum(1 for i in range(5000) if i % 1001 < 1000 and i % 1001 % 25 % 5 == k) for k in range(5)}


def test_bronze_order_puts_missing_dates_last(spark):
    frame = layers.sort_bronze(raw_table(spark, [raw_row(None), raw_row(1), raw_row(0)]))
    assert [r.date for r in frame.collect()] == [START, START + dt.timedelta(1), None]


def test_missing_columns_are_listed_in_order(spark):
    frame = spark.range(1)
    with pytest.raises(ValueError, match=r"bronze table is missing columns: \['category', 'date'"):
        layers.silver(frame)
    with pytest.raises(ValueError, match="raw demand data is missing columns"):
        demand.conform(frame)


def test_silver_clips_and_keeps_missing_values(spark):
    rows = [raw_row(units=-3, price=-1.0), raw_row(1, units=None, price=None), raw_row(2, units=4, price=2.5)]
    found = {r.date.day: r for r in silver_table(spark, rows).collect()}
    assert (found[1].units_sold, found[1].price, found[1].revenue) == (0, 0.01, 0.0)
    assert (found[2].units_sold, found[2].price, found[2].revenue) == (None, None, None)
    assert found[3].revenue == 10.0
    checks = layers.silver_checks(silver_table(spark, rows)).first()
    assert (checks.rows, checks.negative_units, checks.min_date) == (3, 0, START)


def test_calendar_is_monday_based_with_iso_weeks(spark):
    days = ["2024-12-30", "2025-01-04", "2025-01-05", "2025-06-15"]
    frame = layers.add_calendar(spark.createDataFrame([(d,) for d in days], "text string").select(F.to_date("text").alias("date")))
    found = [(r.day_of_week, r.is_weekend, r.month, r.week_of_year) for r in frame.collect()]
    assert found == [(0, 0, 12, 1), (5, 1, 1, 1), (6, 1, 1, 1), (6, 1, 6, 24)]


def test_nan_becomes_missing_at_ingest(spark):
    frame = demand.conform(raw_table(spark, [raw_row(price=float("nan"))]))
    assert frame.first().price is None


def test_raw_csv_and_parquet_round_trip(spark, tmp_path):
    table = raw_table(spark, [raw_row(i) for i in range(3)]).withColumn("extra", F.lit(1))
    table.write.option("header", True).csv(str(tmp_path / "csv"))
    table.write.parquet(str(tmp_path / "parquet"))
    for fmt in ("csv", "parquet"):
        frame = demand.read_raw(spark, str(tmp_path / fmt), fmt, strict=True)
        assert tuple(frame.columns) == RAW_COLUMNS
        assert frame.schema == RAW_SCHEMA or [f.dataType for f in frame.schema] == [f.dataType for f in RAW_SCHEMA]
        assert frame.count() == 3
    with pytest.raises(ValueError, match="empty"):
        table.limit(0).write.parquet(str(tmp_path / "none"))
        demand.read_raw(spark, str(tmp_path / "none"), strict=True)
    with pytest.raises(ValueError, match="fmt"):
        demand.read_raw(spark, "x", "orc")


def test_unreadable_date_stops_the_job(spark):
    frame = raw_table(spark, [raw_row()]).withColumn("date", F.lit("nope"))
    with pytest.raises(Exception, match="nope"):
        demand.conform(frame).collect()


def test_layer_manifest_is_observed_while_writing(spark, tmp_path):
    silver = two_series(spark, 5)
    manifest = writers.write_layer(silver, str(tmp_path / "silver"), "silver", "bronze", layers.silver_check_columns())
    writers.append_manifest(manifest, str(tmp_path / "manifest"))
    row = spark.read.parquet(str(tmp_path / "manifest")).first()
    assert row.layer == "silver" and row.checks["rows"] == "10" and row.checks["negative_units"] == "0"
    assert row.checks["min_date"] == "2025-01-01" and row.checks["max_date"] == "2025-01-05"
    assert demand.read_silver(spark, str(tmp_path / "silver")).count() == 10


def test_bronze_manifest_counts_duplicates(spark, tmp_path):
    raw = spark.createDataFrame([raw_row(units=u) + (u,) for u in (3, 1, 2)] + [raw_row(1) + (9,)], f"{RAW_TYPES}, line int")
    manifest = writers.write_bronze(raw, str(tmp_path / "bronze"), "raw", ["line"])
    writers.append_manifest(manifest, str(tmp_path / "manifest"))
    row = spark.read.parquet(str(tmp_path / "manifest")).first()
    assert row.checks == {"rows": "2", "columns": ",".join(RAW_COLUMNS), "duplicates_removed": "2"}
    assert {r.units_sold for r in spark.read.parquet(str(tmp_path / "bronze")).collect()} == {1, 10}


def test_feature_table_round_trip_in_series_order(spark, tmp_path):
    table = features.build_features(two_series(spark, 20))
    writers.write_table(table, str(tmp_path / "gold"))
    stored = layers.sort_series(demand.read_features(spark, str(tmp_path / "gold"))).collect()
    assert len(stored) == 12 and stored == sorted(stored, key=lambda r: (r.store_id, r.sku_id, r.date))


def test_sinks_reject_bad_formats_and_numbers(spark, tmp_path):
    with pytest.raises(ValueError, match="delta or parquet"):
        writers.write_table(spark.range(1), str(tmp_path / "t"), "orc")
    writers.write_report(spark.sql("SELECT 1D AS a, cast(NULL AS double) AS b"), str(tmp_path / "ok"))
    assert spark.read.text(str(tmp_path / "ok")).first().value == '{"a":1.0,"b":null}'
    with pytest.raises(Exception, match="not finite"):
        writers.write_report(spark.sql("SELECT double('NaN') AS a"), str(tmp_path / "bad"))


def test_feature_values_stay_inside_each_series(spark):
    row = (
        features.build_features(two_series(spark))
        .filter((F.col("sku_id") == "b") & (F.col("date") == START + dt.timedelta(28)))
        .first()
    )
    assert row.lag_14_units == 114
    assert row.lag_1_units == 127 and row.lag_7_units == 121
    assert row.rolling_7_mean_units == pytest.approx(sum(range(121, 128)) / 7)
    assert row.rolling_14_mean_units == pytest.approx(sum(range(114, 128)) / 14)
    assert row.rolling_28_mean_units == pytest.approx(sum(range(100, 128)) / 28)
    assert row.rolling_mean_delta_7_28 == pytest.approx(10.5)
    assert row.rolling_7_std_units == pytest.approx(math.sqrt(28 / 6))
    assert row.promotion_price == 5.0
    assert row.price_vs_sku_avg == pytest.approx(0.0)
    assert row.sku_avg_units == pytest.approx(sum(range(100, 128)) / 28)
    assert row.store_avg_units == pytest.approx(sum(range(55, 83)) / 28)
    assert row.entity_id == "s1::b"
    assert row.day_sin == pytest.approx(math.sin(2 * math.pi * row.day_of_week / 7))


def test_first_fourteen_rows_of_a_series_leave(spark):
    assert features.build_features(two_series(spark)).count() == 2 * (35 - 14)


@pytest.mark.parametrize("day", [34, 30, 20])
def test_a_target_never_reaches_its_own_features(spark, day):
    columns = ["sku_id", "date", "lag_1_units", "rolling_7_mean_units", "rolling_28_mean_units", "sku_avg_units", "store_avg_units"]

    def upto(frame):
        return sorted(
            map(tuple, features.build_features(frame).filter(F.col("date") <= START + dt.timedelta(day)).select(*columns).collect())
        )

    assert upto(two_series(spark)) == upto(two_series(spark, bump=10_000, bump_day=day))


def test_windows_skip_missing_units_and_honour_minimums(spark):
    units = [5, None, None, 7, 9, None, 4, 8, 6, 2]
    frame = silver_table(spark, [raw_row(i, units=u) for i, u in enumerate(units)])
    found = [r.rolling_7_mean_units for r in features.add_series_features(frame).orderBy("date").collect()]
    for i, value in enumerate(found):
        known = [u for u in units[max(0, i - 7) : i] if u is not None]
        assert value == (pytest.approx(sum(known) / len(known)) if len(known) >= 3 else None)


def test_rows_without_date_or_key_do_not_shift_a_series(spark):
    rows = [raw_row(i, units=i) for i in range(20)]
    clean = features.build_features(silver_table(spark, rows)).select("date", *FEATURE_COLUMNS)
    extra = [raw_row(None, units=99), raw_row(3, store=None, units=99, sku="z"), raw_row(4, sku=None, store="s9")]
    noisy = features.build_features(silver_table(spark, rows + extra)).select("date", *FEATURE_COLUMNS)
    assert sorted(map(tuple, clean.collect())) == sorted(map(tuple, noisy.collect()))


def test_sku_price_mean_counts_rows_without_a_store(spark):
    rows = [raw_row(0, price=4.0), raw_row(0, store=None, price=10.0)]
    found = features.add_price_position(silver_table(spark, rows)).filter("store_id = 's1'").first()
    assert found.price_vs_sku_avg == pytest.approx(-3.0)


def test_repeated_days_in_a_series_are_rejected(spark):
    frame = silver_table(spark, [raw_row(0), raw_row(0, units=3)])
    with pytest.raises(Exception, match="two rows for one date"):
        features.add_series_features(frame).collect()


def test_many_to_one_join_can_verify_its_right_side(spark):
    left = spark.createDataFrame([(1,)], "k int")
    right = spark.createDataFrame([(1, 1), (1, 2)], "k int, v int")
    with pytest.raises(Exception, match="not unique"):
        features.join_many_to_one(left, right, ["k"], strict=True).collect()


def test_empty_feature_table_is_reported(spark):
    table = features.build_features(two_series(spark, 5))
    with pytest.raises(Exception, match="empty after lag"):
        demand.check_not_empty(table, "feature table is empty after lag creation").collect()


def test_series_windows_share_one_exchange_and_no_python(spark):
    plan = features.add_series_features(two_series(spark))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(store_id") == 1
    assert plan.count("Window [") == 1
    assert "Python" not in features.build_features(two_series(spark))._jdf.queryExecution().executedPlan().toString()


def test_reduced_features_start_the_week_on_sunday(spark):
    found = features.build_reduced_features(two_series(spark, 10)).filter("sku_id = 'a'").orderBy("date").collect()
    assert [r.date for r in found] == [START + dt.timedelta(i) for i in (7, 8, 9)]
    assert [r.day_of_week for r in found] == [3, 4, 5]
    assert found[0].rolling_14_mean_units == pytest.approx(13.0)


def test_one_hot_columns_and_alignment(spark):
    frame = features.build_features(two_series(spark))
    known = encoding.category_features(frame)
    assert sorted(r.feature for r in known.collect()) == ["category_grocery", "sku_id_a", "sku_id_b", "store_id_s1"]
    values = {"store_id": ["s1"], "sku_id": ["a", "b"], "category": ["grocery"]}
    unseen = frame.withColumn("sku_id", F.lit("new")).withColumn("category", F.lit(None).cast("string"))
    wide = encoding.one_hot_wide(unseen, values).first().asDict()
    assert wide == {"store_id_s1": 1.0, "sku_id_a": 0.0, "sku_id_b": 0.0, "category_grocery": 0.0}
    aligned = encoding.align_columns(frame, ["price", "sku_id_gone"])
    assert aligned.columns == ["price", "sku_id_gone"] and aligned.first().sku_id_gone == 0.0
    sparse = encoding.one_hot_long(unseen.limit(1), known, keep=["date"]).collect()
    assert [(r.feature, r.value) for r in sparse] == [("store_id_s1", 1.0)]
    assert encoding.one_hot_long(frame, known).count() == 3 * frame.count()


def test_model_matrix_names_match_the_vector(spark):
    frame = features.build_features(two_series(spark))
    matrix, names, fitted = encoding.model_matrix(frame)
    assert names == list(FEATURE_COLUMNS) + ["store_id_s1", "sku_id_a", "sku_id_b", "category_grocery"]
    row = matrix.filter("sku_id = 'b'").first()
    assert len(row.features) == len(names) and list(row.features)[-4:] == [1.0, 0.0, 1.0, 1.0]
    unseen = fitted.transform(frame.withColumn("sku_id", F.lit("new")).withColumn("category", F.lit(None).cast("string")))
    assert list(unseen.first().features)[-4:] == [1.0, 0.0, 0.0, 0.0]
