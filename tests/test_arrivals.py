"""Bronze that takes in batches: results, repeated batches, missing keys, and a plan that leaves the stored side in place."""

import re
from uuid import uuid4

import pytest
from pyspark.sql import functions as F

from demandspark.operators import layers
from demandspark.schemas import RAW_COLUMNS
from demandspark.sources import arrivals


@pytest.fixture
def table(spark, tmp_path):
    name = f"bronze_{uuid4().hex}"
    arrivals.open_bronze(spark, name, str(tmp_path / "bronze"), 4)
    yield name
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def rows(spark, low, high, days=70):
    """Every seventh row repeats the key of the row 50 places before it; some keys lack a part."""
    key = "IF(id % 7 = 0 AND id >= 50, id - 50, id)"
    return spark.range(low, high).selectExpr(
        f"IF({key} % 31 = 0, NULL, date_add(date'2025-01-10', cast({key} % {days} AS int))) AS date",
        f"IF({key} % 37 = 0, NULL, concat('s', {key} % 3)) AS store_id",
        f"concat('k', {key} % 11) AS sku_id",
        "'c' AS category",
        "cast(id AS double) AS price",
        "0 AS promotion",
        "0 AS stockout",
        "20.0D AS temperature",
        "id AS units_sold",
        "id AS position",
    )


def content(df):
    return sorted((tuple(r) for r in df.select(*RAW_COLUMNS).collect()), key=repr)


def plan_of(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def test_batches_equal_one_shot(spark, table):
    for low, high in ((0, 400), (300, 700), (300, 700), (0, 1000)):
        arrivals.take_in(rows(spark, low, high), table, ["position"])
    assert content(arrivals.read_bronze(spark, table)) == content(layers.bronze(rows(spark, 0, 1000), ["position"]))


def test_stored_rows_stay_and_empty_batches_add_nothing(spark, table):
    arrivals.take_in(rows(spark, 0, 200), table, ["position"])
    before = content(arrivals.read_bronze(spark, table))
    arrivals.take_in(rows(spark, 0, 0), table, ["position"])
    arrivals.take_in(rows(spark, 0, 200).withColumn("price", F.lit(-1.0)).withColumn("position", -F.col("position")), table, ["position"])
    assert content(arrivals.read_bronze(spark, table)) == before


def test_a_write_that_stored_a_part_is_completed_by_the_next(spark, table):
    batch = rows(spark, 0, 300)
    arrivals.new_rows(batch, table, ["position"]).filter("key_hash % 2 = 0").write.insertInto(table)
    arrivals.take_in(batch, table, ["position"])
    assert content(arrivals.read_bronze(spark, table)) == content(layers.bronze(batch, ["position"]))


def test_a_folder_is_opened_again(spark, tmp_path):
    names = [f"bronze_{uuid4().hex}" for _ in range(2)]
    for name, (low, high) in zip(names, ((0, 300), (200, 500))):
        arrivals.open_bronze(spark, name, str(tmp_path / "shared"), 4)
        arrivals.take_in(rows(spark, low, high), name, ["position"])
    assert content(arrivals.read_bronze(spark, names[1])) == content(layers.bronze(rows(spark, 0, 500), ["position"]))
    for name in names:
        spark.sql(f"DROP TABLE {name}")


@pytest.mark.parametrize("partitions", ["3", "8", "64"])
def test_the_stored_side_is_not_shuffled(spark, table, partitions):
    arrivals.take_in(rows(spark, 0, 500), table, ["position"])
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        plan = plan_of(arrivals.new_rows(rows(spark, 400, 900), table, ["position"]))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert "SortMergeJoin" in plan and "Bucketed: true" in plan
    shuffles = re.findall(r"Exchange hashpartitioning\(([^)]*), (\d+)\)", plan)
    assert not any("__hash" in keys for keys, _ in shuffles)
    assert [n for keys, n in shuffles if "key_hash" in keys] == ["4"]


def test_only_months_of_the_batch_are_read(spark, table):
    arrivals.take_in(rows(spark, 0, 500), table, ["position"])
    one_day = rows(spark, 0, 500).filter("date = '2025-02-03'")
    found = arrivals.new_rows(one_day, table, ["position"])
    execution = found._jdf.queryExecution()
    assert execution.toRdd().count() == 0
    plan = execution.executedPlan().toString().split("== Initial Plan ==")[0]
    filters = re.search(r"PartitionFilters: \[([^\n]*?)\], PushedFilters", plan)
    assert filters and "date_bucket" in filters.group(1) and "array_contains" in filters.group(1)
