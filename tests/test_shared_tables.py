"""What the queries store and read back, on star-schema rows of their own."""

import datetime as dt
import time

import pytest
from pyspark.sql import functions as F

from demandspark.functions.storage import shuffles_removed
from demandspark.operators import features, layers, models
from demandspark.plans import catalog, tables

START = dt.date(2025, 1, 1)
DAYS = 75


@pytest.fixture(scope="module")
def star(spark, tmp_path_factory):
    """Two stores and two SKUs over 75 days, every line twice with other prices, and lines without a date."""
    folder = str(tmp_path_factory.mktemp("star"))

    def put(name, *columns, rows):
        spark.range(rows).selectExpr(*columns).write.parquet(f"{folder}/{name}.parquet")

    put(
        "lineitem",
        "id AS l_orderkey",
        "id % 4 DIV 2 + 10 * (id DIV 300) AS l_partkey",
        "id % 2 AS l_suppkey",
        "cast(1 AS int) AS l_linenumber",
        "cast(id * 7919 % 50 AS double) AS l_quantity",
        "cast(id AS double) AS l_extendedprice",
        "cast(id % 11 AS double) / 100 AS l_discount",
        f"CASE WHEN id < 600 THEN timestamp'{START}' + make_dt_interval(cast(id DIV 4 % {DAYS} AS int)) END AS l_shipdate",
        rows=610,
    )
    put("supplier", "id AS s_suppkey", "id AS s_nationkey", rows=2)
    put("nation", "id AS n_nationkey", "id AS n_regionkey", rows=2)
    put("part", "id AS p_partkey", "concat('Brand#1', id % 10 + 1) AS p_brand", "100D + id AS p_retailprice", rows=30)
    yield folder
    tables.release(spark)


def sorted_rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_the_tree_candidate_shuffles_the_raw_rows_once(spark, star, monkeypatch):
    """The rows that the encoders, the last date and the matrix read are stored; they are those of the plan from bronze."""
    given = []
    report = lambda labelled, rounds, **more: given.append(labelled) or full(labelled, 3, **more)
    full = models.candidate_report
    monkeypatch.setattr(models, "candidate_report", report)
    assert catalog.tree_candidate(spark, star).count() == 4
    labelled = given[0]
    assert labelled.inputFiles() and not any("lineitem" in f for f in labelled.inputFiles())
    plan = labelled._jdf.queryExecution().executedPlan().toString()
    assert "lineitem" not in plan and "Window" not in plan and "Exchange hashpartitioning" not in plan
    region = F.substring("store_id", 7, 2).cast("bigint")
    units = 20 + F.when(F.weekday("date") >= 5, 30).otherwise(0) + 2 * F.month("date") + 5 * region
    whole = features.build_features(layers.silver(tables.bronze(spark, star).withColumn("units_sold", units)))
    want = whole.select(*labelled.drop("split").columns)
    assert want.count() == 4 * (DAYS - 14) and sorted_rows(labelled.drop("split")) == sorted_rows(want)


def shuffle_files(spark):
    blocks = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllBlocks()
    return {b for b in blocks.mkString(" ").split() if b.startswith("shuffle_")}


def left_after(spark, before, wait=20):
    """Shuffle files that came after `before` and are still there; their removal is not waited for by Spark."""
    end = time.monotonic() + wait
    while (new := shuffle_files(spark) - before) and time.monotonic() < end:
        time.sleep(0.2)
    return new


def test_a_stored_table_leaves_no_shuffle_files(spark, star):
    before = shuffle_files(spark)
    setting = spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled")
    tables.release(spark)
    stored = tables.silver(spark, star)
    assert not left_after(spark, before)
    assert stored.count() == 4 * DAYS + 4
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == setting


def test_the_setting_returns_after_an_error(spark):
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    setting = spark.conf.get(name)
    with pytest.raises(ZeroDivisionError), shuffles_removed(spark):
        assert spark.conf.get(name) == "true"
        raise ZeroDivisionError
    assert spark.conf.get(name) == setting
