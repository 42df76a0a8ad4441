"""Tables in month partitions with a manifest, and append-only tables of committed batches."""

import datetime as dt
import os
import re

import pytest
from pyspark.sql import functions as F

from demandspark.operators import splits
from demandspark.sources import commits, dated

START = dt.date(2025, 1, 10)
DAYS = 100


def rows(spark, days=DAYS, units=1):
    return spark.range(days * 3).selectExpr(
        f"date_add(date'{START}', cast(id % {days} AS int)) AS date", "concat('s', id % 2) AS store_id", "concat('k', id) AS sku_id", f"{units} AS units"
    )


def files(path):
    """Files of each month with their times of change."""
    return {
        month: sorted((f, os.stat(f"{path}/{month}/{f}").st_mtime_ns) for f in os.listdir(f"{path}/{month}") if f.startswith("part"))
        for month in os.listdir(path)
        if month.startswith("date_bucket")
    }


def test_rewriting_a_month_touches_no_other(spark, tmp_path):
    path = str(tmp_path / "t")
    dated.write_dated(rows(spark), path)
    before, listed = files(f"{path}/rows"), files(f"{path}/manifest")
    assert len(before) == 4 and set(before) == set(listed)
    new = rows(spark, units=9).filter("date >= '2025-03-01' and date < '2025-04-01'")
    dated.write_dated(new, path)
    after, relisted = files(f"{path}/rows"), files(f"{path}/manifest")
    changed = "date_bucket=2025-03"
    assert {m for m in before if before[m] != after[m]} == {changed} == {m for m in listed if listed[m] != relisted[m]}
    table = dated.read_dated(spark, path)
    assert table.columns == rows(spark).columns and table.count() == DAYS * 3
    assert table.filter("units = 9").count() == 31 * 3
    manifest = {r.date_bucket: r for r in dated.read_manifest(spark, path).collect()}
    assert manifest["2025-01"].min_date == START and manifest["2025-04"].max_date == START + dt.timedelta(DAYS - 1)
    assert sum(r.rows for r in manifest.values()) == DAYS * 3


@pytest.mark.parametrize("name", ["train", "validation", "test"])
def test_slices_equal_those_of_a_scan(spark, tmp_path, name):
    path = str(tmp_path / "t")
    dated.write_dated(rows(spark), path)
    got = dated.read_slice(spark, path, name, 21, 14)
    want = splits.time_slice(rows(spark), name, 21, 14)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_a_slice_opens_its_months_and_looks_up_no_date(spark, tmp_path):
    path = str(tmp_path / "t")
    dated.write_dated(rows(spark), path)
    found = dated.read_slice(spark, path, "test", 5, 5)
    assert found.count() == 15
    found.collect()
    plan = found._jdf.queryExecution().executedPlan().toString()
    scans = re.findall(r"FileScan parquet \[([^\]]*)\].*?Location: .*?\[(.*?)\].*?PartitionFilters: \[(.*?)\]", plan)
    of_rows = [s for s in scans if "units" in s[0] or "sku_id" in s[0]]
    assert of_rows and all("date_bucket" in s[2] for s in of_rows)
    assert all("min_date" in s[0] or "max_date" in s[0] for s in scans if s not in of_rows)  # the dates come from the manifest
    low = dated.read_dated(spark, path, dt.date(2025, 4, 2), None)
    assert {f.split("date_bucket=")[1][:7] for f in low.select(F.input_file_name().alias("f")).distinct().toPandas().f} == {"2025-04"}


def test_dated_tables_take_empty_input_and_missing_dates(spark, tmp_path):
    path = str(tmp_path / "t")
    some = rows(spark, 3).unionByName(rows(spark, 1).withColumn("date", F.lit(None).cast("date")))
    dated.write_dated(some, path)
    assert dated.read_dated(spark, path).count() == 12
    assert dated.read_dated(spark, path, START, START + dt.timedelta(1)).count() == 3
    dated.write_dated(some.limit(0), path)
    assert dated.read_dated(spark, path).count() == 12


def test_committed_batches_count_once(spark, tmp_path):
    path, schema = str(tmp_path / "log"), "id bigint"
    assert commits.read(spark, path, schema).count() == 0 and commits.uncommitted(spark, path) == []
    assert commits.append(spark.range(10), path, "a/1")
    assert not commits.append(spark.range(10), path, "a/1")
    failed = commits.write_attempt(spark.range(100), path)  # a writer that ends before its commit
    assert commits.append(spark.range(10, 15), path, "b")
    assert sorted(r.id for r in commits.read(spark, path, schema).collect()) == list(range(15))
    assert commits.uncommitted(spark, path) == [failed]


def test_of_two_writers_of_a_batch_one_counts(spark, tmp_path):
    path, schema = str(tmp_path / "log"), "id bigint"
    first, second = commits.write_attempt(spark.range(3), path), commits.write_attempt(spark.range(7), path)
    assert commits.commit(spark, path, "day", second) and not commits.commit(spark, path, "day", first)
    assert commits.read(spark, path, schema).count() == 7
    assert commits.remove_uncommitted(spark, path) == 1 and commits.uncommitted(spark, path) == []
    assert commits.read(spark, path, schema).count() == 7


def test_an_unfinished_commit_file_is_not_read(spark, tmp_path):
    path, schema = str(tmp_path / "log"), "id bigint"
    commits.append(spark.range(3), path, "a")
    place, system = commits._place(spark, commits._commit_path(path, "b"))
    system.create(place, False).close()
    assert commits.read(spark, path, schema).count() == 3


def test_release_deletes_what_the_session_wrote(spark):
    from demandspark.plans import tables

    path = tables.new_path(spark, "anything")
    spark.range(3).write.parquet(path)
    assert spark.read.parquet(path).count() == 3
    tables.release(spark)
    assert not os.path.exists(path)
