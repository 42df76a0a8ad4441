"""Compare the registered queries with their reference SQL on one data folder.

Usage: python tests/compare.py [folder] [query ...]
"""

import datetime
import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(folder: str):
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')")
    return connection


def _cell(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return "null"
    if isinstance(value, bool):
        return f"b:{value}"
    if isinstance(value, int):
        return f"i:{value}"
    if isinstance(value, float):
        return f"f:{value!r}"
    if isinstance(value, (datetime.date, datetime.datetime)):
        return f"d:{value}"
    return f"{type(value).__name__}:{value}"


def _canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_cell(row[i]) for i in order) for row in rows)


def compare(frame, connection, sql):
    """None when equal, otherwise a short description of the difference."""
    result = connection.execute(sql)
    names = [d[0] for d in result.description]
    expected_rows = result.fetchall()
    rows = [tuple(r) for r in frame.collect()]
    if sorted(frame.columns) != sorted(names):
        return f"columns {sorted(set(frame.columns) ^ set(names))}"
    if len(rows) != len(expected_rows):
        return f"rows {len(rows)} against {len(expected_rows)}"
    ours, theirs = _canonical(frame.columns, rows), _canonical(names, expected_rows)
    different = [(a, b) for a, b in zip(ours, theirs) if a != b]
    if different:
        first = [(n, x, y) for n, x, y in zip(sorted(names), *different[0]) if x != y]
        return f"{len(different)} rows differ, first {first}"
    return None


def main(folder="/root/testdata/sf0.01", *wanted):
    from pyspark.sql import SparkSession

    from __spark_entry__ import oracle_sql, queries

    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    connection, oracles = connect(folder), oracle_sql()
    failed = 0
    for name, query in queries().items():
        if wanted and name not in wanted:
            continue
        start = time.time()
        try:
            if name in oracles:
                problem = compare(query(spark, folder), connection, oracles[name])
            else:
                problem = None if query(spark, folder).count() else "no rows"
        except Exception as error:  # report and go on with the next query
            problem = str(error).splitlines()[0][:400]
        failed += problem is not None
        print(f"{'ok  ' if problem is None else 'FAIL'} {name} {time.time() - start:.1f}s {problem or ''}", flush=True)
    print(f"{failed} failed; without SQL: {sorted(set(queries()) - set(oracles))}")
    spark.stop()
    return failed


if __name__ == "__main__":
    raise SystemExit(1 if main(*sys.argv[1:]) else 0)
