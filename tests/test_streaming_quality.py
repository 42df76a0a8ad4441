"""Quality per window of event time: late rows inside and beyond the watermark, and the end of the stream."""

import datetime as dt

import pytest

from demandspark.streaming import quality

SCHEMA = "model_version string, date date, actual_units double, predicted_units double, prediction_lower double, prediction_upper double"
START = dt.date(1970, 1, 1) + dt.timedelta(28 * 700)  # the first day of a window


def rows(*days, error=1.0, model="m"):
    return [(model, START + dt.timedelta(d), 10.0, 10.0 + error, 8.0, 10.5) for d in days]


class Feed:
    """A folder of files, and the stream over it, run anew after each new file."""

    def __init__(self, spark, tmp_path):
        self.spark, self.base = spark, str(tmp_path)
        self.schema = spark.createDataFrame([], SCHEMA).schema

    def add(self, *some):
        self.spark.createDataFrame(some, SCHEMA).coalesce(1).write.mode("append").parquet(f"{self.base}/in")

    def run(self):
        stream = self.spark.readStream.schema(self.schema).parquet(f"{self.base}/in")
        quality.quality_stream(stream, f"{self.base}/out", f"{self.base}/check", "28 days", "7 days").awaitTermination()
        out = quality.window_quality(self.spark.createDataFrame([], SCHEMA))
        return {(r.model_version, (r.window_start - START).days): r for r in self.spark.read.schema(out.schema).parquet(f"{self.base}/out").collect()}

    def close(self):
        quality.closing_row(self.spark, self.schema).write.mode("append").parquet(f"{self.base}/in")
        return self.run()


def test_late_rows_count_inside_the_watermark_only(spark, tmp_path):
    feed = Feed(spark, tmp_path)
    feed.add(*rows(0, 5, 27, 30))
    assert feed.run() == {}  # day 30 is seen: the first window may still get rows
    feed.add(*rows(26, error=3.0))  # four days late
    assert feed.run() == {}
    feed.add(*rows(40))
    first = feed.run()
    assert set(first) == {("m", 0)} and first["m", 0].rows == 4 and first["m", 0].mae == pytest.approx(1.5)
    feed.add(*rows(20, error=100.0))  # twenty days late: its window is final
    feed.add(*rows(41, model="n"))
    feed.run()
    done = feed.close()
    assert {k: r.rows for k, r in done.items()} == {("m", 0): 4, ("m", 28): 2, ("n", 28): 1}
    assert done["m", 0].mae == pytest.approx(1.5) and done["m", 28].bias == 1.0 and done["m", 28].observed_coverage == 1.0


def test_a_stream_that_ends_equals_the_batch(spark, tmp_path):
    feed = Feed(spark, tmp_path)
    some = rows(*range(0, 120, 3)) + rows(*range(1, 100, 7), model="n", error=-2.0) + [("m", None, 1.0, 1.0, 0.0, 2.0), ("m", START, None, 1.0, 0.0, 2.0)]
    feed.add(*some)
    got = {k: tuple(r) for k, r in feed.close().items()}
    batch = quality.window_quality(spark.createDataFrame(some, SCHEMA)).collect()
    assert got == {(r.model_version, (r.window_start - START).days): tuple(r) for r in batch} and len(got) == 9


def test_batches_are_refused(spark, tmp_path):
    with pytest.raises(ValueError, match="streaming"):
        quality.quality_stream(spark.createDataFrame([], SCHEMA), str(tmp_path / "o"), str(tmp_path / "c"))
