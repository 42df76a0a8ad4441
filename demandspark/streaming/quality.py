"""Forecast quality per window of event time, over a stream of logged predictions."""

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from demandspark.functions import errors
from demandspark.functions.guards import require_columns
from demandspark.operators.quality import BOUNDS

TIME = "event_time"
_DAY = 86400


def _measures(columns: Sequence[str]) -> dict:
    a, p = F.col("actual_units").cast("double"), F.col("predicted_units").cast("double")
    measures = {"rows": F.count(F.lit(1)), "mae": errors.mae(a, p), "wape": errors.wape(a, p), "bias": errors.bias(a, p)}
    if set(BOUNDS) <= set(columns):
        low, high = (F.col(c).cast("double") for c in BOUNDS)
        measures["observed_coverage"] = errors.rate((a >= low) & (a <= high))
    return measures


def window_quality(log: DataFrame, size: str = "28 days", late: str = "7 days", by: Sequence[str] = ("model_version",)) -> DataFrame:
    """(by, window_start, window_end, rows, mae, wape, bias[, observed_coverage]) per tumbling window of `date`.

    On a stream, rows that are more than `late` behind the latest date seen so far may be dropped, and a window is final once the
    watermark has passed its end; on a batch nothing is late.  Windows count from 1970-01-01.  Rows without a date, an actual or
    a prediction are left out.
    """
    epoch = F.lit("1970-01-01").cast("date")
    require_columns(log, [*by, "date", "actual_units", "predicted_units"], "prediction log")
    # Midnight of the day in UTC, whatever the session's time zone.
    seconds = F.datediff("date", epoch).cast("bigint") * _DAY
    timed = log.withColumn(TIME, F.timestamp_seconds(seconds)).dropna(subset=[TIME, "actual_units", "predicted_units"])
    windowed = timed.withWatermark(TIME, late).groupBy(F.window(TIME, size), *by).agg(
        *[value.alias(name) for name, value in _measures(log.columns).items()]
    )
    day = lambda moment: F.date_add(epoch, F.floor(F.unix_seconds(moment) / _DAY).cast("int"))
    edges = [day(F.col(f"window.{edge}")).alias(f"window_{edge}") for edge in ("start", "end")]
    return windowed.select(*by, *edges, *_measures(log.columns))


def quality_stream(
    log: DataFrame,
    path: str,
    checkpoint: str,
    size: str = "28 days",
    late: str = "7 days",
    by: Sequence[str] = ("model_version",),
) -> StreamingQuery:
    """Append every window of a streaming log to a Parquet table at `path` once it is final.

    The sums of open windows are the query's state: a row per open window and group, whatever the number of predictions.
    `path` and `checkpoint` must lie on storage that every executor can reach.  See `closing_row` for the end of a stream.
    """
    if not log.isStreaming:
        raise ValueError("log must be a streaming DataFrame")
    return (
        window_quality(log, size, late, by)
        .writeStream.format("parquet")
        .outputMode("append")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def closing_row(spark: SparkSession, schema: StructType) -> DataFrame:
    """A row far in the future: appended to the input of a stream, it moves the watermark past every open window.

    Its own window stays open for good and is never written.
    """
    values = {"date": F.lit("9000-01-01").cast("date"), "actual_units": F.lit(0), "predicted_units": F.lit(0)}
    return spark.range(1).select(
        *[values.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in schema.fields]
    )
