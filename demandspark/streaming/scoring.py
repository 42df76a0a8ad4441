"""Record scoring over a stream of feature rows."""

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from demandspark.operators.scoring import Predictor, score_records
from demandspark.schemas import KEY_COLUMNS


def score_stream(
    records: DataFrame,
    predictor: Predictor,
    model_version: str,
    path: str,
    checkpoint: str,
    radius: float | None = None,
    coverage: float = 0.90,
    keep: Sequence[str] = KEY_COLUMNS,
) -> StreamingQuery:
    """Score each arriving feature row once and append it to a Parquet prediction log.

    Scoring is a stateless projection, so it needs no watermark.  `path` and `checkpoint` must lie on
    storage that every executor can reach.
    """
    if not records.isStreaming:
        raise ValueError("records must be a streaming DataFrame")
    scored = score_records(records, predictor, model_version, radius, coverage, keep)
    return (
        scored.writeStream.format("parquet")
        .outputMode("append")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
