"""Quality reports over a prediction log: intervals, segments and consecutive row blocks."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from demandspark.functions import errors
from demandspark.functions.guards import ensure, group_window, is_finite, join_on, require_columns
from demandspark.functions.storage import allow_checkpoints
from demandspark.operators.metrics import checked_aggregate

BOUNDS = ("prediction_lower", "prediction_upper")


def interval_quality(predictions: DataFrame, by: Sequence[str] = ()) -> DataFrame | None:
    """Coverage, width and misses of the logged bounds; None when the log has no bounds."""
    if not set(BOUNDS) & set(predictions.columns):
        return None
    require_columns(predictions, ["actual_units", *BOUNDS], "prediction interval log")
    actual, lower, upper = (F.col(c).cast("double") for c in ("actual_units", *BOUNDS))
    report = checked_aggregate(
        predictions,
        ("actual_units", *BOUNDS),
        {
            "rows": F.count(F.lit(1)),
            "observed_coverage": errors.rate((actual >= lower) & (actual <= upper)),
            "mean_interval_width": F.avg(upper - lower),
            "below_interval_rate": errors.rate(actual < lower),
            "above_interval_rate": errors.rate(actual > upper),
            "__crossed": F.count_if(lower > upper),
        },
        by,
    )
    return report.filter(
        ensure(F.col("__crossed") == 0, "a logged lower bound lies above its upper bound")
    ).drop("__crossed")


def segment_label(columns: Sequence[str]) -> Column:
    """The name of a row's segment, such as `store_id=s1 / category=home`."""
    return F.concat_ws(" / ", *[F.concat(F.lit(f"{c}="), F.coalesce(F.col(c).cast("string"), F.lit("nan"))) for c in columns])


def segment_table(
    predictions: DataFrame,
    segments: Sequence[str] = ("store_id", "category"),
    min_rows: int = 10,
    by: Sequence[str] = (),
) -> DataFrame | None:
    """Quality of every segment.  Small segments and segments with values that are not finite are skipped.

    Returns None when the log lacks actuals or every segment column.
    """
    if min_rows < 1:
        raise ValueError("min_rows is at least 1")
    present = [c for c in segments if c in predictions.columns]
    if not {"actual_units", "predicted_units"} <= set(predictions.columns) or not present:
        return None
    a, p = F.col("actual_units").cast("double"), F.col("predicted_units").cast("double")
    label = segment_label(present)
    return (
        predictions.groupBy(*by, *present)
        .agg(
            F.count(F.lit(1)).alias("rows"),
            F.count_if(~is_finite(a) | ~is_finite(p)).alias("__bad"),
            F.avg(a).alias("mean_actual"),
            F.avg(p).alias("mean_predicted"),
            errors.mae(a, p).alias("mae"),
            errors.wape(a, p).alias("wape"),
            errors.bias(a, p).alias("bias"),
        )
        .filter((F.col("rows") >= min_rows) & (F.col("__bad") == 0))
        .select(*by, label.alias("segment"), "rows", "mean_actual", "mean_predicted", "mae", "wape", "bias")
    )


def segment_quality(
    predictions: DataFrame,
    segments: Sequence[str] = ("store_id", "category"),
    min_rows: int = 10,
    top: int = 10,
    by: Sequence[str] = (),
) -> DataFrame | None:
    """The `top` worst segments by MAE, per `by` group."""
    measured = segment_table(predictions, segments, min_rows, by)
    if measured is None:
        return None
    worst_first = [F.col("mae").desc(), F.col("rows").desc(), F.col("segment")]
    if not by:
        return measured.orderBy(*worst_first).limit(top)
    return (
        measured.withColumn("__rank", F.row_number().over(Window.partitionBy(*by).orderBy(*worst_first)))
        .filter(F.col("__rank") <= top)
        .drop("__rank")
    )


def worst_segment(segments: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Name and MAE of the worst segment per group; one row, of NULLs, for an empty table without groups."""
    worst = F.min_by(F.struct("segment", "mae"), F.struct(-F.col("mae"), -F.col("rows"), F.col("segment")))
    return (
        segments.groupBy(*by)
        .agg(worst.alias("worst"))
        .select(*by, F.col("worst.segment").alias("worst_segment"), F.col("worst.mae").alias("segment_mae"))
    )


def row_index(df: DataFrame, order: Sequence[str], by: Sequence[str] = (), name: str = "row_index") -> DataFrame:
    """Zero-based position of every row in the total order `order`, without one task sorting a whole group.

    The rows before a prefix of the order columns are counted level by level from pre-aggregated counts,
    and only rows that agree on all but the last column are numbered by a window.  With
    (date, store_id, sku_id) that window holds one store and day, however many rows a day or a store has.
    A single order column has no such prefix: its rows are dealt into ranges, which are numbered on their own.
    """
    require_columns(df, [*order, *by], "prediction log")
    if not order:
        raise ValueError("order must name at least one column")
    by, order = list(by), list(order)
    if len(order) == 1:
        return _ranged_index(df, order[0], by, name)
    rows = df
    total = F.lit(0).cast("bigint")
    if len(order) > 1:
        counts = df.groupBy(*by, *order[:-1]).agg(F.count(F.lit(1)).alias("__n"))
        offsets = None
        for depth in range(1, len(order)):
            parent, prefix = by + order[: depth - 1], by + order[:depth]
            level = counts.groupBy(*prefix).agg(F.sum("__n").alias("__n"))
            before = F.sum("__n").over(
                group_window(parent, F.col(order[depth - 1]).asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
            )
            level = level.withColumn("__before", F.coalesce(before, F.lit(0))).drop("__n")
            if offsets is not None:
                upper = offsets.withColumnRenamed("__before", "__upper")
                level = join_on(level, upper, parent) if parent else level
                level = level.withColumn("__before", F.col("__before") + F.col("__upper")).drop("__upper")
            offsets = level
        rows = join_on(df, offsets, by + order[:-1])
        total = F.col("__before")
    inner = F.row_number().over(group_window(by + order[:-1], F.col(order[-1]).asc_nulls_last()))
    return rows.withColumn(name, total + inner - 1).drop("__before")


def _ranged_index(df: DataFrame, order: str, by: list[str], name: str) -> DataFrame:
    """`row_index` by one column: rows before a range are counted per range, those inside it by their place.

    The sorted ranges are checkpointed, so that both steps see the same ones even if an executor is lost.
    """
    allow_checkpoints(df.sparkSession)
    place = F.monotonically_increasing_id()  # range number in the upper bits, place in it in the lower 33
    dealt = df.repartitionByRange(*by, F.col(order).asc_nulls_last()).sortWithinPartitions(*by, F.col(order).asc_nulls_last())
    dealt = dealt.withColumn("__place", place).withColumn("__range", F.shiftright("__place", 33)).checkpoint()
    ranges = dealt.groupBy(*by, "__range").agg(F.count(F.lit(1)).alias("__n"), F.min("__place").alias("__first"))
    earlier = F.sum("__n").over(group_window(by, F.col("__range")).rowsBetween(Window.unboundedPreceding, -1))
    ranges = ranges.withColumn("__before", F.coalesce(earlier, F.lit(0))).drop("__n")
    numbered = join_on(dealt, ranges, [*by, "__range"])
    index = F.col("__before") + F.col("__place") - F.col("__first")
    return numbered.withColumn(name, index).drop("__place", "__range", "__before", "__first")


def rolling_quality(
    predictions: DataFrame,
    window_size: int = 50,
    order: Sequence[str] = ("date", "store_id", "sku_id"),
    by: Sequence[str] = (),
) -> DataFrame | None:
    """MAE, WAPE and bias of consecutive blocks of `window_size` rows; the last block may be short.

    `order` must be a total order; the reference order of rows within a date is unspecified.
    """
    if window_size < 1:
        raise ValueError("window_size is at least 1")
    if not {"actual_units", "predicted_units"} <= set(predictions.columns):
        return None
    columns = dict.fromkeys([*by, *order, "actual_units", "predicted_units"])
    numbered = row_index(predictions.select(*columns), order, by)
    blocks = numbered.withColumn("window", F.floor(F.col("row_index") / window_size).cast("bigint"))
    a, p = F.col("actual_units").cast("double"), F.col("predicted_units").cast("double")
    measures = {
        "rows": F.count(F.lit(1)),
        "mae": errors.mae(a, p),
        "wape": errors.wape(a, p),
        "bias": errors.bias(a, p),
    }
    if "date" in order:
        measures |= {"start_date": F.min("date"), "end_date": F.max("date")}
    report = checked_aggregate(blocks, ("actual_units", "predicted_units"), measures, [*by, "window"])
    return report.select(*by, "window", (F.col("window") * window_size).alias("start_row"), *measures)
