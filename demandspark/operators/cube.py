"""An additive cube of a prediction log: one scan that every monitoring number is summed from.

A cell holds the sums of one (model, kept columns, segment, prediction bin).  Sums of cells are sums of rows, so
errors, coverage, feature means, segment errors and bin shares all come from the cells, and so does any window of days where the
date is a kept column: a stored cube answers a new question without the log.
"""

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from demandspark.functions import errors
from demandspark.functions.guards import attach, ensure, group_window, is_finite, join_on, require_columns
from demandspark.functions.histogram import bin_of, shares_of, stability_index
from demandspark.operators.drift import SMALLEST_STD, finite_number, reference_bins
from demandspark.operators.quality import BOUNDS, segment_label

SEGMENTS = ("store_id", "category")
BIN = "prediction_bin"
LABELLED = ("abs_error", "error", "actual", "abs_actual")
BOUNDED = ("bounded", "bad_bounds", "crossed", "covered", "below", "above", "width")


def _finite(*columns: Column) -> Column:
    return reduce(lambda a, b: a & b, [is_finite(c) for c in columns])


def log_cube(
    predictions: DataFrame,
    baseline: DataFrame | None = None,
    feature_names: Sequence[str] = (),
    by: Sequence[str] = ("model_version",),
    segments: Sequence[str] = SEGMENTS,
    keep: Sequence[str] = (),
) -> DataFrame:
    """Cells (by, keep, segments that the log has, prediction_bin) with their sums; the log is read once.

    Without a baseline, and for a model that has none, the bin is NULL.  Sums of what the log lacks are left out.
    """
    present = set(predictions.columns)
    require_columns(predictions, [*by, *keep, "predicted_units"], "prediction log")
    labelled = "actual_units" in present
    bounded = labelled and bool(present & set(BOUNDS))
    if bounded:
        require_columns(predictions, BOUNDS, "prediction interval log")
    grain = [*by, *keep, *[c for c in segments if c in present]]
    features = [c for c in feature_names if c in present]
    values = ["predicted_units", *(["actual_units"] if labelled else []), *(BOUNDS if bounded else [])]
    rows = predictions.select(
        *grain,
        *[F.col(c).cast("double").alias(f"__{c}") for c in values],
        *[F.expr(finite_number(c)).alias(f"__f{i}") for i, c in enumerate(features)],
    )
    if baseline is not None:
        edges = reference_bins(baseline, by).select(*by, F.col("bin_edges").alias("__edges"))
        rows = attach(rows, edges, by).withColumn(BIN, bin_of("__predicted_units", "__edges"))
    else:
        rows = rows.withColumn(BIN, F.lit(None).cast("int"))
    p = F.col("__predicted_units")
    sums = {"rows": F.count(F.lit(1)), "predicted": F.sum(p)}
    bad = ~_finite(p)
    if labelled:
        a = F.col("__actual_units")
        bad = ~_finite(a, p)
        sums |= {
            "abs_error": F.sum(errors.absolute_error(a, p)),
            "error": F.sum(errors.residual(a, p)),
            "actual": F.sum(a),
            "abs_actual": F.sum(F.abs(a)),
        }
    if bounded:
        low, high = (F.col(f"__{c}") for c in BOUNDS)
        given = low.isNotNull() | high.isNotNull()
        sums |= {
            "bounded": F.count_if(given),
            "bad_bounds": F.count_if(given & ~_finite(a, low, high)),
            "crossed": F.count_if(given & (low > high)),
            "covered": F.count_if(given & (a >= low) & (a <= high)),
            "below": F.count_if(given & (a < low)),
            "above": F.count_if(given & (a > high)),
            "width": F.sum(F.when(given, high - low)),
        }
    sums["bad"] = F.count_if(bad)
    for i in range(len(features)):
        sums |= {f"sum_{features[i]}": F.sum(f"__f{i}"), f"count_{features[i]}": F.count(f"__f{i}")}
    return rows.groupBy(*grain, BIN).agg(*[value.alias(name) for name, value in sums.items()])


def _measures(cells: DataFrame) -> list[str]:
    features = [c for c in cells.columns if c.startswith(("sum_", "count_"))]
    return [c for c in ("rows", "bad", "predicted", *LABELLED, *BOUNDED) if c in cells.columns] + features


def _sound(cells: DataFrame) -> DataFrame:
    """Totals that stop the job on an empty log and on numbers that are missing or not finite."""
    valid = ensure(F.coalesce("rows", F.lit(0)) > 0, "no rows to evaluate: the input is empty") & ensure(
        F.col("bad") == 0, "NULL, NaN and infinite values cannot be evaluated, only finite ones"
    )
    if "bounded" in cells.columns:
        valid = valid & ensure(F.col("bad_bounds") == 0, "NULL, NaN and infinite bounds cannot be evaluated, only finite ones")
        valid = valid & ensure(F.col("crossed") == 0, "a logged lower bound lies above its upper bound")
    return cells.filter(valid)


def _forecast_errors() -> dict[str, Column]:
    share = F.try_divide(F.col("abs_error"), F.col("abs_actual"))
    return {
        "mae": F.col("abs_error") / F.col("rows"),
        "wape": F.when(F.col("abs_actual") > 0, share).otherwise(F.lit(0.0)),
        "bias": F.col("error") / F.col("rows"),
    }


def segment_errors(cells: DataFrame, by: Sequence[str], segments: Sequence[str] = SEGMENTS, min_rows: int = 10) -> DataFrame:
    """The segment table from cells: like `quality.segment_table`."""
    present = [c for c in segments if c in cells.columns]
    sums = cells.groupBy(*by, *present).agg(*[F.sum(c).alias(c) for c in ("rows", "bad", "predicted", *LABELLED)])
    kept = sums.filter((F.col("rows") >= min_rows) & (F.col("bad") == 0))
    return kept.select(
        *by,
        segment_label(present).alias("segment"),
        "rows",
        (F.col("actual") / F.col("rows")).alias("mean_actual"),
        (F.col("predicted") / F.col("rows")).alias("mean_predicted"),
        *[value.alias(name) for name, value in _forecast_errors().items()],
    )


def totals(cells: DataFrame, by: Sequence[str] = (), segments: Sequence[str] = SEGMENTS, min_rows: int = 5) -> DataFrame:
    """One row per group: the sums, `bins` with the rows of each bin, and `worst` (segment, mae), from one pass over the cells.

    Every cell counts once for its segment and once for its bin (two grouping sets); the groups are made of those.
    """
    measures = _measures(cells)
    present = [c for c in segments if c in cells.columns] if "actual" in cells.columns else []
    blank = lambda c: F.lit(None).cast(cells.schema[c].dataType)

    def side(whole: bool) -> Column:
        marks = [(F.col(c) if whole else blank(c)).alias(c) for c in present]
        kept = [(F.col(c) if whole or c == "rows" else blank(c)).alias(c) for c in measures]
        return F.struct(F.lit(whole).alias("__whole"), *marks, (blank(BIN) if whole else F.col(BIN)).alias(BIN), *kept)

    sides = cells.select(*by, F.inline(F.array(side(True), side(False))))
    sets = sides.groupBy(*by, "__whole", *present, BIN).agg(*[F.sum(c).alias(c) for c in measures])
    whole = F.col("__whole")
    wanted = [F.sum(F.when(whole, F.col(c))).alias(c) for c in measures]
    wanted.append(F.collect_list(F.when(~whole, F.struct(F.col(BIN).alias("__bin"), F.col("rows").alias("__n")))).alias("bins"))
    if present:
        mae, label = F.col("abs_error") / F.col("rows"), segment_label(present)
        fit = whole & (F.col("rows") >= min_rows) & (F.col("bad") == 0)
        order = F.when(fit, F.struct(-mae, -F.col("rows"), label))
        wanted.append(F.min_by(F.struct(label.alias("segment"), mae.alias("mae")), order).alias("worst"))
    return _sound(sets.groupBy(*by).agg(*wanted))


def errors_of(summed: DataFrame) -> dict[str, Column]:
    """mae, wape and bias of `totals`; NULL where the log has no actuals."""
    if "actual" not in summed.columns:
        return {name: F.lit(None).cast("double") for name in ("mae", "wape", "bias")}
    return _forecast_errors()


def feature_shift(summed: DataFrame, reference: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """`totals` with `max_feature_shift`, the largest standardised movement of a feature mean against `reference`.

    `reference` has feature, mean and std, for all groups or per group; a group's list is as long as its features are many.
    """
    names = [c.removeprefix("sum_") for c in summed.columns if c.startswith("sum_")]
    keys = [c for c in by if c in reference.columns]
    lists = reference.filter(F.col("feature").isin(names)).groupBy(*keys).agg(
        F.collect_list(F.struct("feature", F.col("mean").cast("double").alias("mean"), F.col("std").cast("double").alias("std"))).alias("__reference")
    )
    mean = {n: F.try_divide(F.col(f"sum_{n}"), F.col(f"count_{n}")) for n in names}
    means = F.create_map(*[part for n in names for part in (F.lit(n), mean[n])])
    shift = lambda r: F.abs((F.element_at(means, r["feature"]) - r["mean"]) / F.greatest(F.abs(r["std"]), F.lit(SMALLEST_STD)))
    known = attach(summed, lists, keys)
    return known.withColumn("max_feature_shift", F.array_max(F.transform("__reference", shift))).drop("__reference")


def shares_psi(summed: DataFrame, baseline: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """`totals` with `psi`, from the rows of each bin; NULL for a group without a baseline."""
    known = attach(summed, reference_bins(baseline, by), by, {"expected_share": "__expected"})
    known = known.withColumn("__observed", shares_of("bins", "rows", "__expected"))
    return known.withColumn("psi", stability_index("__expected", "__observed")).drop("__expected", "__observed")


def rolling_psi(cells: DataFrame, baseline: DataFrame, days: int = 28, by: Sequence[str] = ("model_version",)) -> DataFrame:
    """(by, date, rows, psi) for the window of `days` days that ends on each date of the cube; the log is not read.

    `cells` keep the date.  A day and bin without rows counts as zero; what is windowed has one row per group, bin and date.
    """
    if days < 1:
        raise ValueError("days is at least 1")
    daily = cells.groupBy(*by, "date", F.col(BIN).alias("__bin")).agg(F.sum("rows").alias("__n"), F.sum("bad").alias("__bad"))
    dated = daily.groupBy(*by, "date").agg(
        F.collect_list(F.struct("__bin", "__n")).alias("__counts"), F.sum("__bad").alias("__bad")
    )
    dated = dated.filter(ensure(F.col("__bad") == 0, "PSI needs finite predictions"))
    bins = reference_bins(baseline, by).select(*by, F.col("expected_share").alias("__expected"))
    known = join_on(dated, bins, by) if by else attach(dated, bins)
    count = "aggregate(__counts, 0L, (sum, c) -> sum + CASE WHEN c.__bin = i THEN c.__n ELSE 0L END)"
    dense = known.selectExpr(*by, "date", "__expected", f"posexplode(transform(__expected, (e, i) -> {count})) AS (__bin, __n)")
    frame = group_window([*by, "__bin"], F.datediff("date", F.lit("1970-01-01").cast("date"))).rangeBetween(1 - days, Window.currentRow)
    summed = dense.withColumn("__n", F.sum("__n").over(frame)).groupBy(*by, "date").agg(
        F.sum("__n").alias("rows"), F.any_value("__expected").alias("__expected"), F.collect_list(F.struct("__bin", "__n")).alias("__counts")
    )
    observed = summed.withColumn("__observed", shares_of("__counts", "rows", "__expected"))
    return observed.select(*by, "date", "rows", stability_index("__expected", "__observed").alias("psi"))
