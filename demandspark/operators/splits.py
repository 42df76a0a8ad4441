"""Time splits: every row gets a split label instead of being copied into separate frames."""

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from demandspark.functions.guards import ensure, require_columns


def split_label(date: Column, last_date: Column, validation_days: int, test_days: int) -> Column:
    test_start = F.date_sub(last_date, test_days - 1)
    validation_start = F.date_sub(test_start, validation_days)
    return (
        F.when(date < validation_start, "train")
        .when((date >= validation_start) & (date < test_start), "validation")
        .when(date >= test_start, "test")
    )


def slice_bounds(last: DataFrame, name: str, validation_days: int = 21, test_days: int = 21) -> tuple[Column | None, Column | None]:
    """First date of a split and the date after its last one, None where it is open; `last` is a one-row table of `last_date`."""
    if name not in ("train", "validation", "test"):
        raise ValueError(f"there is no split called {name}")
    if validation_days < 1 or test_days < 1:
        raise ValueError("a split needs at least one validation day and one test day")
    test_start = last.select(F.date_sub("last_date", test_days - 1).alias("day")).scalar()
    validation_start = last.select(F.date_sub("last_date", test_days - 1 + validation_days).alias("day")).scalar()
    return {"train": (None, validation_start), "validation": (validation_start, test_start), "test": (test_start, None)}[name]


def time_slice(df: DataFrame, name: str, validation_days: int = 21, test_days: int = 21) -> DataFrame:
    """Rows of one split, as a plain date range, so that the scan can skip the other files and row groups.

    The last date is looked up in the rows; `sources.dated.read_slice` has it from a manifest instead.
    """
    require_columns(df, ["date"], "feature table")
    low, high = slice_bounds(df.agg(F.max("date").alias("last_date")), name, validation_days, test_days)
    if low is not None:
        df = df.filter(F.col("date") >= low)
    return df if high is None else df.filter(F.col("date") < high)


def time_split(df: DataFrame, validation_days: int = 21, test_days: int = 21, strict: bool = False) -> DataFrame:
    """Add `split` = train, validation or test by calendar days before the last date.

    The last date is a scalar subquery, so rows are neither shuffled nor copied.  Rows without a date
    belong to no split.  `strict` makes the job stop when a split has no rows.
    """
    require_columns(df, ["date"], "feature table")
    if validation_days < 1 or test_days < 1:
        raise ValueError("a split needs at least one validation day and one test day")
    dated = df.withColumn("date", F.to_date("date"))
    last = dated.agg(F.max("date")).scalar()
    labelled = (
        dated.withColumn("__last", last)
        .withColumn("split", split_label(F.col("date"), F.col("__last"), validation_days, test_days))
        .filter(F.col("split").isNotNull())
        .drop("__last")
    )
    if not strict:
        return labelled
    filled = labelled.agg(F.count_distinct("split")).scalar()
    return labelled.filter(
        ensure(filled == 3, "one of the three splits has no rows")
    )


def distinct_dates(df: DataFrame) -> DataFrame:
    require_columns(df, ["date"], "feature table")
    return df.select(F.to_date("date").alias("date")).filter(F.col("date").isNotNull()).distinct()


def fold_calendar(df: DataFrame, horizon_days: int, folds: int = 3) -> DataFrame:
    """(`fold`, `date`, `split`) for expanding-window folds over the observed dates, oldest fold first.

    Only the distinct dates are ordered; their number is bounded by the calendar, not by the table.
    """
    if horizon_days < 1 or folds < 1:
        raise ValueError("a backtest needs at least one fold and one day of horizon")
    days = distinct_dates(df).agg(F.sort_array(F.collect_list("date")).alias("days"))
    checked = days.filter(
        ensure(F.size("days") > horizon_days * folds, "the folds ask for more dates than there are")
    )
    numbered = checked.select(F.size("days").alias("total"), F.posexplode("days").alias("position", "date"))
    fold = F.explode(F.sequence(F.lit(1), F.lit(folds)))
    end = F.col("total") - F.lit(horizon_days) * (F.lit(folds) - F.col("fold"))
    return (
        numbered.withColumn("fold", fold)
        .withColumn("__end", end)
        .filter(F.col("position") < F.col("__end"))
        .select(
            "fold",
            "date",
            F.when(F.col("position") < F.col("__end") - horizon_days, "train").otherwise("validation").alias("split"),
        )
    )


def rolling_origin(df: DataFrame, horizon_days: int, folds: int = 3, split: str | None = None) -> DataFrame:
    """Rows of every fold with `fold` and `split`.

    A training row belongs to each later fold.  Ask for `split="validation"` to get each row at most
    once; evaluation needs no more than that.
    """
    calendar = fold_calendar(df, horizon_days, folds)
    if split is not None:
        calendar = calendar.filter(F.col("split") == split)
    return df.withColumn("date", F.to_date("date")).join(calendar, "date")


def fold_summary(df: DataFrame, horizon_days: int, folds: int = 3) -> DataFrame:
    """Dates and row counts of every fold, from the row count per date."""
    daily = df.groupBy(F.to_date("date").alias("date")).agg(F.count(F.lit(1)).alias("rows"))
    joined = fold_calendar(df, horizon_days, folds).join(daily, "date")
    train, validation = F.col("split") == "train", F.col("split") == "validation"
    return joined.groupBy("fold").agg(
        F.max(F.when(train, F.col("date"))).alias("train_end"),
        F.min(F.when(validation, F.col("date"))).alias("validation_start"),
        F.max(F.when(validation, F.col("date"))).alias("validation_end"),
        F.sum(F.when(train, F.col("rows")).otherwise(0)).alias("train_rows"),
        F.sum(F.when(validation, F.col("rows")).otherwise(0)).alias("validation_rows"),
    )


def tagged_union(frames: Mapping[str, DataFrame], tag: str = "split") -> DataFrame:
    """Append frames of the same columns, each marked with its name."""
    combined = None
    for name, frame in frames.items():
        tagged = frame.withColumn(tag, F.lit(name))
        combined = tagged if combined is None else combined.unionByName(tagged)
    if combined is None:
        raise ValueError("tagged_union needs at least one frame")
    return combined
