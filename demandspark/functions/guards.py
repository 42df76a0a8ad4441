"""Contract checks and null-safe helpers shared by the operators."""

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F


def require_columns(df: DataFrame, columns: Iterable[str], table: str) -> None:
    """Fail at plan-building time, without a Spark job, when a column is absent."""
    missing = sorted(set(columns) - set(df.columns))
    if missing:
        raise ValueError(f"{table} is missing columns: {missing}")


def is_finite(value: Column) -> Column:
    """True for a real number; False for NULL, NaN and both infinities."""
    number = value.cast("double")
    return F.coalesce(~F.isnan(number) & (F.abs(number) < F.lit(float("inf"))), F.lit(False))


def ensure(condition: Column, message: Column | str) -> Column:
    """A filter predicate that keeps every row and stops the job when `condition` does not hold."""
    text = F.lit(message) if isinstance(message, str) else message
    return F.when(condition, F.lit(True)).otherwise(F.raise_error(text).cast("boolean"))


def nan_to_null(df: DataFrame) -> DataFrame:
    """Make NaN missing in every floating column, so that means and counts skip it."""
    floating = {f.name for f in df.schema.fields if f.dataType.typeName() in ("double", "float")}
    return df.select(
        *[
            F.when(~F.isnan(c), F.col(c)).alias(c) if c in floating else F.col(c)
            for c in df.columns
        ]
    )


def floor_at(value: Column, low) -> Column:
    """Lower clip that leaves missing values missing."""
    return F.when(value < low, F.lit(low)).otherwise(value)


def group_window(by: Sequence[str], *order: Column) -> WindowSpec:
    """A window over the `by` groups, or over the whole (already aggregated, small) table."""
    window = Window.partitionBy(*by) if by else Window.partitionBy(F.lit(0))
    return window.orderBy(*order) if order else window


def join_on(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join that matches NULL keys with each other and keeps one copy of the key columns."""
    renamed = right.withColumnsRenamed({key: f"__r_{key}" for key in keys})
    condition = F.expr(" AND ".join(f"`{key}` <=> `__r_{key}`" for key in keys))
    return left.join(renamed, condition, how).drop(*[f"__r_{key}" for key in keys])


def attach(
    df: DataFrame,
    row: DataFrame,
    by: Sequence[str] = (),
    columns: Mapping[str, str] | None = None,
    required: str | None = None,
) -> DataFrame:
    """Add the columns of a one-row-per-group table to every row of `df`; no row of `df` is lost.

    With grouping keys this is a left equi-join.  Without keys the one-row table becomes a scalar
    subquery, so nothing is joined or shuffled.  `columns` maps source names to output names.  A row
    without a partner gets NULL, or stops the job with `required` and the group's key.
    """
    names = dict(columns) if columns else {c: c for c in row.columns if c not in by}
    renamed = [f"`{source}` AS `{target}`" for source, target in names.items()]
    if by:
        keyed = row.selectExpr(*[f"`{c}`" for c in by], *renamed, *(["true AS __found"] if required else []))
        joined = join_on(df, keyed, by, "left")
    else:
        packed = row.selectExpr(f"struct({', '.join(renamed)})").scalar()
        unpacked = [f"__attached.`{target}` AS `{target}`" for target in names.values()]
        found = ["__attached IS NOT NULL AS __found"] if required else []
        joined = df.withColumn("__attached", packed).selectExpr("*", *unpacked, *found).drop("__attached")
    if not required:
        return joined
    key = F.concat_ws(", ", *[F.coalesce(F.col(c).cast("string"), F.lit("NULL")) for c in by]) if by else F.lit("all rows")
    return joined.filter(ensure(F.coalesce("__found", F.lit(False)), F.concat(F.lit(f"{required}: "), key))).drop("__found")
