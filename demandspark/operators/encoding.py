"""Model matrices: one-hot categories and the feature vector."""

from collections.abc import Mapping, Sequence

from pyspark.ml import Pipeline
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandspark.functions.guards import require_columns
from demandspark.schemas import CATEGORICAL_COLUMNS, FEATURE_COLUMNS


def category_features(df: DataFrame, columns: Sequence[str] = CATEGORICAL_COLUMNS) -> DataFrame:
    """`feature`: the distinct names `column_value` of the categories in `df`, as a table of any length."""
    return df.select(F.explode(_names(columns)).alias("feature")).distinct()


def _names(columns: Sequence[str]):
    """Array of the row's `column_value` names; missing categories have none."""
    return F.array_compact(F.array(*[F.concat(F.lit(f"{c}_"), F.col(c)) for c in columns]))


def one_hot_long(df: DataFrame, known: DataFrame, keep: Sequence[str] = (), columns: Sequence[str] = CATEGORICAL_COLUMNS) -> DataFrame:
    """The one-hot encoding in sparse form: `feature` and `value` 1.0 for every known category of a row.

    `known` comes from `category_features` of the training rows.  Unseen and missing categories have no row, so any
    number of categories fits; a dense form is the vector of `encoder_stages`.
    """
    long = df.select(*keep, F.explode(_names(columns)).alias("feature"))
    return long.join(known.select("feature").distinct(), "feature", "left_semi").select(*keep, "feature", F.lit(1.0).alias("value"))


def one_hot_wide(df: DataFrame, values: Mapping[str, Sequence[str]], keep: Sequence[str] = ()) -> DataFrame:
    """0/1 columns named `column_value` for a given list of values; unseen and missing categories are zero everywhere."""
    return df.select(
        *keep,
        *[
            F.when(F.col(column) == value, 1.0).otherwise(0.0).alias(f"{column}_{value}")
            for column, listed in values.items()
            for value in listed
        ],
    )


def align_columns(df: DataFrame, columns: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """Select exactly the trained columns in order: missing ones become 0.0, extra ones disappear."""
    present = set(df.columns)
    return df.select(
        *keep, *[F.col(f"`{c}`") if c in present else F.lit(0.0).alias(c) for c in columns]
    )


def encoder_stages(output: str = "features") -> list:
    """Index, one-hot and assemble stages; unseen and missing categories become all zeros."""
    indexed = [f"{c}_index" for c in CATEGORICAL_COLUMNS]
    encoded = [f"{c}_onehot" for c in CATEGORICAL_COLUMNS]
    return [
        StringIndexer(
            inputCols=list(CATEGORICAL_COLUMNS),
            outputCols=indexed,
            handleInvalid="keep",
            stringOrderType="alphabetAsc",
        ),
        OneHotEncoder(inputCols=indexed, outputCols=encoded, dropLast=True),
        VectorAssembler(inputCols=list(FEATURE_COLUMNS) + encoded, outputCol=output, handleInvalid="error"),
    ]


def model_matrix(df: DataFrame, output: str = "features"):
    """Fit the encoders and return (frame with a vector column, ordered column names, fitted encoders)."""
    require_columns(df, FEATURE_COLUMNS + CATEGORICAL_COLUMNS, "feature table")
    fitted = Pipeline(stages=encoder_stages(output)).fit(df)
    labels = fitted.stages[0].labelsArray
    names = list(FEATURE_COLUMNS) + [
        f"{column}_{value}" for column, values in zip(CATEGORICAL_COLUMNS, labels) for value in values
    ]
    helpers = [f"{c}_{suffix}" for c in CATEGORICAL_COLUMNS for suffix in ("index", "onehot")]
    return fitted.transform(df).drop(*helpers), names, fitted
