"""Model inputs: category slots, imputed and scaled numbers, one feature vector."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import (
    Imputer,
    ImputerModel,
    OneHotEncoder,
    StandardScaler,
    StringIndexer,
    VectorAssembler,
)
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.slots import exact_medians
from tidemark.spec import CATEGORICAL_FEATURES, NUMERIC_FEATURES

SCALED = "numeric_features_scaled"


def category_stages(categories: Sequence[str] = CATEGORICAL_FEATURES) -> list:
    """Categories become slots by falling frequency, with one more slot for unseen or null values."""
    index = StringIndexer(
        inputCols=list(categories),
        outputCols=[f"{c}__index" for c in categories],
        stringOrderType="frequencyDesc",
        handleInvalid="keep",
    )
    slots = OneHotEncoder(
        inputCols=index.getOutputCols(),
        outputCols=[f"{c}__one_hot" for c in categories],
        handleInvalid="keep",
        dropLast=True,
    )
    return [index, slots]


def median_imputer(
    training: DataFrame, numbers: Sequence[str] = NUMERIC_FEATURES
) -> ImputerModel:
    """Fills missing numbers with the exact lower median of the training rows.

    Spark's imputer estimates medians from a sketch; here it is given a single row that holds them.
    """
    medians = (
        exact_medians(training, numbers)
        .groupBy()
        .pivot("feature", list(numbers))
        .agg(F.first("value"))
    )
    return Imputer(
        strategy="median",
        inputCols=list(numbers),
        outputCols=[f"{n}__imputed" for n in numbers],
    ).fit(medians)


def number_stages(training: DataFrame, numbers: Sequence[str] = NUMERIC_FEATURES) -> list:
    """Numbers get the median where missing and are divided by their standard deviation."""
    fill = median_imputer(training, numbers)
    unscaled = VectorAssembler(
        inputCols=[f"{n}__imputed" for n in numbers], outputCol="numeric_features"
    )
    scale = StandardScaler(
        inputCol="numeric_features", outputCol=SCALED, withMean=False, withStd=True
    )
    return [fill, unscaled, scale]


def fit_preprocessor(
    training: DataFrame,
    categories: Sequence[str] = CATEGORICAL_FEATURES,
    numbers: Sequence[str] = NUMERIC_FEATURES,
) -> PipelineModel:
    """Fitted on the training rows alone, to be applied to any later rows."""
    features = VectorAssembler(
        inputCols=[*(f"{c}__one_hot" for c in categories), SCALED], outputCol="features"
    )
    stages = [*category_stages(categories), *number_stages(training, numbers), features]
    return Pipeline(stages=stages).fit(training)
