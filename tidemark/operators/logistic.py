"""Logistic regression: fitting, scoring, grid search and coefficients."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from contextlib import nullcontext

import numpy as np
from pyspark.ml import PipelineModel
from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.common import _py2java
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.newton import Blocks, fit_points, in_blocks
from tidemark.operators.ranking import roc_auc
from tidemark.operators.sweep import SCORE, threshold_metrics
from tidemark.sources.shared import save_shared
from tidemark.spec import ModelGrid


# Coefficients and intercept.
Point = tuple[np.ndarray, float]


def fit_logistic(
    training: DataFrame,
    reg_param: float,
    max_iterations: int = 100,
    start: Point | None = None,
    blocks: Blocks | None = None,
) -> LogisticRegressionModel:
    """Binomial, L2 only. The inputs are scaled already, so the solver does not scale again."""
    starts = {reg_param: start} if start else None
    return fit_penalties(training, [reg_param], max_iterations, starts, blocks)[reg_param]


def fit_penalties(
    training: DataFrame,
    reg_params: Sequence[float],
    max_iterations: int = 100,
    starts: Mapping[float, Point] | None = None,
    blocks: Blocks | None = None,
) -> dict[float, LogisticRegressionModel]:
    """The fit of every penalty, all in the same few passes; see :mod:`tidemark.operators.newton`.

    ``starts`` has points near which the least loss may lie; where it lies does not depend on them.
    ``blocks`` are the training rows where they are written already (``in_blocks``).

    What those do not cover, vectors of more than 2,000 slots or labels of one class, Spark's own
    solver fits, one penalty after the other, in up to ``max_iterations`` passes each.
    """
    estimators = {
        reg: LogisticRegression(
            family="binomial",
            regParam=float(reg),
            elasticNetParam=0.0,
            maxIter=int(max_iterations),
            standardization=False,
        )
        for reg in reg_params
    }
    with nullcontext(blocks) if blocks else in_blocks(training) as given:
        if given is None:
            return {reg: estimator.fit(training) for reg, estimator in estimators.items()}
        points = fit_points(given, reg_params, int(max_iterations), starts)
    return {reg: _model(training.sparkSession, estimators[reg], *points[reg]) for reg in points}


def _model(
    spark: SparkSession, estimator: LogisticRegression, coefficients: np.ndarray,
    intercept: float, steps: int,
) -> LogisticRegressionModel:
    """Spark's model with the given coefficients and the estimator's parameters."""
    kind = spark._jvm.org.apache.spark.ml.classification.LogisticRegressionModel
    vector = _py2java(spark.sparkContext, Vectors.dense(coefficients))
    model = LogisticRegressionModel(kind(estimator.uid, vector, float(intercept)))
    for param, value in estimator.extractParamMap().items():
        if model.hasParam(param.name):
            model.set(model.getParam(param.name), value)
    model.steps_taken = steps
    return model


def iterations(model: LogisticRegressionModel) -> int:
    """How many steps the fit took."""
    return model.summary.totalIterations if model.hasSummary else model.steps_taken


def positive_probability(column: str = "probability") -> Column:
    return vector_to_array(F.col(column))[1]


def with_score(predictions: DataFrame) -> DataFrame:
    """The probability of class 1 as a plain column; unchanged if it is there already."""
    if SCORE in predictions.columns:
        return predictions
    return predictions.withColumn(SCORE, positive_probability())


def score_rows(model: LogisticRegressionModel, features: DataFrame) -> DataFrame:
    return with_score(model.transform(features))


def score_grid(
    models: Mapping[float, LogisticRegressionModel], features: DataFrame
) -> DataFrame:
    """``reg_param, label, probability_score`` of every model, in one pass over the rows."""
    scored = features
    names = {}
    for i, (reg_param, model) in enumerate(models.items()):
        names[reg_param] = f"probability_{i}"
        alone = model.copy().setProbabilityCol(names[reg_param])
        scored = alone.setRawPredictionCol("").setPredictionCol("").transform(scored)
    per_model = F.array(
        *[
            F.struct(
                F.lit(float(reg_param)).alias("reg_param"),
                positive_probability(name).alias(SCORE),
            )
            for reg_param, name in names.items()
        ]
    )
    return scored.select("label", F.inline(per_model))


def scored_grid_metrics(
    scored: DataFrame, reg_params: Sequence[float], thresholds: Sequence[float]
) -> DataFrame:
    """One row per penalty and threshold from ``reg_param, label, probability_score``, a table that
    is read twice; ``position`` numbers the rows, penalties outermost."""
    metrics = threshold_metrics(scored, thresholds, by=["reg_param"])
    areas = roc_auc(scored, by=["reg_param"])
    order = F.array(*[F.lit(float(reg_param)) for reg_param in reg_params])
    outer = F.array_position(order, F.col("reg_param")) - 1
    position = (outer * len(thresholds) + F.col("position")).cast("int")
    return metrics.join(areas, "reg_param").withColumn("position", position)


def grid_metrics(
    models: Mapping[float, LogisticRegressionModel],
    validation: DataFrame,
    grid: ModelGrid,
) -> DataFrame:
    """The grid of all models over the validation rows, which are scored once and written."""
    scored = save_shared(score_grid(models, validation), "scored-grid")
    return scored_grid_metrics(scored, list(models), grid.thresholds).withColumns(
        {"elastic_net_param": F.lit(0.0), "max_iterations": F.lit(grid.max_iterations)}
    )


# --- Fixed values: what the sign of a coefficient is called. ---
DIRECTIONS = {1: "higher_delay_risk", -1: "lower_delay_risk", 0: "neutral"}


def slot_names(preprocessor: PipelineModel) -> list[str]:
    """What each slot of the feature vector stands for, read off the fitted stages.

    The indexer holds every category's values by slot; one more slot per category takes all other
    values. The numbers follow in the order in which the imputer took them.
    """
    stages = {type(stage).__name__: stage for stage in preprocessor.stages}
    indexed, encoded = stages["StringIndexerModel"], stages["OneHotEncoderModel"]
    names = [
        f"{column}_{value}"
        for column, values in zip(encoded.getOutputCols(), indexed.labelsArray)
        for value in (*values, "__unknown")
    ]
    return names + [f"numeric__{name}" for name in stages["ImputerModel"].getInputCols()]


def carried(
    model: LogisticRegressionModel, fitted: PipelineModel, other: PipelineModel
) -> Point:
    """The model's coefficients and intercept in the slots of another preprocessor, 0 in slots that are
    new: a point to begin from, as numbers are divided by other deviations there."""
    weights = dict(zip(slot_names(fitted), model.coefficients.toArray()))
    numbers = len(_deviations(other))
    ratios = np.divide(_deviations(other), _deviations(fitted), out=np.zeros(numbers),
                       where=_deviations(fitted) > 0)
    found = np.array([weights.get(name, 0.0) for name in slot_names(other)])
    found[len(found) - numbers :] *= ratios
    return found, float(model.intercept)


def _deviations(preprocessor: PipelineModel) -> np.ndarray:
    stages = {type(stage).__name__: stage for stage in preprocessor.stages}
    return stages["StandardScalerModel"].std.toArray()


def coefficients(model: LogisticRegressionModel, preprocessor: PipelineModel) -> DataFrame:
    """Every coefficient with its slot name, size and direction, largest first.

    The model holds its coefficients on the driver, so that is where the table starts.
    """
    weights = model.coefficients.toArray().tolist()
    table = SparkSession.active().createDataFrame(
        list(zip(range(len(weights)), slot_names(preprocessor), weights, strict=True)),
        "feature_index int, feature_name string, coefficient double",
    )
    called = F.create_map(*[F.lit(x) for pair in DIRECTIONS.items() for x in pair])
    return table.select(
        "*",
        F.abs("coefficient").alias("absolute_coefficient"),
        called[F.signum("coefficient").cast("int")].alias("direction"),
    ).orderBy(F.desc("absolute_coefficient"), "feature_index")


def fixed_score(columns: Mapping[str, float], intercept: float) -> Column:
    """Probability under given coefficients, as a plain expression."""
    margin = F.lit(float(intercept))
    for name, weight in columns.items():
        margin = margin + F.lit(float(weight)) * F.col(name)
    return 1.0 / (1.0 + F.exp(-margin))
