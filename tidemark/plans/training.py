"""Fitting on the training period, choosing on validation, scoring the test period."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.ml.classification import LogisticRegressionModel
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from tidemark import spec
from tidemark.operators.logistic import (
    carried,
    coefficients,
    fit_logistic,
    fit_penalties,
    grid_metrics,
    score_rows,
)
from tidemark.operators.newton import in_blocks
from tidemark.operators.optimality import gradients
from tidemark.operators.preprocess import fit_preprocessor
from tidemark.operators.selection import select_best
from tidemark.operators.sweep import apply_threshold
from tidemark.sources.shared import save_shared


@dataclass(frozen=True)
class Fitted:
    grid: DataFrame
    best: Row
    preprocessor: PipelineModel
    model: LogisticRegressionModel
    predictions: DataFrame
    coefficients: DataFrame
    # Of every penalty on the training period, and of the returned model on what it was fitted on.
    grid_gradients: DataFrame
    gradients: DataFrame


def _model_input(preprocessor: PipelineModel, rows: DataFrame) -> DataFrame:
    return preprocessor.transform(rows).select("label", "features")


def fit_run(featured: DataFrame, config: spec.RunConfig) -> Fitted:
    """``featured`` is read once per fitting step, so it should be written by split.

    What comes to the driver is the best grid row and the models themselves.
    """
    train, validation, test = (featured.filter(F.col("split") == name) for name in spec.SPLITS)
    grid = config.grid

    preprocessor = fit_preprocessor(train)
    train_input = _model_input(preprocessor, train)
    # Scored once, so it is not written.
    validation_input = _model_input(preprocessor, validation)
    # Written once for the fit and its proof.
    with in_blocks(train_input) as blocks:
        models = fit_penalties(train_input, grid.reg_params, grid.max_iterations, blocks=blocks)
        tried_gradients = save_shared(gradients(models, train_input, blocks), "gradients")
    tried = save_shared(grid_metrics(models, validation_input, grid), "grid")
    best = select_best(tried, grid.thresholds).first()
    reg_param = best["reg_param"]
    model = models[reg_param]
    own_gradients = tried_gradients.filter(F.col("reg_param") == reg_param)

    if config.refit:
        both = train.unionByName(validation)
        earlier, preprocessor = preprocessor, fit_preprocessor(both)
        both_input = _model_input(preprocessor, both)
        # The fit on the training period is near that on both.
        start = carried(model, earlier, preprocessor)
        with in_blocks(both_input) as blocks:
            model = fit_logistic(both_input, reg_param, grid.max_iterations, start, blocks)
            own_gradients = save_shared(
                gradients({reg_param: model}, both_input, blocks), "gradients"
            )

    features = preprocessor.transform(test)
    scored = apply_threshold(score_rows(model, features).drop("prediction"), best["threshold"])
    predictions = save_shared(
        scored.select(*spec.PREDICTION_COLUMNS), "predictions"
    )
    return Fitted(
        grid=tried,
        best=best,
        preprocessor=preprocessor,
        model=model,
        predictions=predictions,
        coefficients=coefficients(model, preprocessor),
        grid_gradients=tried_gradients,
        gradients=own_gradients,
    )
