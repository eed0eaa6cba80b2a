"""The constant predictor that any model has to beat."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.sweep import add_ratios


def majority_class(labelled: DataFrame, label: str = "label") -> DataFrame:
    """One row: the more frequent class, 0 on a tie; fails when read if there are no rows."""
    rows, positives = F.col("rows"), F.col("positives")
    majority = F.when(
        rows == 0, F.raise_error(F.lit("no rows to take a majority class from"))
    ).otherwise((positives * 2 > rows).cast("int"))
    return labelled.agg(
        F.count("*").alias("rows"), F.count_if(F.col(label) == 1.0).alias("positives")
    ).select(majority.alias("predicted_class"))


def constant_baseline(
    labelled: DataFrame, predicted_class: int | Column, label: str = "label"
) -> DataFrame:
    """One row of metrics for predicting one class throughout.

    ``predicted_class`` is 0, 1, or a scalar subquery such as ``majority_class(df).scalar()``.
    A constant has no threshold and no ROC area.
    """
    if not isinstance(predicted_class, Column):
        predicted_class = F.lit(int(predicted_class))
    actual = F.col(label) == 1.0
    positive, zero = F.col("predicted_class") == 1, F.lit(0).cast("long")
    counts = (
        labelled.agg(F.count_if(actual).alias("pos"), F.count_if(~actual).alias("neg"))
        .withColumn("predicted_class", predicted_class)
        .select(
            F.when(positive, F.col("pos")).otherwise(zero).alias("true_positive"),
            F.when(positive, F.col("neg")).otherwise(zero).alias("false_positive"),
            F.when(positive, zero).otherwise(F.col("neg")).alias("true_negative"),
            F.when(positive, zero).otherwise(F.col("pos")).alias("false_negative"),
            "predicted_class",
        )
    )
    return add_ratios(counts).withColumns(
        {
            "threshold": F.lit(None).cast("double"),
            "roc_auc": F.lit(None).cast("double"),
        }
    )


def compare(model_row: DataFrame, baseline_row: DataFrame, split: str) -> DataFrame:
    """The model's row above the baseline's; settings a row lacks are null."""
    model = model_row.withColumns(
        {"model": F.lit("logistic_regression"), "split": F.lit(split)}
    )
    baseline = baseline_row.withColumns(
        {"model": F.lit("majority_class_baseline"), "split": F.lit(split)}
    )
    return model.unionByName(baseline, allowMissingColumns=True)
