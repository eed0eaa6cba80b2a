"""The most confident mistakes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.sweep import SCORE
from tidemark.spec import PREDICTION_COLUMNS

# --- Fixed values: the two kinds of mistakes. ---
FALSE_POSITIVE, FALSE_NEGATIVE = "false_positive", "false_negative"


def top_errors(
    predicted: DataFrame,
    per_type: int = 100,
    columns: Sequence[str] = PREDICTION_COLUMNS,
    key: str = "flight_key",
    score: str = SCORE,
) -> DataFrame:
    """The ``per_type`` most confident false positives and false negatives, ties by key.

    One pass: the rank within each kind of mistake limits every task to its own best ``per_type``
    rows of a kind before the one shuffle.
    """
    missed = F.col("label") == 1.0
    wrong = predicted.filter(F.col("prediction") == 1.0 - F.col("label")).select(
        *columns,
        F.when(missed, FALSE_NEGATIVE).otherwise(FALSE_POSITIVE).alias("error_type"),
        F.when(missed, 1.0 - F.col(score)).otherwise(F.col(score)).alias("error_confidence"),
    )
    best = Window.partitionBy("error_type").orderBy(F.desc("error_confidence"), key)
    ranked = wrong.withColumn("_rank", F.row_number().over(best))
    return ranked.filter(F.col("_rank") <= per_type).drop("_rank").orderBy(
        F.desc("error_type"), F.desc("error_confidence"), key
    )
