"""Outcome counts and ratios over a grid of decision thresholds."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.grid import steps_reached
from tidemark.functions.ratios import COUNTS, ratio_columns, share

SCORE = "probability_score"


def _scored_only(scored: DataFrame, score: str, label: str) -> DataFrame:
    return scored.filter(F.col(score).isNotNull() & F.col(label).isNotNull())


def threshold_counts(
    scored: DataFrame,
    thresholds: Sequence[float],
    by: Sequence[str] = (),
    score: str = SCORE,
    label: str = "label",
) -> DataFrame:
    """True/false positives/negatives at every threshold, in one pass over the rows.

    Rows are counted once, by how many grid points their score reaches; the counts at a threshold
    are sums over those buckets. The second step sees at most one row per grid point and group.
    Columns: ``by``, ``position`` in the grid as given, ``threshold``, and the four counts.
    """
    grid = sorted(set(map(float, thresholds)))
    actual = F.col(label) == 1.0
    buckets = (
        _scored_only(scored, score, label)
        .groupBy(*by, steps_reached(F.col(score), grid).alias("steps"))
        .agg(F.count_if(actual).alias("pos"), F.count_if(~actual).alias("neg"))
        .groupBy(*by)
        .agg(F.collect_list(F.struct("steps", "pos", "neg")).alias("buckets"))
    )
    points = F.array(
        *[
            F.struct(
                F.lit(position).alias("position"),
                F.lit(float(t)).alias("threshold"),
                F.lit(grid.index(float(t))).alias("rank"),
            )
            for position, t in enumerate(thresholds)
        ]
    )

    def total(part: str, predicted_positive: bool) -> Column:
        def counts(bucket: Column) -> Column:
            reached = bucket["steps"] > F.col("rank")
            return reached if predicted_positive else ~reached

        return F.aggregate(
            F.filter("buckets", counts), F.lit(0).cast("long"), lambda n, b: n + b[part]
        )

    return buckets.select(*by, "buckets", F.inline(points)).select(
        *by,
        "position",
        "threshold",
        total("pos", True).alias("true_positive"),
        total("neg", True).alias("false_positive"),
        total("neg", False).alias("true_negative"),
        total("pos", False).alias("false_negative"),
    )


def add_ratios(counts: DataFrame) -> DataFrame:
    """The five ratios and the row count beside the four outcome counts."""
    row_count = sum((F.col(name) for name in COUNTS[1:]), F.col(COUNTS[0]))
    return counts.withColumns({**ratio_columns(), "row_count": row_count})


def threshold_metrics(
    scored: DataFrame,
    thresholds: Sequence[float],
    by: Sequence[str] = (),
    score: str = SCORE,
    label: str = "label",
) -> DataFrame:
    return add_ratios(threshold_counts(scored, thresholds, by, score, label))


def apply_threshold(scored: DataFrame, threshold: float, score: str = SCORE) -> DataFrame:
    """``prediction`` is 1.0 from the threshold upwards, the threshold itself included."""
    return scored.withColumn("prediction", (F.col(score) >= float(threshold)).cast("double"))


def even_grid(points: int) -> list[float]:
    """``points`` scores spread evenly over [0, 1], both ends included."""
    if points < 2:
        raise ValueError(f"a curve needs at least 2 points, got {points}")
    return [i / (points - 1) for i in range(points)]


def roc_points(metrics: DataFrame) -> DataFrame:
    fpr = share(F.col("false_positive"), F.col("false_positive") + F.col("true_negative"))
    return metrics.select(
        "threshold",
        fpr.alias("false_positive_rate"),
        F.col("recall").alias("true_positive_rate"),
    ).orderBy("false_positive_rate", "true_positive_rate", "threshold")


def precision_recall_points(metrics: DataFrame) -> DataFrame:
    return metrics.select("threshold", "recall", "precision").orderBy("recall", "threshold")


def confusion_matrix(metrics: DataFrame, classes: Sequence[str]) -> DataFrame:
    """One row per actual class from one row of metrics."""
    lines = F.array(
        *[
            F.struct(
                F.lit(name).alias("actual_class"),
                F.col(negative).alias("predicted_on_time"),
                F.col(positive).alias("predicted_delayed"),
            )
            for name, negative, positive in (
                (classes[0], "true_negative", "false_positive"),
                (classes[1], "false_negative", "true_positive"),
            )
        ]
    )
    return metrics.select(F.inline(lines))
