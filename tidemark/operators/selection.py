"""Choosing among rows of a validation grid."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def best_per_group(grid: DataFrame, group: str = "reg_param", metric: str = "f1") -> DataFrame:
    """The row with the highest metric in each group, the earliest grid position on a tie."""
    best = F.max_by(
        F.struct(*grid.columns), F.struct(F.col(metric), -F.col("position"))
    ).alias("best")
    return grid.groupBy(group).agg(best).select("best.*")


def select_best(grid: DataFrame, thresholds: Sequence[float]) -> DataFrame:
    """The one best row: highest f1, then precision, recall and area, then the threshold nearest
    to one half, then the smallest penalty, then the earliest grid position.

    ``threshold_at_grid_edge`` tells that the best may lie outside the grid.
    """
    order = [F.desc(name) for name in ("f1", "precision", "recall", "roc_auc")]
    order += [F.abs(F.col("threshold") - 0.5), F.col("reg_param"), F.col("position")]
    edge = F.col("threshold").isin(float(min(thresholds)), float(max(thresholds)))
    return grid.orderBy(*order).limit(1).withColumn("threshold_at_grid_edge", edge)
