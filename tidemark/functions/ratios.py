"""Classification ratios from the four outcome counts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

COUNTS = ("true_positive", "false_positive", "true_negative", "false_negative")


def share(part: Column, whole: Column) -> Column:
    """``part / whole``; 0 where the whole is 0."""
    return F.when(whole != 0, part / whole).otherwise(F.lit(0.0))


def ratio_columns() -> dict[str, Column]:
    """Ratios over the columns named in ``COUNTS``."""
    tp, fp, tn, fn = (F.col(name) for name in COUNTS)
    precision = share(tp, tp + fp)
    recall = share(tp, tp + fn)
    return {
        "accuracy": share(tp + tn, tp + fp + tn + fn),
        "precision": precision,
        "recall": recall,
        "f1": share(2.0 * precision * recall, precision + recall),
        "specificity": share(tn, tn + fp),
    }
