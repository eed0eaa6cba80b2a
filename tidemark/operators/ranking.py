"""Area under the ROC curve."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.ordering import number_rows
from tidemark.operators.sweep import SCORE


def roc_auc(
    scored: DataFrame, by: Sequence[str] = (), score: str = SCORE, label: str = "label"
) -> DataFrame:
    """The exact area: the share of (positive, negative) pairs ranked rightly, ties counting half.

    Rows are first reduced to counts per distinct score, so equal scores cost nothing however many
    they are. The distinct scores are range-partitioned into slices of similar size; each slice is
    summed on its own, and the slices (at most one per shuffle partition and group) are then folded
    in order. Without negatives the area is 1, else without positives it is 0, as in Spark's own
    evaluator; without rows it is null.
    """
    actual = F.col(label) == 1.0
    per_score = (
        scored.filter(F.col(score).isNotNull() & F.col(label).isNotNull())
        .groupBy(*by, score)
        .agg(
            F.count_if(actual).cast("double").alias("pos"),
            F.count_if(~actual).cast("double").alias("neg"),
        )
    )
    sliced = per_score.repartitionByRange(*by, score).withColumn("slice", F.spark_partition_id())
    lower = (
        Window.partitionBy(*by, "slice")
        .orderBy(score)
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    below = F.coalesce(F.sum("neg").over(lower), F.lit(0.0))
    slices = (
        sliced.withColumn("pairs", F.col("pos") * (below + F.col("neg") / 2))
        .groupBy(*by, "slice")
        .agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"), F.sum("pairs").alias("pairs"))
        .groupBy(*by)
        .agg(F.sort_array(F.collect_list(F.struct("slice", "pos", "neg", "pairs"))).alias("slices"))
    )
    zero = F.struct(F.lit(0.0).alias("pos"), F.lit(0.0).alias("neg"), F.lit(0.0).alias("pairs"))
    total = F.aggregate(
        "slices",
        zero,
        lambda t, s: F.struct(
            (t["pos"] + s["pos"]).alias("pos"),
            (t["neg"] + s["neg"]).alias("neg"),
            (t["pairs"] + s["pairs"] + s["pos"] * t["neg"]).alias("pairs"),
        ),
    )
    pos, neg, pairs = (F.col("total")[part] for part in ("pos", "neg", "pairs"))
    area = (
        F.when(pos + neg == 0, F.lit(None))
        .when(neg == 0, F.lit(1.0))
        .when(pos == 0, F.lit(0.0))
        .otherwise(pairs / (pos * neg))
    )
    return slices.withColumn("total", total).select(*by, area.alias("roc_auc"))


def binned_roc_auc(
    scored: DataFrame,
    by: Sequence[str] = (),
    score: str = SCORE,
    label: str = "label",
    bins: int = 1000,
) -> DataFrame:
    """The area over a curve of about ``bins`` points, as Spark's own evaluator draws it.

    The distinct scores of a group, highest first, are put together by so many that at least
    ``bins`` points remain; with fewer than twice as many scores, each is a point. Between points
    the curve is straight. Bins are cut over the whole group, where the evaluator begins anew in
    every partition, so this result does not depend on partitions. The cases without positives or
    negatives are those of :func:`roc_auc`.
    """
    if bins < 1:
        raise ValueError(f"a curve needs at least 1 bin, got {bins}")
    actual = F.col(label) == 1.0
    per_score = (
        scored.filter(F.col(score).isNotNull() & F.col(label).isNotNull())
        .groupBy(*by, score)
        .agg(F.count_if(actual).alias("pos"), F.count_if(~actual).alias("neg"))
    )
    placed = number_rows(per_score, [F.desc(score)], by, "place", "scores")
    together = F.greatest(F.floor(F.col("scores") / F.lit(bins)), F.lit(1))
    points = (
        placed.groupBy(*by, F.floor(F.col("place") / together).alias("bin"))
        .agg(F.sum("pos").cast("double").alias("pos"), F.sum("neg").cast("double").alias("neg"))
        # At most twice as many points as bins for a group.
        .groupBy(*by)
        .agg(F.sort_array(F.collect_list(F.struct("bin", "pos", "neg"))).alias("points"))
    )
    zero = F.struct(*[F.lit(0.0).alias(name) for name in ("pos", "neg", "area")])
    summed = F.aggregate(
        "points",
        zero,
        lambda t, p: F.struct(
            (t["pos"] + p["pos"]).alias("pos"),
            (t["neg"] + p["neg"]).alias("neg"),
            (t["area"] + p["neg"] * (t["pos"] + p["pos"] / 2)).alias("area"),
        ),
    )
    pos, neg, area = (F.col("summed")[part] for part in ("pos", "neg", "area"))
    share = F.when(pos + neg == 0, None).when(neg == 0, 1.0).when(pos == 0, 0.0).otherwise(area / (pos * neg))
    return points.withColumn("summed", summed).select(*by, share.alias("roc_auc"))
