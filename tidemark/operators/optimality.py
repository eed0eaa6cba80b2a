"""Whether fitted coefficients are where the penalised loss is flat.

The loss of a logistic regression with an L2 penalty is convex, so a zero gradient is proof of the
fit, whatever solver found it. The gradient of slot j is the mean of (probability - label) x feature
over the training rows, plus penalty x coefficient; the intercept is a slot that is 1 in every row
and bears no penalty. How large a gradient matters follows from the curvature, the mean of
probability x (1 - probability) x feature squared, plus the penalty: gradient over curvature is how
far the coefficient lies from the least loss along its slot.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import numpy as np
from pyspark.ml.classification import LogisticRegressionModel
from pyspark.ml.functions import vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.logistic import positive_probability
from tidemark.operators.newton import Blocks, slot_sums
from tidemark.spec import CATEGORICAL_FEATURES, NUMERIC_FEATURES

INTERCEPT = -1


def gradients(
    models: Mapping[float, LogisticRegressionModel],
    features: DataFrame,
    blocks: Blocks | None = None,
) -> DataFrame:
    """``reg_param, slot, coefficient, gradient, curvature, weight`` of every slot of every model.

    ``weight`` is the mean of the feature; slot -1 is the intercept. One pass over ``label, features``: the sums over the slots of a row
    are Spark's own vector sums, so tasks send one vector per model. Rows without label are left out.
    Where the rows are written in ``blocks`` already, these are read instead, by numpy.
    """
    if blocks:
        return _gradients_of_blocks(models, blocks)
    rows = features.filter(F.col("label").isNotNull()).select("label", "features")
    scores = {reg: f"p{i}" for i, reg in enumerate(models)}
    for reg, model in models.items():
        alone = model.copy().setProbabilityCol("p").setRawPredictionCol("").setPredictionCol("")
        rows = alone.transform(rows).withColumn(scores[reg], positive_probability("p")).drop("p")
    sums = {
        "row_count": F.count("*"),
        "labels": F.sum("label"),
        "features": Summarizer.sum(F.col("features")),
        "label_sums": Summarizer.sum(F.col("features"), F.col("label")),
        **{f"sum_{p}": F.sum(p) for p in scores.values()},
        **{f"sums_{p}": Summarizer.sum(F.col("features"), F.col(p)) for p in scores.values()},
        **{f"bend_{p}": F.sum(F.col(p) * (1 - F.col(p))) for p in scores.values()},
        **{
            f"bends_{p}": Summarizer.normL2(F.col("features"), F.col(p) * (1 - F.col(p)))
            for p in scores.values()
        },
    }
    # Grouped, so that no rows give no sums.
    total = rows.groupBy(F.lit("all")).agg(*[value.alias(name) for name, value in sums.items()])
    per_model = F.array(
        *[
            F.struct(
                F.lit(float(reg)).alias("reg_param"),
                F.col(f"sum_{p}").alias("scores"),
                vector_to_array(f"sums_{p}").alias("score_sums"),
                F.col(f"bend_{p}").alias("bend"),
                vector_to_array(f"bends_{p}").alias("bends"),
            )
            for reg, p in scores.items()
        ]
    )
    summed = total.select(
        "row_count", "labels", vector_to_array("label_sums").alias("label_sums"),
        vector_to_array("features").alias("totals"), F.inline(per_model),
    )
    fitted = features.sparkSession.createDataFrame(
        [(float(reg), float(m.intercept), m.coefficients.toArray().tolist())
         for reg, m in models.items()],
        "reg_param double, intercept double, coefficients array<double>",
    )
    n = F.col("row_count")
    slots = F.transform(
        F.arrays_zip("coefficients", "score_sums", "label_sums", "bends", "totals"),
        lambda s, at: F.struct(
            at.alias("slot"),
            s["coefficients"].alias("coefficient"),
            ((s["score_sums"] - s["label_sums"]) / n + F.col("reg_param") * s["coefficients"])
            .alias("gradient"),
            (s["bends"] * s["bends"] / n + F.col("reg_param")).alias("curvature"),
            (s["totals"] / n).alias("weight"),
        ),
    )
    constant = F.struct(
        F.lit(INTERCEPT).alias("slot"),
        F.col("intercept").alias("coefficient"),
        ((F.col("scores") - F.col("labels")) / n).alias("gradient"),
        (F.col("bend") / n).alias("curvature"),
        F.lit(1.0).alias("weight"),
    )
    joined = summed.join(fitted, "reg_param")
    return joined.select("reg_param", F.inline(F.concat(F.array(constant), slots)))


def _gradients_of_blocks(
    models: Mapping[float, LogisticRegressionModel], blocks: Blocks
) -> DataFrame:
    """The same table; sums over the rows of every slot come to the driver, as the models did."""
    points = [(float(m.intercept), m.coefficients.toArray()) for m in models.values()]
    totals, labelled, scored = slot_sums(blocks, points)
    n, found = totals[0], []
    for (reg, (intercept, weights)), (scores, bends) in zip(zip(models, points), scored):
        own = np.append(intercept, weights)
        penalty = np.append(0.0, np.full(len(weights), float(reg)))
        columns = (own, (scores - labelled) / n + penalty * own, bends / n + penalty, totals / n)
        lists = (column.tolist() for column in columns)
        found += zip([float(reg)] * len(own), range(INTERCEPT, len(weights)), *lists)
    return blocks.frame.sparkSession.createDataFrame(
        found,
        "reg_param double, slot int, coefficient double, gradient double, curvature double, "
        "weight double",
    )


def is_flat(step: float, gradient: float = 1e-7) -> Column:
    """Whether the least loss along the slot is less than ``step`` of the coefficient away.

    A gradient of at most ``gradient`` is flat as well: a slot that no row has, or whose rows all
    have one label, has no curvature left.
    """
    near = F.abs("gradient") <= F.lit(float(step)) * F.col("curvature")
    return near | (F.abs("gradient") <= F.lit(float(gradient)))


def explained_score(
    rows: DataFrame,
    coefficients: DataFrame,
    intercept: float,
    scales: DataFrame,
    categories: Sequence[str] = CATEGORICAL_FEATURES,
    numbers: Sequence[str] = NUMERIC_FEATURES,
    name: str = "explained_score",
) -> DataFrame:
    """Rows with the probability that follows from the coefficients' names.

    Every category adds the coefficient named by its value, or that of unknown values; every number,
    filled where missing, adds its coefficient times the number over its deviation. ``scales`` has
    one row per number: ``feature, fill, deviation``. Nothing of the fitted stages is used.
    """
    named = coefficients.select("feature_name", "coefficient")
    known = {row["feature_name"]: row["coefficient"] for row in named.filter(
        F.col("feature_name").startswith("numeric__")
        | F.col("feature_name").endswith("__one_hot___unknown")).collect()}
    margin = F.lit(float(intercept))
    for category in categories:
        prefix = f"{category}__one_hot_"
        own = named.filter(F.col("feature_name").startswith(prefix)).select(
            F.substr("feature_name", F.lit(len(prefix) + 1)).alias(f"{category}__value"),
            F.col("coefficient").alias(f"{category}__weight"),
        )
        rows = rows.join(own, rows[category].cast("string") == own[f"{category}__value"], "left")
        unknown = F.lit(known[f"{prefix}__unknown"])
        margin = margin + F.coalesce(F.col(f"{category}__weight"), unknown)
    by_number = {row["feature"]: row for row in scales.collect()}
    for number in numbers:
        scale = by_number[number]
        if scale["deviation"]:
            filled = F.coalesce(F.nanvl(F.col(number), F.lit(None)), F.lit(scale["fill"]))
            weight = known[f"numeric__{number}"] / scale["deviation"]
            margin = margin + F.lit(float(weight)) * filled
    added = [f"{c}__{part}" for c in categories for part in ("value", "weight")]
    return rows.withColumn(name, 1.0 / (1.0 + F.exp(-margin))).drop(*added)
