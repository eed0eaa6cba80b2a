"""Counts that account for every input row."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark import spec


def reason_counts(staged: DataFrame) -> DataFrame:
    return staged.groupBy("rejection_reason").agg(F.count("*").alias("row_count"))


def _flights_per_reason(staged: DataFrame) -> DataFrame:
    """Rows and distinct flights per outcome, in one pass.

    Accepted rows are grouped by identity; rejected rows carry a null identity and so melt into one
    group per reason before the shuffle. The second step sees at most one row per outcome and task.
    """
    accepted = F.col("rejection_reason") == spec.ACCEPTED
    identity = [F.when(accepted, F.col(name)).alias(name) for name in spec.IDENTITY]
    per_flight = staged.groupBy("rejection_reason", *identity).agg(F.count("*").alias("copies"))
    return per_flight.groupBy("rejection_reason").agg(
        F.sum("copies").alias("rows"), F.count("*").alias("flights")
    )


def quality_report(staged: DataFrame, unique: DataFrame | None = None) -> DataFrame:
    """Input rows, rows per outcome, copies removed and unique flights.

    Where the ``unique`` rows are at hand as a written table, they are counted there and no identity
    is shuffled again.
    """
    if unique is None:
        per_reason = _flights_per_reason(staged)
    else:
        per_reason = reason_counts(staged).select(
            "rejection_reason",
            F.col("row_count").alias("rows"),
            unique.agg(F.count("*")).scalar().alias("flights"),
        )
    accepted = F.col("rejection_reason") == spec.ACCEPTED
    zero = F.lit(0).cast("long")
    lines = [
        ("input", F.lit("ALL_ROWS"), F.col("rows")),
        ("cleaning", F.col("rejection_reason"), F.col("rows")),
        (
            "deduplication",
            F.lit("DUPLICATE_ROWS_REMOVED"),
            F.when(accepted, F.col("rows") - F.col("flights")).otherwise(zero),
        ),
        (
            "final_clean_data",
            F.lit("ACCEPTED_UNIQUE_FLIGHTS"),
            F.when(accepted, F.col("flights")).otherwise(zero),
        ),
    ]
    structs = [
        F.struct(F.lit(stage).alias("stage"), reason.alias("reason"), n.alias("row_count"))
        for stage, reason, n in lines
    ]
    return (
        per_reason.select(F.inline(F.array(*structs)))
        .groupBy("stage", "reason")
        .agg(F.sum("row_count").alias("row_count"))
    )
