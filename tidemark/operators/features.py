"""Columns known before departure."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark import spec
from tidemark.functions.clock import cycle


def add_cycle(df: DataFrame, column: str, stem: str, period: float) -> DataFrame:
    sine, cosine = cycle(F.col(column), period)
    return df.withColumns({f"{stem}_sin": sine, f"{stem}_cos": cosine})


def add_schedule_features(df: DataFrame) -> DataFrame:
    """Weekday and month as categories; departure and arrival clock times as cycles."""
    df = df.withColumns(
        {
            "day_of_week_cat": F.col("day_of_week").cast("string"),
            "month_cat": F.col("month").cast("string"),
        }
    )
    df = add_cycle(df, "crs_dep_minutes", "sched_dep_time", spec.MINUTES_PER_DAY)
    return add_cycle(df, "crs_arr_minutes", "sched_arr_time", spec.MINUTES_PER_DAY)
