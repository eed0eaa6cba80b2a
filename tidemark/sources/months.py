"""The months an input is expected to cover."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def month_calendar(spark: SparkSession, start: dt.date, end: dt.date) -> DataFrame:
    """One row per month from the month of ``start`` to the month of ``end``."""
    first = F.lit(start.replace(day=1))
    months = F.sequence(first, F.lit(end), F.expr("interval 1 month"))
    return spark.range(1).select(F.explode(months).alias("month_start"))


def month_coverage(
    dated: DataFrame, start: dt.date, end: dt.date, date: str = "flight_date"
) -> DataFrame:
    """Every expected month with the rows found in it; ``present`` is false where there are none."""
    found = dated.groupBy(F.trunc(date, "month").alias("month_start")).agg(
        F.count("*").alias("row_count")
    )
    rows = F.coalesce("row_count", F.lit(0).cast("long"))
    return (
        month_calendar(dated.sparkSession, start, end)
        .join(found, "month_start", "left")
        .select("month_start", rows.alias("row_count"), (rows > 0).alias("present"))
    )
