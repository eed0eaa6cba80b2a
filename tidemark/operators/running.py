"""Sums over everything earlier, without gathering the whole series in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Day numbers are counted from before the first date Spark can hold (0001-01-01 is day 1), so all
# dates up to 9999-12-31 fit into 22 bits.
DAY_BITS = 22
_DAYS_BEFORE_1970 = 719163


def day_number(date: str) -> F.Column:
    return F.unix_date(date) + F.lit(_DAYS_BEFORE_1970)


def totals_before_day(daily: DataFrame, date: str, values: Sequence[str]) -> DataFrame:
    """Per date, the sum of each value over all strictly earlier dates (null on the first).

    ``daily`` holds one row per date. Days are summed in blocks of 1, 2, 4, ... days, and the days
    before day ``n`` are the disjoint union of one block for each bit set in ``n``. So each date
    looks up at most 22 block sums by an equality join, and no step needs a global order.
    """
    bits = F.sequence(F.lit(0), F.lit(DAY_BITS - 1))
    numbered = daily.select(date, day_number(date).alias("_day"), *values)
    levels = numbered.withColumn("_level", F.explode(bits))
    block_of_day = F.expr("shiftright(_day, _level)")
    blocks = levels.groupBy("_level", block_of_day.alias("_block")).agg(
        *[F.sum(v).alias(v) for v in values]
    )
    lookups = (
        levels.filter("shiftright(_day, _level) % 2 = 1")
        .select(date, "_level", (block_of_day - 1).alias("_block"))
    )
    return (
        lookups.join(blocks, ["_level", "_block"], "left")
        .groupBy(date)
        .agg(*[F.sum(v).alias(v) for v in values])
    )
