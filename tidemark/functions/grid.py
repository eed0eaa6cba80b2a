"""Placing a value on an ascending grid."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def steps_reached(value: Column, grid: Sequence[float]) -> Column:
    """How many points of an ascending grid are at or below the value.

    A bisection written as nested conditions: about log2(n) comparisons per row, each against the
    grid value itself, so ``value >= point`` holds exactly as written.
    """

    def bisect(low: int, high: int) -> Column:
        if low == high:
            return F.lit(low)
        middle = (low + high) // 2
        return F.when(value >= F.lit(float(grid[middle])), bisect(middle + 1, high)).otherwise(
            bisect(low, middle)
        )

    return bisect(0, len(grid))
