"""Clock and calendar expressions."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F


def is_hhmm(column: Column) -> Column:
    """True for a clock reading 0000..2359 or 2400; false for null."""
    reading = column.between(0, 2359) & (column % 100 < 60)
    return F.coalesce(reading | (column == 2400), F.lit(False))


def minutes_of_day(column: Column) -> Column:
    """HHMM to minutes after midnight; 2400 is midnight again."""
    minutes = F.floor(column / 100) * 60 + column % 100
    return (minutes % 1440).cast("double")


def iso_weekday(column: Column) -> Column:
    """Monday is 1, Sunday is 7."""
    return F.weekday(column) + 1


def cycle(column: Column, period: float) -> tuple[Column, Column]:
    """Sine and cosine of a value's place in a cycle of the given length."""
    angle = F.lit(2.0 * math.pi) * column / F.lit(float(period))
    return F.sin(angle), F.cos(angle)
