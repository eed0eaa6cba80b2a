"""From staged rows to the accepted table: one labelled row per flight."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark import spec
from tidemark.functions.clock import iso_weekday, minutes_of_day


def keep_outcome(staged: DataFrame, outcome: str, columns: Sequence[str]) -> DataFrame:
    """Rows with one outcome. As a plain filter this would be pushed down to the scan, the whole
    ladder and all its parsing with it, and every text would be parsed many times over; a row that
    yields a one-row or an empty list keeps the parsing where it is.
    """
    row = F.when(F.col("rejection_reason") == outcome, F.array(F.struct(*columns)))
    return staged.select(F.inline(row))


def keep_first(df: DataFrame, identity: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per identity: the least by ``order``.

    Spark limits each group to its first row before the shuffle as well as after it, so a group of
    copies that holds much of the table shrinks to one row per input partition first.
    """
    copies = Window.partitionBy(*identity).orderBy(*order)
    return df.withColumn("_copy", F.row_number().over(copies)).filter("_copy = 1").drop("_copy")


def surrogate_key(identity: Sequence[str]) -> F.Column:
    """SHA-256 over the identity as ``|``-joined text, null written as empty."""
    parts = [F.coalesce(F.col(name).cast("string"), F.lit("")) for name in identity]
    return F.sha2(F.concat_ws("|", *parts), 256)


def unique_rows(staged: DataFrame, written: bool = False) -> DataFrame:
    """Accepted rows without copies: the base columns alone, from which all others derive.

    This is the table worth writing out when it is read more than once. On a ``written`` staged
    table the outcome is a plain column, whose filter belongs into the scan.
    """
    columns = [*spec.IDENTITY, *spec.COPY_ORDER]
    if written:
        base = staged.filter(F.col("rejection_reason") == spec.ACCEPTED).select(*columns)
    else:
        base = keep_outcome(staged, spec.ACCEPTED, columns)
    # Rows are sorted by the identity; columns with many values first, so that few comparisons go
    # beyond the first two.
    many = ("flight_number", "crs_dep_time")
    identity = sorted(spec.IDENTITY, key=lambda name: many.index(name) if name in many else 9)
    return keep_first(base, identity, spec.COPY_ORDER)


def derive_columns(unique: DataFrame) -> DataFrame:
    """The accepted table: key, label, route, clock minutes and calendar fields added."""
    return unique.withColumns(
        {
            "flight_key": surrogate_key(spec.IDENTITY),
            "route": F.concat_ws("_", "origin", "dest"),
            "crs_dep_minutes": minutes_of_day(F.col("crs_dep_time")),
            "crs_arr_minutes": minutes_of_day(F.col("crs_arr_time")),
            "month": F.month("flight_date"),
            "day_of_week": iso_weekday(F.col("flight_date")),
            "label": (F.col("arr_delay") >= spec.LATE_MINUTES).cast("double"),
        }
    ).select(*spec.ACCEPTED_COLUMNS)


def accepted_rows(staged: DataFrame) -> DataFrame:
    return derive_columns(unique_rows(staged))
