"""Slots of categories and fill values of numbers as tables, for any number of distinct values."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.ordering import lower_quantile, number_rows
from tidemark.sources.shared import save_shared
from tidemark.spec import CATEGORICAL_FEATURES, NUMERIC_FEATURES

# The sketch's ranks are off by at most one row in ``ACCURACY``; the median lies well within a
# bracket of so many times that to both sides.
ACCURACY = 10_000
BRACKET = 5 / ACCURACY
# Values are counted in so many buckets of one width; a sketch is made only of numbers of which more
# than this share lies in the bucket of the median.
BUCKETS = 4096
CROWDED = 0.01


def _long(rows: DataFrame, columns: Sequence[str], kind: str) -> DataFrame:
    """``feature, value`` of every named column of every row."""
    pairs = [
        F.struct(F.lit(name).alias("feature"), F.col(name).cast(kind).alias("value"))
        for name in columns
    ]
    return rows.select(F.inline(F.array(*pairs)))


def rank_slots(rows: DataFrame, categories: Sequence[str] = CATEGORICAL_FEATURES) -> DataFrame:
    """``feature, value, row_count, slot, width``: slots from 0 by falling count, then by value.

    Nulls get no slot. ``width`` is the feature's number of slots with values, which is also the
    slot of all values that are not listed. No value comes to the driver.
    """
    values = _long(rows, categories, "string").filter(F.col("value").isNotNull())
    counted = values.groupBy("feature", "value").agg(F.count("*").alias("row_count"))
    order = [F.desc("row_count"), F.asc("value")]
    return number_rows(counted, order, ["feature"], name="slot", total="width")


def attach_slots(
    rows: DataFrame, slots: DataFrame, categories: Sequence[str] = CATEGORICAL_FEATURES
) -> DataFrame:
    """``<category>__index`` of every row, from a written table of slots.

    One equality join per category: Spark broadcasts a small one, and splits a value that many rows
    hold, since the table of slots has each value once.
    """
    # One number per category comes to the driver.
    widths = dict(map(tuple, slots.groupBy("feature").agg(F.max("width")).collect()))
    for name in categories:
        own = slots.filter(F.col("feature") == name).select(
            F.col("value").alias(f"{name}__value"), F.col("slot").alias(f"{name}__slot")
        )
        joined = rows.join(own, rows[name].cast("string") == own[f"{name}__value"], "left")
        slot = F.coalesce(F.col(f"{name}__slot"), F.lit(widths.get(name, 0)))
        rows = joined.withColumn(f"{name}__index", slot.cast("double")).drop(
            f"{name}__value", f"{name}__slot"
        )
    return rows


def exact_medians(rows: DataFrame, numbers: Sequence[str] = NUMERIC_FEATURES) -> DataFrame:
    """``feature, value, n``: the lower median of each number, nulls and NaN left out.

    A number without values has no row. ``rows`` are read three times, four where values crowd. Counts
    by bucket, or a sketch, tell between which two of its values the median lies; beyond these
    values are only counted, so few of them are shuffled. The counts, 4,097 per column at most,
    come to the driver.
    """
    given = {
        name: F.nanvl(F.col(name).cast("double"), F.lit(None).cast("double")) for name in numbers
    }
    bounds = _bounds(rows, given)
    if not bounds:
        return rows.sparkSession.createDataFrame([], "feature string, value double, n long")
    # Every value below the bracket counts as its lower end, every one above as its upper end.
    clamped = [
        F.struct(
            F.lit(at).alias("at"),
            F.when(given[name].isNotNull(),
                   F.greatest(F.least(given[name], F.lit(high)), F.lit(low))).alias("value"),
        )
        for at, (name, (low, high)) in enumerate(bounds.items())
    ]
    values = rows.select(F.inline(F.array(*clamped))).filter(F.col("value").isNotNull())
    counted = values.groupBy("at", "value").agg(F.count("*").alias("row_count"))
    names = F.array(*[F.lit(name) for name in bounds])
    return lower_quantile(counted, "value", "row_count", 0.5, ["at"]).select(
        names[F.col("at")].alias("feature"), "value", "n"
    )


def _bounds(rows: DataFrame, given: Mapping[str, Column]) -> dict[str, tuple[float, float]]:
    """Per column two of its values between which the lower median lies, columns without values left
    out."""
    ends = rows.agg(
        *[F.struct(F.min(value), F.max(value)).alias(name) for name, value in given.items()]
    ).first()
    bounds = {name: tuple(ends[name]) for name in given if ends[name][0] is not None}
    buckets = {}
    for at, (name, (low, high)) in enumerate(bounds.items()):
        scale = BUCKETS / (high - low) if high > low else math.inf
        if 0 < scale < math.inf:
            # Rises with the value, whatever is lost to rounding.
            bucket = F.floor((given[name] - F.lit(low)) * F.lit(scale))
            buckets[name] = F.struct(
                F.lit(at).alias("at"), bucket.alias("bucket"), given[name].alias("value")
            )
    counted = {name: [] for name in buckets}
    if buckets:
        values = rows.select(F.inline(F.array(*buckets.values())))
        counts = values.filter(F.col("value").isNotNull()).groupBy("at", "bucket").agg(
            F.count("*").alias("n"), F.min("value").alias("low"), F.max("value").alias("high")
        )
        names = list(bounds)
        for at, *row in zip(*(column.to_pylist() for column in counts.toArrow().columns)):
            counted[names[at]].append(row)
    crowded = [name for name, (low, high) in bounds.items() if low < high and name not in buckets]
    for name, found in counted.items():
        total = sum(n for _, n, _, _ in found)
        before = 0
        for _, n, low, high in sorted(found):
            if before + n >= math.ceil(total * 0.5):
                break
            before += n
        bounds[name] = low, high
        if low < high and n > CROWDED * total:
            crowded.append(name)
    if crowded:
        around = F.array(*[F.lit(0.5 + side * BRACKET) for side in (-1, 1)])
        sketch = rows.agg(
            *[F.percentile_approx(given[name], around, F.lit(ACCURACY)).alias(name)
              for name in crowded]
        ).first()
        bounds.update((name, tuple(sketch[name])) for name in crowded)
    return bounds


def saved_slots(rows: DataFrame, categories: Sequence[str] = CATEGORICAL_FEATURES) -> DataFrame:
    return save_shared(rank_slots(rows, categories), "slots")
