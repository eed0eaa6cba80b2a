"""Places in a global order, and order statistics, without gathering the rows in one task.

Rows are range-partitioned into slices of similar size and written; a slice is ordered on its own.
What comes before a slice follows from the totals of the slices, of which there are as many as
shuffle partitions and groups.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.sources.shared import save_shared

SLICE = "slice"


def in_slices(df: DataFrame, order: Sequence[Column], by: Sequence[str] = ()) -> DataFrame:
    """A written table in which equal ``slice`` numbers stand together in the order of rows."""
    parts = df.repartitionByRange(*by, *order)
    return save_shared(parts.withColumn(SLICE, F.spark_partition_id()), "slices")


def slice_totals(sliced: DataFrame, weight: Column, by: Sequence[str] = ()) -> DataFrame:
    """Per group and slice: ``inside``, ``before`` (all earlier slices) and ``total`` of the weight."""
    group = Window.partitionBy(*by)
    earlier = group.orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)
    sums = sliced.groupBy(*by, SLICE).agg(F.sum(weight).alias("inside"))
    return sums.withColumns(
        {
            "before": F.coalesce(F.sum("inside").over(earlier), F.lit(0)),
            "total": F.sum("inside").over(group),
        }
    )


def with_slices(sliced: DataFrame, totals: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Rows with the figures of their slice; a null group is one like any other."""
    keys = [*by, SLICE]
    named = totals.withColumnsRenamed({key: f"{key}__of_slice" for key in keys})
    same = [sliced[key].eqNullSafe(named[f"{key}__of_slice"]) for key in by]
    joined = sliced.join(named, [sliced[SLICE] == named[f"{SLICE}__of_slice"], *same])
    return joined.drop(*named.columns[: len(keys)])


def running_totals(
    df: DataFrame,
    order: Sequence[Column],
    weight: Column,
    by: Sequence[str] = (),
    name: str = "before",
    total: str = "total",
) -> DataFrame:
    """The weight of all earlier rows of the group as ``name``, that of the group as ``total``."""
    sliced = in_slices(df, order, by)
    rows = with_slices(sliced, slice_totals(sliced, weight, by), by)
    earlier = (
        Window.partitionBy(*by, SLICE).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    )
    before = F.col("before") + F.coalesce(F.sum(weight).over(earlier), F.lit(0))
    columns = [F.col(f"`{c}`") for c in df.columns]
    return rows.select(*columns, before.alias(name), F.col("total").alias(total))


def number_rows(
    df: DataFrame,
    order: Sequence[Column],
    by: Sequence[str] = (),
    name: str = "place",
    total: str = "total",
) -> DataFrame:
    """Gapless places from 0 within each group, and the group's number of rows."""
    return running_totals(df, order, F.lit(1).cast("long"), by, name, total)


def lower_quantile(
    counted: DataFrame, value: str, count: str, share: float, by: Sequence[str] = ()
) -> DataFrame:
    """Per group the least value that at least ``share`` of all rows do not exceed.

    ``counted`` holds each distinct value of a group once, with its count. Only the slice that the
    answer lies in is ordered.
    """
    if not 0 < share <= 1:
        raise ValueError(f"a share is above 0 and at most 1, got {share}")
    order = [F.asc(value)]
    sliced = in_slices(counted, order, by)
    wanted = F.ceil(F.col("total") * F.lit(float(share)))
    totals = slice_totals(sliced, F.col(count), by).withColumn("wanted", wanted)
    held = totals.filter(
        (F.col("before") < F.col("wanted")) & (F.col("wanted") <= F.col("before") + F.col("inside"))
    )
    rows = with_slices(sliced, held, by)
    upto = (
        Window.partitionBy(*by, SLICE)
        .orderBy(*order)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    reached = rows.withColumn("reached", F.col("before") + F.sum(count).over(upto))
    enough = reached.filter(F.col("reached") >= F.col("wanted"))
    return enough.groupBy(*by).agg(F.min(value).alias(value), F.first("total").alias("n"))
