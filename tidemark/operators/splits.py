"""Chronological splits and the tables that describe them."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark import spec
from tidemark.functions.ratios import share
from tidemark.operators.history import Histories


def add_split(df: DataFrame, bounds: spec.SplitBounds, date: str = "flight_date") -> DataFrame:
    """A ``split`` column; null for a date outside all splits."""
    day = F.col(date)
    train, validation, test = spec.SPLITS
    split = (
        F.when(day < F.lit(bounds.start), None)
        .when(day <= F.lit(bounds.train_end), train)
        .when(day <= F.lit(bounds.validation_end), validation)
        .when(day <= F.lit(bounds.test_end), test)
    )
    return df.withColumn("split", split)


def split_frames(
    df: DataFrame, bounds: spec.SplitBounds, date: str = "flight_date"
) -> dict[str, DataFrame]:
    """The three splits as filters on the date, which reach a Parquet scan."""
    day = F.col(date)
    train, validation, test = spec.SPLITS
    return {
        train: df.filter(day.between(F.lit(bounds.start), F.lit(bounds.train_end))),
        validation: df.filter(
            (day > F.lit(bounds.train_end)) & (day <= F.lit(bounds.validation_end))
        ),
        test: df.filter((day > F.lit(bounds.validation_end)) & (day <= F.lit(bounds.test_end))),
    }


def split_summary(
    df: DataFrame, date: str = "flight_date", label: str = "label", weight: str | None = None
) -> DataFrame:
    """Size, class counts and date range per split; fails when read if a split has no rows.

    With ``weight``, ``df`` holds totals: ``label`` is then a count of positives and ``weight`` a
    count of rows.
    """
    rows = F.sum(weight) if weight else F.count("*")
    per_split = (
        df.filter(F.col("split").isNotNull())
        .groupBy("split")
        .agg(
            rows.alias("row_count"),
            F.sum(label).cast("long").alias("delayed_count"),
            F.min(date).alias("minimum_date"),
            F.max(date).alias("maximum_date"),
        )
    )
    # At most three rows are gathered here, so that a missing split shows.
    found = per_split.agg(
        F.map_from_entries(
            F.collect_list(F.struct("split", F.struct(*per_split.columns[1:])))
        ).alias("found")
    )
    names = F.array(*[F.lit(name) for name in spec.SPLITS])
    one = F.col("found")[F.col("split")]
    count = F.when(
        one.isNull(), F.raise_error(F.concat(F.lit("split without rows: "), F.col("split")))
    ).otherwise(one["row_count"])
    return (
        found.select("found", F.explode(names).alias("split"))
        .select(
            "split",
            one["minimum_date"].alias("minimum_date"),
            one["maximum_date"].alias("maximum_date"),
            count.alias("row_count"),
            one["delayed_count"].alias("delayed_count"),
        )
        .withColumn("on_time_count", F.col("row_count") - F.col("delayed_count"))
        .withColumn("delay_rate", F.col("delayed_count") / F.col("row_count"))
    )


def class_distribution(summary: DataFrame) -> DataFrame:
    """Two rows per split: each class with its count and share."""
    counts = ("on_time_count", "delayed_count")
    classes = F.array(
        *[
            F.struct(
                F.lit(label).alias("class_label"),
                F.lit(spec.CLASS_NAMES[label]).alias("class_name"),
                F.col(counts[label]).alias("row_count"),
                share(F.col(counts[label]), F.col("row_count")).alias("share"),
            )
            for label in (0, 1)
        ]
    )
    return summary.select("split", F.inline(classes))


def history_coverage(
    df: DataFrame, entities: Sequence[str] = spec.ENTITIES, weight: str | None = None
) -> DataFrame:
    """Per split and entity: mean earlier rows, and the share of rows without any.

    ``weight`` names a row count when ``df`` is a history table rather than event rows.
    """
    rows = F.col(weight) if weight else F.lit(1)
    sums = [F.sum(rows).alias("_rows")]
    for name in entities:
        count = F.col(f"hist_{name}_count")
        sums.append(F.sum(count * rows).alias(f"_sum_{name}"))
        sums.append(F.sum(F.when(count <= 0, rows).otherwise(0)).alias(f"_none_{name}"))
    totals = df.filter(F.col("split").isNotNull()).groupBy("split").agg(*sums)
    lines = F.array(
        *[
            F.struct(
                F.lit(name).alias("history_entity"),
                (F.col(f"_sum_{name}") / F.col("_rows")).alias("mean_prior_flight_count"),
                (F.col(f"_none_{name}") / F.col("_rows")).alias("share_with_no_entity_history"),
            )
            for name in entities
        ]
    )
    return totals.select("split", F.inline(lines))


def entity_coverage(
    found: Histories, bounds: spec.SplitBounds, date: str = "flight_date"
) -> DataFrame:
    """History coverage from each entity's day totals, which stand for their event rows."""
    parts = [
        history_coverage(add_split(table, bounds, date), [name], weight="rows")
        for name, table in found.entities.items()
    ]
    return reduce(DataFrame.unionByName, parts)
