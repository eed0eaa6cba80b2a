"""Outcome histories from strictly earlier dates, and rates smoothed towards the global rate.

All histories are worked out on day totals, never on event rows. The day totals of one entity hold
at most one row per value and day, so a busy value costs no more than a quiet one. Totals by several
entities at once grow nearly as the events do, so every entity has its own, and event rows meet
each by a plain equality of entity and date; written out first, those that are small enough are
broadcast by Spark, and event rows are shuffled for the others only.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.running import totals_before_day
from tidemark.spec import ENTITIES, Smoothing


def day_totals(
    df: DataFrame, keys: Sequence[str], date: str = "flight_date", label: str = "label"
) -> DataFrame:
    """Positive outcomes and rows per key and day."""
    return df.groupBy(*keys, date).agg(
        F.sum(F.col(label).cast("long")).alias("positives"), F.count("*").alias("rows")
    )


def coarser_totals(totals: DataFrame, keys: Sequence[str], date: str = "flight_date") -> DataFrame:
    """Day totals for fewer keys, from finer day totals."""
    return totals.groupBy(*keys, date).agg(
        F.sum("positives").alias("positives"), F.sum("rows").alias("rows")
    )


def prior_totals(
    totals: DataFrame, keys: Sequence[str], name: str, date: str = "flight_date"
) -> DataFrame:
    """Per key and day, totals over earlier days: ``hist_<name>_positives``, ``hist_<name>_count``.

    The frame ends one row back, which means "earlier date" only because there is one row per key
    and day. Both columns are null on a key's first day.
    """
    earlier = (
        Window.partitionBy(*keys).orderBy(date).rowsBetween(Window.unboundedPreceding, -1)
    )
    return totals.select(
        *keys,
        date,
        F.sum("positives").over(earlier).alias(f"hist_{name}_positives"),
        F.sum("rows").over(earlier).alias(f"hist_{name}_count"),
    )


def prior_totals_by_range(
    totals: DataFrame, keys: Sequence[str], name: str, date: str = "flight_date"
) -> DataFrame:
    """The same totals by a frame over day numbers, 0 on a key's first day.

    This frame says "earlier date" by value, so it also holds for several rows per key and day.
    """
    earlier = (
        Window.partitionBy(*keys)
        .orderBy(F.unix_date(date))
        .rangeBetween(Window.unboundedPreceding, -1)
    )
    zero = F.lit(0).cast("long")
    return totals.select(
        *keys,
        date,
        F.coalesce(F.sum("positives").over(earlier), zero).alias(f"hist_{name}_positives"),
        F.coalesce(F.sum("rows").over(earlier), zero).alias(f"hist_{name}_count"),
    )


def prior_totals_of_rows(
    df: DataFrame,
    keys: Sequence[str],
    name: str,
    date: str = "flight_date",
    label: str = "label",
    block_days: int = 16,
    save: Callable[[DataFrame, str], DataFrame] | None = None,
) -> DataFrame:
    """Every row with ``hist_<name>_positives`` and ``hist_<name>_count``: the totals of its key over
    all strictly earlier dates, by a value-range frame over the rows themselves.

    The frame has two levels. Days are cut into blocks of ``block_days``; a window over the sums of a
    key's blocks tells what lies before a block, and a range frame over day numbers, inside the
    block alone, adds the earlier days of it. So the rows of one key are sorted in as many
    partitions as it has blocks, never in one. ``save`` (such as ``save_shared``) writes the sums of
    blocks, whose size then decides how they are joined. A null date is before all others and has
    no earlier one; a null in a key is a value like any other.
    """
    if block_days < 1:
        raise ValueError(f"a block has at least one day, got {block_days}")
    save = save or (lambda table, name: table)
    day, block = f"{name}__day", f"{name}__block"
    positives, count = f"hist_{name}_positives", f"hist_{name}_count"
    least = F.lit(0).cast("long")
    numbered = df.withColumn(day, F.unix_date(date))
    numbered = numbered.withColumn(block, F.floor(F.col(day) / F.lit(block_days)))
    one = F.col(label).cast("long")
    sums = numbered.groupBy(*keys, block).agg(
        F.sum(one).alias("positives"), F.count("*").alias("rows")
    )
    before = Window.partitionBy(*keys).orderBy(block).rowsBetween(Window.unboundedPreceding, -1)
    blocks = save(
        sums.select(
            *[F.col(key).alias(f"{key}__of_block") for key in keys],
            F.col(block).alias(f"{block}__of_block"),
            F.coalesce(F.sum("positives").over(before), least).alias("positives_before"),
            F.coalesce(F.sum("rows").over(before), least).alias("rows_before"),
        ),
        f"blocks-{name}",
    )
    inside = (
        Window.partitionBy(*keys, block)
        .orderBy(day)
        .rangeBetween(Window.unboundedPreceding, -1)
    )
    framed = numbered.withColumns(
        {
            positives: F.coalesce(F.sum(one).over(inside), least),
            count: F.count(F.lit(1)).over(inside),
        }
    )
    same = [F.col(c).eqNullSafe(F.col(f"{c}__of_block")) for c in (*keys, block)]
    joined = framed.join(blocks, same, "left")
    # A row frame would count rows without a date as earlier than all others.
    dated = F.col(day).isNotNull()
    return joined.select(
        *df.columns,
        F.when(dated, F.col(positives) + F.col("positives_before")).otherwise(least).alias(positives),
        F.when(dated, F.col(count) + F.col("rows_before")).otherwise(least).alias(count),
    )


def global_prior(
    totals: DataFrame, default_rate: float, date: str = "flight_date", rate: str = "delay_rate"
) -> DataFrame:
    """Per day, the count and the rate over all earlier days; the default rate on the first day."""
    daily = coarser_totals(totals, [], date)
    before = totals_before_day(daily, date, ["positives", "rows"])
    return before.select(
        date,
        F.coalesce("rows", F.lit(0).cast("long")).alias("hist_global_count"),
        F.coalesce(F.col("positives") / F.col("rows"), F.lit(float(default_rate))).alias(
            f"hist_global_{rate}"
        ),
    )


def smoothed_rate(name: str, weight: float, prior_rate: str) -> Column:
    """(earlier positives + weight x prior rate) / (earlier rows + weight), over prior totals."""
    zero, w = F.lit(0).cast("long"), F.lit(float(weight))
    positives = F.coalesce(f"hist_{name}_positives", zero)
    return (positives + w * F.col(prior_rate)) / (F.coalesce(f"hist_{name}_count", zero) + w)


def history_columns(
    entities: Sequence[str] = ENTITIES, rate: str = "delay_rate"
) -> list[str]:
    names = ["global", *entities]
    return [f"hist_{name}_{part}" for name in names for part in ("count", rate)]


def entity_history(totals: DataFrame, name: str, date: str = "flight_date") -> DataFrame:
    """An entity's day totals with ``hist_<name>_positives`` and ``hist_<name>_count`` beside them."""
    earlier = Window.partitionBy(name).orderBy(date).rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0).cast("long")
    return totals.withColumns(
        {
            f"hist_{name}_positives": F.coalesce(F.sum("positives").over(earlier), zero),
            f"hist_{name}_count": F.coalesce(F.sum("rows").over(earlier), zero),
        }
    )


def history_table(
    totals: DataFrame,
    name: str,
    smoothing: Smoothing = Smoothing(),
    date: str = "flight_date",
    rate: str = "delay_rate",
) -> DataFrame:
    """One entity's day totals with its own and the global history."""
    prior = global_prior(totals, smoothing.default_rate, date, rate)
    own = smoothed_rate(name, smoothing.prior_weight, f"hist_global_{rate}")
    table = entity_history(totals, name, date).join(prior, date, "left")
    return table.withColumn(f"hist_{name}_{rate}", own).select(
        name, date, "positives", "rows", *history_columns([name], rate)
    )


@dataclass(frozen=True)
class Histories:
    """Day totals and the global history by date, and each entity's by its value and date."""

    daily: DataFrame
    prior: DataFrame
    entities: Mapping[str, DataFrame]


def histories(
    df: DataFrame,
    entities: Sequence[str] = ENTITIES,
    smoothing: Smoothing = Smoothing(),
    date: str = "flight_date",
    label: str = "label",
    rate: str = "delay_rate",
    save: Callable[[DataFrame, str], DataFrame] | None = None,
) -> Histories:
    """``save`` (such as ``save_shared``) writes the day totals and each history out, which gives
    them a known size when the joins are planned; ``df`` should then be a written table."""
    save = save or (lambda table, name: table)
    daily = save(day_totals(df, [], date, label), "daily")
    return Histories(
        daily=daily,
        prior=save(global_prior(daily, smoothing.default_rate, date, rate), "global-prior"),
        entities={
            name: save(
                entity_history(day_totals(df, [name], date, label), name, date), f"history-{name}"
            )
            for name in entities
        },
    )


def attach_history(
    df: DataFrame,
    found: Histories,
    smoothing: Smoothing = Smoothing(),
    date: str = "flight_date",
    rate: str = "delay_rate",
) -> DataFrame:
    """Event rows with the history columns of their entities and day.

    A null entity has no earlier rows: count 0 and the global rate.
    """
    joined = df.join(found.prior, date, "left")
    for name, table in found.entities.items():
        own = table.drop("positives", "rows")
        count, positives = f"hist_{name}_count", f"hist_{name}_positives"
        joined = joined.join(own, [name, date], "left").withColumns(
            {
                count: F.coalesce(count, F.lit(0).cast("long")),
                f"hist_{name}_{rate}": smoothed_rate(
                    name, smoothing.prior_weight, f"hist_global_{rate}"
                ),
            }
        ).drop(positives)
    return joined.select(*df.columns, *history_columns(list(found.entities), rate))


def add_history(
    df: DataFrame,
    entities: Sequence[str] = ENTITIES,
    smoothing: Smoothing = Smoothing(),
    date: str = "flight_date",
    label: str = "label",
    rate: str = "delay_rate",
) -> DataFrame:
    """Day totals, histories and joins in one lazy plan, for small tables."""
    found = histories(df, entities, smoothing, date, label, rate)
    return attach_history(df, found, smoothing, date, rate)
