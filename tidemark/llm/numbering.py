"""Gapless numbers from 0 within each key, without bringing the rows of a key together.

Every task numbers its own rows of a key as they stream by; the written numbers are then moved by
the count of rows that earlier tasks have of that key. What is grouped by key is one row per task
and key, whatever the rows of a hot key.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


class Running:
    """The next numbers of keys 0 .. n - 1 within one task."""

    def __init__(self, n_keys: int):
        self._next = np.zeros(n_keys, np.int64)

    def number(self, keys: np.ndarray) -> np.ndarray:
        order = np.argsort(keys, kind="stable")
        counts = np.bincount(keys, minlength=len(self._next))
        firsts = np.repeat(np.cumsum(counts) - counts, counts)
        numbers = np.empty(len(keys), np.int64)
        numbers[order] = np.arange(len(keys)) - firsts
        numbers += self._next[keys]
        self._next += counts
        return numbers


def moves_by_task(rows: DataFrame, key: str, task: str = "task") -> DataFrame:
    """``<key>, <task>, n, move``: a task's rows of the key, and those that earlier tasks have."""
    earlier = Window.partitionBy(key).orderBy(task).rowsBetween(Window.unboundedPreceding, -1)
    counts = rows.groupBy(key, task).agg(F.count("*").alias("n"))
    return counts.withColumn("move", F.coalesce(F.sum("n").over(earlier), F.lit(0)))


def move_by_task(rows: DataFrame, key: str, number: str, task: str = "task") -> DataFrame:
    """Turn numbers within (task, key) of a written table into numbers within key; drops task."""
    moves = moves_by_task(rows, key, task).drop("n")
    moved = rows.join(moves, [key, task]).withColumn(number, F.col(number) + F.col("move"))
    return moved.select(*[name for name in rows.columns if name != task])
