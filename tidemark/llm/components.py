"""Connected components by alternating large and small stars, with no group gathered anywhere.

Each round points every node's larger neighbours at its smallest (large star), then its smaller
ones (small star). The smallest neighbour comes from a grouped minimum and goes back by a join, so
a centre with many neighbours costs no task more than its share of the edges. The number of rounds
grows with the logarithm of the longest path. Edges are written after every round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.sources.shared import save_shared


def _large(edges: DataFrame) -> DataFrame:
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.first("a"), F.min("b")).alias("root"))
    return both.join(least, "a").filter(F.col("b") > F.col("a")).select(
        F.col("b").alias("a"), F.col("root").alias("b")
    )


def _small(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("root"))
    moved = down.join(least, "a").select(F.col("b").alias("a"), F.col("root").alias("b"))
    return moved.unionByName(least.select("a", F.col("root").alias("b")))


def _state(edges: DataFrame) -> tuple[int, int]:
    row = edges.agg(
        F.count("*"), F.coalesce(F.bit_xor(F.xxhash64("a", "b")), F.lit(0))
    ).first()
    return row[0], row[1]


def connected_components(edges: DataFrame) -> DataFrame:
    """``node, root`` of every node that has an edge; the root is the component's least node.

    ``edges`` has comparable columns ``a`` and ``b``; loops and repeated edges do no harm.
    """
    proper = edges.select("a", "b").filter(F.col("a") != F.col("b")).distinct()
    stars, before = save_shared(proper, "edges"), None
    while (state := _state(stars)) != before:
        before = state
        pointed = _small(_large(stars).filter(F.col("a") != F.col("b")))
        stars = save_shared(pointed.filter(F.col("a") != F.col("b")).distinct(), "stars")
    roots = stars.select("b").distinct().select(F.col("b").alias("node"), F.col("b").alias("root"))
    return stars.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)
