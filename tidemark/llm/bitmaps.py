"""Filters of a fixed number of bits, set by Spark and read by tasks.

A filter says of a hash "absent" or "perhaps there", whatever number of hashes has set it, so it may
be sent to tasks however large the table behind it is.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def gather(hashes: DataFrame, column: Column, bits: int) -> np.ndarray:
    """The filter of ``bits`` bits (a power of two, 32,768 at least) as bytes: what reaches the
    driver is ``bits / 8`` bytes at most."""
    # Spark's bitmaps count from 1.
    bit = column.bitwiseAND(F.lit(bits - 1)) + 1
    parts = (
        hashes.select(bit.alias("bit"))
        .groupBy(F.bitmap_bucket_number("bit").alias("bucket"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position("bit")).alias("bitmap"))
    )
    found = np.zeros(bits // 8, np.uint8)
    for row in parts.collect():
        part = np.frombuffer(bytes(row["bitmap"]), np.uint8)
        at = (row["bucket"] - 1) * len(part)
        found[at : at + len(part)] = part
    return found


def perhaps(bitmap: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Which hashes may have set the filter."""
    bit = hashes & np.uint64(8 * len(bitmap) - 1)
    held = bitmap[(bit >> np.uint64(3)).astype(np.int64)] >> (bit & np.uint64(7)).astype(np.uint8)
    return (held & 1).astype(bool)
