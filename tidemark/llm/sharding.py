"""Documents dealt to shards of near-equal bytes, equal texts together, by differencing.

Karmarkar-Karp differencing starts from one partial partition per indivisible group (its bytes in
one shard, none in the others) and repeatedly combines the two partial partitions of largest
spread, the fullest shard of one with the emptiest of the other, until one is left.

Large groups have to be settled before small ones, which then even out what the large ones left. So
groups are taken in classes of size, each class a factor of ``2 ** CLASS_BITS`` below the one
before. A class is dealt by hash to nodes of about ``NODE`` groups, and every node is differenced
by a task of its own. Among its partial partitions is its share of what all larger classes have put
into the shards, so each node evens out its share of the spread. Between classes one sum per shard
comes to the driver. No task sees more than a node, whatever the corpus.

A group is the SHA-256 of its text and counts as a whole, however many rows it has; its bytes are
summed before any shuffle. A null text is empty and in one group with empty texts. Rows that repeat
get a slot each; doc_id may be null. A very long text is one group however large. Groups of equal
size are taken in the order of their hash. No documents give no rows. Other columns are not read.
"""

from __future__ import annotations

import heapq
from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.numbering import Running, move_by_task
from tidemark.sources.shared import save_shared

NODE = 4096
CLASS_BITS = 3
ROW_BYTES = 16


def difference(partials: np.ndarray) -> np.ndarray:
    """The shard of every slot of every partial partition (rows: partitions, columns: slots)."""
    n, k = partials.shape
    order = np.argsort(-partials, axis=1, kind="stable")
    sums = list(np.take_along_axis(partials, order, axis=1))
    heap = [(int(s[-1] - s[0]), i) for i, s in enumerate(sums)]
    heapq.heapify(heap)
    merged: list[tuple[int, int, np.ndarray]] = []
    while len(heap) > 1:
        (_, a), (_, b) = heapq.heappop(heap), heapq.heappop(heap)
        both = sums[a] + sums[b][::-1]
        places = np.argsort(-both, kind="stable")
        sums[a] = sums[b] = None
        merged.append((a, b, places))
        sums.append(both[places])
        heapq.heappush(heap, (int(sums[-1][-1] - sums[-1][0]), n + len(merged) - 1))
    shards: list[np.ndarray | None] = [None] * (n + len(merged))
    shards[-1] = np.arange(k)
    for i in range(len(merged) - 1, -1, -1):
        a, b, places = merged[i]
        mine, shards[n + i] = shards[n + i], None
        shards[a], shards[b] = np.empty(k, np.int64), np.empty(k, np.int64)
        shards[a][places] = mine
        shards[b][k - 1 - places] = mine
    found = np.empty((n, k), np.int64)
    np.put_along_axis(found, order, np.array(shards[:n]).reshape(n, k), axis=1)
    return found


def _node(filled: np.ndarray) -> Callable[[pd.DataFrame], pd.DataFrame]:
    """Differences a node's groups with ``filled``, its share of what the shards hold already."""
    k = len(filled)

    def node(groups: pd.DataFrame) -> pd.DataFrame:
        groups = groups.sort_values(["bytes", "group"], ascending=[False, True])
        partials = np.zeros((len(groups) + 1, k), np.int64)
        partials[0] = filled
        partials[1:, 0] = groups["bytes"]
        found = difference(partials)
        shards = np.argsort(found[0])[found[1:, 0]]
        return groups[["group", "bytes"]].assign(shard=shards.astype("int32"))

    return node


def assign_groups(groups: DataFrame, shards: int) -> DataFrame:
    """``group, shard`` from ``group, bytes``, a written table with one row per group."""
    sized = groups.withColumn("size_class", F.floor(F.log2("bytes") / CLASS_BITS))
    counts = sized.groupBy("size_class").agg(F.count("*").alias("n")).collect()
    filled, placed = np.zeros(shards, np.int64), []
    for size_class, n in sorted(map(tuple, counts), reverse=True):
        nodes = -(-n // NODE)
        dealt = sized.filter(F.col("size_class") == size_class).withColumn(
            "node", F.pmod(F.xxhash64("group"), F.lit(nodes))
        )
        found = dealt.groupBy("node").applyInPandas(
            _node(filled // nodes), "group binary, bytes long, shard int"
        )
        placed.append(save_shared(found, "placed"))
        for row in placed[-1].groupBy("shard").agg(F.sum("bytes").alias("bytes")).collect():
            filled[row["shard"]] += row["bytes"]
    if not placed:
        return groups.select("group", F.lit(0).alias("shard"))
    return reduce(DataFrame.unionByName, placed).select("group", "shard")


def _slots(shards: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        running, task = Running(shards), TaskContext.get().partitionId()
        for batch in batches:
            slot = running.number(batch.column("shard").to_numpy())
            tasks = pa.array(np.full(batch.num_rows, task), pa.int32())
            batch = batch.append_column("slot", pa.array(slot, pa.int64()))
            yield batch.append_column("task", tasks)

    return number


def shard(documents: DataFrame, shards: int) -> DataFrame:
    """``doc_id, size, text_crc32, law, shard, slot, grown_shard`` of every row."""
    text = F.coalesce("text", F.lit(""))
    rows = save_shared(
        documents.select(
            F.col("doc_id").cast("long"),
            (F.octet_length(text) + F.lit(ROW_BYTES)).cast("long").alias("size"),
            F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"),
            F.unhex(F.sha2(text, 256)).alias("group"),
        ),
        "sizes",
    )
    groups = save_shared(rows.groupBy("group").agg(F.sum("size").alias("bytes")), "groups")
    placed = rows.join(assign_groups(groups, shards), "group").drop("group")
    columns = "doc_id long, size long, text_crc32 long, shard int"
    numbered = placed.select("doc_id", "size", "text_crc32", "shard").mapInArrow(
        _slots(shards), f"{columns}, slot long, task int"
    )
    numbered = move_by_task(save_shared(numbered, "slots"), "shard", "slot")
    return numbered.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )

