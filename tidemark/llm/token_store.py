"""Token ids in directly addressable codes: any token by its position, without decoding others.

An id is split into chunks of eight bits. Level 0 holds the lowest chunk of every id and one bit
per id that says whether the id goes on; level 1 holds the next chunk of those that do, and so on.
The place of an id on the next level is the number of set bits before it, read from a directory of
counts, one per 64 bits, and the bits of one machine word.

A file is a Parquet file whose rows are segments of whole documents in ascending order of doc_id:
about ``SEGMENT_TOKENS`` ids each, more only where one document has more. Nulls: a null text is
empty, a null doc_id sorts first. Equal doc_ids stand next to each other in any order, one entry per
row. A very long text is a segment of its own. Equal ids in a text have equal codes. Empty
tables give no segments. Other columns are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.tokens import encoder, vocabulary_path

SEGMENT_TOKENS = 1 << 18
CHUNK_BITS = 8
_MASK = np.uint32((1 << CHUNK_BITS) - 1)

SEGMENT = (
    "part int, seq int, first long, n_tokens long, doc_ids array<bigint>, ends array<bigint>, "
    "levels array<struct<chunks: binary, more: binary, ranks: binary>>"
)
_ARROW = pa.schema(
    [
        ("part", pa.int32()),
        ("seq", pa.int32()),
        ("first", pa.int64()),
        ("n_tokens", pa.int64()),
        ("doc_ids", pa.list_(pa.int64())),
        ("ends", pa.list_(pa.int64())),
        (
            "levels",
            pa.list_(
                pa.struct([("chunks", pa.binary()), ("more", pa.binary()), ("ranks", pa.binary())])
            ),
        ),
    ]
)


# --- the code ---


def encode_levels(ids: np.ndarray) -> list[dict[str, bytes]]:
    levels, rest = [], np.asarray(ids, np.uint32)
    while True:
        more = rest > _MASK
        bits = np.zeros((len(rest) + 63) // 64 * 64, bool)
        bits[: len(rest)] = more
        packed = np.packbits(bits, bitorder="little").view(np.uint64)
        counts = np.bitwise_count(packed).astype(np.uint32)
        levels.append(
            {
                "chunks": (rest & _MASK).astype(np.uint8).tobytes(),
                "more": packed.tobytes(),
                "ranks": (np.cumsum(counts, dtype=np.uint32) - counts).tobytes(),
            }
        )
        if not more.any():
            return levels
        rest = rest[more] >> np.uint32(CHUNK_BITS)


def ids_at(levels: list[dict[str, bytes]], positions: np.ndarray) -> np.ndarray:
    """The ids at any positions of a segment, in any order."""
    at = np.asarray(positions, np.int64)
    ids = np.zeros(len(at), np.uint32)
    alive = np.arange(len(at))
    for number, level in enumerate(levels):
        chunks = np.frombuffer(level["chunks"], np.uint8)[at]
        ids[alive] |= chunks.astype(np.uint32) << np.uint32(CHUNK_BITS * number)
        word = np.frombuffer(level["more"], np.uint64)[at >> 6]
        below = np.uint64(1) << (at & 63).astype(np.uint64)
        goes_on = (word & below) != 0
        ranks = np.frombuffer(level["ranks"], np.uint32)[at >> 6]
        at = (ranks + np.bitwise_count(word & (below - np.uint64(1))))[goes_on].astype(np.int64)
        alive = alive[goes_on]
    return ids


# --- writing ---


def _writer(path: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path).encode
        part, seq, first = TaskContext.get().partitionId(), 0, 0
        doc_ids: list[int | None] = []
        ids: list[np.ndarray] = []
        ends: list[int] = []
        held = 0

        def segment() -> pa.RecordBatch:
            row = {
                "part": part, "seq": seq, "first": first, "n_tokens": held, "doc_ids": doc_ids,
                "ends": ends, "levels": encode_levels(np.concatenate(ids)),
            }
            return pa.RecordBatch.from_pylist([row], _ARROW)

        for batch in batches:
            found, bounds = encode(batch.column("text"))
            for i, doc_id in enumerate(batch.column("doc_id").to_pylist()):
                n = int(bounds[i + 1] - bounds[i])
                if held and held + n > SEGMENT_TOKENS:
                    yield segment()
                    seq, first = seq + 1, first + held
                    doc_ids, ids, ends, held = [], [], [], 0
                doc_ids.append(doc_id)
                ids.append(found[bounds[i] : bounds[i + 1]])
                held += n
                ends.append(held)
        if held:
            yield segment()

    return write


def write_tokens(documents: DataFrame, path: str, vocabulary: str | None = None) -> None:
    """Encode every text, close it with the end id and write the segments to ``path``.

    One shuffle puts the documents in order; a hash of the text spreads rows of one doc_id.
    """
    ordered = (
        documents.select(F.col("doc_id").cast("long"), "text")
        .repartitionByRange(F.col("doc_id").asc_nulls_first(), F.xxhash64("text"))
        .sortWithinPartitions(F.col("doc_id").asc_nulls_first())
    )
    segments = ordered.mapInArrow(_writer(vocabulary or vocabulary_path()), SEGMENT)
    segments.write.option("compression", "uncompressed").parquet(path)


# --- reading ---


def read_segments(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(SEGMENT).parquet(path)


def _bases(segments: DataFrame) -> DataFrame:
    """``part, base``: the number of ids in all files before it.

    Files are numbered in order, so this takes one total per file.
    """
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    totals = segments.groupBy("part").agg(F.sum("n_tokens").alias("total"))
    return totals.select("part", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("base"))


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            ids = ids_at(row["levels"], np.arange(row["n_tokens"])).astype("<u4")
            starts = [0, *row["ends"][:-1]]
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": pa.array(row["doc_ids"], pa.int64()),
                    "part": pa.array([row["part"]] * len(starts), pa.int32()),
                    "start": pa.array([row["first"] + s for s in starts], pa.int64()),
                    "n_tokens": pa.array(np.diff([0, *row["ends"]]), pa.int64()),
                    "ids_crc32": pa.array(
                        [zlib.crc32(ids[s:e].tobytes()) for s, e in zip(starts, row["ends"])],
                        pa.int64(),
                    ),
                }
            )


def document_digests(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of every document, from its ids as read back."""
    segments = read_segments(spark, path)
    digests = segments.select("part", "first", "n_tokens", "doc_ids", "ends", "levels").mapInArrow(
        _digests, "doc_id long, part int, start long, n_tokens long, ids_crc32 long"
    )
    return digests.join(_bases(segments), "part").select(
        "doc_id", (F.col("base") + F.col("start")).alias("start"), "n_tokens", "ids_crc32"
    )


def _picked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            wanted = np.array(row["positions"], np.int64)
            yield pa.RecordBatch.from_pydict(
                {
                    "position": pa.array(wanted, pa.int64()),
                    "id": pa.array(ids_at(row["levels"], wanted - row["start"]), pa.int64()),
                }
            )


def tokens_at(spark: SparkSession, path: str, positions: DataFrame) -> DataFrame:
    """``position, id`` for a table of global positions; those outside the corpus are left out.

    Positions meet segments by blocks of ``SEGMENT_TOKENS`` positions that a segment touches.
    """
    block = F.lit(SEGMENT_TOKENS)
    segments = read_segments(spark, path)
    start = F.col("base") + F.col("first")
    spans = segments.select("part", "seq", "first", "n_tokens").join(_bases(segments), "part")
    spans = spans.select("part", "seq", start.alias("start"),
                         (start + F.col("n_tokens")).alias("end"))
    spans = spans.withColumn(
        "block",
        F.explode(F.sequence(F.floor(F.col("start") / block), F.floor((F.col("end") - 1) / block))),
    )
    asked = positions.select(
        F.col("position").cast("long"), F.floor(F.col("position") / block).alias("block")
    ).distinct()
    inside = (F.col("position") >= F.col("start")) & (F.col("position") < F.col("end"))
    wanted = (
        asked.join(spans, "block").filter(inside)
        .groupBy("part", "seq", "start").agg(F.collect_list("position").alias("positions"))
    )
    found = segments.join(wanted, ["part", "seq"]).select("start", "levels", "positions")
    return found.mapInArrow(_picked, "position long, id long")
