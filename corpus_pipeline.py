"""A corpus made ready for training: filters, near-duplicates, benchmark passages, secrets, packing.

Each stage works on all that the one before has kept, written as Parquet and read again. All but the
last return the columns of the documents they were given; the last returns pieces of documents with
their token ids and places, from which ``packing.sequences`` makes training sequences.

Null, empty and very long texts, repeated rows, ties and further columns pass through every stage as
the operators' docstrings say: null and empty texts are kept and become a single end id, texts of
any length are judged whole. Of repeated rows, and of any rows of one doc_id and text, the
near-duplicates stage leaves one; of a group of near-duplicates that of least doc_id, then of least
text hash. An empty table gives an empty table of the same columns at every stage.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import decontamination, near_duplicates, packing, secrets, toxicity
from tidemark.sources.shared import delete, shared_area, shared_folder

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"
# Spark's own bound is 64 MB and 10,000 rows.
MOST_BYTES = "4m"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _in_small_batches(stage: Stage) -> Stage:
    """The stage, its texts passing to Python by at most ``MOST_BYTES``, or a single longer text."""

    @wraps(stage)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        if spark.conf.get(BATCH_BYTES, None) is None:
            spark.conf.set(BATCH_BYTES, MOST_BYTES)
        return stage(spark, docs, sf_dir)

    return run


@_in_small_batches
def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the noisy-channel score calls toxic go."""
    return toxicity.reject_toxic(docs, toxicity.fit(docs, _table(spark, sf_dir, "labels")))


@_in_small_batches
def keep_one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of near-duplicates one row of least doc_id stays."""
    return near_duplicates.one_of_each_group(docs, percent=80)


@_in_small_batches
def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of a benchmark item go."""
    found = decontamination.find_passages(docs, _table(spark, sf_dir, "benchmark"))
    held = found.filter(F.col("n_hit") > 0).select(F.col("key").alias("held_key")).distinct()
    return docs.join(held, decontamination.row_key() == F.col("held_key"), "left_anti")


@_in_small_batches
def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are masked; every document stays."""
    return secrets.redact(docs)


@_in_small_batches
def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents with their ids, and their places in training sequences."""
    return packing.pack(docs, with_ids=True)


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", reject_toxic),
    ("near_duplicates", keep_one_of_each_group),
    ("decontamination", drop_contaminated),
    ("secrets", mask_secrets),
    ("packing", pack),
]

# Learned scores and tokenizers have no SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows. What a stage wrote for itself is deleted when its result is written,
    and that result when the next one is; the last one stays, since the frame returned reads it."""
    docs = _table(spark, sf_dir, "documents")
    folder = f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    before, given = None, spark.conf.get(BATCH_BYTES, None)
    try:
        for name, stage in STAGES:
            with shared_area(spark):
                stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
            if before:
                delete(spark, f"{folder}/{before}")
            docs, before = spark.read.parquet(f"{folder}/{name}"), name
    finally:
        if given is None:
            spark.conf.unset(BATCH_BYTES)
    return docs
