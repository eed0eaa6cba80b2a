"""Tables written to the cluster's shared folder, to cut lineage and to be read more than once."""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

# The folder of the block that tables are being saved in, if any.
_area: ContextVar[str | None] = ContextVar("shared_area", default=None)


def shared_folder(spark: SparkSession) -> str:
    """The folder named in ``spark.checkpoint.dir``, else one below ``spark.sql.warehouse.dir``."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    return (folder or f"{spark.conf.get('spark.sql.warehouse.dir')}/shared").rstrip("/")


def save_shared(
    df: DataFrame, name: str, by: Sequence[str] = (), **options: str
) -> DataFrame:
    """Write the rows as Parquet, in folders ``by`` some columns, and return the written table.

    Readers of the returned table prune columns and skip row groups, survive the loss of executors
    without recomputing what came before, and are planned with the table's true size.
    """
    path = _new_path(df.sparkSession, name)
    df.write.options(**options).partitionBy(*by).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _new_path(spark: SparkSession, name: str) -> str:
    folder = _area.get() or f"{shared_folder(spark)}/{spark.sparkContext.applicationId}"
    return f"{folder}/{name}-{uuid.uuid4().hex}"


def delete(spark: SparkSession, folder: str) -> bool:
    """Delete a folder wherever Spark can reach it; tells whether there was one."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def shared_area(spark: SparkSession) -> Iterator[str]:
    """A folder of its own for the tables saved within the block; it is deleted at the end."""
    folder = f"{shared_folder(spark)}/{spark.sparkContext.applicationId}/run-{uuid.uuid4().hex}"
    token = _area.set(folder)
    try:
        yield folder
    finally:
        _area.reset(token)
        delete(spark, folder)


@contextmanager
def written(df: DataFrame, name: str) -> Iterator[DataFrame]:
    """The rows as a table written for the length of a block."""
    path = _new_path(df.sparkSession, name)
    try:
        df.write.parquet(path)
        yield df.sparkSession.read.schema(df.schema).parquet(path)
    finally:
        delete(df.sparkSession, path)


@contextmanager
def kept(*frames: DataFrame) -> Iterator[None]:
    """Hold frames in memory, spilling to disk, for the length of a block."""
    for frame in frames:
        frame.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield
    finally:
        for frame in frames:
            frame.unpersist()
