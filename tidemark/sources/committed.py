"""A run's results as one version: either all of them become the current ones, or none.

Below ``output`` every run writes into a folder of its own, ``runs/<run>``. When all results are
written they are read back, and a manifest with the rows and sums of each goes to
``committed/<run>``. That one write is the commit: readers take the last run whose manifest is
complete. So a run that is killed or fails half way leaves the former results as they were, and
readers of the former run are not disturbed while a new one is written. No rename is needed, so this
holds on object stores as well.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable, Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.sources.shared import delete

MANIFEST_SCHEMA = "name string, row_count long, sums map<string, double>"


def _new_run() -> str:
    """Names in order of time."""
    return f"{dt.datetime.now(dt.timezone.utc):%Y%m%dT%H%M%S.%f}-{uuid.uuid4().hex[:8]}"


def committed_runs(spark: SparkSession, output: str) -> list[str]:
    """Names of the runs whose manifest is complete, the last one last."""
    pattern = spark._jvm.org.apache.hadoop.fs.Path(f"{output}/committed/*/_SUCCESS")
    files = pattern.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(pattern)
    return sorted(file.getPath().getParent().getName() for file in files or [])


def committed_folder(spark: SparkSession, output: str) -> str:
    """Where the current results lie."""
    runs = committed_runs(spark, output)
    if not runs:
        raise FileNotFoundError(f"no run has been committed under {output}")
    return f"{output}/runs/{runs[-1]}"


def committed_manifest(spark: SparkSession, output: str) -> DataFrame:
    """``name, row_count, sums`` of the current results; sums are those of the numeric columns."""
    runs = committed_runs(spark, output)
    if not runs:
        raise FileNotFoundError(f"no run has been committed under {output}")
    return spark.read.schema(MANIFEST_SCHEMA).json(f"{output}/committed/{runs[-1]}")


def _described(name: str, table: DataFrame) -> DataFrame:
    numbers = [f.name for f in table.schema if isinstance(f.dataType, T.NumericType)]
    sums = [
        part
        for number in numbers
        for part in (F.lit(number), F.sum(F.col(f"`{number}`").cast("double")))
    ]
    return table.agg(
        F.lit(name).alias("name"),
        F.count(F.lit(1)).alias("row_count"),
        (F.create_map(*sums) if sums else F.create_map()).cast("map<string, double>").alias("sums"),
    )


def commit_run(
    spark: SparkSession,
    output: str,
    write: Callable[[str], Mapping[str, DataFrame]],
    keep: int = 2,
) -> dict[str, DataFrame]:
    """Let ``write`` put a run's results below the folder it is given, and commit them.

    ``write`` returns the results by name, as read back. If it fails, its folder is deleted and the
    former results stay the current ones. Afterwards the last ``keep`` committed runs remain.
    """
    if keep < 1:
        raise ValueError(f"at least the current run has to remain, got {keep}")
    run = _new_run()
    folder = f"{output}/runs/{run}"
    try:
        results = dict(write(folder))
        manifest = reduce(
            DataFrame.unionByName,
            [_described(name, table) for name, table in results.items()],
            spark.createDataFrame([], MANIFEST_SCHEMA),
        )
        manifest.coalesce(1).write.json(f"{output}/committed/{run}")
    except BaseException:
        delete(spark, folder)
        delete(spark, f"{output}/committed/{run}")
        raise
    for old in committed_runs(spark, output)[:-keep]:
        # The manifest goes first, so no reader is led to a folder that is being deleted.
        delete(spark, f"{output}/committed/{old}")
        delete(spark, f"{output}/runs/{old}")
    return results
