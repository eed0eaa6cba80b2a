"""Raw CSV files: reading them under differing headers, checking and describing them.

Files are opened by Spark's readers alone, so they may lie wherever Spark can read.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Callable, Sequence
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.headers import bind_headers, plain, resolve_fields
from tidemark.plans.concurrent import side_by_side
from tidemark.spec import FIELD_HEADERS

RAW_COLUMNS = tuple(aliases[0] for aliases in FIELD_HEADERS.values())

# A comma outside quotes.
_COMMA = r',(?=(?:[^"]*"[^"]*")*[^"]*$)'


def narrow(raw: DataFrame) -> DataFrame:
    """A source of any width cut down to the twelve raw columns, in fixed order and usual names."""
    usual = dict(zip(FIELD_HEADERS, RAW_COLUMNS))
    return resolve_fields(raw).withColumnsRenamed(usual)


def _read_layout(
    spark: SparkSession, paths: list[str], places: Sequence[int], width: int
) -> DataFrame:
    """Files whose raw columns stand at the same places, read by position as strings."""
    names = [f"c{i}" for i in range(width)]
    schema = T.StructType([T.StructField(name, T.StringType()) for name in names])
    rows = spark.read.schema(schema).option("header", True).option("mode", "PERMISSIVE").csv(paths)
    return rows.select(*[F.col(names[at]).alias(c) for at, c in zip(places, RAW_COLUMNS)])


def read_csv(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """The twelve raw columns from all paths; any two files may have different headers.

    The first line of every file is looked up ahead, without reading on. Files whose fields stand at the same places
    are read together, whatever their headers call them, so there are as many scans as there are
    really different layouts. What comes to the driver is the file listing, which Spark holds
    there for any scan.
    """
    if not paths:
        raise ValueError("no input path given")
    listed = file_headers(spark, paths).filter(F.size("header") > 0)
    by_header = listed.groupBy("header").agg(F.collect_list("path").alias("paths")).collect()
    if not by_header:
        raise ValueError(f"no CSV file with a header under {list(paths)}")
    layouts = defaultdict(list)
    for row in by_header:
        bound = bind_headers(row["header"])
        places = tuple(row["header"].index(bound[field]) for field in FIELD_HEADERS)
        layouts[(places, len(row["header"]))] += map(unquote, row["paths"])
    frames = [_read_layout(spark, files, *layout) for layout, files in sorted(layouts.items())]
    return reduce(DataFrame.unionByName, frames)


def write_raw_csv(raw: DataFrame, folder: str) -> None:
    """As read: blanks at the ends of fields are kept."""
    (
        raw.write.option("header", True)
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(folder)
    )


# --- describing files ---


# Files whose first lines one job looks up.
FILES_AT_ONCE = 50


def _first_line(session: SparkSession, file: str) -> DataFrame:
    """``path, bytes, line`` of one file; no row if it is empty.

    With a limit in the task that scans the file, the scan stops behind its first line.
    """
    lines = session.read.text(file).select(
        F.lit(file).alias("path"),
        F.col("_metadata.file_size").alias("bytes"),
        F.col("_metadata.file_block_start").alias("block"),
        F.col("value").alias("line"),
    )
    return lines.filter("block = 0").drop("block").coalesce(1).limit(1)


def _first_lines(spark: SparkSession, files: Sequence[str]) -> list[tuple[str, int, str]]:
    """What is read of a file does not grow with its size: a session of its own does not cut files,
    so the first line is the first that the only task of a file meets."""
    alone = spark.newSession()
    for option in ("maxPartitionBytes", "openCostInBytes"):
        alone.conf.set(f"spark.sql.files.{option}", str(1 << 40))

    def job(some: Sequence[str]) -> Callable[[], list[tuple[str, int, str]]]:
        def look_up() -> list[tuple[str, int, str]]:
            each = [_first_line(alone, file) for file in some]
            return [tuple(row) for row in reduce(DataFrame.unionByName, each).collect()]

        return look_up

    jobs = {at: job(files[at : at + FILES_AT_ONCE]) for at in range(0, len(files), FILES_AT_ONCE)}
    found = side_by_side(spark, "headers", jobs, threads=8)
    return [row for rows in found.values() for row in rows]


def file_headers(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """``path, bytes, header`` per CSV file, empty files included.

    The driver holds the listing, as Spark does for any scan, and one header per file. A byte-order
    mark and quotes around names are taken off.
    """
    listed = spark.read.option("pathGlobFilter", "*.csv").text(list(paths)).inputFiles()
    files = [unquote(name) for name in listed]
    first = {path: (size, line) for path, size, line in _first_lines(spark, files)}
    # A local path is written with one slash by the one and with three by the other.
    rows = [
        (re.sub("^file:/+", "file:/", name), *first.get(file, (0, None)))
        for name, file in zip(listed, files)
    ]
    table = spark.createDataFrame(rows, "path string, bytes long, line string")
    line = F.regexp_replace(F.regexp_replace("line", "^﻿", ""), "\r$", "")
    names = F.transform(F.split(line, _COMMA), lambda name: F.regexp_replace(name, '^"|"$', ""))
    header = F.when(F.coalesce(line, F.lit("")) != "", names).otherwise(F.array())
    return table.select("path", "bytes", header.cast("array<string>").alias("header"))


def header_check(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """Per file its number of columns and the required fields it lacks; an empty file lacks all.

    A field is there under any of its accepted headers.
    """
    present = F.transform(
        "header", lambda name: F.regexp_replace(F.lower(name), "[^a-z0-9]", "")
    )
    absent = [
        F.when(
            ~F.arrays_overlap(present, F.array(*[F.lit(plain(a)) for a in aliases])),
            F.lit(plain(aliases[0])),
        )
        for aliases in FIELD_HEADERS.values()
    ]
    return file_headers(spark, paths).select(
        "path",
        "bytes",
        F.size("header").alias("column_count"),
        F.sort_array(F.array_compact(F.array(*absent))).alias("missing"),
    )


def require_headers(spark: SparkSession, paths: Sequence[str], named: int = 10) -> None:
    """Fail unless every file holds all required fields; tells how many do not and names some."""
    bad = header_check(spark, paths).filter(F.size("missing") > 0)
    total = bad.count()
    if total:
        faults = [
            f"{row['path']}: " + (f"missing {', '.join(row['missing'])}" if row["column_count"]
                                  else "empty file")
            for row in bad.orderBy("path").limit(named).collect()
        ]
        raise ValueError(f"{total} unusable CSV files, among them:\n" + "\n".join(faults))


def file_manifest(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """``path, bytes, column_count`` per CSV file."""
    return header_check(spark, paths).drop("missing")
