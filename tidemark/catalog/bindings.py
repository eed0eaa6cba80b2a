"""The given tables seen as raw text records (for cleaning) and as outcome events (for history)."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.accepted import accepted_rows, derive_columns, unique_rows
from tidemark.operators.features import add_schedule_features
from tidemark.operators.history import Histories, attach_history, histories
from tidemark.operators.splits import add_split
from tidemark.operators.staging import stage
from tidemark.sources.shared import save_shared
from tidemark.spec import ENTITIES, SplitBounds

# Bounds inside the range of l_shipdate, so that rows fall before, into and after every split.
BOUNDS = SplitBounds(
    start=dt.date(1995, 2, 1),
    train_end=dt.date(1999, 12, 31),
    validation_end=dt.date(2000, 12, 31),
    test_end=dt.date(2001, 9, 30),
)

# events.value at or above this counts as a positive outcome.
EVENT_VALUE = 15.0
EVENT_ENTITIES = ("user_id", "event_type")
DAY_SECONDS = 86400.0

# Columns read from each table. With the schema given Spark opens no file before the scan.
SCHEMAS = {
    "nation": "n_nationkey int, n_name string",
    "supplier": "s_suppkey bigint, s_nationkey int",
    "customer": "c_custkey bigint, c_nationkey int",
    "orders": "o_orderkey bigint, o_custkey bigint",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
    "l_quantity double, l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def flights_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Twelve text fields per line item, with defects planted by divisibility of the part key.

    First lines of an order appear twice, the second time one minute later: copies to remove.
    """
    # Base tables are joined one by one: their file sizes are known, so Spark broadcasts a
    # dimension only while it is below the session's threshold.
    nation = table(spark, sf_dir, "nation")
    sn = nation.withColumnsRenamed({"n_nationkey": "sn_key", "n_name": "sn"})
    cn = nation.withColumnsRenamed({"n_nationkey": "cn_key", "n_name": "cn"})
    line = (
        table(spark, sf_dir, "lineitem")
        .join(table(spark, sf_dir, "supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
        .join(sn, F.col("s_nationkey") == F.col("sn_key"))
        .join(table(spark, sf_dir, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
        .join(table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
        .join(cn, F.col("c_nationkey") == F.col("cn_key"))
        .select(
            "l_orderkey",
            F.col("l_partkey").alias("pk"),
            F.col("l_linenumber").alias("ln"),
            F.col("l_quantity").cast("long").alias("q"),
            F.col("l_shipdate").cast("date").alias("day"),
            F.col("s_nationkey").alias("nk"),
            "sn",
            "cn",
        )
    )
    late = F.when(F.col("ln") == 1, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    line = line.withColumn("shift", F.explode(late))

    pk, ln, q = F.col("pk"), F.col("ln"), F.col("q")

    def every(n: int) -> Column:
        return pk % n == 0

    def text(column: Column) -> Column:
        return column.cast("string")

    return line.select(
        F.when(every(97), "not-a-date")
        .when(ln % 3 == 0, F.date_format("day", "yyyy-MM-dd"))
        .when(ln % 3 == 1, F.date_format("day", "M/d/yyyy"))
        .otherwise(F.date_format("day", "yyyyMMdd"))
        .alias("FlightDate"),
        F.when(every(89), "  ")
        .otherwise(F.concat(F.lit(" "), F.lower("sn"), F.lit(" ")))
        .alias("Reporting_Airline"),
        text(F.col("l_orderkey")).alias("Flight_Number_Reporting_Airline"),
        F.lower("sn").alias("Origin"),
        F.col("cn").alias("Dest"),
        F.when(every(83), "2560")
        .when(every(79), "2400")
        .when(every(73), "900.0")
        .when(every(43), F.concat(F.lit("\t"), text((pk % 24) * 100), F.lit("\t ")))
        .when(every(41), ".5")
        .otherwise(text((pk % 24) * 100 + q % 60))
        .alias("CRSDepTime"),
        text(((pk + 3) % 24) * 100 + ln).alias("CRSArrTime"),
        F.when(every(71), "0").otherwise(text(60 + 5 * q)).alias("CRSElapsedTime"),
        F.when(every(67), "").otherwise(text(100 + pk % 2000)).alias("Distance"),
        F.when(every(61), "")
        .otherwise(text(q + 2 * (F.col("nk") % 7) - 30 + F.col("shift")))
        .alias("ArrDelay"),
        F.when(every(47), "").when(every(59), "1").otherwise("0").alias("Cancelled"),
        F.when(every(53), "1.0").otherwise("0").alias("Diverted"),
    )


def staged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stage(flights_raw(spark, sf_dir), BOUNDS)


def accepted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return accepted_rows(staged(spark, sf_dir))


def saved_accepted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The accepted table, its base columns written out, for queries that read it repeatedly."""
    return derive_columns(save_shared(unique_rows(staged(spark, sf_dir)), "unique"))


def saved_histories(rows: DataFrame, entities: Sequence[str] = ENTITIES) -> Histories:
    return histories(rows, entities, save=save_shared)


def with_history(rows: DataFrame, entities: Sequence[str] = ENTITIES) -> DataFrame:
    return add_split(attach_history(rows, saved_histories(rows, entities)), BOUNDS)


def featured(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_history(add_schedule_features(saved_accepted(spark, sf_dir)))


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Accepted rows with a model-free score: the smoothed route rate."""
    rows = with_history(saved_accepted(spark, sf_dir), ["route"])
    return rows.withColumn("probability_score", F.col("hist_route_delay_rate"))


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        "event_id",
        "user_id",
        "event_type",
        F.col("ts").cast("date").alias("day"),
        (F.hour("ts") * 3600 + F.minute("ts") * 60 + F.second("ts")).alias("second_of_day"),
        (F.col("value") >= EVENT_VALUE).cast("double").alias("label"),
    )
