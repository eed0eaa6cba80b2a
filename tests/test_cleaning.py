import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidemark import spec
from tidemark.functions.clock import is_hhmm, iso_weekday, minutes_of_day
from tidemark.functions.parsing import first_date, real_number, whole_number
from tidemark.operators.accepted import accepted_rows, keep_first, unique_rows
from tidemark.operators.headers import bind_headers, resolve_fields
from tidemark.operators.quality import quality_report, reason_counts
from tidemark.operators.staging import stage
from tidemark.sources.csv_files import RAW_COLUMNS
from tidemark.sources.shared import save_shared

BOUNDS = spec.SplitBounds()
GOOD = ("2023-01-01", "AA", "1", "SEA", "LAX", "800", "1030", "150", "954", "14", "0", "0")


def record(**changes):
    row = dict(zip(RAW_COLUMNS, GOOD))
    row.update(changes)
    return tuple(row[name] for name in RAW_COLUMNS)


def raw(spark, *rows):
    return spark.createDataFrame(list(rows), ", ".join(f"{c} string" for c in RAW_COLUMNS))


def one_column(spark, values):
    rows = [(i, value) for i, value in enumerate(values)]
    return spark.createDataFrame(rows, "i int, text string").orderBy("i")


def values(df):
    return [row[0] for row in df.collect()]


def test_exclusions_and_the_late_boundary(spark):
    staged = stage(
        raw(
            spark,
            record(),
            record(Flight_Number_Reporting_Airline="2", CRSDepTime="900", ArrDelay="15"),
            record(Flight_Number_Reporting_Airline="3", ArrDelay="", Cancelled="1"),
            record(Flight_Number_Reporting_Airline="4", ArrDelay="", Diverted="1"),
        ),
        BOUNDS,
    )
    labels = accepted_rows(staged).orderBy("flight_number").select("label")
    assert values(labels) == [0.0, 1.0]
    counts = {r["rejection_reason"]: r["row_count"] for r in reason_counts(staged).collect()}
    assert counts == {"ACCEPTED": 2, "CANCELLED": 1, "DIVERTED": 1}


REASONS = [
    ({}, "ACCEPTED"),
    ({"FlightDate": "soon"}, "INVALID_FLIGHT_DATE"),
    ({"FlightDate": None}, "INVALID_FLIGHT_DATE"),
    ({"FlightDate": "2022-12-31"}, "OUTSIDE_PROJECT_DATE_RANGE"),
    ({"FlightDate": "2026-01-01"}, "OUTSIDE_PROJECT_DATE_RANGE"),
    ({"FlightDate": "12/31/2025"}, "ACCEPTED"),
    ({"FlightDate": "20230101"}, "ACCEPTED"),
    ({"Cancelled": "1.0"}, "CANCELLED"),
    ({"Cancelled": "2.0"}, "ACCEPTED"),
    ({"Diverted": "1"}, "DIVERTED"),
    ({"Reporting_Airline": "  "}, "MISSING_IDENTIFIER"),
    ({"Flight_Number_Reporting_Airline": None}, "MISSING_IDENTIFIER"),
    ({"Origin": ""}, "MISSING_IDENTIFIER"),
    ({"Dest": None}, "MISSING_IDENTIFIER"),
    ({"Dest": "\t"}, "ACCEPTED"),
    ({"CRSDepTime": "2560"}, "INVALID_SCHEDULED_TIME"),
    ({"CRSDepTime": "2400"}, "ACCEPTED"),
    ({"CRSDepTime": "2401"}, "INVALID_SCHEDULED_TIME"),
    ({"CRSDepTime": "-5"}, "INVALID_SCHEDULED_TIME"),
    ({"CRSDepTime": "900.0"}, "ACCEPTED"),
    ({"CRSArrTime": ""}, "INVALID_SCHEDULED_TIME"),
    ({"CRSArrTime": "1060"}, "INVALID_SCHEDULED_TIME"),
    ({"CRSElapsedTime": "0"}, "INVALID_SCHEDULED_DURATION"),
    ({"CRSElapsedTime": None}, "INVALID_SCHEDULED_DURATION"),
    ({"Distance": "-1"}, "INVALID_DISTANCE"),
    ({"Distance": "far"}, "INVALID_DISTANCE"),
    ({"ArrDelay": ""}, "MISSING_ARRIVAL_DELAY"),
    ({"ArrDelay": "NaN"}, "MISSING_ARRIVAL_DELAY"),
    ({"Cancelled": ""}, "MISSING_STATUS_FLAG"),
    ({"Diverted": None}, "MISSING_STATUS_FLAG"),
    # The first rule that applies decides.
    ({"FlightDate": "soon", "Cancelled": "1"}, "INVALID_FLIGHT_DATE"),
    ({"Cancelled": "1", "Diverted": "1", "ArrDelay": ""}, "CANCELLED"),
    ({"Cancelled": "", "ArrDelay": ""}, "MISSING_ARRIVAL_DELAY"),
    ({"Origin": "", "Distance": "0"}, "MISSING_IDENTIFIER"),
]


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_every_row_gets_its_first_reason(spark, ansi):
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        rows = [
            record(Flight_Number_Reporting_Airline=str(i)) if not changes else record(**changes)
            for i, (changes, _) in enumerate(REASONS)
        ]
        staged = stage(raw(spark, *rows).coalesce(1), BOUNDS)
        assert values(staged.select("rejection_reason")) == [reason for _, reason in REASONS]
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)


def test_dates(spark):
    texts = ["2023-01-05", "1/5/2023", "01/05/2023", "20230105", "2023-1-5", "02/30/2023",
             "2023-01-05 12:00:00 AM", "", None]
    got = values(one_column(spark, texts).select(first_date("text", spec.DATE_FORMATS)))
    day = dt.date(2023, 1, 5)
    assert got == [day, day, day, day, None, None, None, None, None]


def test_numbers(spark):
    whole = one_column(spark, [" 800 ", "800.0", "800.", "-3", "8e2", "800d", "", None, "x",
                             "\t800", "800\t ", ".5", "-.5", ".", "+"])
    assert values(whole.select(whole_number("text"))) == [
        800, 800, 800, -3, None, None, None, None, None, 800, 800, 0, 0, None, None
    ]
    real = one_column(spark, [" 1.5 ", "", None, "NaN", "x", "-2"])
    assert values(real.select(real_number("text"))) == [1.5, None, None, None, None, -2.0]


def test_clock(spark):
    readings = [0, 59, 60, 1230, 2359, 2360, 2400, 2401, -1, None]
    df = spark.createDataFrame([(i, r) for i, r in enumerate(readings)], "i int, r int")
    rows = df.orderBy("i").select(is_hhmm(F.col("r")), minutes_of_day(F.col("r"))).collect()
    assert [r[0] for r in rows] == [
        True, True, False, True, True, False, True, False, False, False
    ]
    assert [rows[i][1] for i in (0, 1, 3, 4, 6)] == [0.0, 59.0, 750.0, 1439.0, 0.0]
    days = spark.sql("SELECT explode(sequence(date'2024-01-01', date'2024-01-07')) AS d")
    assert values(days.select(iso_weekday(F.col("d")))) == [1, 2, 3, 4, 5, 6, 7]


def test_headers_bind_by_alias_and_first_alias_wins(spark):
    headers = ["fl date", "UniqueCarrier", "OP_UNIQUE_CARRIER", "FlightNum", "ORIGIN",
               "destination", "crs_dep_time", "CRS ARR TIME", "CRSElapsedTime", "Distance",
               "arr.delay", "Canceled", "diverted", "something else"]
    bound = bind_headers(headers)
    assert bound["flight_date_raw"] == "fl date" and bound["carrier"] == "UniqueCarrier"
    assert bound["arr_delay_raw"] == "arr.delay"
    df = spark.createDataFrame([tuple("abcdefghijklmn")], headers)
    assert resolve_fields(df).columns == list(spec.FIELD_HEADERS)
    assert resolve_fields(df).first()["arr_delay_raw"] == "k"


def test_missing_and_clashing_headers_are_named():
    with pytest.raises(ValueError, match="carrier.*distance_raw"):
        bind_headers([h for h in RAW_COLUMNS if h not in ("Reporting_Airline", "Distance")])
    with pytest.raises(ValueError, match="origin"):
        bind_headers([*RAW_COLUMNS, "ORI_GIN"])


def test_copies_keep_the_least_row(spark):
    staged = stage(
        raw(
            spark,
            record(ArrDelay="16", CRSArrTime="1030"),
            record(ArrDelay="14", CRSArrTime="1040"),
            record(ArrDelay="14", CRSArrTime="1035"),
            record(ArrDelay="20", Reporting_Airline=" aa "),
            record(CRSDepTime="801"),
        ),
        BOUNDS,
    )
    rows = accepted_rows(staged).orderBy("crs_dep_time").collect()
    assert [(r["crs_dep_time"], r["arr_delay"], r["crs_arr_time"]) for r in rows] == [
        (800, 14.0, 1035), (801, 14.0, 1030)
    ]
    assert accepted_rows(staged).columns == list(spec.ACCEPTED_COLUMNS)
    report = {(r["stage"], r["reason"]): r["row_count"] for r in quality_report(staged).collect()}
    assert report == {
        ("input", "ALL_ROWS"): 5,
        ("cleaning", "ACCEPTED"): 5,
        ("deduplication", "DUPLICATE_ROWS_REMOVED"): 3,
        ("final_clean_data", "ACCEPTED_UNIQUE_FLIGHTS"): 2,
    }


def test_report_from_written_tables_is_the_same(spark):
    rows = [record(Flight_Number_Reporting_Airline=str(i % 7), Diverted=str(int(i % 5 == 0)))
            for i in range(30)]
    staged = save_shared(stage(raw(spark, *rows), BOUNDS), "staged")
    one_pass = quality_report(staged)
    counted = quality_report(staged, save_shared(unique_rows(staged), "unique"))
    assert sorted(map(tuple, one_pass.collect())) == sorted(map(tuple, counted.collect()))
    total = {(r["stage"], r["reason"]): r["row_count"] for r in counted.collect()}
    assert total["cleaning", "ACCEPTED"] + total["cleaning", "DIVERTED"] == 30


def test_report_without_accepted_rows(spark):
    staged = stage(raw(spark, record(Cancelled="1"), record(Cancelled="1")), BOUNDS)
    report = {(r["stage"], r["reason"]): r["row_count"] for r in quality_report(staged).collect()}
    assert report == {
        ("input", "ALL_ROWS"): 2,
        ("cleaning", "CANCELLED"): 2,
        ("deduplication", "DUPLICATE_ROWS_REMOVED"): 0,
        ("final_clean_data", "ACCEPTED_UNIQUE_FLIGHTS"): 0,
    }


def test_copies_shrink_before_the_shuffle(spark, plan):
    df = spark.range(100).selectExpr("id % 3 AS k", "id AS v")
    text = plan(keep_first(df, ["k"], ["v"]))
    below = text[text.index("Exchange"):]
    assert "WindowGroupLimit" in below and "Partial" in below
    assert {(r["k"], r["v"]) for r in keep_first(df, ["k"], ["v"]).collect()} == {
        (0, 0), (1, 1), (2, 2)
    }


def test_parsing_is_not_pushed_into_a_filter(spark, plan):
    text = plan(accepted_rows(stage(raw(spark, record()), BOUNDS)))
    assert not any("Filter" in line and "gettimestamp" in line for line in text.splitlines())
    assert text.count("Exchange") == 1
