import datetime as dt
from pathlib import Path

import pytest

from tidemark.sources import csv_files, sinks
from tidemark.sources.csv_files import RAW_COLUMNS, file_headers
from tidemark.sources.months import month_calendar, month_coverage
from tidemark.sources.shared import kept, save_shared, shared_area, shared_folder

HEADER = ",".join(csv_files.RAW_COLUMNS)
ROW = "2023-01-01,AA,1,SEA,LAX,800,1030,150,954,14,0,0"
SWAPPED = HEADER.replace("Origin,Dest", "Dest,Origin")


def write(folder, name, *lines, start=""):
    folder.mkdir(exist_ok=True)
    path = folder / name
    path.write_text(start + "\n".join(lines) + "\n", encoding="utf-8")
    return str(path)


def test_csv_is_read_as_text_with_aliases_and_extra_columns(spark, tmp_path):
    write(tmp_path / "new", "a.csv", "Year," + HEADER, "2023," + ROW, start="﻿")
    old = HEADER.replace("FlightDate", "FL_DATE").replace("Reporting_Airline,", "UniqueCarrier,", 1)
    write(tmp_path / "old", "b.csv", old, ROW.replace("AA", "007"))
    raw = csv_files.read_csv(spark, [str(tmp_path / "new"), str(tmp_path / "old" / "*.csv")])
    assert raw.columns == list(csv_files.RAW_COLUMNS)
    assert {kind for _, kind in raw.dtypes} == {"string"}
    assert sorted(r["Reporting_Airline"] for r in raw.collect()) == ["007", "AA"]
    with pytest.raises(ValueError):
        csv_files.read_csv(spark, [])


def test_files_of_any_layout_are_read_together(spark, tmp_path):
    write(tmp_path / "in", "a.csv", HEADER, ROW)
    write(tmp_path / "in", "b c.csv", SWAPPED, ROW.replace("SEA,LAX", "LAX,SEA"))
    for i in range(120):  # other names, same places
        write(tmp_path / "in", f"d{i}.csv", HEADER.replace("FlightDate", f"fl{'_' * i}date"),
              ROW.replace("AA,1", f"AA,{100 + i}"))
    mixed = csv_files.read_csv(spark, [str(tmp_path / "in")])
    assert {(r["Origin"], r["Dest"]) for r in mixed.collect()} == {("SEA", "LAX")}
    assert mixed.count() == 122
    assert mixed._jdf.queryExecution().analyzed().toString().count("Relation") == 2


def test_missing_columns_are_named(spark, tmp_path):
    write(tmp_path / "in", "a.csv", HEADER.replace("Distance,", ""), ROW)
    with pytest.raises(ValueError, match="distance_raw"):
        csv_files.read_csv(spark, [str(tmp_path / "in")])


def test_every_file_is_checked(spark, tmp_path):
    folder = tmp_path / "in"
    write(folder, "good.csv", '"Year",' + HEADER, "2023," + ROW, start="﻿")
    csv_files.require_headers(spark, [str(folder)])
    write(folder, "bad.csv", HEADER.replace("Distance,", "").replace(",Dest", ""), ROW)
    (folder / "empty.csv").write_text("")
    got = {r["path"].rsplit("/", 1)[1]: r
           for r in csv_files.header_check(spark, [str(folder)]).collect()}
    assert got["good.csv"]["missing"] == [] and got["good.csv"]["column_count"] == 13
    assert got["bad.csv"]["missing"] == ["dest", "distance"]
    assert got["empty.csv"]["column_count"] == 0
    with pytest.raises(ValueError, match="empty.csv: empty file"):
        csv_files.require_headers(spark, [str(folder)])


def bytes_read_by_last_job(spark, folder):
    """What one more look-up adds to the bytes that this process's file systems have read."""
    statistics = spark._jvm.org.apache.hadoop.fs.FileSystem.getAllStatistics

    def total():
        return sum(s.getBytesRead() for s in statistics())

    before = total()
    file_headers(spark, [folder]).collect()
    return total() - before


def test_header_look_up_reads_no_further_than_it_has_to(spark, tmp_path):
    """Twenty times the rows cost no more bytes; a scan would read them all."""
    header = ",".join(RAW_COLUMNS)
    sizes = {}
    for name, rows in (("small", 20_000), ("large", 400_000)):
        (tmp_path / name).mkdir()
        line = ",".join("x" * 8 for _ in RAW_COLUMNS)
        (tmp_path / name / "a.csv").write_text(header + "\n" + (line + "\n") * rows)
        found = file_headers(spark, [str(tmp_path / name)]).collect()
        assert [r["header"] for r in found] == [list(RAW_COLUMNS)]
        assert found[0]["bytes"] == (tmp_path / name / "a.csv").stat().st_size
        sizes[name] = bytes_read_by_last_job(spark, str(tmp_path / name))
    assert sizes["large"] < 4 << 20 < found[0]["bytes"]


def test_headers_where_files_are_cut_or_put_together(spark, tmp_path):
    """Sessions that cut files or pack several into a task change nothing."""
    for i in range(5):
        (tmp_path / f"{i} é.csv").write_text(f"a{i},b\n" + "1,2\n" * 5000)
    (tmp_path / "empty.csv").write_text("")
    expected = {f"a{i}" for i in range(5)}
    held = spark.newSession()
    for bytes_ in ("4096", "10000000"):
        held.conf.set("spark.sql.files.maxPartitionBytes", bytes_)
        rows = file_headers(held, [str(tmp_path)]).collect()
        assert len(rows) == 6
        assert {r["header"][0] for r in rows if r["header"]} == expected


def test_manifest(spark, tmp_path):
    path = write(tmp_path / "in", "a b.csv", HEADER, *[ROW] * 5000)
    row = csv_files.file_manifest(spark, [str(tmp_path / "in")]).first()
    assert row["bytes"] == len(open(path, "rb").read()) and row["column_count"] == 12


def test_months(spark):
    start, end = dt.date(2023, 1, 15), dt.date(2025, 12, 31)
    assert month_calendar(spark, start, end).count() == 36
    dated = spark.createDataFrame([(dt.date(2023, 1, 20),), (dt.date(2023, 3, 1),)],
                                  "flight_date date")
    got = month_coverage(dated, start, dt.date(2023, 3, 31)).orderBy("month_start").collect()
    assert [(r["row_count"], r["present"]) for r in got] == [(1, True), (0, False), (1, True)]


def test_reports_are_one_file_and_never_empty(spark, tmp_path):
    df = spark.createDataFrame([("a", 1), ("b", None)], "k string, v int")
    sinks.write_report(df, str(tmp_path / "report"))
    assert len(list((tmp_path / "report").glob("*.csv"))) == 1
    again = spark.read.option("header", True).csv(str(tmp_path / "report"))
    assert sorted(map(tuple, again.collect())) == [("a", "1"), ("b", None)]
    with pytest.raises(ValueError):
        sinks.write_report(df.limit(0), str(tmp_path / "none"))
    assert not (tmp_path / "none").exists()


def test_json_sorts_keys_and_refuses_nan(spark, tmp_path):
    df = spark.sql(
        "SELECT 2 AS b, named_struct('z', date'2023-01-01', 'a', CAST(NULL AS int)) AS s, "
        "array(named_struct('y', 1.5D, 'x', 'q')) AS a")
    sinks.write_json(df, str(tmp_path / "doc"))
    text = next((tmp_path / "doc").glob("*.txt")).read_text().strip()
    assert text == '{"a":[{"x":"q","y":1.5}],"b":2,"s":{"a":null,"z":"2023-01-01"}}'
    for bad in ("double('NaN')", "double('Infinity')"):
        with pytest.raises(Exception, match="not a finite number"):
            sinks.json_lines(spark.sql(f"SELECT {bad} AS x")).collect()


def test_shared_tables(spark):
    df = spark.range(10).selectExpr("id", "id * 2 AS twice")
    one, two = save_shared(df, "t"), save_shared(df, "t")
    assert one.schema.names == ["id", "twice"] and one.exceptAll(two).isEmpty()
    assert all(shared_folder(spark) in name for name in one.inputFiles())
    with kept(df):
        assert df.is_cached
    assert not df.is_cached


def test_an_area_is_deleted_at_its_end(spark):
    df = spark.range(3)
    with shared_area(spark) as folder:
        inside = save_shared(df, "t")
        assert folder in inside.inputFiles()[0] and inside.count() == 3
        place = Path(inside.inputFiles()[0].removeprefix("file://")).parent
        assert place.exists()
    assert not place.parent.exists()
    assert folder not in save_shared(df, "t").inputFiles()[0]


class _Session:
    """Just enough of a session to ask for its shared folder."""

    def __init__(self, **conf):
        self.conf = conf
        self.sparkContext = self

    def getCheckpointDir(self):
        return None


def test_shared_folder_comes_from_the_session():
    named = _Session(**{"spark.checkpoint.dir": "hdfs://nn/shared/"})
    assert shared_folder(named) == "hdfs://nn/shared"
    unnamed = _Session(**{"spark.sql.warehouse.dir": "hdfs://nn/warehouse"})
    assert shared_folder(unnamed) == "hdfs://nn/warehouse/shared"


def test_raw_records_are_joined_once_for_all_files(spark, monkeypatch):
    from tidemark.catalog import bindings, queries

    calls, raw = [], bindings.flights_raw
    monkeypatch.setattr(bindings, "flights_raw", lambda *a: calls.append(1) or raw(*a))
    made = queries._saved_raw(spark, "/root/testdata/sf0.001")
    assert not any("/lineitem" in name for name in made.inputFiles())
    queries.checked_headers(spark, "/root/testdata/sf0.001").collect()
    assert len(calls) == 2
