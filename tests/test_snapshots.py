"""File names, newest per day, files not loaded yet."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import functions as F

from conftest import rows
from stayledger.operators import snapshots


def files(spark, *names, modified=datetime(2025, 8, 2, 10)):
    data = [("SRC", n, modified, modified) for n in names]
    return spark.createDataFrame(data, "PROPERTY string, NAME string, MODIFIED_AT timestamp_ntz, CREATED_AT timestamp_ntz")


def test_smile_names(spark):
    df = snapshots.with_smile_name(
        files(spark, "Pace_Date01082025_0930.xls", "01082025_2359", "Pace_Date31132025_0930.xls", "SRC_history.xls", "pace.xls")
    )
    assert rows(df, "NAME", "REPORT_AT", "REPORT_DATE") == [
        ("01082025_2359", datetime(2025, 8, 1, 23, 59), date(2025, 8, 1)),
        ("Pace_Date01082025_0930.xls", datetime(2025, 8, 1, 9, 30), date(2025, 8, 1)),
        ("Pace_Date31132025_0930.xls", None, None),
        ("SRC_history.xls", None, None),
        ("pace.xls", None, None),
    ]
    assert rows(snapshots.unnamed_files(df), "NAME") == [("Pace_Date31132025_0930.xls",), ("pace.xls",)]


def test_opera_names(spark):
    df = snapshots.with_opera_name(files(spark, "pace_01082025.txt", "pace.TXT", "pace_01082025.xls", "x_History_01082025.txt"))
    assert dict(rows(df, "NAME", "REPORT_AT")) == {
        "pace_01082025.txt": datetime(2025, 8, 1),
        "pace.TXT": datetime(2025, 8, 2, 10),
        "pace_01082025.xls": None,
        "x_History_01082025.txt": None,
    }


def test_suffix_date(spark):
    df = files(spark, "x_20250801.txt", "a_b_20250802", "x_0801.txt").select("NAME", snapshots.suffix_date(F.col("NAME")).alias("d"))
    assert rows(df) == [("a_b_20250802", date(2025, 8, 2)), ("x_0801.txt", None), ("x_20250801.txt", date(2025, 8, 1))]


def test_newest_per_day_and_ties(spark):
    same = snapshots.with_smile_name(
        files(spark, "a01082025_0900", "b01082025_0930", "c01082025_0930", "d02082025_0100")
    )
    assert rows(snapshots.latest_per_day(same), "NAME") == [("c01082025_0930",), ("d02082025_0100",)]


def test_late_older_file(spark):
    late = snapshots.with_smile_name(files(spark, "a01082025_0900"))
    loaded = snapshots.with_smile_name(files(spark, "b01082025_0930"))
    assert rows(snapshots.latest_per_day(late), "NAME") == [("a01082025_0900",)]
    assert rows(snapshots.latest_per_day(late, loaded)) == []


def test_new_files_are_told_apart_by_name_within_a_property(spark):
    raw = files(spark, "a", "b").unionByName(files(spark, "a").withColumn("PROPERTY", F.lit("HLP")))
    assert rows(snapshots.new_files(raw, files(spark, "a")), "PROPERTY", "NAME") == [("HLP", "a"), ("SRC", "b")]


def test_history_file_is_the_first_by_name(spark):
    got = snapshots.history_file(files(spark, "z_history.xls", "b_HISTORY.xls", "pace.xls"))
    assert rows(got, "NAME") == [("b_HISTORY.xls",)]
