"""Landing folders: encodings, date styles, odd headers, repeats, history files, streams."""

from __future__ import annotations

import os
from dataclasses import replace
from datetime import date

import pytest

from conftest import rows
from stayledger.dimensions import OPERA, SMILE_HL, SMILE_PQ, Site
from stayledger.plans import staging
from stayledger.plans.staging import (
    OPERA_DAILY_LAYOUT,
    OPERA_FULL_LAYOUT,
    OPERA_HISTORY_LAYOUT,
    SMILE_HL_LAYOUT,
    SMILE_PQ_LAYOUT,
)
from stayledger.schemas import OPERA_FILE, SAMPLE_HEADERS, SMILE_HL_HEADERS, SMILE_PQ_HEADERS, required
from stayledger.sources.workbooks import csv_decoder
from stayledger.streaming.ingest import refresh_stream, stage_stream

SITES = (
    Site("CPV", "Opera site", "CPV", OPERA),
    Site("SRC", "HL site", "SRC", SMILE_HL),
    Site("SBHPQ", "PQ site", "SBHPQ", SMILE_PQ),
    Site("FSH", "not loaded", "FSH", ""),
)
SMILE = {SMILE_HL: SMILE_HL_LAYOUT.delimited(), SMILE_PQ: replace(SMILE_PQ_LAYOUT, decoder=csv_decoder)}
DAILY = {**SMILE, OPERA: OPERA_DAILY_LAYOUT}
FULL = {**SMILE, OPERA: OPERA_FULL_LAYOUT}
HISTORY = {**SMILE, OPERA: OPERA_HISTORY_LAYOUT}


def put(root, folder, name, text, encoding="utf-8"):
    path = root / folder
    path.mkdir(parents=True, exist_ok=True)
    (path / name).write_bytes(text.encode(encoding))


def opera_text(*nights, columns=tuple(OPERA_FILE), extra=(), drop=()):
    """nights: (considered, created, arrival, departure, rooms) as they are written."""
    names = [c for c in (*columns, *extra) if c not in drop]
    lines = ["\t".join(names)]
    for considered, created, arr, dep, rooms in nights:
        cell = {
            "CONSIDERED_DATE": considered, "CREATED_DATE": created, "ARR": arr, "DEP": dep, "NO_ROOMS": rooms,
            "ROOM_REVENUE": "100.50", "FOOD_REVENUE": "1", "OTHER_REVENUE": "", "MARKET_CODE": "TI", "ROOM_CAT": "KNG",
            "RTC": '"K ""X"""', "COUNTRY": "NA",
        }
        lines.append("\t".join(str(cell.get(c, "9")) for c in names))
    return "\r\n".join(lines) + "\r\n"


def smile_text(headers, *nights, drop=()):
    """nights: (staying, arrival, rooms)"""
    names = [h for h in headers if h not in drop]
    lines = [",".join(names)]
    for staying, arrival, rooms in nights:
        cell = {
            "STAYING": staying, "ARRIVAL": arrival, "DEPARTURE": staying, "CREATE_TIME": "2025-07-01 10:00:00",
            "N_OF_ROOM": rooms, "ROOM_REV": "10.005", "ARR": "5", "FB_REV": "1", "OTHER_REV": "", "MARKET": "CW",
        }
        lines.append(",".join(str(cell.get(headers[h], "")) for h in names))
    return "\n".join(lines) + "\n"


def counts(ledger, table="stg_opera"):
    return rows(ledger.table(table).groupBy("PROPERTY", "REPORT_DATE", "FILE_NAME").count())


def test_utf16_serial_dates_with_foreign_columns_in_another_order(spark, ledger, tmp_path):
    text = opera_text(
        ("45870", "45800.5", "45870", "45871", 2), ("45871", "", "45870", "45872", 1),
        columns=tuple(reversed(OPERA_FILE)), extra=("RATE_USD", "GROUP_YN"),
    )
    put(tmp_path / "in", "CPV", "pace_01082025.txt", text, "utf-16")
    put(tmp_path / "in", "CPV", "pace_02082025.txt", opera_text(("45871", "45801", "45871", "45872", 3)), "utf-16")
    staging.stage_full(ledger, str(tmp_path / "in"), SITES, layouts=FULL)
    got = rows(ledger.table("stg_opera"), "REPORT_DATE", "CONSIDERED_DATE", "CREATED_DATE", "NO_ROOMS", "ROOM_REVENUE", "RTC", "COUNTRY")
    assert [(str(r[0]), str(r[1]), str(r[2]), r[3], str(r[4]), r[5], r[6]) for r in got] == [
        ("2025-08-01", "2025-08-01", "2025-05-23", 2, "100.50", 'K "X"', None),
        ("2025-08-01", "2025-08-02", "None", 1, "100.50", 'K "X"', None),
        ("2025-08-02", "2025-08-02", "2025-05-24", 3, "100.50", 'K "X"', None),
    ]


def test_daily_export_keeps_rows_with_bad_dates_for_the_audit(spark, ledger, tmp_path):
    text = "\ufeff" + opera_text(("1-8-2025", "01-07-2025", "01-08-2025", "02-08-2025", 1), ("31-02-2025", "x", "01-08-2025", "02-08-2025", 2))
    put(tmp_path / "in", "CPV", "pace_01082025.txt", text)
    staging.stage_incremental(ledger, str(tmp_path / "in"), SITES, layouts=DAILY)
    assert rows(ledger.table("stg_opera"), "CONSIDERED_DATE", "NO_ROOMS") == [(date(2025, 8, 1), 1), (None, 2)]


def test_unusable_files_are_recorded_and_do_not_stop_the_others(spark, ledger, tmp_path):
    root = tmp_path / "in"
    good = opera_text(("01-08-2025", "01-07-2025", "01-08-2025", "02-08-2025", 1))
    put(root, "CPV", "pace_01082025.txt", good)
    put(root, "CPV", "pace_02082025.txt", opera_text(("01-08-2025", "", "", "", 1), drop=("RTC",)))
    put(root, "CPV", "pace_03082025.txt", "nothing\tuseful\n")
    put(root, "SRC", "Pace_Date01082025_0930.xls", smile_text(SMILE_HL_HEADERS, ("2025-08-01", "2025-08-01", 1)))
    put(root, "SRC", "Pace_Date02082025_0930.xls", smile_text(SMILE_HL_HEADERS, ("2025-08-01", "2025-08-01", 1), drop=("ARR",)))
    put(root, "SRC", "Pace_Date31132025_0930.xls", "junk")
    put(root, "FSH", "Pace_Date01082025_0930.xls", "junk")
    staging.stage_incremental(ledger, str(root), SITES, layouts=DAILY)
    assert counts(ledger) == [("CPV", date(2025, 8, 1), "pace_01082025.txt", 1)]
    assert counts(ledger, "stg_smile") == [("SRC", date(2025, 8, 1), "Pace_Date01082025_0930.xls", 1)]
    manifest = dict((r[0], r[1:]) for r in rows(ledger.table("load_manifest"), "NAME", "STATUS", "REASON"))
    assert manifest["pace_01082025.txt"] == ("LOADED", None)
    assert manifest["pace_02082025.txt"] == ("FAILED", "missing columns: RTC")
    assert manifest["pace_03082025.txt"] == ("FAILED", "no header row")
    assert manifest["Pace_Date02082025_0930.xls"] == ("FAILED", "missing columns: ARR")
    # A refused file stays new: once it is whole, it is taken in.
    put(root, "CPV", "pace_02082025.txt", good)
    staging.stage_incremental(ledger, str(root), SITES, layouts=DAILY)
    assert {r[1] for r in counts(ledger)} == {date(2025, 8, 1), date(2025, 8, 2)}


def test_two_snapshots_a_day_then_a_newer_one_then_the_same_name_again(spark, ledger, tmp_path):
    root = tmp_path / "in"
    night = lambda n: smile_text(SMILE_PQ_HEADERS, *[("2025-08-02", "2025-08-01", 1)] * n)
    put(root, "SBHPQ", "Pace_Date01082025_0900.xls", night(1))
    put(root, "SBHPQ", "Pace_Date01082025_1000.xls", night(2))
    staging.stage_incremental(ledger, str(root), SITES, layouts=DAILY)
    assert [r[2:] for r in counts(ledger, "stg_smile")] == [("Pace_Date01082025_1000.xls", 2)]
    put(root, "SBHPQ", "Pace_Date01082025_1000.xls", night(5))
    staging.stage_incremental(ledger, str(root), SITES, layouts=DAILY)
    assert [r[2:] for r in counts(ledger, "stg_smile")] == [("Pace_Date01082025_1000.xls", 2)]
    put(root, "SBHPQ", "Pace_Date01082025_1100.xls", night(3))
    staging.stage_incremental(ledger, str(root), SITES, layouts=DAILY)
    assert [r[2:] for r in counts(ledger, "stg_smile")] == [("Pace_Date01082025_1100.xls", 3)]
    # A late older file replaces the day, unless asked not to.
    put(root, "SBHPQ", "Pace_Date01082025_0800.xls", night(4))
    staging.stage_incremental(ledger, str(root), SITES, layouts=DAILY, strict_latest=True)
    assert [r[2:] for r in counts(ledger, "stg_smile")] == [("Pace_Date01082025_1100.xls", 3)]
    staging.stage_incremental(ledger, str(root), SITES, layouts=DAILY)
    assert [r[2:] for r in counts(ledger, "stg_smile")] == [("Pace_Date01082025_0800.xls", 4)]
    # A full load starts over and takes the newest.
    staging.stage_full(ledger, str(root), SITES, layouts=DAILY)
    assert [r[2:] for r in counts(ledger, "stg_smile")] == [("Pace_Date01082025_1100.xls", 3)]


def test_history_files(spark, ledger, tmp_path):
    root = tmp_path / "in"
    text = opera_text(("01/Aug/25", "01/Jul/25", "01/AUG/25", "02/Aug/25", 1), ("02/Aug/25", "", "01/Aug/25", "02/Aug/25", 2), ("bad", "", "", "", 3))
    put(root, "CPV", "CPV_history.txt", text, "utf-16")
    put(root, "SRC", "SRC_history.xls", smile_text(SMILE_HL_HEADERS, ("45870", "2025-08-01", 1), ("2025-08-05", "2025-08-01", 7)))
    staging.history_incremental(ledger, str(root), SITES, layouts=HISTORY)
    history = ledger.table("booking_pace_history")
    expected = [
        ("CPV", date(2025, 8, 1), 1, 1, "2025-08", "CPV_history.txt"),
        ("CPV", date(2025, 8, 2), 2, 0, "2025-08", "CPV_history.txt"),
        ("SRC", date(2025, 8, 1), 1, 1, "2025-08", "SRC_history.xls"),
        ("SRC", date(2025, 8, 5), 7, 0, "2025-08", "SRC_history.xls"),
    ]
    shown = ("PROPERTY", "STAYING", "N_OF_ROOM", "BOOKING", "STAY_MONTH", "FILE_NAME")
    assert rows(history, *shown) == expected
    # An empty term leaves a history turnover unknown.
    assert {r.TOTAL_TURN_OVER for r in history.collect()} == {None}
    staging.history_incremental(ledger, str(root), SITES, layouts=HISTORY)
    assert rows(ledger.table("booking_pace_history"), *shown) == expected
    staging.history_full(ledger, str(root), date(2025, 8, 2), SITES, layouts=HISTORY)
    assert rows(ledger.table("booking_pace_history"), *shown) == expected[:3]
    assert rows(ledger.table("booking_pace_actual"), "PROPERTY", "STAYING_DATE", "TOTAL_ROOM", "WINDOW_ID") == [
        ("CPV", date(2025, 8, 1), 1, 6),
        ("CPV", date(2025, 8, 2), 2, None),
        ("SRC", date(2025, 8, 1), 1, 6),
    ]


def test_stream_takes_every_file_once_and_a_late_one_too(spark, ledger, tmp_path):
    root, checkpoint = tmp_path / "in", str(tmp_path / "checkpoint")
    put(root, "CPV", "pace_01082025.txt", opera_text(("01-08-2025", "01-07-2025", "01-08-2025", "02-08-2025", 1)))
    put(root, "SRC", "Pace_Date02082025_0930.xls", smile_text(SMILE_HL_HEADERS, ("2025-08-02", "2025-08-02", 1)))
    stage_stream(ledger, str(root), checkpoint, SITES, DAILY).awaitTermination()
    assert [r[1] for r in counts(ledger)] == [date(2025, 8, 1)]
    late = root / "CPV" / "pace_31072025.txt"
    put(root, "CPV", late.name, opera_text(("31-07-2025", "", "", "", 1), ("01-08-2025", "", "", "", 1)))
    os.utime(late, (1_600_000_000, 1_600_000_000))
    put(root, "SRC", "Pace_Date02082025_0800.xls", smile_text(SMILE_HL_HEADERS, *[("2025-08-02", "2025-08-02", 1)] * 3))
    stage_stream(ledger, str(root), checkpoint, SITES, DAILY).awaitTermination()
    assert [r[1:] for r in counts(ledger)] == [
        (date(2025, 7, 31), "pace_31072025.txt", 2),
        (date(2025, 8, 1), "pace_01082025.txt", 1),
    ]
    # The earlier snapshot of the loaded day came later and does not replace it.
    assert counts(ledger, "stg_smile") == [("SRC", date(2025, 8, 2), "Pace_Date02082025_0930.xls", 1)]


def statuses(ledger):
    return rows(ledger.table("load_manifest"), "NAME", "STATUS", "REASON")


NIGHT = ("01-08-2025", "01-07-2025", "01-08-2025", "02-08-2025", 1)


def test_a_full_load_that_fails_leaves_everything(spark, ledger, tmp_path, monkeypatch):
    root = tmp_path / "in"
    put(root, "CPV", "pace_01082025.txt", opera_text(NIGHT))
    daily = {OPERA: OPERA_DAILY_LAYOUT}
    staging.stage_incremental(ledger, str(root), SITES, layouts=daily)
    before = counts(ledger), statuses(ledger)

    def broken(*_):
        raise OSError("unreadable")

    with monkeypatch.context() as patch:
        patch.setattr(staging, "read_layout", broken)
        with pytest.raises(OSError):
            staging.stage_full(ledger, str(root), SITES, layouts=daily)
    assert (counts(ledger), statuses(ledger)) == before
    # A full load drops what the folder no longer has.
    (root / "CPV" / "pace_01082025.txt").unlink()
    put(root, "CPV", "pace_02082025.txt", opera_text(NIGHT))
    staging.stage_full(ledger, str(root), SITES, layouts=daily)
    assert [r[2] for r in counts(ledger)] == ["pace_02082025.txt"]
    assert statuses(ledger) == [("pace_02082025.txt", "LOADED", None)]
    (root / "CPV" / "pace_02082025.txt").unlink()
    put(root, "CPV", "nothing.log", "x")
    staging.stage_full(ledger, str(root), SITES, layouts=daily)
    assert counts(ledger) == []


def test_cells_that_do_not_fit_are_kept_as_rejected(spark, ledger, tmp_path):
    root = tmp_path / "in"
    text = opera_text(NIGHT, ("01-08-2025", "01-07-2025", "01-08-2025", "x", 2.7)).replace("100.50", "1,234.50", 1)
    put(root, "CPV", "pace_01082025.txt", text)
    staging.stage_incremental(ledger, str(root), SITES, layouts=DAILY)
    assert rows(ledger.table("load_rejects"), "PROPERTY", "FILE_NAME", "COLUMN", "TEXT") == [
        ("CPV", "pace_01082025.txt", "DEP", "x"),
        ("CPV", "pace_01082025.txt", "NO_ROOMS", "2.7"),
        ("CPV", "pace_01082025.txt", "ROOM_REVENUE", "1,234.50"),
    ]
    assert statuses(ledger) == [("pace_01082025.txt", "PARTIAL", "3 cells rejected")]
    # The file counts as taken in; loading the day anew replaces its rejects.
    put(root, "CPV", "pace_x_01082025.txt", opera_text(NIGHT))
    staging.stage_incremental(ledger, str(root), SITES, layouts=DAILY)
    assert ledger.table("load_rejects").isEmpty()


def test_the_header_is_the_first_line(spark, ledger, tmp_path):
    root = tmp_path / "in"
    put(root, "CPV", "pace_01082025.txt", "a title\r\n" + opera_text(NIGHT))
    put(root, "CPV", "pace_02082025.txt", opera_text(NIGHT))
    staging.stage_incremental(ledger, str(root), SITES, layouts=DAILY)
    assert [r[2:] for r in counts(ledger)] == [("pace_02082025.txt", 1)]
    assert statuses(ledger)[0] == ("pace_01082025.txt", "FAILED", "no header row")


def test_odd_names_are_read_as_they_are(spark, ledger, tmp_path):
    root = tmp_path / "in"
    names = ["pace_[a]_01082025.txt", "pace {b}_02082025.txt", "pace*_03082025.txt", "pace?_04082025.txt", "pace%20_05082025.txt", "pa\\ce_06082025.txt"]
    for name in names:
        put(root, "CPV", name, opera_text(NIGHT))
    put(root, "CPV", "pace_99999999.txt", opera_text(NIGHT))
    for _ in range(2):
        staging.stage_incremental(ledger, str(root), SITES, layouts=DAILY)
        assert sorted(r[2] for r in counts(ledger)) == sorted(names)
        assert [s for s in statuses(ledger) if s[1] == "FAILED"] == [("pace_99999999.txt", "FAILED", "no report day in the name")]


def test_a_snapshot_in_parts(spark, ledger, tmp_path):
    root = tmp_path / "in"
    for n in range(3):
        put(root, "CPV/NAME=pace_01082025.txt", f"part-{n}.csv", opera_text(*[NIGHT] * (n + 1)))
    put(root, "CPV/NAME=pace_02082025.txt", "part-0.csv", opera_text(NIGHT))
    put(root, "CPV/NAME=pace_02082025.txt", "part-1.csv", opera_text(NIGHT, drop=("RTC",)))
    for folder in ("pace_01082025.txt", "pace_02082025.txt"):
        (root / "FOLDER=CPV").mkdir(exist_ok=True)
        (root / "CPV" / f"NAME={folder}").rename(root / "FOLDER=CPV" / f"NAME={folder}")
    staging.stage_incremental(ledger, str(root), SITES, layouts=DAILY)
    assert [r[2:] for r in counts(ledger)] == [("pace_01082025.txt", 6)]
    assert statuses(ledger) == [("pace_01082025.txt", "LOADED", None), ("pace_02082025.txt", "FAILED", "missing columns: RTC")]


def test_stream_takes_a_mended_file_and_notes_a_late_one(spark, ledger, tmp_path):
    root, checkpoint = tmp_path / "in", str(tmp_path / "checkpoint")
    put(root, "CPV", "pace_b_01082025.txt", opera_text(NIGHT))
    put(root, "CPV", "pace_02082025.txt", opera_text(NIGHT, drop=("RTC",)))
    stage_stream(ledger, str(root), checkpoint, SITES, DAILY).awaitTermination()
    ledger.refresh()
    assert [r[2] for r in counts(ledger)] == ["pace_b_01082025.txt"]
    put(root, "CPV", "pace_02082025.txt", opera_text(NIGHT))
    put(root, "SRC", "Pace_Date01082025_0930.xls", smile_text(SMILE_HL_HEADERS, ("2025-08-01", "2025-08-01", 1)))
    stage_stream(ledger, str(root), checkpoint, SITES, DAILY).awaitTermination()
    ledger.refresh()
    assert [r[2] for r in counts(ledger)] == ["pace_b_01082025.txt", "pace_02082025.txt"]
    put(root, "SRC", "Pace_Date01082025_0800.xls", smile_text(SMILE_HL_HEADERS, ("2025-08-01", "2025-08-01", 1)))
    stage_stream(ledger, str(root), checkpoint, SITES, DAILY).awaitTermination()
    ledger.refresh()
    assert ("Pace_Date01082025_0800.xls", "SKIPPED", "a newer snapshot of the day is loaded") in statuses(ledger)


def test_stream_refreshes_the_marts(spark, ledger, tmp_path):
    root = tmp_path / "in"
    put(root, "SRC", "Pace_Date02082025_0930.xls", smile_text(SMILE_HL_HEADERS, ("2025-08-02", "2025-08-02", 4), ("2025-08-01", "2025-08-01", 2)))
    refresh_stream(ledger, str(root), str(tmp_path / "c"), date(2025, 8, 2), sites=SITES, layouts=DAILY).awaitTermination()
    assert rows(ledger.table("booking_pace_report"), "STAYING_DATE", "TOTAL_ROOM") == [(date(2025, 8, 2), 4)]
    assert rows(ledger.table("booking_pace_actual"), "STAYING_DATE", "TOTAL_ROOM") == [(date(2025, 8, 1), 2)]


def test_sample_workbook(spark, ledger, tmp_path):
    cells = {"Arrival": "45329.0", "Deprature": "45330", "Staying": "45329.5", "Creation Date": "45300", "Property": "SRC", "N of Room": "2.0"}
    put(tmp_path, "s", "sample.csv", ",".join(SAMPLE_HEADERS) + "\n" + ",".join(cells.get(h, "") for h in SAMPLE_HEADERS) + "\n")
    staging.load_sample(ledger, str(tmp_path / "s" / "sample.csv"))
    got = ledger.table("booking_pace_sample_data")
    assert rows(got, "REPORT_DATE", "STAY_MONTH", "STAYING", "N_OF_ROOM") == [(date(2023, 5, 1), "2024-02", date(2024, 2, 7), 2)]


def test_missing_column_is_named(spark):
    with pytest.raises(ValueError, match="missing columns: B"):
        required(spark.range(1).withColumnRenamed("id", "A"), ["A", "B"])
