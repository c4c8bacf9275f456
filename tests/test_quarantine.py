"""What cannot be taken in is kept: history files, samples, reasons; replayed batches, archives, headers, pages."""

from __future__ import annotations

import json
import os
from datetime import date, datetime

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from booking import at, day, opera, smile
from conftest import rows
from stayledger import cli
from stayledger.dimensions import OPERA, site_registry
from stayledger.functions import dates
from stayledger.operators import audits
from stayledger.plans import ledger as marts
from stayledger.plans import staging
from stayledger.schemas import SAMPLE_HEADERS, SMILE_HL_HEADERS
from stayledger.sinks.archive import archive_taken
from stayledger.sinks.tables import TABLES, Ledger
from stayledger.sources import delimited, heads
from stayledger.sources.cells import outcome
from stayledger.sources.files import list_files, list_snapshots
from stayledger.streaming import batches, ingest
from test_files import DAILY, HISTORY, NIGHT, SITES, counts, opera_text, put, smile_text, statuses

MARTS = ("booking_pace_detail", "booking_pace_history", "booking_pace_report", "booking_pace_actual")


def rejects(ledger):
    return rows(ledger.table("load_rejects"), "PROPERTY", "FILE_NAME", "COLUMN", "TEXT", "REASON", "STAYING")


def test_a_history_file_loses_no_cell_and_no_row_unseen(spark, ledger, tmp_path):
    root = tmp_path / "in"
    text = opera_text(("01/Aug/25", "01/Jul/25", "01/Aug/25", "02/Aug/25", 1), ("31/Feb/25", "", "01/Aug/25", "02/Aug/25", 2), ("", "", "", "", 3))
    put(root, "CPV", "CPV_history.txt", text.replace("100.50", "1,234.50", 1), "utf-16")
    put(root, "SRC", "SRC_history.xls", smile_text(SMILE_HL_HEADERS, ("2025-08-01", "2025-08-01", 1), drop=("ARR",)))
    for _ in range(2):
        staging.history_incremental(ledger, str(root), SITES, layouts=HISTORY)
        assert rows(ledger.table("booking_pace_history"), "PROPERTY", "STAYING", "ROOM_REV") == [("CPV", date(2025, 8, 1), None)]
        assert rejects(ledger) == [
            ("CPV", "CPV_history.txt", "CONSIDERED_DATE", "31/Feb/25", "no such day", None),
            ("CPV", "CPV_history.txt", "CONSIDERED_DATE", None, "no night", None),
            ("CPV", "CPV_history.txt", "ROOM_REVENUE", "1,234.50", "not a number", date(2025, 8, 1)),
        ]
        # Rows that could not be taken in are there as a whole.
        lost = [json.loads(r.LEFT_OUT) for r in ledger.table("load_rejects").where("LEFT_OUT IS NOT NULL").collect()]
        assert sorted(r["NO_ROOMS"] for r in lost) == [2, 3] and {r["ROOM_REVENUE"] for r in lost} == {100.5}
        assert statuses(ledger) == [
            ("CPV_history.txt", "PARTIAL", "3 cells rejected, 2 rows left out"),
            ("SRC_history.xls", "FAILED", "missing columns: ARR"),
        ]
    # Mended files replace their entries and rejects.
    put(root, "CPV", "CPV_history.txt", opera_text(("01/Aug/25", "", "", "", 1), ("02/Aug/25", "", "", "", 2)), "utf-16")
    put(root, "SRC", "SRC_history.xls", smile_text(SMILE_HL_HEADERS, ("2025-08-01", "2025-08-01", 1)))
    staging.history_full(ledger, str(root), date(2025, 8, 31), SITES, layouts=HISTORY)
    assert rejects(ledger) == [] and {s[1] for s in statuses(ledger)} == {"LOADED"}
    assert rows(ledger.table("booking_pace_history"), "PROPERTY", "STAYING") == [
        ("CPV", date(2025, 8, 1)), ("CPV", date(2025, 8, 2)), ("SRC", date(2025, 8, 1)),
    ]


def test_a_history_in_parts_is_one_file(spark, ledger, tmp_path):
    root = tmp_path / "in"
    for n in (1, 2, 3):
        put(root, "FOLDER=CPV/NAME=CPV_history.txt", f"part-{n}.csv", opera_text((f"0{n}/Aug/25", "", "", "", n)), "utf-16")
    put(root, "FOLDER=CPV/NAME=Z_history.txt", "part-1.csv", opera_text(("09/Aug/25", "", "", "", 9)), "utf-16")
    staging.history_full(ledger, str(root), date(2025, 8, 31), SITES, layouts=HISTORY)
    assert rows(ledger.table("booking_pace_history"), "STAYING", "N_OF_ROOM") == [(date(2025, 8, n), n) for n in (1, 2, 3)]
    assert statuses(ledger) == [("CPV_history.txt", "LOADED", None)]
    # One part that cannot be used: none is, and the site keeps what it has.
    put(root, "FOLDER=CPV/NAME=CPV_history.txt", "part-2.csv", opera_text(("02/Aug/25", "", "", "", 7), drop=("RTC",)), "utf-16")
    staging.history_full(ledger, str(root), date(2025, 8, 31), SITES, layouts=HISTORY)
    assert statuses(ledger) == [("CPV_history.txt", "FAILED", "missing columns: RTC")]
    assert ledger.table("booking_pace_history").count() == 3


def test_sample_is_replaced_and_its_rejects_are_kept(spark, ledger, tmp_path):
    cells = {"Staying": "45329.5", "Property": "SRC", "N of Room": "2.5", "Room REV": "1,000"}
    put(tmp_path, "s", "sample.csv", ",".join(SAMPLE_HEADERS) + "\n" + ",".join(f'"{cells.get(h, "")}"' for h in SAMPLE_HEADERS) + "\n")
    for _ in range(2):
        staging.load_sample(ledger, str(tmp_path / "s" / "sample.csv"))
        assert rows(ledger.table("booking_pace_sample_data"), "STAYING", "N_OF_ROOM") == [(date(2024, 2, 7), None)]
        assert rejects(ledger) == [
            ("SRC", "sample.csv", "N_OF_ROOM", "2.5", "not a whole number", date(2024, 2, 7)),
            ("SRC", "sample.csv", "ROOM_REV", "1,000", "not a number", date(2024, 2, 7)),
        ]


@pytest.mark.parametrize(
    "kind, style, text, value, reason",
    [
        ("date", "cell", "45870", date(2025, 8, 1), None),
        ("date", "cell", "20240105", None, "outside the calendar"),
        ("date", "cell", "-99999999", None, "outside the calendar"),
        ("date", "cell", "132313", date(2262, 4, 4), None),
        ("date", "cell", "2025-02-30", None, "no such day"),
        ("date", "cell", "9999-01-01", None, "outside the calendar"),
        ("date", "cell", "x", None, "not a date"),
        ("date", "cell", "N/A", None, None),
        ("date", "serial", "1e300", None, "outside the calendar"),
        ("date", "serial", "NaN", None, None),
        ("date", "day-month-year", "31-02-2025", None, "no such day"),
        ("date", "day-month-year", "01-01-99999", None, "outside the calendar"),
        ("date", "day/abbrev/yy", "01/Aug/25", date(2025, 8, 1), None),
        ("date", "day/abbrev/yy", "31/Feb/25", None, "no such day"),
        ("date", "day-first", "30.2.2025", None, "no such day"),
        ("timestamp_ntz", "cell", "2025-08-01 10:00:00", datetime(2025, 8, 1, 10), None),
        ("timestamp_ntz", "cell", "20250801", None, "outside the calendar"),
        ("int", "cell", "2.0", 2, None),
        ("int", "cell", "2.5", None, "not a whole number"),
        ("int", "cell", "99999999999", None, "too large"),
        ("int", "cell", "two", None, "not a number"),
        ("decimal(18,2)", "cell", "1,5", None, "not a number"),
        ("decimal(18,2)", "cell", "1e30", None, "too large"),
        ("string", "cell", "a", "a", None),
        ("date", "cell", None, None, None),
    ],
)
def test_outcomes_name_the_reason(spark, kind, style, text, value, reason):
    df = spark.createDataFrame([(text,)], "c string").select(outcome(F.col("c"), kind, style).alias("o"))
    assert tuple(df.first().o) == (value, reason)


def test_serials_end_with_the_calendar(spark):
    df = spark.createDataFrame([("132319",), ("132320",), ("-81179",), ("-81184",), ("inf",)], "c string")
    got = [r.d for r in df.select(dates.excel_serial_date("c").alias("d")).collect()]
    assert got == [date(2262, 4, 10), None, date(1677, 9, 25), None, None]


# -- streams


def marts_of(ledger):
    ledger.refresh()
    return {t: rows(ledger.table(t).drop("CREATED_AT", "MODIFIED_AT")) for t in MARTS}


def landed(root):
    put(root, "SRC", "Pace_Date02082025_0930.xls", smile_text(SMILE_HL_HEADERS, ("2025-08-02", "2025-08-02", 4), ("2025-08-01", "2025-08-01", 2)))
    put(root, "CPV", "pace_02082025.txt", opera_text(("02-08-2025", "01-07-2025", "01-08-2025", "02-08-2025", 1), ("01-08-2025", "", "01-08-2025", "", 5)))


def run_stream(ledger, root, checkpoint):
    ingest.refresh_stream(ledger, str(root), str(checkpoint), date(2025, 8, 2), sites=SITES, layouts=DAILY).awaitTermination()


@pytest.fixture(scope="module")
def clean(spark, tmp_path_factory):
    """The marts of one undisturbed run."""
    folder = tmp_path_factory.mktemp("clean")
    made = Ledger(spark, "t_clean")
    made.create(str(folder / "tables"), TABLES)
    landed(folder / "in")
    run_stream(made, folder / "in", folder / "c")
    return marts_of(made)


@pytest.mark.parametrize("broken_at", ["booking_pace_detail", "booking_pace_actual", "stream_batches"])
def test_a_batch_broken_off_anywhere_is_completed_by_the_next_start(spark, ledger, tmp_path, monkeypatch, clean, broken_at):
    root, checkpoint = tmp_path / "in", tmp_path / "c"
    landed(root)
    whole = type(ledger).replace_keys

    def failing(self, table, *args, **kwargs):
        if table == broken_at:
            raise OSError("broken off")
        return whole(self, table, *args, **kwargs)

    with monkeypatch.context() as patch:
        patch.setattr(type(ledger), "replace_keys", failing)
        with pytest.raises(StreamingQueryException):
            run_stream(ledger, root, checkpoint)
    ledger.refresh()
    assert ledger.table("stream_batches").isEmpty()
    run_stream(ledger, root, checkpoint)
    assert marts_of(ledger) == clean
    assert [r.DAYS for r in ledger.table("stream_batches").collect()] == [[date(2025, 8, 2)]]


def test_a_batch_replayed_after_success_is_recognised(spark, ledger, tmp_path, monkeypatch, clean):
    root, checkpoint = tmp_path / "in", tmp_path / "c"
    landed(root)
    run_stream(ledger, root, checkpoint)
    ledger.refresh()
    done = ledger.table("stream_batches").first()
    assert (done.STREAM_ID, done.BATCH_ID, done.AS_OF) == (batches.stream_id(ledger, str(checkpoint)), 0, date(2025, 8, 2))
    for name in os.listdir(checkpoint / "commits"):
        os.remove(checkpoint / "commits" / name)  # as if the driver was lost right after the batch

    def never(*_, **__):
        raise AssertionError("staged again")

    with monkeypatch.context() as patch:
        patch.setattr(ingest, "stage_listing", never)
        run_stream(ledger, root, checkpoint)
    assert marts_of(ledger) == clean
    # Another stream over the same folder, or the same number of another checkpoint, is a batch of its own.
    run_stream(ledger, root, tmp_path / "other")
    ledger.refresh()
    assert ledger.table("stream_batches").count() == 2 and marts_of(ledger) == clean


def test_batches_touch_the_days_of_their_files_only(spark, ledger, tmp_path):
    old = [("SRC", day(1), day(3), 1, at(1)), ("SRC", day(2), day(3), 1, at(2))]
    ledger.append("stg_smile", smile(spark, *old))
    ledger.append("stg_opera", opera(spark))
    keys = spark.createDataFrame([("SRC", day(2))], "PROPERTY string, REPORT_DATE date")
    marts.refresh_days(ledger, keys, day(2))
    assert rows(ledger.table("booking_pace_detail"), "REPORT_DATE") == [(day(2),)]
    assert rows(ledger.table("booking_pace_report"), "REPORT_DATE", "TOTAL_ROOM") == [(day(2), 1)]
    marts.refresh_days(ledger, keys.limit(0), day(2))
    assert rows(ledger.table("booking_pace_detail"), "REPORT_DATE") == [(day(2),)]


# -- archive


def test_taken_files_leave_the_landing_folder_and_refused_ones_stay(spark, ledger, tmp_path):
    root, archive = tmp_path / "in", tmp_path / "archive"
    registry = site_registry(spark, SITES, *DAILY)
    put(root, "CPV", "pace_[1]_01082025.txt", opera_text(NIGHT))
    put(root, "CPV", "pace_02082025.txt", opera_text(NIGHT, drop=("RTC",)))
    put(root, "SRC", "Pace_Date01082025_0930.xls", smile_text(SMILE_HL_HEADERS, ("2025-08-01", "2025-08-01", 1)))

    def listed():
        return sorted(os.path.relpath(os.path.join(b, n), root) for b, _, ns in os.walk(root) for n in ns if not n.endswith(".crc"))

    assert archive_taken(ledger, list_snapshots(spark, str(root), registry), str(root), str(archive)) == (0, 0)
    staging.stage_incremental(ledger, str(root), SITES, layouts=DAILY)
    assert archive_taken(ledger, list_snapshots(spark, str(root), registry), str(root), str(archive)) == (2, 0)
    assert listed() == ["CPV/pace_02082025.txt"]
    assert (archive / "CPV" / "pace_[1]_01082025.txt").read_text() == opera_text(NIGHT).replace("\r\n", "\n")
    # A name the archive has already stays, and the mended file goes once it is taken in.
    put(root, "CPV", "pace_[1]_01082025.txt", opera_text(NIGHT, NIGHT))
    put(root, "CPV", "pace_02082025.txt", opera_text(NIGHT))
    staging.stage_incremental(ledger, str(root), SITES, layouts=DAILY)
    assert archive_taken(ledger, list_snapshots(spark, str(root), registry), str(root), str(archive)) == (1, 1)
    assert listed() == ["CPV/pace_[1]_01082025.txt"]
    assert len(counts(ledger)) == 2


# -- headers


def test_header_reader_reads_as_little_of_a_long_file_as_of_a_short_one(spark, tmp_path):
    night = opera_text(NIGHT)
    put(tmp_path, "d", "short %20.txt", night, "utf-16")
    put(tmp_path, "d", "long.txt", night + night.split("\r\n")[1] * 40_000, "utf-16")
    put(tmp_path, "d", "one line.txt", "A\tB" + "\tC" * 20_000, "utf-16")
    files = list_files(spark, str(tmp_path / "d"))
    got = {r.URI.rsplit("/", 1)[1]: r for r in heads.first_lines(files, "UTF-16").collect()}
    assert len(got) == 3
    assert got["long.txt"].N_READ == heads.BLOCK and got["long.txt"].LINE == night.split("\r\n")[0]
    assert got["one%20line.txt"].LINE.count("C") == 20_000
    assert not heads.readable("nowhere://a/b") and heads.readable(files.first().URI)


def test_both_header_passes_agree(spark, tmp_path, monkeypatch):
    put(tmp_path, "d", "a.txt", "﻿" + opera_text(NIGHT))
    put(tmp_path, "d", "b.txt", opera_text(NIGHT, drop=("RTC",)))
    put(tmp_path, "d", "c.txt", "title\n" + opera_text(NIGHT))
    put(tmp_path, "d", "d.txt", "")
    files = list_files(spark, str(tmp_path / "d"))
    columns = ["RTC", "ADULTS"]
    options = {"encoding": "UTF-8", "multiline": False}
    quick = rows(delimited.header_lines(files, columns, "\t", **options))
    monkeypatch.setattr(delimited, "readable", lambda uri: False)
    assert rows(delimited.header_lines(files, columns, "\t", **options)) == quick
    assert [r[2] for r in quick] == [None, "missing columns: RTC"]


# -- pages


@pytest.mark.parametrize("skip, take", [(0, 5), (7, 1), (30, 25), (118, 10), (500, 3), (0, 0)])
def test_pages_equal_those_of_a_full_sort(spark, skip, take):
    table = [(None if i % 7 == 0 else i % 5, f"n{i % 60:03d}", i) for i in range(120)]
    df = spark.createDataFrame(table, "a int, b string, c int").repartition(5)
    expected = df.orderBy("a", "b", "c").offset(skip).limit(take).collect()
    assert audits.page(df, skip, take, "a", "b", "c").collect() == expected


# -- command line


def test_command_line_archives_and_loads_both_currencies(spark, ledger, tmp_path, capsys, monkeypatch):
    monkeypatch.setattr(cli, "SITES", SITES)
    root = tmp_path / "in"
    put(root, "CPV", "pace_01082025.txt", opera_text(NIGHT))

    def call(*words):
        cli.run(cli.parser().parse_args([*words, "--database", ledger.database]), spark)
        return capsys.readouterr().out

    monkeypatch.setattr(staging, "DAILY_LAYOUTS", {OPERA: staging.OPERA_DAILY_LAYOUT})
    said = call("-t", "iload_property", "-p", "CPV", "--root", str(root), "--archive", str(tmp_path / "archive"))
    assert said.startswith("1 files moved") and not list((root / "CPV").glob("*.txt"))
    put(tmp_path, "rates/USD", "p.json", '{"Data": [{"currencyCode": "USD", "cash": "26000", "transfer": "26010", "sell": "26300"}]}')
    put(tmp_path, "rates/LAK", "p.json", "<html></html>")
    call("-t", "get_exchange_rate", "--root", str(tmp_path / "rates"), "--currency", "BOTH", "-d", "01082025")
    assert [r.FROM_CURRENCY_CODE for r in ledger.table("exchange_rate").collect()] == ["USD"]
    assert call("-t", "reconcile").startswith("0 entries")
