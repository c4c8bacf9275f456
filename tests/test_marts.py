"""Change logic and runs, as pure functions and on stored tables."""

from __future__ import annotations

import os
from datetime import date

import pytest
from pyspark.sql import functions as F

from booking import at, day, opera, smile
from conftest import rows
from stayledger.operators import changes, filters
from stayledger.operators.canonical import canonical_smile, union_layouts
from stayledger.operators.marts import pace_actual, pace_report
from stayledger.plans import audit, ledger as stored, marts
from stayledger.schemas import ACTUAL, DETAIL, HISTORY, REPORT
from stayledger.sinks import versions

TABLES = ("booking_pace_detail", "booking_pace_history", "booking_pace_report", "booking_pace_actual")


@pytest.fixture
def nights(spark):
    """Three report days of two SMILE properties and one Opera property."""
    s = [
        (p, day(r), day(n), r + n, at(r))
        for p in ("SRC", "HLP")
        for r in (10, 11, 12)
        for n in (r - 2, r - 1, r, r + 1, r + 5)
    ]
    o = [("CPV", day(r), day(n), 1, at(r)) for r in (10, 11, 12) for n in (r - 1, r, r + 3)]
    return s, o


def snapshot(ledger):
    return {t: rows(ledger.table(t).select(*sorted(ledger.table(t).columns))) for t in TABLES}


def stage(ledger, spark, s, o):
    ledger.truncate_load("stg_smile", smile(spark, *s))
    ledger.truncate_load("stg_opera", opera(spark, *o))


def test_full_run_on_tables_equals_pure_run(spark, ledger, nights):
    s, o = nights
    stage(ledger, spark, s, o)
    stored.run_full(ledger, day(12))
    made = marts.run_full(smile(spark, *s), opera(spark, *o), day(12))
    for table, frame in zip(TABLES, made):
        columns = sorted(frame.columns)
        assert rows(ledger.table(table), *columns) == rows(frame, *columns), table


def test_incremental_runs_equal_full_detail_and_report(spark, ledger, nights):
    s, o = nights
    for d in (10, 12):
        stage(ledger, spark, [n for n in s if n[1] <= day(d)], [n for n in o if n[1] <= day(d)])
        stored.run_incremental(ledger, day(d))
    made = marts.run_full(smile(spark, *s), opera(spark, *o), day(12))
    assert rows(ledger.table(TABLES[0]), *DETAIL) == rows(made.detail, *DETAIL)
    assert rows(ledger.table(TABLES[2]), *REPORT) == rows(made.report, *REPORT)
    # A past night is rolled into history and actual by the run of its day; the 11th had none.
    assert {r.STAYING for r in ledger.table(TABLES[1]).collect()} == {day(9), day(11)}
    assert {r.STAYING_DATE for r in ledger.table(TABLES[3]).collect()} == {day(9), day(11)}


def test_second_incremental_run_changes_nothing(spark, ledger, nights):
    stage(ledger, spark, *nights)
    stored.run_incremental(ledger, day(12))
    before = snapshot(ledger)
    stored.run_incremental(ledger, day(12))
    assert snapshot(ledger) == before


def test_changed_snapshot_replaces_its_day_only(spark, ledger, nights, tmp_path):
    s, o = nights
    stage(ledger, spark, s, o)
    stored.run_incremental(ledger, day(12))
    folder = tmp_path / "tables" / "booking_pace_detail" / "REPORT_DATE=2025-08-10"
    untouched = sorted(os.listdir(folder))
    changed = [(p, r, n, 99, at(12, 20)) if (p, r) == ("SRC", day(11)) else (p, r, n, k, m) for p, r, n, k, m in s]
    stage(ledger, spark, changed, o)
    stored.run_incremental(ledger, day(12))
    assert sorted(os.listdir(folder)) == untouched
    detail = ledger.table("booking_pace_detail")
    assert {r.N_OF_ROOM for r in detail.filter("PROPERTY = 'SRC' AND REPORT_DATE = DATE'2025-08-11'").collect()} == {99}
    assert 99 not in {r.N_OF_ROOM for r in detail.filter("PROPERTY = 'HLP'").collect()}


def test_rooms_of_report_and_detail_agree_and_windows_are_known(spark, nights):
    s, o = nights
    made = marts.run_full(smile(spark, *s), opera(spark, *o), day(12))
    per_day = lambda df, c: rows(df.groupBy("PROPERTY", "REPORT_DATE").agg(F.sum(c)))
    assert per_day(made.detail, "N_OF_ROOM") == per_day(made.report, "TOTAL_ROOM")
    assert made.report.filter(F.col("WINDOW_ID").isNull()).count() == 0


def test_replaced_key_that_became_empty_disappears(spark, ledger):
    ledger.append("stg_smile", smile(spark, ("SRC", day(1), day(2), 1, at(1)), ("SRC", day(2), day(2), 1, at(2)), ("HLP", day(1), day(1), 7, at(1))))
    keys = spark.createDataFrame([("SRC", day(1)), ("SRC", day(2)), ("ZZZ", day(9))], "PROPERTY string, REPORT_DATE date")
    ledger.replace_keys("stg_smile", keys, smile(spark))
    assert rows(ledger.table("stg_smile"), "PROPERTY", "REPORT_DATE") == [("HLP", day(1))]
    assert [r[0] for r in spark.sql(f"SHOW PARTITIONS {ledger.name('stg_smile')}").collect()] == ["REPORT_DATE=2025-08-01"]


def test_unknown_keys_match_nothing(spark):
    target = spark.createDataFrame([("SRC", None, 1), (None, day(1), 2), ("SRC", day(1), 3)], "PROPERTY string, REPORT_DATE date, n int")
    keys = spark.createDataFrame([("SRC", None), (None, day(1)), ("SRC", day(1))], "PROPERTY string, REPORT_DATE date")
    assert rows(changes.restrict_to_keys(target, keys), "n") == [(3,)]
    assert rows(changes.delete_keys(target, keys), "n") == [(1,), (2,)]


def test_deletes_keep_rows_without_a_date(spark):
    df = spark.createDataFrame([("SRC", None), ("SRC", day(1)), ("SRC", day(5)), ("HLP", day(1))], "PROPERTY string, STAYING date")
    assert rows(changes.delete_up_to(df, "SRC", day(3), "STAYING")) == [("HLP", day(1)), ("SRC", day(5)), ("SRC", None)]
    assert rows(changes.delete_after(df, "SRC", day(3), "STAYING")) == [("HLP", day(1)), ("SRC", day(1)), ("SRC", None)]
    assert rows(changes.delete_night(df, day(2), "STAYING")) == [("SRC", day(5)), ("SRC", None)]


def test_change_detection_sees_late_files_of_older_days(spark):
    schema = "PROPERTY string, REPORT_DATE date, MODIFIED_AT timestamp_ntz"
    source = spark.createDataFrame([("SRC", day(1), at(9)), ("SRC", day(2), at(2)), ("HLP", day(1), at(1))], schema)
    target = spark.createDataFrame([("SRC", day(1), at(1)), ("SRC", day(2), at(2)), ("HLP", day(1), None)], schema)
    assert rows(changes.changed_keys(source, target), "PROPERTY", "REPORT_DATE") == [("HLP", day(1)), ("SRC", day(1))]
    newer = target.unionByName(spark.createDataFrame([("SRC", day(3), at(20))], schema))
    # One watermark per property misses the late file.
    assert rows(changes.changed_since_watermark(source, newer), "PROPERTY") == [("HLP",)]


def test_rerun_of_a_missed_day_and_restore(spark, ledger, nights):
    s, o = nights
    stage(ledger, spark, s, o)
    # The runs of the 10th and 11th never happened: only the 12th's past night is known.
    stored.run_incremental(ledger, day(12))
    assert {r.STAYING for r in ledger.table("booking_pace_history").collect()} == {day(11)}
    before = [ledger.table(t) for t in TABLES]
    pure = marts.restore(smile(spark, *s), opera(spark, *o), before[1], before[3], day(10), day(12))
    expected_history, expected_actual = rows(pure.history, *HISTORY), rows(pure.actual, *ACTUAL)
    stored.restore(ledger, day(10), day(12))
    assert rows(ledger.table("booking_pace_history"), *HISTORY) == expected_history
    assert rows(ledger.table("booking_pace_actual"), *ACTUAL) == expected_actual
    assert {r.STAYING for r in ledger.table("booking_pace_history").collect()} == {day(9), day(10), day(11)}
    # Opera rows of the restored nights have no creation date: strict windows leave them unknown.
    gaps = ledger.table("booking_pace_actual").filter("PROPERTY = 'CPV' AND STAYING_DATE < DATE'2025-08-11'")
    assert {r.WINDOW_ID for r in gaps.collect()} == {None}
    again = snapshot(ledger)
    stored.restore(ledger, day(10), day(12))
    assert snapshot(ledger) == again


def test_history_file_up_to_a_cutoff(spark, ledger, nights):
    s, o = nights
    stage(ledger, spark, s, o)
    stored.run_incremental(ledger, day(12))
    canon = union_layouts(smile(spark, *s), opera(spark, *o))
    file_rows = marts.as_history(filters.past_night(canon).filter("PROPERTY = 'SRC'"))
    undated = file_rows.limit(1).withColumn("STAYING", F.lit(None).cast("date"))
    file_rows = file_rows.unionByName(undated)
    history, actual = ledger.table("booking_pace_history"), ledger.table("booking_pace_actual")
    pure = marts.load_history_full(history, actual, file_rows, "SRC", day(10))
    expected = rows(pure.history, *HISTORY), rows(pure.actual, *ACTUAL)
    stored.load_history_full(ledger, file_rows, day(10))
    assert rows(ledger.table("booking_pace_history"), *HISTORY) == expected[0]
    assert rows(ledger.table("booking_pace_actual"), *ACTUAL) == expected[1]
    src = ledger.table("booking_pace_history").filter("PROPERTY = 'SRC'")
    assert {r.STAYING for r in src.collect()} == {day(9), day(10)}
    kept = ledger.table("booking_pace_actual").filter("PROPERTY = 'SRC'")
    assert {r.STAYING_DATE for r in kept.collect()} == {day(9), day(10), day(11)}


def test_history_file_adds_unknown_nights_only(spark, ledger, nights):
    s, o = nights
    stage(ledger, spark, s, o)
    stored.run_incremental(ledger, day(12))
    file_rows = marts.as_history(union_layouts(smile(spark, *s), opera(spark)).filter("PROPERTY = 'SRC'"))
    pure = rows(marts.load_history_incremental(ledger.table("booking_pace_history"), file_rows), *HISTORY)
    stored.load_history_incremental(ledger, file_rows)
    assert rows(ledger.table("booking_pace_history"), *HISTORY) == pure
    stored.load_history_incremental(ledger, file_rows)
    assert rows(ledger.table("booking_pace_history"), *HISTORY) == pure


def test_audit_of_tables(spark, ledger, nights):
    stage(ledger, spark, *nights)
    stored.run_incremental(ledger, day(12))
    summary = {(r.MART, r.PROPERTY): r for r in audit.audit_tables(ledger).collect()}
    detail = summary["booking_pace_detail", "SRC"]
    assert (detail.MIN_DATE, detail.MAX_DATE, detail.NB_ROWS, detail.NULL_DATES) == (day(10), day(12), 9, 0)
    assert audit.audit_days(ledger, "booking_pace_report").first().REPORT_DATE == day(12)


def test_legacy_variants(spark):
    s, o = smile(spark, ("SRC", day(1), day(2), 1, at(1))), opera(spark, ("CPV", day(1), day(2), 1, at(1)))
    old = union_layouts(s, o, legacy_booking=True, legacy_room=True)
    assert rows(old, "PROPERTY", "R_TYPE", "BOOKING") == [("CPV", None, 0), ("SRC", "SV3A", 0)]
    new = union_layouts(s, o)
    assert rows(new, "PROPERTY", "R_TYPE", "R_CHARGE", "BOOKING") == [("CPV", None, "CV2F", 0), ("SRC", "SV3A", None, 1)]


def test_unknown_group_values_form_one_group(spark):
    rows_ = [("SRC", date(2025, 8, 1), day(2), 1, at(1)), ("SRC", date(2025, 8, 1), day(2), 2, at(1))]
    detail = filters.otb(union_layouts(smile(spark, *rows_), opera(spark)))
    assert rows(pace_report(detail), "R_CHARGE", "TOTAL_ROOM", "TOTAL_BOOKING") == [(None, 3, 3)]
    assert rows(pace_actual(detail), "R_CHARGE", "TOTAL_ROOM") == [(None, 3)]


def spoil(folder, *keep):
    """Make every stored file below a table's folder unreadable, but for the named days."""
    spoilt = 0
    for base, _, names in os.walk(folder):
        for name in names:
            if name.endswith(".parquet") and not any(base.endswith(d) for d in keep):
                with open(os.path.join(base, name), "wb") as out:
                    out.write(b"not parquet")
                spoilt += 1
    return spoilt


def test_incremental_run_opens_no_file_of_an_unchanged_day(spark, ledger, nights, tmp_path):
    s, o = nights
    for d in (10, 12):
        stage(ledger, spark, [n for n in s if n[1] <= day(d)], [n for n in o if n[1] <= day(d)])
        stored.run_incremental(ledger, day(d))
    for table in versions.FOLLOWED:
        versions.bring_up_to_date(ledger, table)
    others = "REPORT_DATE = DATE'2025-08-12' AND PROPERTY <> 'SRC'"
    before = rows(ledger.table("booking_pace_detail").filter(others), *DETAIL)
    # The 12th of one property changes in place; everything about the other days can no longer be read.
    new = [("SRC", day(12), day(13), 50, at(12, 20))]
    keys = spark.createDataFrame([("SRC", day(12))], "PROPERTY string, REPORT_DATE date")
    ledger.replace_keys("stg_smile", keys, smile(spark, *new))
    tables = tmp_path / "tables"
    kept = {"booking_pace_history": ["STAYING=2025-08-11"], "booking_pace_actual": ["STAYING_DATE=2025-08-11"]}
    for table in versions.FOLLOWED:
        assert spoil(tables / table, *kept.get(table, ["REPORT_DATE=2025-08-12"])) > 0
    stored.run_incremental(ledger, day(12))
    today = ledger.table("booking_pace_detail").filter("REPORT_DATE = DATE'2025-08-12'")
    assert rows(today.filter("PROPERTY = 'SRC'"), "STAYING", "N_OF_ROOM") == [(day(13), 50)]
    assert rows(today.filter(others), *DETAIL) == before and len(before) == 5
    report = ledger.table("booking_pace_report").filter("REPORT_DATE = DATE'2025-08-12' AND PROPERTY = 'SRC'")
    assert rows(report, "STAYING_DATE", "TOTAL_ROOM") == [(day(13), 50)]
    # The changed snapshot has no past night any more.
    night = ledger.table("booking_pace_history").filter("STAYING = DATE'2025-08-11'")
    assert {r.PROPERTY for r in night.collect()} == {"HLP", "CPV"}
    assert audit.audit_tables(ledger).count() == 3 + 4 * 3  # properties of staging and of the marts, from entries alone


def test_entries_equal_a_full_count_whoever_wrote(spark, ledger, nights):
    s, o = nights
    stage(ledger, spark, s, o)
    stored.run_incremental(ledger, day(12))
    assert stored.changed_staging(ledger).isEmpty() and stored.changed_detail(ledger).isEmpty()
    # Written past the ledger, twice: entries follow.
    ledger.append("stg_smile", smile(spark, ("NEW", day(9), day(9), 1, at(9)), (None, day(9), day(9), 1, None)))
    ledger.table("stg_smile").limit(0).write.insertInto(ledger.name("stg_smile"))
    canon = union_layouts(ledger.table("stg_smile"), ledger.table("stg_opera"))
    full = changes.changed_keys(canon, ledger.table("booking_pace_detail"))
    assert rows(stored.changed_staging(ledger)) == rows(full) and full.count() == 2
    assert versions.bring_up_to_date(ledger, "stg_smile") == []
    for table in versions.FOLLOWED:
        told = versions.versions(ledger, table).select(versions.TABLES[table].day, "PROPERTY", "NB_ROWS", "MODIFIED_AT")
        assert rows(told) == rows(versions.counted(ledger, table).select("DAY", "PROPERTY", "NB_ROWS", "MODIFIED_AT"))
    assert versions.reconcile(ledger).isEmpty()
    # An emptied table, and entries that are lost or wrong.
    ledger.truncate_load("stg_opera", opera(spark))
    assert versions.versions(ledger, "stg_opera").isEmpty()
    wrong = ledger.table("day_versions").withColumn("NB_ROWS", F.col("NB_ROWS") + F.when(F.col("PROPERTY") == "HLP", 1).otherwise(0))
    ledger.truncate_load("day_versions", spark.createDataFrame(wrong.collect(), wrong.schema))
    found = versions.reconcile(ledger)
    assert {(r.PROPERTY, r.COUNTED_ROWS - r.NB_ROWS) for r in found.collect()} == {("HLP", -1)}
    assert versions.reconcile(ledger).isEmpty()


def test_nights_that_actual_lacks_come_from_the_entries(spark, ledger, nights):
    s, o = nights
    stage(ledger, spark, s, o)
    stored.run_incremental(ledger, day(12))
    gone = spark.createDataFrame([("SRC", day(11))], "PROPERTY string, STAYING_DATE date")
    ledger.delete_keys("booking_pace_actual", gone)
    had, known = (versions.nights(ledger, t) for t in ("booking_pace_history", "booking_pace_actual"))
    full = changes.actual_gaps(ledger.table("booking_pace_history"), ledger.table("booking_pace_actual"))
    assert rows(changes.missing_keys(had, known, changes.NIGHT_KEY)) == rows(full) == [("SRC", day(11))]
    stored.refresh_report_incremental(ledger, day(20))
    assert rows(ledger.table("booking_pace_actual").filter("PROPERTY = 'SRC'"), "STAYING_DATE") == [(day(11),)]


def test_rows_are_computed_once_and_emptied_days_go(spark, ledger):
    ledger.append("booking_pace_detail", filters.otb(canonical_smile(smile(spark, *[("SRC", day(d), day(d), 1, at(d)) for d in (1, 2, 3)]))))
    seen = spark.sparkContext.accumulator(0)

    def noted(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    new = filters.otb(canonical_smile(smile(spark, ("SRC", day(1), day(9), 7, at(5)), ("SRC", day(4), day(9), 8, at(5)))))
    new = new.mapInArrow(noted, new.schema)
    keys = spark.createDataFrame([("SRC", day(d)) for d in (1, 2, 4, 5)], "PROPERTY string, REPORT_DATE date")
    ledger.replace_keys("booking_pace_detail", keys, new)
    assert rows(ledger.table("booking_pace_detail"), "REPORT_DATE", "N_OF_ROOM") == [(day(1), 7), (day(3), 1), (day(4), 8)]
    assert seen.value == 2
    assert sorted(ledger.files("booking_pace_detail")) == [day(1), day(3), day(4)]
