"""Rows that lie where they belong are not moved: long key lists are broadcast by property, and days are written from days."""

from __future__ import annotations

import pytest
from pyspark.sql.readwriter import DataFrameWriter

from booking import at, day, smile
from conftest import rows
from stayledger import session
from stayledger.operators import changes
from stayledger.plans import ledger as runs
from stayledger.session import pin_keys
from stayledger.sinks import tables


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def shuffles(text):
    return text.count("Exchange") - text.count("BroadcastExchange") - text.count("ReusedExchange")


@pytest.fixture
def written(monkeypatch):
    """(table, plan) of every insert."""
    found = []
    original = DataFrameWriter.insertInto

    def seen(self, name, overwrite=None):
        found.append((name.split("`")[3], plan(self._df)))
        return original(self, name, overwrite)

    monkeypatch.setattr(DataFrameWriter, "insertInto", seen)
    return found


@pytest.mark.parametrize("properties", [10, 0])
def test_long_key_lists(spark, monkeypatch, properties):
    shape = "PROPERTY string, REPORT_DATE date, n int"
    some = [("A", day(1), 1), ("A", day(1), 2), ("A", day(2), 3), ("B", day(1), 4), (None, day(1), 5), ("A", None, 6), (None, None, 7), ("C", day(3), 8)]
    df = spark.createDataFrame(some, shape)
    listed = [("A", day(1)), ("A", day(1)), ("B", day(2)), ("C", day(3)), (None, day(1)), ("A", None), (None, None)]
    keys = pin_keys(spark.createDataFrame(listed, "PROPERTY string, REPORT_DATE date"), limit=0)
    monkeypatch.setattr(session, "MAX_BROADCAST_ROWS", 2)
    monkeypatch.setattr(session, "MAX_BROADCAST_PROPERTIES", properties)
    hit, left = changes.restrict_to_keys(df, keys, pinned=True), changes.delete_keys(df, keys, pinned=True)
    assert hit.columns == left.columns == df.columns
    assert rows(hit, "n") == [(1,), (2,), (8,)]
    assert rows(left, "n") == [(3,), (4,), (5,), (6,), (7,)]
    for made in (hit, left):
        assert ("BroadcastHashJoin" in plan(made)) == (properties > 0)


def _loaded(spark, ledger):
    nights = [(p, day(d), day(s), 1, at(d)) for p in ("P", "Q", "R") for d in (1, 2, 3) for s in (1, 2, 3)]
    ledger.append("stg_smile", smile(spark, *nights))
    return sorted((p, d, s) for p, d, s, *_ in nights if s >= d)


def test_days_are_written_from_days(spark, ledger, written, monkeypatch):
    monkeypatch.setattr(session, "MAX_BROADCAST_ROWS", 2)
    expected = _loaded(spark, ledger)
    runs.refresh_detail_full(ledger, day(3))
    assert rows(ledger.table(runs.DETAIL), "PROPERTY", "REPORT_DATE", "STAYING") == expected
    assert rows(ledger.table(runs.HISTORY_TABLE), "PROPERTY", "STAYING") == [(p, day(2)) for p in "PQR"]
    newer = [(p, day(d), day(3), 5, at(20)) for p in ("P", "Q") for d in (1, 3)] + [("P", day(3), day(2), 5, at(20))]
    ledger.append("stg_smile", smile(spark, *newer))
    runs.refresh_detail_incremental(ledger, day(3))
    added = [(p, d, s) for p, d, s, *_ in newer if s >= d]
    assert rows(ledger.table(runs.DETAIL), "PROPERTY", "REPORT_DATE", "STAYING") == sorted(expected + added)
    assert rows(ledger.table(runs.HISTORY_TABLE), "PROPERTY", "STAYING", "N_OF_ROOM") == [("P", day(2), 1), ("P", day(2), 5), ("Q", day(2), 1), ("R", day(2), 1)]
    moved = [(t, made) for t, made in written if t in (runs.DETAIL, runs.HISTORY_TABLE)]
    assert len(moved) == 4
    for _, made in moved:
        assert "Rebalance" not in made and "Sort" not in made.replace("SortMergeJoin", "")
        # All that is dealt out is the list of keys.
        assert "hashpartitioning(REPORT_DATE" not in made and "hashpartitioning(STAYING" not in made


def test_a_day_in_many_files_is_gathered(spark, ledger, monkeypatch):
    expected = _loaded(spark, ledger)
    for _ in range(3):
        ledger.append(runs.DETAIL, spark.table(ledger.name("stg_smile")).limit(0))
    runs.refresh_detail_full(ledger, day(3))
    whole = ledger.table(runs.DETAIL)
    for _ in range(3):
        ledger.append(runs.DETAIL, whole.filter("PROPERTY = 'R'").limit(100))
    before = rows(ledger.table(runs.DETAIL))
    keys = spark.createDataFrame([("P", day(1))], "PROPERTY string, REPORT_DATE date")
    new = ledger.table(runs.DETAIL).filter("PROPERTY = 'P' AND REPORT_DATE = DATE'2025-08-01'")
    ledger.replace_keys(runs.DETAIL, keys, new, placed=True)
    files = len(ledger.files(runs.DETAIL)[day(1)])
    assert files > 1
    monkeypatch.setattr(tables, "FILES_A_DAY", files - 1)
    ledger.replace_keys(runs.DETAIL, keys, new, placed=True)
    assert len(ledger.files(runs.DETAIL)[day(1)]) == 1
    assert rows(ledger.table(runs.DETAIL)) == before
    assert set(expected) <= set(rows(ledger.table(runs.DETAIL), "PROPERTY", "REPORT_DATE", "STAYING"))


def test_replaced_keys_join_the_base_once(spark, written):
    from conftest import SF_DIR
    from workload.mutations import sink_replace_keys_stored

    sink_replace_keys_stored(spark, SF_DIR)
    moved = [made for table, made in written if table == runs.DETAIL]
    assert len(moved) == 2
    for made in moved:
        assert "Exchange hashpartitioning" not in made and "lineitem" not in made
