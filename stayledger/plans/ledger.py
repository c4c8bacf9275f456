"""The mart refreshes on stored tables: only the days that change are written.

The logic is that of ``plans.marts``; here the changed keys are pinned first,
because the tables they were derived from are about to change, and they come from
the entries of ``sinks.versions``, so that no run reads days that did not change.
Detail and history take their rows from tables with the same days, in their order, so these
rows are written as they come (``placed``).
"""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stayledger.dimensions import LEAD_WINDOWS
from stayledger.operators import changes, filters
from stayledger.operators.canonical import union_layouts
from stayledger.operators.lead_windows import STRICT
from stayledger.operators.marts import pace_actual, pace_report
from stayledger.plans import marts
from stayledger.plans.marts import Windows
from stayledger.schemas import HISTORY, conform
from stayledger.session import pin, pin_keys
from stayledger.sinks.tables import Ledger, listed_days
from stayledger.sinks.versions import nights as nights_of
from stayledger.sinks.versions import versions

DETAIL, HISTORY_TABLE = "booking_pace_detail", "booking_pace_history"
REPORT, ACTUAL = "booking_pace_report", "booking_pace_actual"


def _canon(ledger: Ledger) -> DataFrame:
    return union_layouts(ledger.table("stg_smile"), ledger.table("stg_opera"))


def _within(df: DataFrame, keys: DataFrame, day: str) -> DataFrame:
    """Rows of the pinned keys; their days, of which the calendar has few, prune the scan's partitions
    however many keys there are and whichever way they are joined."""
    days = listed_days(keys.select(day))
    if not days:
        return df.limit(0)
    return changes.restrict_to_keys(df.filter(F.col(day).isin(days)), keys, ("PROPERTY", day), pinned=True)


def _as_actual_keys(keys: DataFrame) -> DataFrame:
    return keys.select("PROPERTY", F.col("STAYING").alias("STAYING_DATE"))


def refresh_detail_full(ledger: Ledger, as_of: date) -> None:
    """Rebuild detail and history."""
    detail, history = marts.detail_full(ledger.table("stg_smile"), ledger.table("stg_opera"), as_of)
    ledger.truncate_load(DETAIL, detail, placed=True)
    ledger.truncate_load(HISTORY_TABLE, history, placed=True)


def changed_staging(ledger: Ledger) -> DataFrame:
    """Days (PROPERTY, REPORT_DATE) that staging has and detail lacks, or has in an older version."""
    staged = versions(ledger, "stg_smile").unionByName(versions(ledger, "stg_opera"))
    return changes.changed_keys(staged, versions(ledger, DETAIL))


def changed_detail(ledger: Ledger) -> DataFrame:
    """The same of detail and report."""
    return changes.changed_keys(versions(ledger, DETAIL), versions(ledger, REPORT))


def _replace_detail(ledger: Ledger, keys: DataFrame, as_of: date) -> None:
    """Replace the pinned keys' days in detail, and last night in history where today is among them.

    History goes first: the change list is found again from detail if the run
    breaks off in between."""
    fresh = _within(_canon(ledger), keys, "REPORT_DATE")
    ledger.replace_keys(
        HISTORY_TABLE,
        changes.shifted_nights(keys, as_of),
        marts.as_history(filters.past_night(fresh, as_of)),
        placed=True,
    )
    ledger.replace_keys(DETAIL, keys, filters.otb(fresh), placed=True)


def refresh_detail_incremental(ledger: Ledger, as_of: date) -> None:
    """Replace the changed days in detail, and last night in history where today changed."""
    _replace_detail(ledger, pin_keys(changed_staging(ledger)), as_of)


def refresh_report_full(ledger: Ledger, windows: Windows = LEAD_WINDOWS) -> None:
    report, actual = marts.report_full(ledger.table(DETAIL), ledger.table(HISTORY_TABLE), windows)
    ledger.truncate_load(REPORT, report)
    ledger.truncate_load(ACTUAL, actual)


def _replace_report(ledger: Ledger, keys: DataFrame, as_of: date, windows: Windows) -> None:
    """Replace the pinned keys' days in report; last night and the missing nights in actual."""
    ledger.replace_keys(REPORT, keys, pace_report(_within(ledger.table(DETAIL), keys, "REPORT_DATE"), windows))

    # Last night is replaced in every property that has it on either side.
    had, known = nights_of(ledger, HISTORY_TABLE), nights_of(ledger, ACTUAL)
    last = known.unionByName(had).filter(F.col("STAYING") == F.lit(as_of - timedelta(days=1)))
    nights = pin_keys(changes.missing_keys(had, known, changes.NIGHT_KEY).union(last).distinct())
    rows = _within(ledger.table(HISTORY_TABLE), nights, "STAYING")
    ledger.replace_keys(ACTUAL, _as_actual_keys(nights), pace_actual(rows, windows))


def refresh_report_incremental(ledger: Ledger, as_of: date, windows: Windows = LEAD_WINDOWS) -> None:
    """Replace the changed days in report; last night and the missing nights in actual."""
    _replace_report(ledger, pin_keys(changed_detail(ledger)), as_of, windows)


def refresh_days(ledger: Ledger, keys: DataFrame, as_of: date, windows: Windows = LEAD_WINDOWS) -> None:
    """Bring all four marts up to date for the given days (PROPERTY, REPORT_DATE), whether or not they changed."""
    keys = pin_keys(keys)
    _replace_detail(ledger, keys, as_of)
    _replace_report(ledger, keys, as_of, windows)


def restore(ledger: Ledger, start: date, end: date, windows: Windows = LEAD_WINDOWS, mode: str = STRICT) -> None:
    """Fill the nights history missed from the snapshots of a range, then the nights actual lacks."""
    canon = filters.reported_between(_canon(ledger), start, end)
    nights = marts.as_history(filters.past_night(canon))
    had = nights_of(ledger, HISTORY_TABLE)
    gaps = pin_keys(changes.missing_keys(nights, had, changes.NIGHT_KEY))
    ledger.replace_keys(HISTORY_TABLE, gaps, _within(nights, gaps, "STAYING"), placed=True)

    # Only the range's nights of history are looked at.
    filled = filters.night_reported_between(nights_of(ledger, HISTORY_TABLE), start, end)
    missing = pin_keys(changes.missing_keys(filled, nights_of(ledger, ACTUAL), changes.NIGHT_KEY))
    fresh = pace_actual(_within(ledger.table(HISTORY_TABLE), missing, "STAYING"), windows, mode)
    ledger.replace_keys(ACTUAL, _as_actual_keys(missing), fresh)


def load_history_full(
    ledger: Ledger, rows: DataFrame, cutoff: date, windows: Windows = LEAD_WINDOWS, mode: str = STRICT
) -> None:
    """Take the rows as the whole history, up to the cutoff, of the properties they belong to.

    What those properties had after the cutoff is dropped from history; actual
    keeps its nights after the cutoff."""
    rows = pin(conform(rows, HISTORY).filter(F.col("STAYING").isNotNull()))
    props = pin_keys(rows.select("PROPERTY").distinct())
    kept = rows.filter(F.col("STAYING") <= F.lit(cutoff))

    past = ledger.table(ACTUAL).filter(F.col("STAYING_DATE") <= F.lit(cutoff)).select("PROPERTY", "STAYING_DATE")
    stale = past.distinct().join(props, "PROPERTY", "left_semi")
    nights = pin_keys(stale.union(_as_actual_keys(kept)).distinct())
    ledger.replace_keys(HISTORY_TABLE, props, kept, on=("PROPERTY",), present=kept)
    ledger.replace_keys(ACTUAL, nights, pace_actual(kept, windows, mode))


def load_history_incremental(ledger: Ledger, rows: DataFrame) -> None:
    """Add the nights history does not have."""
    rows = conform(rows, HISTORY).filter(F.col("STAYING").isNotNull())
    gaps = pin_keys(changes.missing_keys(rows, nights_of(ledger, HISTORY_TABLE), changes.NIGHT_KEY))
    ledger.replace_keys(HISTORY_TABLE, gaps, _within(rows, gaps, "STAYING"))


def run_full(ledger: Ledger, as_of: date) -> None:
    """Staging to all four marts, from nothing."""
    refresh_detail_full(ledger, as_of)
    refresh_report_full(ledger)


def run_incremental(ledger: Ledger, as_of: date) -> None:
    """Bring all four marts up to date with staging."""
    refresh_detail_incremental(ledger, as_of)
    refresh_report_incremental(ledger, as_of)
