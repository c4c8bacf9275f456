"""Detail, history, report and actual as functions of staging and their earlier versions.

Each function returns new versions of the marts, over all properties at once;
no table is changed here.  ``as_of`` is the run's "today".  Lists of keys, which
several branches of a plan need, are pinned (a few rows per property and day);
everything else stays lazy.
"""

from __future__ import annotations

from datetime import date, timedelta
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stayledger.dimensions import LEAD_WINDOWS, LeadWindow
from stayledger.operators import changes, filters
from stayledger.operators.canonical import union_layouts
from stayledger.operators.lead_windows import STRICT
from stayledger.operators.marts import pace_actual, pace_report, pace_report_legacy
from stayledger.schemas import ACTUAL, DETAIL, HISTORY, REPORT, conform
from stayledger.session import pin_keys

Windows = tuple[LeadWindow, ...]


class DetailHistory(NamedTuple):
    detail: DataFrame
    history: DataFrame


class ReportActual(NamedTuple):
    report: DataFrame
    actual: DataFrame


class HistoryActual(NamedTuple):
    history: DataFrame
    actual: DataFrame


class Marts(NamedTuple):
    detail: DataFrame
    history: DataFrame
    report: DataFrame
    actual: DataFrame


def as_history(canon: DataFrame) -> DataFrame:
    """Canonical rows in the history shape, which has no report day."""
    return conform(canon, HISTORY)


def detail_full(smile: DataFrame, opera: DataFrame, as_of: date) -> DetailHistory:
    """Both marts from staging alone; history holds last night only."""
    canon = union_layouts(smile, opera)
    return DetailHistory(filters.otb(canon), as_history(filters.past_night(canon, as_of)))


def detail_incremental(
    smile: DataFrame, opera: DataFrame, detail: DataFrame, history: DataFrame, as_of: date
) -> DetailHistory:
    """Replace the changed days in detail; last night in history where today's snapshot changed."""
    canon = union_layouts(smile, opera)
    keys = pin_keys(changes.changed_keys(canon, detail))
    fresh = changes.restrict_to_keys(canon, keys, pinned=True)
    return DetailHistory(
        changes.replace_keys(conform(detail, DETAIL), keys, filters.otb(fresh), pinned=True),
        changes.delete_shifted_keys(conform(history, HISTORY), keys, as_of, pinned=True).unionByName(
            as_history(filters.past_night(fresh, as_of))
        ),
    )


def report_full(
    detail: DataFrame, history: DataFrame, windows: Windows = LEAD_WINDOWS, impl: str = "case"
) -> ReportActual:
    return ReportActual(pace_report(detail, windows, impl=impl), pace_actual(history, windows, impl=impl))


def actual_refresh_rows(history: DataFrame, kept: DataFrame, as_of: date) -> DataFrame:
    """History rows to aggregate into actual: last night, and the nights actual does not have.

    ``kept`` is actual without last night.  A night with an unknown part of its
    key is nobody's gap."""
    last_night = F.col("STAYING") == F.lit(as_of - timedelta(days=1))
    known = kept.select("PROPERTY", F.col("STAYING_DATE").alias("STAYING"))
    known_nights = pin_keys(changes.distinct_keys(known, changes.NIGHT_KEY))
    missing = changes.delete_keys(history, known_nights, changes.NIGHT_KEY, pinned=True)
    complete = F.col("PROPERTY").isNotNull() & F.col("STAYING").isNotNull()
    return missing.filter(complete | F.coalesce(last_night, F.lit(False)))


def report_incremental(
    detail: DataFrame,
    history: DataFrame,
    report: DataFrame,
    actual: DataFrame,
    as_of: date,
    windows: Windows = LEAD_WINDOWS,
) -> ReportActual:
    """Replace the changed days in report; last night and missing nights in actual."""
    keys = pin_keys(changes.changed_keys(detail, report))
    fresh = pace_report(changes.restrict_to_keys(detail, keys, pinned=True), windows)
    kept = changes.delete_night(conform(actual, ACTUAL), as_of)
    return ReportActual(
        changes.replace_keys(conform(report, REPORT), keys, fresh, pinned=True),
        kept.unionByName(pace_actual(actual_refresh_rows(history, kept, as_of), windows)),
    )


def report_rolling(detail: DataFrame, report: DataFrame, as_of: date, days: int = 7) -> DataFrame:
    """Superseded refresh: recompute the last days with the old bucket scheme."""
    start = F.lit(as_of - timedelta(days=days))
    fresh = pace_report_legacy(detail.filter(F.col("REPORT_DATE") >= start))
    stale = F.coalesce(F.col("REPORT_DATE") >= start, F.lit(False))
    return report.filter(~stale).unionByName(fresh)


def restore(
    smile: DataFrame,
    opera: DataFrame,
    history: DataFrame,
    actual: DataFrame,
    start: date,
    end: date,
    windows: Windows = LEAD_WINDOWS,
    mode: str = STRICT,
) -> HistoryActual:
    """Fill the nights history missed from the snapshots of a range, then the nights actual lacks."""
    canon = filters.reported_between(union_layouts(smile, opera), start, end)
    # Only past nights can fill a gap, and a snapshot day without one adds no
    # row, so the gap test runs on the past nights instead of all staging rows.
    nights = as_history(filters.past_night(canon)).filter(F.col("PROPERTY").isNotNull())
    history = conform(history, HISTORY)
    had = pin_keys(changes.distinct_keys(history, changes.NIGHT_KEY))
    filled = history.unionByName(changes.delete_keys(nights, had, changes.NIGHT_KEY, pinned=True))
    in_range = filters.night_reported_between(filled, start, end)
    known = pin_keys(
        changes.distinct_keys(
            actual.select("PROPERTY", F.col("STAYING_DATE").alias("STAYING")), changes.NIGHT_KEY
        )
    )
    gap_rows = changes.delete_keys(in_range, known, changes.NIGHT_KEY, pinned=True).filter(F.col("PROPERTY").isNotNull())
    return HistoryActual(
        filled, conform(actual, ACTUAL).unionByName(pace_actual(gap_rows, windows, mode))
    )


def load_history_full(
    history: DataFrame,
    actual: DataFrame,
    rows: DataFrame,
    prop: str,
    cutoff: date,
    windows: Windows = LEAD_WINDOWS,
    mode: str = STRICT,
) -> HistoryActual:
    """Take one property's history file as its history up to the cutoff.

    Clears up to the cutoff, adds the file, drops what lies after the cutoff, and
    rebuilds actual up to the cutoff.  File rows without a night are left out
    (``filters.null_dates`` shows them)."""
    cleared = changes.delete_up_to(conform(history, HISTORY), prop, cutoff, "STAYING")
    added = cleared.unionByName(conform(rows, HISTORY).filter(F.col("STAYING").isNotNull()))
    loaded = changes.delete_after(added, prop, cutoff, "STAYING")
    rebuilt = pace_actual(filters.up_to(loaded, prop, cutoff), windows, mode)
    kept = changes.delete_up_to(conform(actual, ACTUAL), prop, cutoff, "STAYING_DATE")
    return HistoryActual(loaded, kept.unionByName(rebuilt))


def load_history_incremental(history: DataFrame, rows: DataFrame) -> DataFrame:
    """Add the file rows of nights the property's history does not have."""
    history = conform(history, HISTORY)
    dated = conform(rows, HISTORY).filter(F.col("STAYING").isNotNull())
    return history.unionByName(changes.new_days(dated, history))


def run_full(smile: DataFrame, opera: DataFrame, as_of: date, windows: Windows = LEAD_WINDOWS) -> Marts:
    """Staging to all four marts, from nothing."""
    detail, history = detail_full(smile, opera, as_of)
    return Marts(detail, history, *report_full(detail, history, windows))


def run_incremental(
    smile: DataFrame, opera: DataFrame, marts: Marts, as_of: date, windows: Windows = LEAD_WINDOWS
) -> Marts:
    """Staging to all four marts, from their earlier versions."""
    detail, history = detail_incremental(smile, opera, marts.detail, marts.history, as_of)
    return Marts(
        detail,
        history,
        *report_incremental(detail, history, marts.report, marts.actual, as_of, windows),
    )
