"""Lead-time bucket expressions built from the dimension rows."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from stayledger.dimensions import LEAD_WINDOWS, LEGACY_BUCKETS, LeadWindow, check_windows


def window_case(days: Column, windows: tuple[LeadWindow, ...] = LEAD_WINDOWS, open_top: bool = True) -> Column:
    """Window id of a day count as one CASE; NULL where no window holds it.

    ``open_top`` lets the open-ended window match; the closed comparison of the
    strict variant never does, since a NULL bound compares as unknown."""
    case, reached = F, None
    for w in check_windows(windows):
        if reached is None or w.lower > reached + 1:
            case = case.when(days < w.lower, F.lit(None))
        if w.upper is not None:
            case, reached = case.when(days <= w.upper, w.id), w.upper
        elif open_top:
            case = case.when(days >= w.lower, w.id)
    return case.otherwise(F.lit(None)).cast("int")


def _legacy(days: Column, field: int) -> Column:
    *bounded, rest = LEGACY_BUCKETS
    case = F
    for bucket in bounded:
        case = case.when(days <= bucket[0], bucket[field])
    return case.otherwise(rest[field])


def legacy_bucket(days: Column) -> Column:
    """Superseded bucket label: negative lead time falls in the first, unknown in the last."""
    return _legacy(days, 1)


def legacy_bucket_sort(days: Column) -> Column:
    return _legacy(days, 2)
