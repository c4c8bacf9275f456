"""Pace and actual aggregates.

One groupBy each: partial aggregation runs before the single shuffle, so a hot
property costs one partial row per group and task, not its raw rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stayledger.dimensions import LEAD_WINDOWS, LeadWindow
from stayledger.functions.dates import lead_days
from stayledger.functions.lead import legacy_bucket, legacy_bucket_sort
from stayledger.operators.lead_windows import CLAMPED, add_lead_window
from stayledger.schemas import ACTUAL, MONEY, REPORT, conform

_DIMENSIONS = ("STAYING", "PROPERTY", "MARKET", "R_TYPE", "R_CHARGE", "WINDOW_ID")


def total_booking() -> Column:
    """Rooms of arrival nights: SUM(BOOKING * N_OF_ROOM)."""
    return F.sum(F.col("BOOKING") * F.col("N_OF_ROOM")).cast("int")


def _measures() -> list[Column]:
    return [
        F.sum("N_OF_ROOM").cast("int").alias("TOTAL_ROOM"),
        F.sum("ROOM_REV").cast(MONEY).alias("ROOM_REV"),
        F.sum("ARR").cast(MONEY).alias("ARR"),
        total_booking().alias("TOTAL_BOOKING"),
        F.max("CREATED_AT").alias("CREATED_AT"),
        F.max("MODIFIED_AT").alias("MODIFIED_AT"),
    ]


def _aggregate(df: DataFrame, keys: tuple[str, ...], shape: dict[str, str]) -> DataFrame:
    grouped = df.groupBy(*keys).agg(*_measures())
    return conform(grouped.withColumnRenamed("STAYING", "STAYING_DATE"), shape)


def pace_report(
    detail: DataFrame,
    windows: tuple[LeadWindow, ...] = LEAD_WINDOWS,
    mode: str = CLAMPED,
    impl: str = "case",
) -> DataFrame:
    """On-the-books rooms and revenue per report day, night, property, segment and lead window."""
    return _aggregate(add_lead_window(detail, windows, mode, impl), ("REPORT_DATE", *_DIMENSIONS), REPORT)


def pace_actual(
    history: DataFrame,
    windows: tuple[LeadWindow, ...] = LEAD_WINDOWS,
    mode: str = CLAMPED,
    impl: str = "case",
) -> DataFrame:
    """The same measures of past nights, without a report day."""
    return _aggregate(add_lead_window(history, windows, mode, impl), _DIMENSIONS, ACTUAL)


def pace_report_legacy(detail: DataFrame) -> DataFrame:
    """Superseded report: bucket label and sort number instead of a window id, no booking count."""
    days = lead_days()
    return (
        detail.withColumns({"WINDOW": legacy_bucket(days), "WINDOW_SORT": legacy_bucket_sort(days)})
        .groupBy(
            "REPORT_DATE",
            F.col("STAYING").alias("STAYING_DATE"),
            "PROPERTY",
            "MARKET",
            "R_TYPE",
            "R_CHARGE",
            "WINDOW",
            "WINDOW_SORT",
        )
        .agg(*(m for m in _measures_without_booking()))
    )


def _measures_without_booking() -> list[Column]:
    rooms, room_rev, arr, _, created, modified = _measures()
    return [rooms, room_rev, arr, created, modified]


def ordered_report(report: DataFrame) -> DataFrame:
    """Reading order of the report; writing needs none."""
    return report.orderBy(*list(REPORT)[:7])
