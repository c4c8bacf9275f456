"""Small staging frames for the mart tests."""

from __future__ import annotations

from datetime import date, datetime
from decimal import Decimal

from stayledger.schemas import STG_OPERA, STG_SMILE, conform

SMILE_COLUMNS = (
    "PROPERTY string, REPORT_DATE date, STAYING date, ARRIVAL date, CREATE_TIME timestamp_ntz, MARKET string, "
    "R_TYPE string, R_CHARGE string, N_OF_ROOM int, ROOM_REV decimal(18,2), ARR decimal(18,2), MODIFIED_AT timestamp_ntz"
)
OPERA_COLUMNS = (
    "PROPERTY string, REPORT_DATE date, CONSIDERED_DATE date, ARR date, CREATED_DATE date, MARKET_CODE string, "
    "ROOM_CAT string, RTC string, NO_ROOMS int, ROOM_REVENUE decimal(18,2), MODIFIED_AT timestamp_ntz"
)


def day(d: int, month: int = 8) -> date:
    return date(2025, month, d)


def at(d: int, hour: int = 9) -> datetime:
    return datetime(2025, 8, d, hour)


def smile(spark, *nights):
    """nights: (property, report day, staying, rooms, modified)"""
    data = [
        (p, r, s, s, datetime(2025, 7, 1), "CW", "SV3A", None, n, Decimal(n * 100), Decimal(n), m) for p, r, s, n, m in nights
    ]
    return conform(spark.createDataFrame(data, SMILE_COLUMNS), STG_SMILE)


def opera(spark, *nights):
    data = [(p, r, s, r, None, "TI", None, "CV2F", n, Decimal(n * 10), m) for p, r, s, n, m in nights]
    return conform(spark.createDataFrame(data, OPERA_COLUMNS), STG_OPERA)
