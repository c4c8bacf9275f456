"""Projections that bring every layout into the canonical reservation-night shape."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stayledger.functions.dates import stay_month
from stayledger.functions.money import (
    OPERA_TERMS,
    SMILE_TERMS,
    booking_flag,
    booking_flag_legacy,
    turnover_null_prop,
    turnover_null_safe,
)
from stayledger.schemas import DETAIL, HISTORY, OPERA_HISTORY_NAMES, conform

_SAME = {name: name for name in ("CREATED_AT", "MODIFIED_AT", "FILE_NAME")}


def _project(df: DataFrame, columns: dict[str, Column | str]) -> DataFrame:
    exprs = {name: F.col(c) if isinstance(c, str) else c for name, c in columns.items()}
    return conform(df.select(*(c.alias(name) for name, c in exprs.items())), DETAIL)


def rename_headers(df: DataFrame, headers: dict[str, str]) -> DataFrame:
    """File headers to column names; headers the map does not know stay as they are."""
    return df.withColumnsRenamed(headers)


def canonical_smile(stg: DataFrame, legacy_booking: bool = False) -> DataFrame:
    """SMILE staging rows in the detail shape, turnover of four NULL-safe terms."""
    created = F.to_date("CREATE_TIME")
    staged = stg.withColumn("CREATE_DATE", created)
    return _project(
        staged,
        {
            "REPORT_DATE": "REPORT_DATE",
            "STAY_MONTH": stay_month("STAYING"),
            "PROPERTY": "PROPERTY",
            "ARRIVAL": "ARRIVAL",
            "DEPARTURE": "DEPARTURE",
            "STAYING": "STAYING",
            "CREATE_DATE": "CREATE_DATE",
            "MARKET": "MARKET",
            "RATE_CODE": "RATE_CODE",
            "RATE_AMT": "RATE_AMT",
            "TOTAL_TURN_OVER": turnover_null_safe(*SMILE_TERMS),
            "ARR": "ARR",
            "ROOM_REV": "ROOM_REV",
            "FB_REV": "FB_REV",
            "OTHER_REV": "OTHER_REV",
            "STATUS": "STATUS",
            "R_TYPE": "R_TYPE",
            "R_CHARGE": "R_CHARGE",
            "N_OF_ROOM": "N_OF_ROOM",
            "N_OF_ADT": "N_OF_ADT",
            "N_OF_CHD": "N_OF_CHD",
            "BK_SOURCE": "BK_SOURCE",
            "COUNTRY": "COUNTRY",
            "NATIONALITY": "NATIONALITY",
            "BOOKING": booking_flag_legacy() if legacy_booking else booking_flag(),
            **_SAME,
        },
    )


def canonical_opera(stg: DataFrame, legacy_booking: bool = False, legacy_room: bool = False) -> DataFrame:
    """Opera staging rows in the detail shape, turnover of three NULL-safe terms.

    Opera's ARR is the arrival date; it has no average rate, status or rate amount.
    ``legacy_room`` leaves the room columns NULL, as the superseded scripts did."""
    return _project(
        stg,
        {
            "REPORT_DATE": "REPORT_DATE",
            "STAY_MONTH": stay_month("CONSIDERED_DATE"),
            "PROPERTY": "PROPERTY",
            "ARRIVAL": "ARR",
            "DEPARTURE": "DEP",
            "STAYING": "CONSIDERED_DATE",
            "CREATE_DATE": "CREATED_DATE",
            "MARKET": "MARKET_CODE",
            "RATE_CODE": "RATE_CODE",
            "TOTAL_TURN_OVER": turnover_null_safe(*OPERA_TERMS),
            "ROOM_REV": "ROOM_REVENUE",
            "FB_REV": "FOOD_REVENUE",
            "OTHER_REV": "OTHER_REVENUE",
            "R_TYPE": F.lit(None) if legacy_room else "ROOM_CAT",
            "R_CHARGE": F.lit(None) if legacy_room else "RTC",
            "N_OF_ROOM": "NO_ROOMS",
            "N_OF_ADT": "ADULTS",
            "N_OF_CHD": "CHILDREN",
            "BK_SOURCE": "SOURCE_CODE",
            "COUNTRY": "COUNTRY",
            "NATIONALITY": "COUNTRY",
            "BOOKING": booking_flag_legacy("CREATED_DATE", "ARR")
            if legacy_booking
            else booking_flag("CONSIDERED_DATE", "ARR"),
            **_SAME,
        },
    )


def canonical_history_smile(rows: DataFrame, null_safe: bool = False) -> DataFrame:
    """SMILE history-file rows (PROPERTY and provenance attached) in the history shape.

    The turnover of a history file is NULL when a term is; ``null_safe`` counts it as 0."""
    turnover = turnover_null_safe if null_safe else turnover_null_prop
    return conform(
        rows.withColumns(
            {
                "STAY_MONTH": stay_month("STAYING"),
                "CREATE_DATE": F.to_date("CREATE_TIME"),
                "TOTAL_TURN_OVER": turnover(*SMILE_TERMS),
                "BOOKING": booking_flag(),
            }
        ),
        HISTORY,
    )


def canonical_history_opera(rows: DataFrame, null_safe: bool = False) -> DataFrame:
    """Opera history-file rows (PROPERTY and provenance attached) in the history shape."""
    turnover = turnover_null_safe if null_safe else turnover_null_prop
    renamed = rows.withColumnsRenamed(OPERA_HISTORY_NAMES)
    return conform(
        renamed.withColumns(
            {
                "STAY_MONTH": stay_month("STAYING"),
                "TOTAL_TURN_OVER": turnover("ROOM_REV", "FB_REV", "OTHER_REV"),
                "NATIONALITY": F.col("COUNTRY"),
                "BOOKING": booking_flag(),
            }
        ),
        HISTORY,
    )


def union_layouts(smile: DataFrame, opera: DataFrame, **options: bool) -> DataFrame:
    """All properties of both staging layouts as one canonical frame."""
    legacy_booking = options.get("legacy_booking", False)
    return canonical_smile(smile, legacy_booking).unionByName(
        canonical_opera(opera, legacy_booking, options.get("legacy_room", False))
    )


def with_collation(df: DataFrame, *columns: str, collation: str = "UTF8_LCASE_RTRIM") -> DataFrame:
    """Compare and group these text columns case- and trailing-blank-insensitively."""
    return df.withColumns({c: F.collate(F.col(c), collation) for c in columns})
