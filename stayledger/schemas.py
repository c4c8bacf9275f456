"""Column lists of every table, as ``name -> Spark type``, and helpers that use them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MONEY = "decimal(18,2)"
RATE = "decimal(18,4)"

PROVENANCE = {"CREATED_AT": "timestamp_ntz", "MODIFIED_AT": "timestamp_ntz", "FILE_NAME": "string"}

# Columns of the SMILE HL layout, file header -> column.
SMILE_HL_HEADERS = {
    "Folionum": "FOLIONUM",
    "Arrival": "ARRIVAL",
    "Departure": "DEPARTURE",
    "Staying": "STAYING",
    "Create time": "CREATE_TIME",
    "Group code": "GROUP_CODE",
    "Group Name": "GROUP_NAME",
    "TA": "TA",
    "TA ID": "TA_ID",
    "Guest Name": "GUEST_NAME",
    "Market": "MARKET",
    "Rate code": "RATE_CODE",
    "Rate Amt": "RATE_AMT",
    "Package code": "PACKAGE_CODE",
    "Pkg Amount": "PACKAGE_AMOUNT",
    "ARR": "ARR",
    "Room Rev": "ROOM_REV",
    "FB Rev": "FB_REV",
    "Other Rev": "OTHER_REV",
    "Status": "STATUS",
    "R type": "R_TYPE",
    "R T Charge": "R_CHARGE",
    "R Surcharge": "R_SURCHARGE",
    "N of Room": "N_OF_ROOM",
    "N of Adt": "N_OF_ADT",
    "N of Chd": "N_OF_CHD",
    "Bk source": "BK_SOURCE",
    "Country": "COUNTRY",
    "Nationality": "NATIONALITY",
}

# Columns of the SMILE PQ layout, file header -> column.
SMILE_PQ_HEADERS = {
    "FolioNum": "FOLIONUM",
    "Arrival": "ARRIVAL",
    "Departure": "DEPARTURE",
    "Staying": "STAYING",
    "Create Time": "CREATE_TIME",
    "Group Code": "GROUP_CODE",
    "TA": "TA",
    "TA ID": "TA_ID",
    "Guest Name": "GUEST_NAME",
    "Market": "MARKET",
    "Rate Code": "RATE_CODE",
    "Rate Amount": "RATE_AMT",
    "Package Code": "PACKAGE_CODE",
    "Total Turn Over": "TOTAL_TURN_OVER",
    "ARR": "ARR",
    "Room REV": "ROOM_REV",
    "FB Rev": "FB_REV",
    "OTher Rev": "OTHER_REV",
    "Status": "STATUS",
    "R Type": "R_TYPE",
    "R T Charge": "R_CHARGE",
    "R Surcharge": "R_SURCHARGE",
    "N of Room": "N_OF_ROOM",
    "N of Adt": "N_OF_ADT",
    "N of Child": "N_OF_CHD",
    "Bk source": "BK_SOURCE",
    "Country": "COUNTRY",
    "Nationality": "NATIONALITY",
}

# Columns of the sample workbook, header -> column ("Deprature" is how the file spells it).
SAMPLE_HEADERS = {
    "Report Date": "REPORT_DATE",
    "Stay Month": "STAY_MONTH",
    "Property": "PROPERTY",
    "Arrival": "ARRIVAL",
    "Deprature": "DEPARTURE",
    "Staying": "STAYING",
    "Creation Date": "CREATE_DATE",
    "Market": "MARKET",
    "Rate code": "RATE_CODE",
    "Rate Amt": "RATE_AMT",
    "Total turn Over": "TOTAL_TURN_OVER",
    "ARR": "ARR",
    "Room REV": "ROOM_REV",
    "FB Rev": "FB_REV",
    "Other Rev": "OTHER_REV",
    "Status": "STATUS",
    "R type": "R_TYPE",
    "R T Charge": "R_CHARGE",
    "N of Room": "N_OF_ROOM",
    "N of Adt": "N_OF_ADT",
    "N of Chd": "N_OF_CHD",
    "Bk source": "BK_SOURCE",
    "Country": "COUNTRY",
    "Nationality": "NATIONALITY",
}

# Opera column -> history column.
OPERA_HISTORY_NAMES = {
    "CONSIDERED_DATE": "STAYING",
    "ARR": "ARRIVAL",
    "DEP": "DEPARTURE",
    "CREATED_DATE": "CREATE_DATE",
    "MARKET_CODE": "MARKET",
    "ROOM_CAT": "R_TYPE",
    "RTC": "R_CHARGE",
    "ROOM_REVENUE": "ROOM_REV",
    "FOOD_REVENUE": "FB_REV",
    "OTHER_REVENUE": "OTHER_REV",
    "NO_ROOMS": "N_OF_ROOM",
    "ADULTS": "N_OF_ADT",
    "CHILDREN": "N_OF_CHD",
    "SOURCE_CODE": "BK_SOURCE",
}

# Fixed values, from here to the rates: columns of the tables and their types.
_SMILE_TYPES = {
    "FOLIONUM": "int",
    "ARRIVAL": "date",
    "DEPARTURE": "date",
    "STAYING": "date",
    "CREATE_TIME": "timestamp_ntz",
    "TA_ID": "int",
    "RATE_AMT": "double",
    "PACKAGE_AMOUNT": MONEY,
    "TOTAL_TURN_OVER": MONEY,
    "ARR": MONEY,
    "ROOM_REV": MONEY,
    "FB_REV": MONEY,
    "OTHER_REV": MONEY,
    "N_OF_ROOM": "int",
    "N_OF_ADT": "int",
    "N_OF_CHD": "int",
}


def _smile(headers: dict[str, str]) -> dict[str, str]:
    return {name: _SMILE_TYPES.get(name, "string") for name in headers.values()}


SMILE_HL_FILE = _smile(SMILE_HL_HEADERS)
SMILE_PQ_FILE = _smile(SMILE_PQ_HEADERS)

OPERA_FILE = {
    "CONSIDERED_DATE": "date",
    "ADULTS": "int",
    "CHILDREN": "int",
    "CREATED_DATE": "date",
    "COUNTRY": "string",
    "NO_ROOMS": "int",
    "MARKET_CODE": "string",
    "SOURCE_CODE": "string",
    "CHANNEL": "string",
    "RATE_CODE": "string",
    "ROOM_CAT": "string",
    "RTC": "string",
    "ARR": "date",
    "DEP": "date",
    "RESV_NAME_ID": "int",
    "ROOM_REVENUE": MONEY,
    "FOOD_REVENUE": MONEY,
    "OTHER_REVENUE": MONEY,
}

_DAY_KEY = {"PROPERTY": "string", "REPORT_DATE": "date"}

# One SMILE staging table takes both layouts; what one of them lacks is NULL.
STG_SMILE = {**SMILE_HL_FILE, "TOTAL_TURN_OVER": MONEY, **PROVENANCE, **_DAY_KEY}
STG_OPERA = {**OPERA_FILE, "COMP_ROOM_REVENUE": MONEY, **PROVENANCE, **_DAY_KEY}

HISTORY = {
    "STAY_MONTH": "string",
    "PROPERTY": "string",
    "ARRIVAL": "date",
    "DEPARTURE": "date",
    "STAYING": "date",
    "CREATE_DATE": "date",
    "MARKET": "string",
    "RATE_CODE": "string",
    "RATE_AMT": "double",
    "TOTAL_TURN_OVER": MONEY,
    "ARR": MONEY,
    "ROOM_REV": MONEY,
    "FB_REV": MONEY,
    "OTHER_REV": MONEY,
    "STATUS": "string",
    "R_TYPE": "string",
    "R_CHARGE": "string",
    "N_OF_ROOM": "int",
    "N_OF_ADT": "int",
    "N_OF_CHD": "int",
    "BK_SOURCE": "string",
    "COUNTRY": "string",
    "NATIONALITY": "string",
    "BOOKING": "int",
    **PROVENANCE,
}

DETAIL = {"REPORT_DATE": "date", **HISTORY}

SAMPLE = {name: DETAIL[name] for name in SAMPLE_HEADERS.values()}

ACTUAL = {
    "STAYING_DATE": "date",
    "PROPERTY": "string",
    "MARKET": "string",
    "R_TYPE": "string",
    "R_CHARGE": "string",
    "WINDOW_ID": "int",
    "TOTAL_ROOM": "int",
    "ROOM_REV": MONEY,
    "ARR": MONEY,
    "TOTAL_BOOKING": "int",
    "CREATED_AT": "timestamp_ntz",
    "MODIFIED_AT": "timestamp_ntz",
}

REPORT = {"REPORT_DATE": "date", **ACTUAL}

EXCHANGE_RATE = {
    "REPORT_DATE": "date",
    "FROM_CURRENCY_CODE": "string",
    "TO_CURRENCY_CODE": "string",
    "BUY_CASH": RATE,
    "BUY_TRANSFER": RATE,
    "SELL_CASH": RATE,
    "SELL_TRANSFER": RATE,
    "CREATED_AT": "timestamp_ntz",
    "MODIFIED_AT": "timestamp_ntz",
}

MANIFEST = {
    "PROPERTY": "string",
    "NAME": "string",
    "STATUS": "string",
    "REASON": "string",
    "REPORT_AT": "timestamp_ntz",
    "MODIFIED_AT": "timestamp_ntz",
    "REPORT_DATE": "date",
}


LOAD_REJECTS = {
    "PROPERTY": "string",
    "FILE_NAME": "string",
    "COLUMN": "string",
    "TEXT": "string",
    # Why the text gave no value.
    "REASON": "string",
    # Of history files: the night of the row, and the whole row where it could not be taken in.
    "STAYING": "date",
    "LEFT_OUT": "string",
    "REPORT_DATE": "date",
}

# What a table holds of a property on a day, and the digest of the files it was taken from.
DAY_VERSIONS = {
    "TABLE_NAME": "string",
    "PROPERTY": "string",
    "NB_ROWS": "bigint",
    "MODIFIED_AT": "timestamp_ntz",
    "FILES": "string",
    "DAY": "date",
}

# Batches of a stream whose days are in the marts.
STREAM_BATCHES = {
    "STREAM_ID": "string",
    "BATCH_ID": "bigint",
    "DAYS": "array<date>",
    "AS_OF": "date",
}

AUDIT = {
    "MART": "string",
    "PROPERTY": "string",
    "MIN_DATE": "date",
    "MAX_DATE": "date",
    "NB_ROWS": "bigint",
    "NULL_DATES": "bigint",
    "MODIFIED_AT": "timestamp_ntz",
    "AUDIT_DATE": "date",
}


def ddl(columns: dict[str, str]) -> str:
    """Column list as DDL text."""
    return ", ".join(f"`{name}` {kind}" for name, kind in columns.items())


def conform(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Exactly these columns, by name, in this order, cast to these types; a column the frame lacks is NULL."""
    have = set(df.columns)
    return df.select(
        *(
            (F.col(name) if name in have else F.lit(None)).cast(kind).alias(name)
            for name, kind in columns.items()
        )
    )


def required(df: DataFrame, columns: dict[str, str] | list[str]) -> DataFrame:
    """Exactly these columns; a missing one raises, naming it."""
    missing = [name for name in columns if name not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    return df.select(*columns)
