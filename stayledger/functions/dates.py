"""Date expressions (Column -> Column).

Parsed dates lie within the calendar, ``FIRST_DAY`` to ``LAST_DAY``; what a text names beyond it is no date.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: day zero of spreadsheet serial dates.
SERIAL_ORIGIN = "1899-12-30"
# The days that a timestamp of nanoseconds can hold in full.
FIRST_DAY, LAST_DAY = date(1677, 9, 22), date(2262, 4, 10)
_FIRST_SERIAL, _LAST_SERIAL = ((d - date.fromisoformat(SERIAL_ORIGIN)).days for d in (FIRST_DAY, LAST_DAY))


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def in_calendar(day: Column) -> Column:
    """The day, or NULL when it lies outside the calendar."""
    return F.when(day.between(F.lit(FIRST_DAY), F.lit(LAST_DAY)), day)


def excel_serial_date(c: Column | str) -> Column:
    """Spreadsheet serial number (text or number, fraction = time of day) to its calendar date."""
    serial = F.floor(F.nanvl(_col(c).try_cast("double"), F.lit(None).cast("double")))
    days = F.when(serial.between(F.lit(_FIRST_SERIAL), F.lit(_LAST_SERIAL)), serial).cast("int")
    return F.date_add(F.lit(SERIAL_ORIGIN).cast("date"), days)


def coerce_date(c: Column | str, pattern: str = "d-M-yyyy") -> Column:
    """Parse by pattern; text that does not fit becomes NULL."""
    return in_calendar(F.try_to_date(_col(c), pattern))


def abbrev_date(c: Column | str, strict: bool = False) -> Column:
    """``01/Aug/25`` to a date.  Years 69-99 mean 19xx, as strptime reads them.

    ``strict`` makes text that does not fit fail the query (under ANSI mode)."""
    parse = F.to_date if strict else F.try_to_date
    day = parse(_col(c), "d/MMM/yy")
    return F.when(F.year(day) >= 2069, F.add_months(day, -1200)).otherwise(day)


def dayfirst_date(c: Column | str) -> Column:
    """Free-form date, day before month; anything else becomes NULL."""
    text = F.trim(_col(c))
    day, clock = F.substring_index(text, " ", 1), F.trim(F.regexp_replace(text, r"^\S+", ""))
    # What follows the day must be a time of day.
    whole = (clock == "") | F.rlike(clock, F.lit(r"^([01]?\d|2[0-3]):[0-5]\d(:[0-5]\d(\.\d+)?)?$"))
    return F.when(
        whole,
        in_calendar(
            F.coalesce(
                F.try_to_date(day, "d/M/yyyy"),
                F.try_to_date(day, "d-M-yyyy"),
                F.try_to_date(day, "d.M.yyyy"),
                F.try_to_date(day, "yyyy-M-d"),
                F.try_to_date(day, "yyyy/M/d"),
            )
        ),
    )


def cell_date(c: Column | str) -> Column:
    """A spreadsheet cell as text: ISO date or timestamp, read as a whole, else a serial number."""
    text = F.trim(_col(c))
    iso = F.when(F.rlike(text, F.lit(r"^\d{4}-\d{2}-\d{2}")), text.try_cast("timestamp_ntz"))
    # A plain day, as most cells are, needs no pattern.
    plain = _col(c).try_cast("date")
    return F.when(plain.cast("string") == _col(c), in_calendar(plain)).otherwise(
        F.coalesce(in_calendar(iso.cast("date")), excel_serial_date(text))
    )


def cell_timestamp(c: Column | str) -> Column:
    """A spreadsheet cell as text: ISO timestamp, else the midnight of a serial number's date."""
    text = F.trim(_col(c))
    at = text.try_cast("timestamp_ntz")
    at = F.when(in_calendar(at.cast("date")).isNotNull(), at)
    return F.coalesce(at, excel_serial_date(text).cast("timestamp_ntz"))


# Why a text gives no date.
NO_SUCH_DAY, OUT_OF_CALENDAR, NOT_A_DATE = "no such day", "outside the calendar", "not a date"


def date_outcome(c: Column | str, parse: Callable[[Column], Column], shape: str) -> Column:
    """(value, reason) of a text: its date by ``parse``, else why there is none.  ``shape`` is the pattern of texts that are
    written like a date of the style; a number is one too where the style reads numbers."""
    text = _col(c)
    value = parse(text)
    reason = F.when(text.isNotNull() & value.isNull(), undated(text, shape))
    return F.struct(value.alias("value"), reason.cast("string").alias("reason"))


def undated(text: Column, shape: str) -> Column:
    """Why a text that gives no date gives none."""
    year = F.regexp_extract(text, r"(?<!\d)(\d{4,})(?!\d)", 1).try_cast("int")
    far = ~year.between(FIRST_DAY.year, LAST_DAY.year) | text.try_cast("double").isNotNull()
    return F.when(F.rlike(text, F.lit(shape)), F.when(far, OUT_OF_CALENDAR).otherwise(NO_SUCH_DAY)).otherwise(NOT_A_DATE)


def stay_month(c: Column | str) -> Column:
    return F.date_format(_col(c), "yyyy-MM")


def lead_days(created: Column | str = "CREATE_DATE", arrival: Column | str = "ARRIVAL") -> Column:
    """Days from creation to arrival; NULL when either is unknown, negative when created later."""
    return F.datediff(_col(arrival), _col(created))


def lead_days_clamped(created: Column | str = "CREATE_DATE", arrival: Column | str = "ARRIVAL") -> Column:
    """Lead days with unknown and negative values taken as 0."""
    return F.greatest(F.coalesce(lead_days(created, arrival), F.lit(0)), F.lit(0))


def shift_date(c: Column | str, days: int) -> Column:
    return F.date_add(_col(c), days)
