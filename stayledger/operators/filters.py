"""Row selections."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def otb(df: DataFrame, staying: str = "STAYING") -> DataFrame:
    """On-the-books rows: nights on or after the report day."""
    return df.filter(F.col(staying) >= F.col("REPORT_DATE"))


def past_night(df: DataFrame, as_of: date | None = None, staying: str = "STAYING") -> DataFrame:
    """The night before the report day; of one report day, or of every one when ``as_of`` is None."""
    night = F.col(staying) == F.date_sub("REPORT_DATE", 1)
    return df.filter(night if as_of is None else (F.col("REPORT_DATE") == F.lit(as_of)) & night)


def up_to(df: DataFrame, prop: str, cutoff: date, staying: str = "STAYING") -> DataFrame:
    """Nights of one property up to and including the cutoff."""
    return df.filter((F.col("PROPERTY") == prop) & (F.col(staying) <= F.lit(cutoff)))


def reported_between(df: DataFrame, start: date, end: date) -> DataFrame:
    return df.filter(F.col("REPORT_DATE").between(F.lit(start), F.lit(end)))


def night_reported_between(df: DataFrame, start: date, end: date, staying: str = "STAYING") -> DataFrame:
    """Nights whose following day lies in the range.

    Written on the bare column, so that the bounds reach the scan."""
    return df.filter(F.col(staying).between(F.date_sub(F.lit(start), 1), F.date_sub(F.lit(end), 1)))


def in_list(df: DataFrame, column: str, values: list) -> DataFrame:
    return df.filter(F.col(column).isin(*values))


def null_dates(df: DataFrame, *columns: str) -> DataFrame:
    """Rows where one of the key dates is unknown."""
    cond = F.lit(False)
    for c in columns:
        cond = cond | F.col(c).isNull()
    return df.filter(cond)


def same_day_files(files: DataFrame, loaded: DataFrame) -> DataFrame:
    """Every file of a property and day of which a snapshot was loaded."""
    days = loaded.select("PROPERTY", "REPORT_DATE").distinct()
    return files.join(days, ["PROPERTY", "REPORT_DATE"], "left_semi")
