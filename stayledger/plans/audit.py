"""Reconciliation of the marts: counts, coverage, freshness, rows without key dates.

Of stored tables, the counts are those of ``sinks.versions``: days that did not change since are not read.
"""

from __future__ import annotations

from datetime import date
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stayledger.session import pin
from stayledger.sinks.tables import Ledger
from stayledger.sinks.versions import versions

# Table -> its day column.
DAY_COLUMN = {
    "stg_smile": "REPORT_DATE",
    "stg_opera": "REPORT_DATE",
    "booking_pace_detail": "REPORT_DATE",
    "booking_pace_history": "STAYING",
    "booking_pace_report": "REPORT_DATE",
    "booking_pace_actual": "STAYING_DATE",
}


def audit_day_counts(frames: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """MART, PROPERTY, DAY, NB_ROWS, MODIFIED_AT of every frame, given with its day column."""
    parts = [
        df.groupBy("PROPERTY", F.col(day).alias("DAY"))
        .agg(F.count(F.lit(1)).alias("NB_ROWS"), F.max("MODIFIED_AT").alias("MODIFIED_AT"))
        .select(F.lit(mart).alias("MART"), "*")
        for mart, (df, day) in frames.items()
    ]
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


def audit_summary(frames: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """MART, PROPERTY, MIN_DATE, MAX_DATE, NB_ROWS, NULL_DATES, MODIFIED_AT: coverage, freshness and
    rows without a day.  One aggregation over the day counts, so each mart is read once."""
    return summed_up(audit_day_counts(frames))


def summed_up(day_counts: DataFrame) -> DataFrame:
    """The summary of day counts."""
    return (
        day_counts.groupBy("MART", "PROPERTY")
        .agg(
            F.min("DAY").alias("MIN_DATE"),
            F.max("DAY").alias("MAX_DATE"),
            F.sum("NB_ROWS").alias("NB_ROWS"),
            F.coalesce(F.sum(F.when(F.col("DAY").isNull(), F.col("NB_ROWS"))), F.lit(0)).alias("NULL_DATES"),
            F.max("MODIFIED_AT").alias("MODIFIED_AT"),
        )
    )


def stored_day_counts(ledger: Ledger, tables: dict[str, str] = DAY_COLUMN) -> DataFrame:
    """The day counts of stored tables; of the rows, only those without a day are read."""
    undated = audit_day_counts({t: (ledger.table(t).filter(F.col(day).isNull()), day) for t, day in tables.items()})
    parts = [
        versions(ledger, t).select(F.lit(t).alias("MART"), "PROPERTY", F.col(day).alias("DAY"), "NB_ROWS", "MODIFIED_AT")
        for t, day in tables.items()
    ]
    return reduce(DataFrame.unionByName, parts, undated)


def audit_tables(ledger: Ledger, tables: dict[str, str] = DAY_COLUMN) -> DataFrame:
    """Summary of the ledger's tables, in reading order."""
    return summed_up(stored_day_counts(ledger, tables)).orderBy("MART", "PROPERTY")


def store_audit(ledger: Ledger, as_of: date) -> int:
    """Keep the summary under its day in the audit table; returns its number of lines."""
    lines = pin(audit_tables(ledger).withColumn("AUDIT_DATE", F.lit(as_of)))
    ledger.replace_keys("audit", lines, lines, on=("AUDIT_DATE",), present=lines)
    return lines.count()


def audit_days(ledger: Ledger, table: str) -> DataFrame:
    """Rows per property and day of one table, newest first."""
    day = DAY_COLUMN[table]
    counts = stored_day_counts(ledger, {table: day})
    return counts.select("PROPERTY", F.col("DAY").alias(day), "NB_ROWS").orderBy(F.col(day).desc(), "PROPERTY")
