"""Snapshot files: report day from the name, newest per day, files not loaded yet.

A files frame has PROPERTY, PATH, NAME, MODIFIED_AT, CREATED_AT and, once named,
REPORT_DATE and REPORT_AT.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# File-name patterns, the stamp being ddMMyyyy and, for SMILE, _HHmm.
SMILE_NAME = r"(?i)^.*(\d{8}_\d{4})"
DATE_PREFIX_NAME = r"(?i)^.*Date(\d{8}_\d{4})"
OPERA_NAME = r"(?i)^.*_(\d{8})"
HISTORY_MARK = "_history"


def _stamp_time(stamp: Column) -> Column:
    """Timestamp of a ddMMyyyy or ddMMyyyy_HHmm stamp; NULL when it is empty or no such day exists."""

    def made(text: Column) -> Column:
        def part(start: int, length: int) -> Column:
            return F.substring(text, start, length).try_cast("int")

        zero = F.lit(0)
        return F.try_make_timestamp_ntz(
            part(5, 4),
            part(3, 2),
            part(1, 2),
            F.coalesce(part(10, 2), zero),
            F.coalesce(part(12, 2), zero),
            F.lit(0).cast("decimal(16,6)"),
        )

    # The name is searched once, however often its parts are mentioned.
    return F.get(F.transform(F.array(stamp), made), F.lit(0))


def is_history_name(name: Column) -> Column:
    return F.lower(name).contains(HISTORY_MARK)


def with_smile_name(files: DataFrame, pattern: str = SMILE_NAME) -> DataFrame:
    """Report day and time of SMILE snapshots; history files and other names get NULL."""
    name = F.col("NAME")
    at = F.when(~is_history_name(name), _stamp_time(F.regexp_extract(name, pattern, 1)))
    return files.withColumn("REPORT_AT", at).withColumn("REPORT_DATE", F.to_date("REPORT_AT"))


def with_opera_name(files: DataFrame) -> DataFrame:
    """Report day of Opera snapshots: ``.txt``, no history file, day in the name or else the file's own day."""
    name = F.col("NAME")
    usable = F.lower(name).endswith(".txt") & ~F.lower(name).contains("history")
    stamp = F.regexp_extract(name, OPERA_NAME, 1)
    at = F.when(usable & (stamp != ""), _stamp_time(stamp)).when(usable & (stamp == ""), F.col("CREATED_AT"))
    return files.withColumn("REPORT_AT", at).withColumn("REPORT_DATE", F.to_date("REPORT_AT"))


def suffix_date(name: Column) -> Column:
    """Last ``_`` token of the name without extension, read as yyyyMMdd."""
    stem = F.regexp_replace(name, r"(?<=.)\.[^.]*$", "")
    return F.try_to_date(F.substring_index(stem, "_", -1), "yyyyMMdd")


def latest_per_day(files: DataFrame, loaded: DataFrame | None = None) -> DataFrame:
    """Newest file per property and report day; ties go to the later modification, then the greater name.

    With ``loaded`` (files already in the manifest) a late file that is older
    than the loaded one of its day no longer replaces it."""
    order = ("REPORT_AT", "MODIFIED_AT", "NAME")
    place = Window.partitionBy("PROPERTY", "REPORT_DATE").orderBy(*(F.col(c).desc() for c in order))
    newest = (
        files.filter(F.col("REPORT_DATE").isNotNull())
        .withColumn("_place", F.row_number().over(place))
        .filter(F.col("_place") == 1)
        .drop("_place")
    )
    if loaded is None:
        return newest
    known = loaded.groupBy("PROPERTY", "REPORT_DATE").agg(F.max("REPORT_AT").alias("_loaded_at"))
    return (
        newest.join(known, ["PROPERTY", "REPORT_DATE"], "left")
        .filter(F.col("_loaded_at").isNull() | (F.col("REPORT_AT") >= F.col("_loaded_at")))
        .drop("_loaded_at")
    )


def older_than_loaded(files: DataFrame, loaded: DataFrame) -> DataFrame:
    """Files of days of which a newer snapshot is loaded."""
    known = loaded.groupBy("PROPERTY", "REPORT_DATE").agg(F.max("REPORT_AT").alias("_loaded_at"))
    return files.join(known, ["PROPERTY", "REPORT_DATE"]).filter(F.col("REPORT_AT") < F.col("_loaded_at")).drop("_loaded_at")


def ordered_files(files: DataFrame) -> DataFrame:
    return files.orderBy("REPORT_DATE", "PROPERTY", "NAME")


def new_files(files: DataFrame, archived: DataFrame) -> DataFrame:
    """Files whose name is not archived for their property."""
    return files.join(archived.select("PROPERTY", "NAME"), ["PROPERTY", "NAME"], "left_anti")


def history_file(files: DataFrame) -> DataFrame:
    """One history file per property: the first by name."""
    return (
        files.filter(is_history_name(F.col("NAME")))
        .groupBy("PROPERTY")
        .agg(F.min_by(F.struct(*files.columns), F.col("NAME")).alias("f"))
        .select("f.*")
    )


def history_parts(files: DataFrame) -> DataFrame:
    """All parts, which share one name, of the history file of each property."""
    first = history_file(files).select("PROPERTY", "NAME")
    return files.join(first, ["PROPERTY", "NAME"], "left_semi")


def unnamed_files(files: DataFrame) -> DataFrame:
    """Files that are no history file and have no usable report day: to be looked at by hand."""
    return files.filter(F.col("REPORT_DATE").isNull() & ~is_history_name(F.col("NAME")))


def carry_flag(files: DataFrame, loaded: DataFrame, flag: str = "ETL_CHECK") -> DataFrame:
    """Left join on name: the loaded side's columns get ``_right``, its true flag wins over the file's own."""
    right = loaded.select(
        "PROPERTY",
        "NAME",
        *(F.col(c).alias(f"{c}_right") for c in loaded.columns if c not in ("PROPERTY", "NAME")),
    )
    joined = files.join(right, ["PROPERTY", "NAME"], "left")
    return joined.withColumn(
        flag, F.when(F.col(f"{flag}_right"), F.lit(True)).otherwise(F.col(flag))
    )
