"""What changed, what is missing, and the new version of a table that follows from it.

Key frames are aggregated before any join, and the joins are plain equi semi /
anti joins on the fact side.  Whether the keys are broadcast is the caller's to
decide (``session.pin_keys`` does, by counting them, and ``session.key_join`` for longer
lists); otherwise Spark shuffles, splitting skewed partitions of the fact side.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stayledger.session import key_join

DAY_KEY = ("PROPERTY", "REPORT_DATE")
NIGHT_KEY = ("PROPERTY", "STAYING")


def latest_modified(df: DataFrame, keys: tuple[str, ...] = DAY_KEY, ts: str = "MODIFIED_AT") -> DataFrame:
    """Newest modification per key."""
    return df.groupBy(*keys).agg(F.max(ts).alias(ts))


def distinct_keys(df: DataFrame, keys: tuple[str, ...] = DAY_KEY) -> DataFrame:
    return df.select(*keys).distinct()


def changed_keys(
    source: DataFrame,
    target: DataFrame,
    keys: tuple[str, ...] = DAY_KEY,
    ts: str = "MODIFIED_AT",
) -> DataFrame:
    """Keys the target lacks, or holds in an older version, with the source's newest modification."""
    s = latest_modified(source, keys, ts)
    t = latest_modified(target, keys, ts).withColumnRenamed(ts, "_target_ts")
    return (
        s.join(t, list(keys), "left")
        .filter(F.col("_target_ts").isNull() | (F.col(ts) > F.col("_target_ts")))
        .drop("_target_ts")
    )


def property_watermark(target: DataFrame, ts: str = "MODIFIED_AT") -> DataFrame:
    """Superseded change detection: one newest modification per property, 1900-01-01 when unknown."""
    floor = F.lit("1900-01-01").cast("timestamp_ntz")
    return target.groupBy("PROPERTY").agg(F.coalesce(F.max(ts), floor).alias("WATERMARK"))


def changed_since_watermark(source: DataFrame, target: DataFrame, ts: str = "MODIFIED_AT") -> DataFrame:
    """Superseded change list: distinct (PROPERTY, REPORT_DATE, modification) newer than the property's watermark."""
    floor = F.lit("1900-01-01").cast("timestamp_ntz")
    fresh = source.select(*DAY_KEY, ts).distinct()
    return (
        fresh.join(property_watermark(target, ts), "PROPERTY", "left")
        .filter(F.col(ts) > F.coalesce(F.col("WATERMARK"), floor))
        .drop("WATERMARK")
    )


def _keyed(df: DataFrame, keys: DataFrame, on: tuple[str, ...], how: str, pinned: bool) -> DataFrame:
    return key_join(df, keys, on, how) if pinned else df.join(keys.select(*on), list(on), how)


def restrict_to_keys(df: DataFrame, keys: DataFrame, on: tuple[str, ...] = DAY_KEY, pinned: bool = False) -> DataFrame:
    """Rows whose key is listed; an unknown key part matches nothing.

    ``pinned``: the keys are (``session.pin_keys``), so that they can be counted to choose the join."""
    return _keyed(df, keys, on, "left_semi", pinned)


def missing_keys(source: DataFrame, target: DataFrame, on: tuple[str, ...]) -> DataFrame:
    """Distinct keys of the source that the target does not have."""
    return distinct_keys(source, on).join(distinct_keys(target, on), list(on), "left_anti")


def history_gaps(staging: DataFrame, history: DataFrame) -> DataFrame:
    """Snapshot days (PROPERTY, REPORT_DATE) whose preceding night is not in history."""
    nights = distinct_keys(history, NIGHT_KEY).select(
        "PROPERTY", F.date_add("STAYING", 1).alias("REPORT_DATE")
    )
    return distinct_keys(staging).join(nights, list(DAY_KEY), "left_anti")


def actual_gaps(history: DataFrame, actual: DataFrame) -> DataFrame:
    """Nights (PROPERTY, STAYING) in history that actual does not have."""
    known = actual.select("PROPERTY", F.col("STAYING_DATE").alias("STAYING"))
    return missing_keys(history, known, NIGHT_KEY)


def new_days(rows: DataFrame, history: DataFrame) -> DataFrame:
    """Rows of nights that history does not know for the property.

    A row without a night is kept, as an unknown value is in no list."""
    return rows.join(distinct_keys(history, NIGHT_KEY), list(NIGHT_KEY), "left_anti")


def delete_keys(target: DataFrame, keys: DataFrame, on: tuple[str, ...] = DAY_KEY, pinned: bool = False) -> DataFrame:
    """The target without the rows of the listed keys."""
    return _keyed(target, keys, on, "left_anti", pinned)


def replace_keys(
    target: DataFrame, keys: DataFrame, new: DataFrame, on: tuple[str, ...] = DAY_KEY, pinned: bool = False
) -> DataFrame:
    """The target with the listed keys' rows replaced by ``new`` (none, when the key became empty)."""
    return delete_keys(target, keys, on, pinned).unionByName(new)


def replace_day(target: DataFrame, prop: str, day: date, new: DataFrame) -> DataFrame:
    """The target with one property's day replaced."""
    hit = (F.col("PROPERTY") == prop) & (F.col("REPORT_DATE") == F.lit(day))
    return _without(target, hit).unionByName(new)


def shifted_nights(keys: DataFrame, as_of: date | None = None) -> DataFrame:
    """(PROPERTY, night before the report day) of the keys; of one report day when given."""
    chosen = keys if as_of is None else keys.filter(F.col("REPORT_DATE") == F.lit(as_of))
    return chosen.select("PROPERTY", F.date_sub("REPORT_DATE", 1).alias("STAYING"))


def delete_shifted_keys(history: DataFrame, keys: DataFrame, as_of: date, pinned: bool = False) -> DataFrame:
    """History without last night's rows of the properties whose day ``as_of`` changed."""
    return delete_keys(history, shifted_nights(keys, as_of), NIGHT_KEY, pinned)


def delete_up_to(target: DataFrame, prop: str, cutoff: date, column: str) -> DataFrame:
    """The target without one property's rows up to the cutoff; rows without a date stay."""
    return _without(target, (F.col("PROPERTY") == prop) & (F.col(column) <= F.lit(cutoff)))


def delete_after(target: DataFrame, prop: str, cutoff: date, column: str) -> DataFrame:
    """The target without one property's rows after the cutoff; rows without a date stay."""
    return _without(target, (F.col("PROPERTY") == prop) & (F.col(column) > F.lit(cutoff)))


def delete_night(actual: DataFrame, as_of: date, column: str = "STAYING_DATE") -> DataFrame:
    """The target without the night before ``as_of``."""
    return _without(actual, F.col(column) == F.date_sub(F.lit(as_of), 1))


def _without(target: DataFrame, hit) -> DataFrame:
    return target.filter(~F.coalesce(hit, F.lit(False)))
