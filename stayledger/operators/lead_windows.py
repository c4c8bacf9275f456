"""Lead-time window of every row.

Three forms give the same rows.  ``case`` (default) turns the dimension rows into
one CASE expression, so it stays inside the scan's stage without any join.
``lookup`` joins a day -> id table on equality, ``range`` is the literal range
join; both broadcast the dimension, whose size is fixed by its row objects.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stayledger.dimensions import LEAD_WINDOWS, LeadWindow, check_windows, window_dim
from stayledger.functions.dates import lead_days, lead_days_clamped
from stayledger.functions.lead import window_case

CLAMPED = "clamped"
STRICT = "strict"


def window_days(mode: str) -> Column:
    """Day count the mode compares: clamped at 0, or the raw difference."""
    if mode not in (CLAMPED, STRICT):
        raise ValueError(f"unknown window mode {mode!r}")
    return lead_days_clamped() if mode == CLAMPED else lead_days()


def add_lead_window(
    df: DataFrame,
    windows: tuple[LeadWindow, ...] = LEAD_WINDOWS,
    mode: str = CLAMPED,
    impl: str = "case",
) -> DataFrame:
    """Add WINDOW_ID.

    ``clamped``: unknown or negative lead time counts as 0 and the last window is
    open.  ``strict``: raw difference and closed bounds, so unknown, negative and
    beyond-the-last lead times get NULL."""
    days = window_days(mode)
    if impl == "case":
        return df.withColumn("WINDOW_ID", window_case(days, windows, open_top=mode == CLAMPED))
    if impl == "lookup":
        return _by_lookup(df, days, windows, mode)
    if impl == "range":
        return _by_range(df, days, window_dim(df.sparkSession, windows), mode)
    raise ValueError(f"unknown window implementation {impl!r}")


def _by_range(df: DataFrame, days: Column, dim: DataFrame, mode: str) -> DataFrame:
    w = dim.select(F.col("ID").alias("WINDOW_ID"), F.col("FROM").alias("_from"), F.col("TO").alias("_to"))
    below = F.col("_days") <= F.col("_to")
    if mode == CLAMPED:
        below = below | F.col("_to").isNull()
    joined = df.withColumn("_days", days).join(
        F.broadcast(w), (F.col("_days") >= F.col("_from")) & below, "left"
    )
    return joined.drop("_days", "_from", "_to")


def _by_lookup(df: DataFrame, days: Column, windows: tuple[LeadWindow, ...], mode: str) -> DataFrame:
    ordered = check_windows(windows)
    top = max(w.lower if w.upper is None else w.upper for w in ordered)
    # One row per day that some window covers; the open window is its first day,
    # to which every longer lead time is cut down.
    rows = [
        (day, w.id)
        for w in ordered
        if w.upper is not None or mode == CLAMPED
        for day in range(w.lower, (w.lower if w.upper is None else w.upper) + 1)
    ]
    lookup = df.sparkSession.createDataFrame(rows, "_days int, WINDOW_ID int")
    open_top = mode == CLAMPED and ordered[-1].upper is None
    key = F.least(days, F.lit(top)) if open_top else days
    # least() skips NULLs, so an unknown strict day count must not pass through it;
    # clamped days are never NULL.
    return df.withColumn("_days", key).join(F.broadcast(lookup), "_days", "left").drop("_days")
