"""Turnover and booking-flag expressions (Column -> Column)."""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column
from pyspark.sql import functions as F

from stayledger.schemas import MONEY

SMILE_TERMS = ("ARR", "ROOM_REV", "FB_REV", "OTHER_REV")
OPERA_TERMS = ("ROOM_REVENUE", "FOOD_REVENUE", "OTHER_REVENUE")


def turnover_null_safe(*terms: str) -> Column:
    """Sum of the terms with NULL counted as 0."""
    zero = F.lit(0).cast(MONEY)
    return reduce(add, (F.coalesce(F.col(t), zero) for t in terms)).cast(MONEY)


def turnover_null_prop(*terms: str) -> Column:
    """Sum of the terms, NULL as soon as one of them is."""
    return reduce(add, (F.col(t) for t in terms)).cast(MONEY)


def booking_flag(staying: str = "STAYING", arrival: str = "ARRIVAL") -> Column:
    """1 on the arrival night, else 0 (also when a date is unknown)."""
    return F.when(F.col(staying) == F.col(arrival), 1).otherwise(0)


def booking_flag_legacy(created: str = "CREATE_DATE", arrival: str = "ARRIVAL") -> Column:
    """Superseded rule: 1 when the booking was made on the arrival day."""
    return F.when(F.col(created) == F.col(arrival), 1).otherwise(0)
