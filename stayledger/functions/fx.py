"""Exchange-rate text expressions (Column -> Column)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def pair_part(c: Column | str, position: int) -> Column:
    """Part 1 or 2 of a ``USD/LAK`` pair; NULL when there is none."""
    return F.try_element_at(F.split(_col(c), "/"), F.lit(position))


def first_token(c: Column | str) -> Column:
    """Text before the first blank."""
    return F.substring_index(_col(c), " ", 1)


def rate_number(c: Column | str) -> Column:
    """Rate text to a number: dots are thousands marks; digits that then start with 0 are a fraction."""
    digits = F.regexp_replace(_col(c), r"\.", "")
    text = F.when(digits.startswith("0"), F.concat(F.lit("0."), F.substr(digits, F.lit(2)))).otherwise(digits)
    return text.try_cast("double")
