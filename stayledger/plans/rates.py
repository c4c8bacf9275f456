"""Exchange-rate refresh from landed payloads."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stayledger.operators.changes import replace_keys
from stayledger.sinks.tables import Ledger
from stayledger.sources.rates import explode_html, explode_json, normalise_lak, normalise_usd

# The pairs each source is asked for.
USD_PAIRS = (("USD", "VND"),)
LAK_PAIRS = (("USD", "LAK"), ("VND", "LAK"))

RATE_KEY = ("REPORT_DATE", "FROM_CURRENCY_CODE", "TO_CURRENCY_CODE")


def usd_rates(payloads: DataFrame) -> DataFrame:
    """Landed JSON payloads (REPORT_DATE, PAYLOAD, CREATED_AT, MODIFIED_AT) to rates."""
    return normalise_usd(explode_json(payloads))


def lak_rates(pages: DataFrame) -> DataFrame:
    """Landed pages (REPORT_DATE, HTML, CREATED_AT, MODIFIED_AT) to rates."""
    return normalise_lak(explode_html(pages))


def rate_keys(days: DataFrame, pairs: tuple[tuple[str, str], ...]) -> DataFrame:
    """The source's pairs on every landed day (REPORT_DATE), whether the payload has them or not."""
    pair = F.array(*(F.struct(F.lit(a).alias("FROM_CURRENCY_CODE"), F.lit(b).alias("TO_CURRENCY_CODE")) for a, b in pairs))
    return days.select("REPORT_DATE").distinct().select("REPORT_DATE", F.inline(pair))


def replace_rates(rates: DataFrame, fresh: DataFrame, days: DataFrame, pairs: tuple[tuple[str, str], ...]) -> DataFrame:
    """The rates table with the source's pairs of the landed days replaced by the fresh rates."""
    return replace_keys(rates, rate_keys(days, pairs), fresh, RATE_KEY)


def refresh_rates(ledger: Ledger, fresh: DataFrame, days: DataFrame, pairs: tuple[tuple[str, str], ...]) -> None:
    """The same on the stored table; a pair that the payload of a day lacks ends up without a rate."""
    ledger.replace_keys("exchange_rate", rate_keys(days, pairs), fresh)
