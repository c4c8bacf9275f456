"""Exchange-rate payloads, already landed as text, to rate rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stayledger.functions.fx import first_token, pair_part, rate_number
from stayledger.schemas import EXCHANGE_RATE, conform

_PAYLOAD = "struct<Data: array<struct<currencyCode: string, cash: double, transfer: double, sell: double>>>"

# Headers of the rate table, the second of a pair being the transfer rate.
HTML_COLUMNS = {
    "Currency": "PAIR",
    "Buying Rate": "BUY_CASH",
    "Buying Rate.1": "BUY_TRANSFER",
    "Selling Rate": "SELL_CASH",
    "Selling Rate.1": "SELL_TRANSFER",
}
LAK_PAIRS = ("USD/LAK", "VND/LAK")


def explode_json(payloads: DataFrame, payload: str = "PAYLOAD") -> DataFrame:
    """One row per entry of the payload's Data list, next to the payload's other columns."""
    keep = [c for c in payloads.columns if c != payload]
    rate = F.explode(F.from_json(payload, _PAYLOAD)["Data"]).alias("r")
    return payloads.select(*keep, rate).select(
        *keep,
        F.col("r.currencyCode").alias("FROM_CURRENCY_CODE"),
        F.col("r.cash").alias("BUY_CASH"),
        F.col("r.transfer").alias("BUY_TRANSFER"),
        F.col("r.sell").alias("SELL_CASH"),
    )


def normalise_usd(rates: DataFrame) -> DataFrame:
    """US dollar rates against VND; the sell transfer rate is the sell cash rate."""
    return conform(
        rates.filter(F.col("FROM_CURRENCY_CODE") == "USD").withColumns(
            {"TO_CURRENCY_CODE": F.lit("VND"), "SELL_TRANSFER": F.col("SELL_CASH")}
        ),
        EXCHANGE_RATE,
    )


def _text(inner: Column) -> Column:
    """Visible text of a cell's markup, given without its own tags."""
    # A tag that is not closed ends with the cell's end tag.  Few cells hold tags or entities; the others are spared the replacements.
    plain = F.when(inner.contains("<"), F.regexp_replace(F.concat(inner, F.lit("</td>")), r"(?s)<[^>]*>", " ")).otherwise(inner)
    resolved = plain
    for entity, char in (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&amp;", "&")):
        resolved = F.replace(resolved, F.lit(entity), F.lit(char))
    text = F.when(inner.contains("&"), resolved).otherwise(plain)
    return F.trim(F.regexp_replace(text, r"\s+", " "))


_CELL = r"(?is)<t[hd]\b[^>]*>(.*?)</t[hd]>"


def _cells(row: Column) -> Column:
    """Cell texts of one table row, a spanning cell repeated over its columns."""

    def texts(group: int, then: Callable[[Column], Column]) -> Column:
        return F.transform(F.regexp_extract_all(row, F.lit(_CELL), F.lit(group)), then)

    def spread(cell: Column) -> Column:
        span = F.regexp_extract(cell, r"""(?is)^<t[hd]\b[^>]*\bcolspan\s*=\s*["']?(\d+)""", 1).try_cast("int")
        width = F.when(F.lower(cell).contains("colspan"), F.greatest(F.coalesce(span, F.lit(1)), F.lit(1))).otherwise(1)
        return F.array_repeat(_text(F.regexp_extract(cell, _CELL, 1)), width)

    # Few rows have a spanning cell; of the others only what the cells hold is looked at.
    return F.when(F.lower(row).contains("colspan"), F.flatten(texts(0, spread))).otherwise(texts(1, _text))


def _once(value: Column, then: Callable[[Column], Column]) -> Column:
    """``then(value)`` with the value computed once, however often ``then`` mentions it."""
    return F.get(F.transform(F.array(value), then), F.lit(0))


def _numbered(names: Column) -> Column:
    """Header names with repeats made unique: the second ``x`` is ``x.1``."""

    def one(name: Column, i: Column) -> Column:
        before = F.size(F.filter(F.slice(names, F.lit(1), i), lambda other: other == name))
        return F.when(before > 0, F.concat(name, F.lit("."), before.cast("string"))).otherwise(name)

    return F.transform(names, one)


def explode_html(pages: DataFrame, html: str = "HTML") -> DataFrame:
    """Rows of the first table of a page: CELLS under HEADER, next to the page's other columns."""
    keep = [c for c in pages.columns if c != html]
    first_table = F.regexp_extract(F.col(html), r"(?is)<table\b[^>]*>(.*?)</table>", 1)
    rows = F.regexp_extract_all(first_table, F.lit(r"(?is)<tr\b[^>]*>(.*?)</tr>"), F.lit(1))
    # The header is taken once per page; the rows are exploded as markup and each one's cells are then taken apart once: as
    # filters do not move below them, the outer explodes keep the texts from being worked out again for each filter.
    exploded = (
        pages.select(*keep, rows.alias("_rows"))
        .withColumn("HEADER", _once(_cells(F.get("_rows", F.lit(0))), _numbered))
        .select(*keep, "HEADER", F.posexplode_outer("_rows").alias("_row", "_html"))
    )
    return exploded.filter(F.col("_row") > 0).select(*keep, "HEADER", F.explode_outer(F.array(_cells(F.col("_html")))).alias("CELLS"))


def normalise_lak(rows: DataFrame, pairs: tuple[str, ...] = LAK_PAIRS) -> DataFrame:
    """Rates against LAK from exploded table rows."""
    picked = rows.select(
        "REPORT_DATE",
        "CREATED_AT",
        "MODIFIED_AT",
        *(
            F.get("CELLS", F.array_position("HEADER", name).cast("int") - 1).alias(column)
            for name, column in HTML_COLUMNS.items()
        ),
    ).filter(F.col("PAIR").isin(*pairs))
    return conform(
        picked.withColumns(
            {
                "FROM_CURRENCY_CODE": pair_part("PAIR", 1),
                "TO_CURRENCY_CODE": pair_part("PAIR", 2),
                "BUY_CASH": rate_number(first_token("BUY_CASH")),
                "BUY_TRANSFER": rate_number("BUY_TRANSFER"),
                "SELL_CASH": rate_number("SELL_CASH"),
                "SELL_TRANSFER": rate_number("SELL_TRANSFER"),
            }
        ),
        EXCHANGE_RATE,
    )
