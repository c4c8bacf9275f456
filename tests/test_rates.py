"""Rate payloads and the command line."""

from __future__ import annotations

from datetime import date
from decimal import Decimal

from conftest import rows
from stayledger.cli import parser, run

PAGE = """<html><table class="t"><thead><tr><th>Currency</th><th colspan="2">Buying Rate</th><th colspan="2">Selling Rate</th></tr></thead>
<tbody><tr><td>USD/LAK</td><td>21.600 (1-20)</td><td>21.610</td><td>21.650</td><td>21.650</td></tr>
<tr><td>VND/LAK</td><td>0.81</td><td>0.82</td><td>0.85</td><td>0.7</td></tr>
<tr><td>THB/LAK</td><td>600</td><td>601</td><td>602</td><td>603</td></tr></tbody></table></html>"""
JSON = '{"Data":[{"currencyCode":"USD","cash":26150,"transfer":26180,"sell":26540.5},{"currencyCode":"EUR","cash":1,"sell":2}]}'


def rates(ledger):
    return rows(ledger.table("exchange_rate"), "REPORT_DATE", "FROM_CURRENCY_CODE", "TO_CURRENCY_CODE", "BUY_CASH", "SELL_TRANSFER")


def test_rates_of_a_day_are_replaced_pair_by_pair(spark, ledger, tmp_path):
    (tmp_path / "usd.json").write_text(JSON)
    (tmp_path / "lak.html").write_text(PAGE)

    def load(name, currency):
        args = ["-t", "get_exchange_rate", "--database", ledger.database, "--root", str(tmp_path / name), "-d", "26072025", "--currency", currency]
        run(parser().parse_args(args), spark)

    load("usd.json", "USD")
    load("lak.html", "LAK")
    day = date(2025, 7, 26)
    expected = [
        (day, "USD", "LAK", Decimal("21600.0000"), Decimal("21650.0000")),
        (day, "USD", "VND", Decimal("26150.0000"), Decimal("26540.5000")),
        (day, "VND", "LAK", Decimal("0.8100"), Decimal("0.7000")),
    ]
    assert rates(ledger) == expected
    (tmp_path / "usd.json").write_text(JSON.replace("26150", "26160"))
    load("usd.json", "USD")
    assert rates(ledger)[1][3] == Decimal("26160.0000")
    assert len(rates(ledger)) == 3


def test_pairs_that_a_payload_lacks_are_gone(spark, ledger, tmp_path):
    path = tmp_path / "lak.html"

    def load(page):
        path.write_text(page)
        run(parser().parse_args(["-t", "get_exchange_rate", "--database", ledger.database, "--root", str(path), "-d", "26072025", "--currency", "LAK"]), spark)
        return [r[1:3] for r in rates(ledger)]

    assert load(PAGE) == [("USD", "LAK"), ("VND", "LAK")]
    assert load(PAGE.replace("VND/LAK", "VND")) == [("USD", "LAK")]
    assert load("<html>closed</html>") == []


def test_the_audit_keeps_every_line(spark, ledger):
    from booking import at, day, smile

    ledger.append("stg_smile", smile(spark, *((f"P{n}", day(2), day(2), 1, at(2)) for n in range(1_200))))
    for _ in range(2):
        run(parser().parse_args(["-t", "audit", "--as-of", "2025-08-02", "--database", ledger.database]), spark)
        assert ledger.table("audit").count() == 1_200


def test_command_line_runs_the_marts(spark, ledger):
    from booking import at, day, smile

    ledger.append("stg_smile", smile(spark, ("SRC", day(2), day(2), 4, at(2)), ("SRC", day(2), day(1), 2, at(2))))
    base = ["--database", ledger.database]
    for task in ("iload_detail", "iload_report", "audit"):
        run(parser().parse_args(["-t", task, "--as-of", "2025-08-02", *base]), spark)
    assert rows(ledger.table("booking_pace_report"), "TOTAL_ROOM") == [(4,)]
    assert rows(ledger.table("booking_pace_actual"), "TOTAL_ROOM") == [(2,)]
    run(parser().parse_args(["-t", "restore_history", "--start_date", "2025-08-01", "--end_date", "2025-08-02", *base]), spark)
    assert rows(ledger.table("booking_pace_actual"), "TOTAL_ROOM") == [(2,)]


def test_pages_are_taken_apart_once(spark):
    from stayledger.plans.rates import lak_rates

    page = PAGE.replace("21.610", "<b>21.610</b>").replace("0.82", "&nbsp;0.82 <i").replace("<td>0.85", "<TD colspan=1>\n0.85")
    pages = spark.createDataFrame([(date(2025, 7, 26), p) for p in (page, None, "", "<table></table>")], "REPORT_DATE date, HTML string")
    stamped = pages.selectExpr("*", "TIMESTAMP_NTZ'2025-07-26 09:00:00' AS CREATED_AT", "TIMESTAMP_NTZ'2025-07-26 09:00:00' AS MODIFIED_AT")
    rates = lak_rates(stamped)
    got = rows(rates, "FROM_CURRENCY_CODE", "BUY_TRANSFER", "SELL_CASH")
    assert got == [("USD", Decimal("21610.0000"), Decimal("21650.0000")), ("VND", Decimal("0.8200"), Decimal("0.8500"))]
    # No filter works a text out that the columns need anyway.
    plan = rates._jdf.queryExecution().executedPlan().toString()
    assert not [line for line in plan.splitlines() if "Filter" in line and "regexp" in line]
