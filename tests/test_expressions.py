"""Edge values of the scalar expressions and of the lead windows."""

from __future__ import annotations

from datetime import date, datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from conftest import rows
from stayledger.dimensions import LEAD_WINDOWS, LeadWindow, check_windows
from stayledger.functions import dates, fx, lead, money
from stayledger.operators.canonical import with_collation
from stayledger.operators.lead_windows import add_lead_window
from stayledger.sources.cells import typed_cell


def one(spark, expr, value, kind="string"):
    return spark.createDataFrame([(value,)], f"c {kind}").select(expr(F.col("c"))).first()[0]


@pytest.mark.parametrize(
    "text, day",
    [
        ("45329", date(2024, 2, 7)),
        ("45329.75", date(2024, 2, 7)),
        ("0", date(1899, 12, 30)),
        ("x", None),
        ("NaN", None),
        (None, None),
    ],
)
def test_excel_serial(spark, text, day):
    assert one(spark, dates.excel_serial_date, text) == day


@pytest.mark.parametrize(
    "text, day",
    [("1-8-2025", date(2025, 8, 1)), ("01-08-2025", date(2025, 8, 1)), ("2025-08-01", None), ("31-02-2025", None), (None, None)],
)
def test_coerce(spark, text, day):
    assert one(spark, dates.coerce_date, text) == day


@pytest.mark.parametrize(
    "text, day",
    [
        ("01/Aug/25", date(2025, 8, 1)),
        ("01/AUG/25", date(2025, 8, 1)),
        ("29/Feb/72", date(1972, 2, 29)),
        ("31/Dec/68", date(2068, 12, 31)),
        ("01/Jan/69", date(1969, 1, 1)),
        ("01/Xxx/25", None),
    ],
)
def test_abbrev(spark, text, day):
    assert one(spark, dates.abbrev_date, text) == day


def test_abbrev_strict_raises(spark):
    with pytest.raises(Exception):
        one(spark, lambda c: dates.abbrev_date(c, strict=True), "nonsense")


def test_mixed_serial_and_timestamp_cells(spark):
    assert one(spark, dates.cell_date, "45658") == date(2025, 1, 1)
    assert one(spark, dates.cell_date, "2024-11-01 00:00:00") == date(2024, 11, 1)
    assert one(spark, dates.cell_date, "2024-01-05garbage") is None
    assert one(spark, dates.dayfirst_date, "01/02/2024 10:15") == date(2024, 2, 1)
    assert one(spark, dates.dayfirst_date, "01/02/2024 foo") is None
    assert one(spark, dates.cell_timestamp, "2025-08-18 18:52:54.328883") == datetime(2025, 8, 18, 18, 52, 54, 328883)


@pytest.mark.parametrize(
    "text, value",
    [("26.150", 26150.0), ("0.85", 0.85), ("21.650", 21650.0), ("0.7", 0.7), ("0", 0.0), ("-", None), (None, None)],
)
def test_rate_number(spark, text, value):
    assert one(spark, fx.rate_number, text) == value


def test_rate_tokens(spark):
    assert one(spark, fx.first_token, "26150 x y") == "26150"
    assert one(spark, lambda c: fx.pair_part(c, 2), "USD/LAK") == "LAK"
    assert one(spark, lambda c: fx.pair_part(c, 2), "USD") is None


@pytest.mark.parametrize("text", ["", "NA", "NaN", "null", "#N/A"])
def test_texts_for_no_value(spark, text):
    assert one(spark, lambda c: typed_cell(c, "string"), text) is None


def test_numbers_in_cells(spark):
    assert one(spark, lambda c: typed_cell(c, "int"), "2.0") == 2
    assert one(spark, lambda c: typed_cell(c, "decimal(18,2)"), "4194666.546") == Decimal("4194666.55")
    assert one(spark, lambda c: typed_cell(c, "int"), "two") is None
    assert one(spark, lambda c: typed_cell(c, "int"), "2.7") is None
    assert one(spark, lambda c: typed_cell(c, "int"), "-3.00") == -3


def test_turnover(spark):
    df = spark.createDataFrame([(Decimal("1.10"), None), (Decimal("1.10"), Decimal("2.20"))], "a decimal(18,2), b decimal(18,2)")
    got = df.select(money.turnover_null_safe("a", "b").alias("s"), money.turnover_null_prop("a", "b").alias("p"))
    assert rows(got) == rows(
        spark.createDataFrame([(Decimal("1.10"), None), (Decimal("3.30"), Decimal("3.30"))], got.schema)
    )
    assert got.schema["s"].dataType.simpleString() == "decimal(18,2)"


LEADS = [-5, -1, 0, 3, 4, 7, 8, 14, 15, 21, 22, 30, 31, 60, 61, 90, 91, 180, 181, 365, 366, 10_000, None]


def expected_window(days, mode):
    if mode == "clamped":
        days = max(days or 0, 0)
    if days is None:
        return None
    for w in LEAD_WINDOWS:
        if w.upper is None:
            return w.id if mode == "clamped" and days >= w.lower else None
        if w.lower <= days <= w.upper:
            return w.id
    return None


@pytest.mark.parametrize("mode", ["clamped", "strict"])
@pytest.mark.parametrize("impl", ["case", "lookup", "range"])
def test_window_forms_agree(spark, mode, impl):
    arrival = date(2024, 1, 1)
    data = [(d, arrival, None if d is None else arrival - timedelta(days=d)) for d in LEADS]
    df = spark.createDataFrame(data, "d int, ARRIVAL date, CREATE_DATE date")
    got = add_lead_window(df, mode=mode, impl=impl)
    assert {r.d: r.WINDOW_ID for r in got.collect()} == {d: expected_window(d, mode) for d in LEADS}
    assert got.count() == len(LEADS)


@pytest.mark.parametrize("impl", ["case", "lookup", "range"])
def test_windows_with_a_hole(spark, impl):
    windows = (LeadWindow(1, "a", 2, 3), LeadWindow(2, "b", 6, 8))
    arrival = date(2024, 1, 1)
    df = spark.createDataFrame([(d, arrival, arrival - timedelta(days=d)) for d in range(10)], "d int, ARRIVAL date, CREATE_DATE date")
    got = {r.d: r.WINDOW_ID for r in add_lead_window(df, windows, impl=impl).collect()}
    assert got == {0: None, 1: None, 2: 1, 3: 1, 4: None, 5: None, 6: 2, 7: 2, 8: 2, 9: None}


def test_overlapping_windows_are_refused():
    with pytest.raises(ValueError):
        check_windows((LeadWindow(1, "a", 0, 5), LeadWindow(2, "b", 5, 9)))
    with pytest.raises(ValueError):
        check_windows((LeadWindow(1, "a", 0, None), LeadWindow(2, "b", 5, 9)))


def test_legacy_bucket(spark):
    df = spark.createDataFrame([(d,) for d in (-3, 7, 8, 366, None)], "d int")
    got = {r.d: (r.w, r.s) for r in df.select("d", lead.legacy_bucket(F.col("d")).alias("w"), lead.legacy_bucket_sort(F.col("d")).alias("s")).collect()}
    assert got == {-3: ("1 WEEK", 1), 7: ("1 WEEK", 1), 8: ("2 WEEKS", 2), 366: ("> 12 MONTHS", 9), None: ("> 12 MONTHS", 9)}


def test_collation_groups_codes_without_case(spark):
    df = spark.createDataFrame([("BAR", 1), ("bar ", 2), ("x", 4)], "MARKET string, n int")
    got = with_collation(df, "MARKET").groupBy("MARKET").agg(F.sum("n").alias("n"))
    assert sorted(r.n for r in got.collect()) == [3, 4]
