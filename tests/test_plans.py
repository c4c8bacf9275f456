"""Shapes of the physical plans that matter at scale."""

from __future__ import annotations

import contextlib
import io
import re
from datetime import date

import pytest
from pyspark.sql import functions as F

from booking import at, day, smile
from stayledger.operators import changes, filters
from stayledger.operators.canonical import canonical_smile
from stayledger.operators.marts import pace_report
from stayledger.session import pin_keys
from stayledger.sinks.tables import TABLES


def plan(df) -> str:
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


@pytest.fixture
def detail(spark, ledger):
    ledger.append("booking_pace_detail", filters.otb(canonical_smile(smile(spark, ("SRC", day(1), day(2), 1, at(1))))))
    return ledger.table("booking_pace_detail")


def test_report_shuffles_once_and_joins_nothing(detail):
    text = plan(pace_report(detail))
    assert len(re.findall(r"Arguments: hashpartitioning", text)) == 1
    assert "Join" not in text
    assert "partial_sum" in text


def test_report_reads_only_what_it_needs(detail):
    schema = re.search(r"ReadSchema: struct<(.*)>", plan(pace_report(detail))).group(1)
    assert "TOTAL_TURN_OVER" not in schema and "FILE_NAME" not in schema and "ROOM_REV" in schema


def test_day_filters_prune_partitions_and_property_filters_are_pushed(detail):
    chosen = filters.in_list(filters.reported_between(detail, date(2025, 8, 1), date(2025, 8, 2)), "PROPERTY", ["SRC"])
    text = plan(chosen)
    assert re.search(r"PartitionFilters: \[[^\]]*REPORT_DATE", text)
    assert re.search(r"PushedFilters: \[[^\]]*PROPERTY", text)


def test_short_key_lists_are_broadcast_and_long_ones_are_not(spark, detail):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        keys = changes.distinct_keys(detail)
        short = changes.restrict_to_keys(detail, pin_keys(keys))
        assert "BroadcastHashJoin" in plan(short)
        assert "BroadcastHashJoin" not in plan(changes.restrict_to_keys(detail, pin_keys(keys, limit=0)))
        assert short.count() == changes.restrict_to_keys(detail, pin_keys(keys, limit=0)).count() == 1
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_every_table_is_partitioned_by_its_day(spark, ledger):
    for name, spec in TABLES.items():
        described = spark.catalog.listColumns(ledger.name(name))
        assert [c.name for c in described if c.isPartition] == [spec.day]


def test_hot_property_is_grouped_by_partial_sums(spark):
    rows = spark.range(20_000).select(
        F.when(F.col("id") % 3 == 0, "HOT").otherwise(F.concat(F.lit("P"), (F.col("id") % 500).cast("string"))).alias("PROPERTY"),
        F.lit(day(1)).alias("REPORT_DATE"),
        F.lit(at(1)).alias("MODIFIED_AT"),
    )
    got = {r.PROPERTY: r for r in changes.latest_modified(rows).collect()}
    assert "HOT" in got
    assert "partial_max" in plan(changes.latest_modified(rows))
