"""Every registered query against its SQL twin, on whole tables."""

from __future__ import annotations

import glob
import os

import duckdb
import pytest

import __spark_entry__ as driver
from conftest import SF_DIR

TYPES = {
    "int": "INTEGER",
    "bigint": "BIGINT",
    "string": "VARCHAR",
    "date": "DATE",
    "timestamp_ntz": "TIMESTAMP",
    "double": "DOUBLE",
    "boolean": "BOOLEAN",
}


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for path in glob.glob(f"{SF_DIR}/*.parquet"):
        con.sql(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return con


def _sorted(rows):
    return sorted(rows, key=lambda r: [(v is None, str(v)) for v in r])


@pytest.mark.parametrize("name", sorted(driver.queries()))
def test_matches_sql(spark, duck, name):
    df = driver.queries()[name](spark, SF_DIR)
    columns = sorted(df.columns)
    got = [tuple(r) for r in df.select(*(f"`{c}`" for c in columns)).collect()]
    assert got
    sql = driver.oracle_sql().get(name)
    if sql is None:
        return
    relation = duck.sql(sql)
    assert sorted(relation.columns) == columns
    spark_types = dict(df.dtypes)
    duck_types = dict(zip(relation.columns, (str(t) for t in relation.types)))
    assert {c: TYPES.get(spark_types[c], spark_types[c].upper()) for c in columns} == duck_types
    order = [relation.columns.index(c) for c in columns]
    expected = [tuple(r[i] for i in order) for r in relation.fetchall()]
    assert _sorted(got) == _sorted(expected)


def test_entry(spark):
    df = driver.entry(spark)
    assert df.count() > 0
    assert "WINDOW_ID" in df.columns
