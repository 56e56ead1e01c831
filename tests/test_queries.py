"""Every registered query against its expected result in DuckDB."""

import math
import os

import duckdb
import pytest
from conftest import SF_DIR

import __spark_entry__ as entry

QUERIES = entry.own_queries()
EXPECTED = entry.oracle_sql()
KINDS = {
    "int": "INTEGER",
    "bigint": "BIGINT",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
}


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for file in os.listdir(SF_DIR):
        name = file.removesuffix(".parquet")
        connection.sql(f"create view {name} as select * from '{SF_DIR}/{file}'")
    return connection


def ordered(columns, data):
    places = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(row[i] for i in places) for row in data), key=repr)


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, duck, name):
    df = QUERIES[name](spark, SF_DIR)
    found = [tuple(r) for r in df.collect()]
    expected = duck.sql(EXPECTED[name])
    kinds = dict(zip(expected.columns, map(str, expected.types)))
    assert {c: KINDS[k] for c, k in df.dtypes} == kinds
    assert ordered(df.columns, found) == ordered(expected.columns, expected.fetchall())


def test_all_queries_have_expected_results():
    assert set(QUERIES) <= set(EXPECTED) <= set(entry.queries())


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["category", "total_orders", "total_revenue", "avg_delivery_days"]
    assert df.count() == 7


def test_known_totals(spark):
    """Numbers the test tables are known to give."""
    run = lambda name: QUERIES[name](spark, SF_DIR).first()
    summary = run("dq_summary")
    assert (summary.total_rows, summary.null_customer_ids) == (9617, 468)
    assert summary.missing_shipment_rows == 1538
    assert math.isclose(run("total_revenue").total_revenue, 507_570_631.74)
    assert run("total_orders").total_orders == 1429
    assert run("dq_delivered_missing_raw").delivered_orders_missing_raw_shipment == 132


def test_zones_need_a_shared_folder(spark, monkeypatch):
    monkeypatch.setattr(entry.Zones, "_written", {})
    monkeypatch.setattr("orderlake.sources.work.shared_folder", lambda spark: None)
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        entry.Zones(spark, SF_DIR)
