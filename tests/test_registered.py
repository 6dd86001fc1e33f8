"""Every registered query against its SQL twin on the smallest tables."""

import math
from datetime import datetime

import __spark_entry__ as registered
import duckdb
import pytest

SF = "/root/testdata/sf0.001"
TABLES = ["region", "nation", "customer", "supplier", "orders", "lineitem", "events"]


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return connection


def text(value):
    if isinstance(value, float) and math.isnan(value):
        return "nan"
    return value.isoformat() if isinstance(value, datetime) else repr(value)


def test_every_query_has_a_twin():
    assert set(registered.tape_queries()) == set(registered.sql_twins.oracle_sql())


@pytest.mark.parametrize("name", sorted(registered.tape_queries()))
def test_query_equals_twin(spark, duck, name):
    found = registered.queries()[name](spark, SF)
    columns = sorted(found.columns)
    twin = duck.execute(registered.oracle_sql()[name])
    order = [d[0] for d in twin.description]
    assert sorted(order) == columns
    expected = [tuple(text(row[order.index(c)]) for c in columns) for row in twin.fetchall()]
    actual = [tuple(text(v) for v in row) for row in found.select(*columns).collect()]
    assert sorted(actual) == sorted(expected)


def test_empty_histories_have_sizes(spark):
    empty = "array<struct<date timestamp, x double>>"
    report = spark.createDataFrame([([], [])], f"price_history {empty}, dividend_history {empty}")
    assert tuple(registered.history_sizes(report).first()) == (0, 0, None)


def test_entry(spark):
    assert registered.entry(spark).count() == 4
