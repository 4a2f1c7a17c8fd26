"""Every registered query against its SQL in DuckDB (TEST_SCALES names the scales)."""

import os
from collections import Counter

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from hourboard.checks.queries import REGISTRY

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()
DATA = "/root/testdata"
SCALES = os.environ.get("TEST_SCALES", "sf0.01").split(",")


@pytest.fixture(scope="module", params=SCALES)
def scale(request):
    connection = duckdb.connect()
    for table in TABLES:
        path = f"{DATA}/{request.param}/{table}.parquet"
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{path}'")
    return request.param, connection


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], Counter(tuple(row[i] for i in order) for row in rows)


@pytest.mark.parametrize("name", sorted(REGISTRY))
def test_query_equals_sql(spark, scale, name):
    sf, connection = scale
    frame = queries()[name](spark, f"{DATA}/{sf}")
    cursor = connection.execute(oracle_sql()[name])
    expected = rows_of([d[0] for d in cursor.description], cursor.fetchall())
    actual = rows_of(frame.columns, [tuple(row) for row in frame.collect()])
    assert actual[0] == expected[0]
    assert actual[1] == expected[1]
    assert actual[1]


def test_every_query_has_sql():
    assert set(REGISTRY) == set(REGISTRY) & set(queries()) & set(oracle_sql())


def test_queries_leave_no_table_behind(spark, scale):
    sf, _ = scale
    before = {t.name for t in spark.catalog.listTables()}
    for name in ("empty_day_clear", "run_log", "named_params", "signage_import", "stored_log_impressions"):
        queries()[name](spark, f"{DATA}/{sf}").count()
    assert {t.name for t in spark.catalog.listTables()} == before


def test_entry(spark):
    assert entry(spark).count() == 235


@pytest.mark.parametrize("sf, day, month", [("sf0.001", 11, 235), ("sf0.01", 42, 1364)])
def test_known_sizes(spark, sf, day, month):
    assert queries()["hourly_impressions_day"](spark, f"{DATA}/{sf}").count() == day
    assert queries()["hourly_impressions"](spark, f"{DATA}/{sf}").count() == month
