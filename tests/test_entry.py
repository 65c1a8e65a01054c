"""Registered queries against their SQL on the smallest tables."""

import math
import re

import duckdb
import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()
# Whole-chain queries whose parts other entries already cover; the driver compares them too.
LONG = {"regions_of_records", "points_of_shared_keys", "core_point_counts", "run_counts", "incident_boxes", "incident_records", "cluster_summaries"}


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return connection


def plain(value):
    if isinstance(value, float):
        return "" if math.isnan(value) else repr(round(value, 9) + 0.0)
    return "" if value is None else str(value)


def test_names_match():
    queries, oracles = entry.queries(), entry.oracle_sql()
    assert set(oracles) <= set(queries)
    assert {n for n in set(queries) - set(oracles) if not n.startswith("op")} <= {"pipeline"}


def test_flagship_has_rows(spark):
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("name", [n for n in entry.oracle_sql() if n not in LONG and not n.startswith("op")])
def test_query_equals_sql(spark, duck, name):
    df = entry.queries()[name](spark, SF)
    columns = sorted(df.columns)
    got = sorted(tuple(plain(row[c]) for c in columns) for row in df.collect())
    cursor = duck.execute(entry.oracle_sql()[name])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == columns
    order = [names.index(c) for c in columns]
    assert got == sorted(tuple(plain(row[i]) for i in order) for row in cursor.fetchall())
