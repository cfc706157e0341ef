"""Every registered query against its SQL on DuckDB, on the same Parquet files."""

from __future__ import annotations

import math

import duckdb
import pytest

import __spark_entry__ as contract
from tallywright.plans.oracle import ORACLE as LIBRARY
from tallywright.plans.queries import registry

TABLES = (
    "region nation customer supplier part orders lineitem events "
    "documents embeddings pages benchmark labels conversations"
).split()
QUERIES = contract.queries()
ORACLE = contract.oracle_sql()


def _plain(value):
    if isinstance(value, float) and math.isnan(value):
        return "NaN"
    return value


def _sorted(rows):
    return sorted(rows, key=lambda row: tuple((v is None, str(v)) for v in row))


@pytest.fixture(scope="module")
def duck(sf_small):
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_small}/{table}.parquet'")
    return connection


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_same_rows(spark, duck, sf_small, name):
    found = QUERIES[name](spark, sf_small)
    columns = sorted(found.columns)
    rows = _sorted([tuple(_plain(r[c]) for c in columns) for r in found.collect()])
    if name not in ORACLE:
        assert rows
        return
    cursor = duck.execute(ORACLE[name])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == columns
    places = [names.index(c) for c in columns]
    expected = _sorted([tuple(_plain(r[i]) for i in places) for r in cursor.fetchall()])
    assert rows == expected


def test_every_query_of_the_library_has_sql():
    assert set(registry()) == set(LIBRARY)
    assert set(ORACLE) <= set(QUERIES)


def test_entry_is_a_report(spark):
    assert contract.entry(spark).columns == ["merchant_category", "fraud_count", "fraud_volume"]


def test_first_hits_by_rule(spark, sf_small):
    flags = QUERIES["fraud_flags"](spark, sf_small)
    hits = {r["fraud_reason"]: r["count"] for r in flags.groupBy("fraud_reason").count().collect()}
    assert (hits["outlier"], hits["night"], hits["category"]) == (36, 28, 63)
    assert sum(hits.values()) == 989
