"""Every registered query against its SQL twin."""

import os

import duckdb
import pytest

import __spark_entry__ as contract
from conftest import SMALL
from weblode.oracle import ORACLE
from weblode.registered import QUERIES


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for file in os.listdir(SMALL):
        name = file.removesuffix(".parquet")
        connection.sql(f"create view {name} as select * from '{SMALL}/{file}'")
    return connection


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=columns.__getitem__)
    return [columns[i] for i in order], sorted(repr([row[i] for i in order]) for row in rows)


@pytest.mark.parametrize("name", QUERIES)
def test_query(name, spark, duck):
    df = QUERIES[name](spark, SMALL)
    got = canonical(df.columns, df.collect())
    assert got[1]
    if name in ORACLE:
        expected = duck.sql(ORACLE[name])
        assert got == canonical(expected.columns, expected.fetchall())


def test_every_query_has_a_twin():
    assert set(QUERIES) == set(ORACLE)


def test_contract_holds_them():
    assert set(QUERIES) <= set(contract.queries()) and set(ORACLE) <= set(contract.oracle_sql())


def test_entry(spark):
    df = contract.entry(spark)
    assert df.columns == ["position", "url", "pagerank"]
    assert df.count() > 0
