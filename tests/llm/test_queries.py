"""Registered queries: columns, and their SQL on the small tables."""

import os

import duckdb
import pytest

from conftest import SMALL
from weblode.llm.registered import ORACLE, QUERIES


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=columns.__getitem__)
    return [columns[i] for i in order], sorted(repr([row[i] for i in order]) for row in rows)


def test_one_query_of_each_operator():
    assert sorted(n.split("_")[0] for n in QUERIES) == sorted(["pipeline", *(f"op{k}" for k in range(1, 14))])


@pytest.mark.parametrize("name", ORACLE)
def test_sql(name, spark):
    duck = duckdb.connect()
    for file in os.listdir(SMALL):
        duck.sql(f"create view {file.removesuffix('.parquet')} as select * from '{SMALL}/{file}'")
    df = QUERIES[name](spark, SMALL)
    expected = duck.sql(ORACLE[name])
    assert canonical(df.columns, df.collect()) == canonical(expected.columns, expected.fetchall())
