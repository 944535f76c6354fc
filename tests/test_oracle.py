"""Every registered query against DuckDB on the smallest data."""

import math
from decimal import Decimal

import duckdb
import pytest

import __spark_entry__ as driver
from granary import oracle, queries

QUERIES, ORACLE = queries.queries(), oracle.oracle_sql()


@pytest.fixture(scope="module")
def duck(sf_dir):
    connection = duckdb.connect()
    for name in ["nation", "customer", "part", "orders", "lineitem"]:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return connection


def plain(value):
    if isinstance(value, Decimal):
        return float(value)
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 9)
    return value


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(row[i]) for i in order) for row in rows), key=repr)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_matches_oracle(spark, duck, sf_dir, name):
    df = QUERIES[name](spark, sf_dir)
    result = duck.execute(ORACLE[name])
    columns = [column[0] for column in result.description]
    assert sorted(df.columns) == sorted(columns)
    assert canonical(df.columns, df.collect()) == canonical(columns, result.fetchall())


def test_every_query_is_checked():
    assert set(ORACLE) == set(QUERIES)
    assert set(QUERIES) <= set(driver.queries()) and set(ORACLE) <= set(driver.oracle_sql()) <= set(driver.queries())
