"""Every registered query against its SQL on the smallest data set."""

import datetime as dt
import math
import os

import duckdb
import pytest

import __spark_entry__ as contract
from starloom.queries import catalogue

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events".split()

QUERIES, ORACLES = catalogue.QUERIES, catalogue.ORACLES


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF_DIR}/{t}.parquet'")
    yield con
    con.close()


def cell(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v)
    if isinstance(v, dt.datetime):
        return v.isoformat()
    return str(v)


def table_rows(columns, records):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(cell(r[i]) for i in order) for r in records)


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)
    assert QUERIES.items() <= contract.queries().items() and ORACLES.items() <= contract.oracle_sql().items()
    assert set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, SF_DIR)
    assert name in ORACLES
    expected = duck.execute(ORACLES[name])
    columns = [d[0] for d in expected.description]
    assert sorted(df.columns) == sorted(columns)
    assert table_rows(df.columns, [tuple(r) for r in df.collect()]) == table_rows(columns, expected.fetchall())


def test_entry(spark):
    df = contract.entry(spark)
    assert df.columns == ["city_name", "region_name", "total_tickets", "sla_breach_rate", "avg_resolution_time"]
    assert df.count() > 0
