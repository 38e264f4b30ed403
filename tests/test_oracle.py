"""Every registered query against its SQL on a second engine."""

import datetime
import decimal
import os
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as contract

SF_DIR = os.getenv("ORACLE_SF_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not Path(SF_DIR).is_dir(), reason="needs the generated tables")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for file in Path(SF_DIR).glob("*.parquet"):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM read_parquet('{file}')")
    yield con
    con.close()


def plain(value):
    if isinstance(value, decimal.Decimal):
        return f"{value:f}"
    if isinstance(value, float):
        return repr(round(value, 9))
    if isinstance(value, datetime.datetime):
        return value.isoformat(sep=" ")
    return str(value)


def rows(names, data):
    order = sorted(range(len(names)), key=names.__getitem__)
    return sorted(tuple(plain(row[i]) for i in order) for row in data)


@pytest.mark.parametrize("name", sorted(contract.oracle_sql()))
def test_query_matches_sql(spark, duck, name):
    result = contract.queries()[name](spark, SF_DIR)
    cursor = duck.execute(contract.oracle_sql()[name])
    names = [d[0] for d in cursor.description]
    expected = rows(names, cursor.fetchall())
    assert sorted(result.columns) == sorted(names)
    actual = rows(result.columns, result.collect())
    assert len(actual) == len(expected) > 0
    assert actual == expected


def test_entry(spark):
    assert contract.entry(spark).count() > 0
