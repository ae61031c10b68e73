"""Every registered query against its SQL in DuckDB, on the smallest tables."""

import datetime as dt
import os

import duckdb
import pytest

import __spark_entry__ as entry

FOLDER = "/root/testdata/sf0.001"
QUERIES, SQL = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for file in os.listdir(FOLDER):
        con.execute(f"CREATE VIEW {file[:-8]} AS SELECT * FROM '{FOLDER}/{file}'")
    return con


def plain(value):
    if isinstance(value, float):
        return None if value != value else round(value, 6)
    if isinstance(value, (dt.date, dt.datetime)):
        return value.isoformat()
    return value


def rows(records, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in records), key=repr)


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_sql(spark, duck, name):
    frame = QUERIES[name](spark, FOLDER)
    got = frame.collect()
    expected = duck.execute(SQL[name])
    columns = [d[0] for d in expected.description]
    assert sorted(frame.columns) == sorted(columns)
    assert rows(got, frame.columns) == rows(expected.fetchall(), columns)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_runs(spark, name):
    assert QUERIES[name](spark, FOLDER).count() > 0


def test_entry(spark):
    assert entry.entry(spark).columns == ["item_id", "neighbour", "sim", "rank"]
