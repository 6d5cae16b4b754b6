"""Every registered query against its SQL oracle on the smallest data."""

import os

import duckdb
import pytest

import __spark_entry__ as entry_module
from check import rows

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def con():
    db = duckdb.connect()
    for name in os.listdir(SF):
        db.execute(f"CREATE VIEW {name[:-8]} AS SELECT * FROM '{SF}/{name}'")
    return db


def test_entry(spark):
    df = entry_module.entry(spark)
    assert df.count() == 10 and "health" in df.columns


def test_every_oracle_has_a_query():
    assert set(entry_module.oracle_sql()) <= set(entry_module.queries())


@pytest.mark.parametrize("name", sorted(entry_module.queries()))
def test_query(spark, con, name):
    df = entry_module.queries()[name](spark, SF)
    got = rows(df.columns, [tuple(r) for r in df.collect()])
    sql = entry_module.oracle_sql().get(name)
    if sql is None:
        assert got
        return
    rel = con.execute(sql)
    cols = [d[0] for d in rel.description]
    assert sorted(cols) == sorted(df.columns)
    assert got == rows(cols, rel.fetchall())
