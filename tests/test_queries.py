"""Every registered query against its SQL on the smallest given tables."""

import os

import duckdb
import pytest

import __spark_entry__ as entry_points
from seriesloom.plans.catalog import QUERIES
from seriesloom.plans.delivery import DELIVERY_QUERIES

OWN = {**QUERIES, **DELIVERY_QUERIES}
SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for file in os.listdir(SF):
        con.execute(f"create view {file.split('.')[0]} as select * from '{SF}/{file}'")
    return con


def plain(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    text = lambda v: "null" if v is None else repr(v) if isinstance(v, float) else str(v)
    return sorted(tuple(text(r[i]) for i in order) for r in rows)


def test_every_query_has_sql():
    assert set(OWN) <= set(entry_points.queries()) and set(OWN) <= set(entry_points.oracle_sql())


def test_entry(spark):
    assert entry_points.entry(spark).count() > 0


@pytest.mark.parametrize("name", list(OWN))
def test_query_equals_sql(spark, db, name):
    df = entry_points.queries()[name](spark, SF)
    result = db.execute(entry_points.oracle_sql()[name])
    columns = [d[0] for d in result.description]
    assert sorted(df.columns) == sorted(columns)
    assert plain(df.columns, df.collect()) == plain(columns, result.fetchall())
