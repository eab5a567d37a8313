"""Every registered query against its SQL."""

import duckdb
import pytest

import __spark_entry__ as entry
from conftest import SMALL

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()
QUERIES, SQL = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SMALL}/{table}.parquet'")
    return con


def _rows(frame):
    frame = frame[sorted(frame.columns)].astype(object)
    return sorted(map(tuple, frame.where(frame.notna(), None).values.tolist()), key=repr)


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_sql(spark, duck, name):
    ours, theirs = QUERIES[name](spark, SMALL).toPandas(), duck.execute(SQL[name]).df()
    assert sorted(ours.columns) == sorted(theirs.columns)
    assert _rows(ours) == _rows(theirs)
    assert len(ours) > 0


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_runs_without_sql(spark, name):
    assert QUERIES[name](spark, SMALL).count() > 0


def test_every_sql_has_a_query():
    assert set(SQL) <= set(QUERIES)


def test_entry(spark):
    assert entry.entry(spark).count() == 268
