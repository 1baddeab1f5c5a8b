"""Every registered query against its SQL counterpart at the smallest scale."""

from __future__ import annotations

import os

import pytest

import __spark_entry__ as entry
from catalogue import binding
from catalogue import queries as catalogue_queries
from check_oracles import TABLES, rows_of

SF_DIR = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables are not here")


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    con.execute("set timezone = 'UTC'")
    for table in TABLES:
        con.execute(f"create view {table} as select * from '{SF_DIR}/{table}.parquet'")
    return con


NAMES = sorted(catalogue_queries.catalogue())


def test_every_query_has_sql():
    assert set(NAMES) <= set(entry.queries())
    assert set(NAMES) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_sql(spark, duck, name):
    df = entry.queries()[name](spark, SF_DIR)
    cursor = duck.execute(entry.oracle_sql()[name])
    want = rows_of([d[0] for d in cursor.description], cursor.fetchall())
    assert rows_of(df.columns, [tuple(r) for r in df.collect()]) == want


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_tables_are_derived_when_asked_for(spark, tmp_path):
    """A query that reads messages waits for messages only."""
    bound = binding.Tables(spark, "/root/testdata/sf0.001", str(tmp_path))
    assert bound.messages.count() == 100 and [p.name for p in tmp_path.iterdir()] == ["messages"]
    assert bound.messages is bound.messages
    assert bound.snapshots.count() > 0 and sorted(p.name for p in tmp_path.iterdir()) == ["messages", "snapshots"]
