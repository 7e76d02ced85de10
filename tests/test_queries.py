"""Every query of the entity log against its SQL on the smallest tables."""

from __future__ import annotations

from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry_points
from entitylog.plans import expected as statements
from entitylog.plans import tables

SF_DIR = Path("/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for path in SF_DIR.glob("*.parquet"):
        con.execute(f"create view {path.stem} as select * from '{path}'")
    yield con
    con.close()


def comparable(rows):
    flat = [tuple(round(x, 6) if isinstance(x, float) else x for x in row) for row in rows]
    return sorted(flat, key=lambda row: tuple((x is None, str(x)) for x in row))


def test_every_query_has_its_sql():
    assert set(tables.QUERIES) <= set(statements.sql())
    assert set(tables.QUERIES) <= set(entry_points.queries())
    assert set(entry_points.oracle_sql()) <= set(entry_points.queries())


def test_entry(spark):
    assert entry_points.entry(spark).columns == ["k", "o", "value"]


@pytest.mark.parametrize("name", sorted(tables.QUERIES))
def test_query(spark, duck, name):
    got = tables.QUERIES[name](spark, str(SF_DIR))
    columns = sorted(got.columns)
    sql = statements.sql()[name]
    assert sorted(duck.sql(sql).columns) == columns
    expected = duck.sql(f"select {', '.join(columns)} from ({sql}) as expected").fetchall()
    assert comparable(tuple(r) for r in got.select(*columns).collect()) == comparable(expected)
    assert expected
