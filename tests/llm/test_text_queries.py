"""Text queries that SQL can express, against their SQL on the smallest tables."""

from __future__ import annotations

from pathlib import Path

import duckdb
import pytest

from entitylog.llm import expected, queries

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


def test_sql_names_queries():
    assert set(expected.sql()) <= set(queries.QUERIES)


@pytest.mark.parametrize("name", sorted(expected.sql()))
def test_text_query(spark, duck, name):
    got = queries.QUERIES[name](spark, str(SF_DIR))
    columns = sorted(got.columns)
    sql = expected.sql()[name]
    want = duck.sql(f"select * from ({sql}) as expected")
    assert sorted(want.columns) == columns
    rows = duck.sql(f"select {', '.join(columns)} from ({sql}) as expected").fetchall()
    assert comparable(tuple(r) for r in got.select(*columns).collect()) == comparable(rows)
    assert rows
