"""Every registered query against its SQL on the smallest given tables."""

from __future__ import annotations

from pathlib import Path

import pytest

duckdb = pytest.importorskip("duckdb")

import querybook  # noqa: E402

DATA = Path("/root/testdata/sf0.001")
SQL = querybook.oracle_sql()
TYPES = {"bigint": "BIGINT", "string": "VARCHAR", "double": "DOUBLE"}

pytestmark = pytest.mark.skipif(not DATA.is_dir(), reason="the given tables are not here")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for f in DATA.glob("*.parquet"):
        con.sql(f"create view {f.stem} as select * from '{f}'")
    return con


def _sorted(rows):
    return sorted(rows, key=lambda r: tuple((x is None, str(x)) for x in r))


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_its_sql(spark, duck, name):
    df = querybook.queries()[name](spark, str(DATA))
    columns = sorted(df.columns)
    want = duck.sql(SQL[name])
    assert sorted(want.columns) == columns
    types = dict(zip(want.columns, map(str, want.types)))
    assert {c: TYPES[t] for c, t in df.dtypes} == types
    places = [want.columns.index(c) for c in columns]
    got = [tuple(r) for r in df.select(*columns).collect()]
    assert _sorted(got) == _sorted(tuple(r[i] for i in places) for r in want.fetchall())


def test_every_query_has_sql():
    assert set(querybook.queries()) == set(SQL)
