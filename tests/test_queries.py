"""Every query with SQL gives the rows that DuckDB gives."""

import math
from pathlib import Path

import duckdb
import pytest

from trailmark.plans.queries import ORACLES, QUERIES


def plain(x):
    if isinstance(x, list):
        return tuple(map(plain, x))
    if isinstance(x, float):
        return "nan" if math.isnan(x) else round(x, 6) + 0.0
    return x


def rows(table, columns):
    return sorted((tuple(plain(r[c]) for c in columns) for r in table.to_pylist()), key=repr)


@pytest.fixture(scope="session")
def duck(sf):
    con = duckdb.connect()
    for f in Path(sf).glob("*.parquet"):
        con.execute(f"CREATE VIEW {f.stem} AS SELECT * FROM '{f}'")
    return con


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_against_sql(spark, duck, sf, name):
    got = QUERIES[name](spark, sf).toArrow()
    want = duck.sql(ORACLES[name]).to_arrow_table()
    assert sorted(got.column_names) == sorted(want.column_names)
    assert want.num_rows
    for c in got.column_names:
        if "list" in str(got.schema.field(c).type):
            continue
        assert str(got.schema.field(c).type).rstrip("0123456789") == str(want.schema.field(c).type).rstrip("0123456789"), (c, got.schema, want.schema)
    assert rows(got, sorted(got.column_names)) == rows(want, sorted(got.column_names))


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_without_sql(spark, sf, name):
    assert QUERIES[name](spark, sf).count()
