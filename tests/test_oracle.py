"""Every warehouse query against its SQL, run by DuckDB on the same files."""

from __future__ import annotations

import duckdb
import pytest
from conftest import SF

import __spark_entry__ as entry
from tallyward.plans.oracle import ORACLE
from tallyward.plans.warehouse import QUERIES

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()
TYPES = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
    "boolean": "BOOLEAN", "date": "DATE",
}


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES:
        con.sql(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    yield con
    con.close()


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    df = entry.queries()[name](spark, SF)
    cols = sorted(df.columns)
    sql = duck.sql(entry.oracle_sql()[name])
    assert sorted(sql.columns) == cols
    types = dict(zip(sql.columns, map(str, sql.types), strict=True))
    assert {c: TYPES[t] for c, t in df.dtypes} == types
    got = sorted((tuple(r) for r in df.select(*cols).collect()), key=repr)
    want = sorted(
        duck.sql(f"SELECT {', '.join(cols)} FROM ({entry.oracle_sql()[name]})").fetchall(),
        key=repr,
    )
    assert got == want
    assert got


def test_entry(spark):
    assert entry.entry(spark).count() > 0
