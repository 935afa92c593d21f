"""Every catalogue query that has an SQL form, against DuckDB on the smallest data."""

import math

import duckdb
import pytest

import __spark_entry__ as entry_module
from conftest import DATA

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    return con


def plain(v):
    if isinstance(v, bool) or v is None:
        return str(v)
    if isinstance(v, float):
        return "None" if math.isnan(v) else repr(float(f"{v:.11g}") + 0.0)
    return str(v)


@pytest.mark.parametrize("name", sorted(entry_module.oracle_sql()))
def test_query_equals_sql(spark, duck, name):
    df = entry_module.queries()[name](spark, DATA)
    columns = sorted(df.columns)
    ours = sorted(tuple(plain(r[c]) for c in columns) for r in df.collect())
    relation = duck.sql(entry_module.oracle_sql()[name])
    order = [relation.columns.index(c) for c in columns]
    assert sorted(relation.columns) == columns
    theirs = sorted(tuple(plain(r[i]) for i in order) for r in relation.fetchall())
    assert ours == theirs


def test_every_oracle_has_a_query():
    assert set(entry_module.oracle_sql()) <= set(entry_module.queries())


def test_entry(spark):
    assert entry_module.entry(spark).count() == 4
