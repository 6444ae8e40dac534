"""Each query with SQL gives the same rows as DuckDB on the small tables."""

import duckdb
import pytest

import __spark_entry__ as entry
from lexloom.plans import queries as plans

DATA = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"create view {t} as select * from '{DATA}/{t}.parquet'")
    return c


def plain(rows):
    return sorted((tuple(round(x, 6) + 0.0 if isinstance(x, float) else x for x in r) for r in rows), key=repr)


@pytest.mark.parametrize("name", sorted(plans.oracle_sql()))
def test_same_as_sql(spark, duck, name):
    df = plans.queries()[name](spark, DATA)
    columns = sorted(df.columns)
    result = duck.execute(plans.oracle_sql()[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == columns
    places = [names.index(c) for c in columns]
    assert plain(df.select(*columns).collect()) == plain(tuple(r[i] for i in places) for r in result.fetchall())


def test_entry_runs(spark):
    assert entry.entry(spark).limit(5).count() == 5


def test_registry():
    assert set(entry.oracle_sql()) <= set(entry.queries())
