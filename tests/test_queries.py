"""Every registered query gives the rows of its SQL on the smallest tables."""

import datetime
import math

import duckdb
import pytest

from cellweave import plans
from cellweave.fixtures import TABLES, with_tables
from cellweave.registry import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"
NAMES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
plans.load()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for n in NAMES:
        con.sql(f"create view {n} as select * from '{SF}/{n}.parquet'")
    return con


def plain(v):
    if v is None or isinstance(v, float) and math.isnan(v):
        return None
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None).isoformat()  # sessions are in UTC
    if isinstance(v, datetime.date):
        return f"{v.isoformat()}T00:00:00"
    return round(v, 9) if isinstance(v, float) else v.isoformat() if hasattr(v, "isoformat") else v


def rows_of(table, cols):
    return sorted((tuple(plain(x) for x in r) for r in zip(*[table[c] for c in cols], strict=True)), key=lambda r: tuple(map(str, r)))


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_gives_the_rows_of_its_sql(spark, duck, name):
    df = QUERIES[name](spark, SF)
    cols = sorted(df.columns)
    relation = duck.sql(ORACLES[name])
    assert sorted(relation.columns) == cols
    theirs = dict(zip(relation.columns, zip(*relation.fetchall()), strict=False)) or {c: [] for c in cols}
    mine = {k: v.to_pylist() for k, v in zip(df.columns, df.toArrow().columns, strict=True)}
    assert rows_of(mine, cols) == rows_of(theirs, cols)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_other_queries_give_rows(spark, name):
    assert QUERIES[name](spark, SF).count() > 0


@pytest.mark.parametrize("name", sorted(TABLES))
def test_derived_tables_are_the_same_in_both(spark, duck, name):
    from cellweave.fixtures import Tables

    df = Tables(spark, SF)(name)
    relation = duck.sql(with_tables(f"SELECT * FROM {name}", [name]))
    theirs = dict(zip(relation.columns, zip(*relation.fetchall()), strict=False))
    assert rows_of({k: v.to_pylist() for k, v in zip(df.columns, df.toArrow().columns, strict=True)}, sorted(df.columns)) == rows_of(theirs, sorted(df.columns))


def test_entry_point(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert set(ORACLES) <= set(e.oracle_sql()) <= set(e.queries())
