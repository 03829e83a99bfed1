"""The registered queries and the pipeline on the smallest tables."""

import re

import duckdb
import pytest

import corpus_pipeline
from cellweave.llm import oracles, packing, pii, queries
from cellweave.llm.common import durable, table

SF = "/root/testdata/sf0.001"
NAMES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for n in NAMES:
        con.sql(f"create view {n} as select * from '{SF}/{n}.parquet'")
    return con


def test_one_query_for_each_operator():
    assert sorted(int(re.match(r"op(\d+)_", n)[1]) for n in queries.queries()) == list(range(1, 14))


@pytest.mark.parametrize("name", sorted(oracles.oracle_sql()))
def test_query_gives_the_rows_of_its_sql(spark, duck, name):
    df = queries.queries()[name](spark, SF)
    cols = sorted(df.columns)
    mine = sorted(tuple(map(str, r)) for r in df.select(*cols).collect())
    theirs = sorted(tuple(map(str, r)) for r in duck.sql(f"select {', '.join(cols)} from ({oracles.oracle_sql()[name]})").fetchall())
    assert mine == theirs and mine


def test_stages_keep_columns_and_take_effect(spark):
    docs = table(spark, SF, "documents")
    columns, seen = docs.columns, []
    for _, stage in corpus_pipeline.STAGES[:-1]:
        before = docs
        docs = durable(stage(spark, docs, SF))
        assert docs.columns == columns
        seen.append((before.count(), docs.count()))
    assert seen[0][0] > seen[0][1] and seen[1][0] > seen[1][1] and seen[2][0] >= seen[2][1] and seen[3][0] == seen[3][1] > 0
    assert all(not pii.base_spans(r.text or "") for r in docs.collect())
    rows = corpus_pipeline.STAGES[-1][1](spark, docs, SF).collect()
    assert {r.doc_id for r in rows} == {r.doc_id for r in docs.select("doc_id").collect()}
    assert sum(r.length for r in rows) == sum({r.doc_id: r.doc_tokens for r in rows}.values())
    assert max(r.offset + r.length for r in rows) <= packing.Limits().tokens
