"""Numbered operators and stages that once did less than the whole job."""

import numpy as np
from test_numbered_operators import SCHEMA, docs

from cellweave.llm import jaccard, quality, vectors


def test_vectors_of_two_lengths_both_link(spark):
    rng = np.random.default_rng(2)
    rows = []
    for d in (8, 24):
        for _ in range(20):
            v = rng.normal(size=d)
            rows += [(len(rows) + k, (v + k * 1e-4).astype(np.float32).tolist(), 1, "x") for k in range(3)]
    got = {r.vec_id: (r.n_links, r.component_id) for r in vectors.near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == {i: (2, i - i % 3) for i in range(120)}


def test_quality_stage_keeps_all_without_labels(spark):
    none = spark.createDataFrame([], "doc_id long, quality int")
    elsewhere = spark.createDataFrame([(-5, 1), (-6, 0)], "doc_id long, quality int")
    for labels in (none, elsewhere):
        assert sorted(r.doc_id for r in quality.keep_good(docs(spark), labels).collect()) == list(range(13))
    good = spark.createDataFrame([(i, 1) for i in range(13)], "doc_id long, quality int")
    bad = good.selectExpr("doc_id", "0 as quality")
    assert quality.keep_good(docs(spark), good).count() == 13 and quality.keep_good(docs(spark), bad).count() == 0


def test_texts_that_share_an_id_are_decided_one_by_one(spark):
    a, b, c, d = ("a b c d e f g", "q w e r t y u", "z x c v b n m", "one two three four five six")
    rows = [(1, a), (4, a), (4, b), (4, b), (5, c), (5, d), (6, d), (7, b), (8, None), (8, "")]
    kept = jaccard.keep_first(docs(spark, [t for _, t in rows], [i for i, _ in rows])).collect()
    key = lambda r: (r[0], r[1] or "", r[1] is None)
    assert sorted([(r.doc_id, r.text) for r in kept], key=key) == sorted([(1, a), (4, b), (5, c), (5, d), (8, None), (8, "")], key=key)
