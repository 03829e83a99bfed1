"""Toxicity on tables with few labelled rows, and rows that license scans and BPE state as odd."""

from cellweave.llm import bpe, licenses, queries, trees
from cellweave.llm.common import table

SF = "/root/testdata/sf0.001"


def test_few_toxic_rows_are_enough_to_predict(spark):
    got = queries.op6_toxicity(spark, SF).join(table(spark, SF, "labels", "doc_id", "toxic"), "doc_id").collect()
    right = sum(r.predicted == r.toxic == 1 for r in got)
    assert sum(r.predicted for r in got) == right  # no clean document
    assert right >= 0.7 * sum(r.toxic for r in got) > 5


def test_a_few_rows_make_a_leaf():
    import numpy as np

    x = np.concatenate([np.zeros((60, 1)), np.ones((4, 1))])
    y = np.concatenate([np.zeros(60), np.ones(4)])
    raw = trees.boost(x, y).raw(x)
    assert raw[:60].max() < -2 and raw[60:].min() > 0


def test_null_ids_repeated_rows_and_clashing_names(spark):
    rows = [(None, "MIT License", 1, "x"), (4, "the MIT license and the mit license", 2, "x"), (4, "the MIT license and the mit license", 2, "x"), (5, None, 3, "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_words long, labels string")
    found = sorted(((r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in licenses.scan(df.select("doc_id", "text")).collect()), key=str)
    assert found == sorted([(None, 2, 1, 0, 0, "mit"), (4, 7, 2, 1, 5, "mit"), (4, 7, 2, 1, 5, "mit"), (5, 0, 0, None, None, "")], key=str)
    digests = bpe.codec_digest(df.select("doc_id", "text"), queries.tokenizer_path("byte_bpe_50k.json")).collect()
    assert sorted((str(r.doc_id), r.n_tokens > 0) for r in digests) == [("4", True), ("4", True), ("5", False), ("None", True)]
