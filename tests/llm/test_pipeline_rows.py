"""The pipeline's stages and rows against composition of the operators and plain recomputation."""

import random
import time
import zlib

import corpus_pipeline
import numpy as np
import pyarrow as pa
from test_numbered_operators import brute_components

from cellweave.llm import jaccard, pieces, pii
from cellweave.llm.common import durable, table
from cellweave.llm.queries import PACKING, queries, tokenizer_path

SF = "/root/testdata/sf0.001"


def test_each_stage_does_what_its_operator_says(spark):
    docs = table(spark, SF, "documents")
    columns, stages = docs.columns, dict(corpus_pipeline.STAGES)
    # Toxicity and quality: the rows that the registered query does not reject, as all labels are the same ones.
    toxic = {r.doc_id: r.predicted for r in queries()["op6_toxicity"](spark, SF).collect()}
    clean = durable(stages["toxicity"](spark, docs, SF))
    assert clean.columns == columns and sorted(r.doc_id for r in clean.collect()) == sorted(i for i, p in toxic.items() if not p)
    good = durable(stages["quality"](spark, clean, SF))
    assert good.columns == columns and 0 < good.count() < clean.count()
    # Near copies: of each component by brute force the smallest id.
    texts = {r.doc_id: r.text for r in good.collect()}
    parts = brute_components(texts)
    single = durable(stages["near_copies"](spark, good, SF))
    assert single.columns == columns and sorted(r.doc_id for r in single.collect()) == sorted(i for i, (_, c) in parts.items() if i == c)
    # Personal data: the texts with their spans replaced.
    model = pii.default_tagger()
    hidden = durable(stages["pii"](spark, single, SF))
    for r in hidden.collect():
        base = pii.base_spans(texts[r.doc_id] or "")
        added = pii.added_spans(texts[r.doc_id] or "", pii.tagged_spans([texts[r.doc_id] or ""], model)[0], base)
        assert r.text == (None if texts[r.doc_id] is None else pii.redacted(texts[r.doc_id], base + added))
    # Packing: all ids of all texts once, under all limits.
    final = {r.doc_id: r.text or "" for r in hidden.collect()}
    encoder = pieces.PieceEncoder(tokenizer_path("word_bpe_49k.json"))
    ids = dict(zip(final, [np.append(np.frombuffer(x, "<u4"), np.uint32(1)) for x in encoder.encode(pa.array(list(final.values())))], strict=True))
    by_doc, by_seq = {}, {}
    for r in corpus_pipeline.run(spark, SF).collect():
        by_doc.setdefault(r.doc_id, []).append(r)
        by_seq.setdefault(r.sequence_id, []).append(r)
        assert zlib.crc32(ids[r.doc_id][r.start : r.start + r.length].astype("<u4").tobytes()) == r.ids_crc32
    assert {k: sum(r.length for r in v) for k, v in by_doc.items()} == {k: len(x) for k, x in ids.items()}
    assert all(sum(r.length for r in v) <= PACKING.tokens and len(v) <= PACKING.segments and sum(r.loss_tokens for r in v) <= PACKING.loss for v in by_seq.values())


def test_odd_rows_go_through_all_stages(spark):
    labels = table(spark, SF, "labels")
    rows = table(spark, SF, "documents").limit(40).selectExpr("*", "1 as score", "text as node", "lang as grp")
    odd = spark.createDataFrame([(None, None), (7, None), (7, ""), (7, ""), (None, "words " * 9)], "doc_id long, text string")
    odd = odd.selectExpr("doc_id", "text", "cast(null as string) as lang", "cast(null as string) as source", "cast(null as bigint) as n_chars", "1 as score", "text as node", "lang as grp")
    docs = durable(rows.unionByName(odd, allowMissingColumns=True).select(*rows.columns))
    assert labels.count()
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = durable(stage(spark, docs, SF))
        assert docs.columns == rows.columns
    assert corpus_pipeline.STAGES[-1][1](spark, docs, SF).count() >= docs.select("doc_id").distinct().count() - 1
    empty = rows.limit(0)
    for _, stage in corpus_pipeline.STAGES:
        out = stage(spark, empty, SF)
        assert out.count() == 0


def test_near_copies_with_clashing_names_and_repeated_ids(spark):
    from cellweave.llm import jaccard

    text = "one two three four five six seven eight nine ten eleven twelve"
    rows = [(4, text, 1, 2, 3), (4, text + " x", 1, 2, 3), (4, "other words that stand for nothing at all here", 7, 8, 9), (2, text, 4, 5, 6), (None, text, 0, 0, 0)]
    df = spark.createDataFrame(rows, "doc_id long, text string, _node int, _node_ int, component_id int")
    kept = jaccard.keep_first(df)
    assert kept.columns == df.columns
    assert sorted(map(tuple, kept.collect()), key=str) == sorted([rows[2], rows[3], rows[4]], key=str)


def test_near_copies_leave_only_what_is_read(spark):
    import os

    from cellweave.llm import jaccard
    from cellweave.llm.common import shared_dir

    top = shared_dir(spark).removeprefix("file://")
    before = set(os.listdir(top))
    docs = [(k, f"word{k % 7} " + " ".join(f"t{j + k % 5}" for j in range(40))) for k in range(200)]
    found = jaccard.link_classes(spark.createDataFrame(docs, "doc_id long, text string"))
    left = set(os.listdir(top)) - before
    assert len(left) <= 4 and found.count() == 200  # rows, reach, and the last rounds of the components


def test_near_copies_shuffle_only_texts_that_may_go(spark):
    r = random.Random(5)
    rows = [(i, " ".join("%02000x" % r.getrandbits(8000) for _ in range(10))) for i in range(0, 600, 2)]
    copies = [(i + 1, text) for i, text in rows[:20]]
    df = durable(spark.createDataFrame(rows + copies, "doc_id long, text string"))
    name, shuffled = "spark.sql.autoBroadcastJoinThreshold", lambda: spark.sparkContext._jsc.sc().statusStore().executorSummary("driver").totalShuffleWrite()
    before = spark.conf.get(name)
    spark.conf.set(name, "-1")
    try:
        time.sleep(1)
        began = shuffled()
        kept = jaccard.keep_first(df).collect()
        time.sleep(1)
        written = shuffled() - began
    finally:
        spark.conf.set(name, before)
    assert sorted((x.doc_id, x.text) for x in kept) == rows
    assert written < sum(len(t) for _, t in rows) / 4  # texts are random, so that they do not get much smaller


def test_rows_without_those_gone_at_odd_keys_and_a_full_table(spark):
    r = random.Random(6)
    keys = sorted({r.choice([r.randrange(-50, 500), r.getrandbits(64) - 2**63, r.randrange(2**30) << 33 | r.randrange(9)]) for _ in range(900)} | {-(2**63), 2**63 - 1, 0})
    gone = set(r.sample(keys, 300)) | {keys[0], keys[-1]}
    rows = spark.createDataFrame([(k, f"t{k}", k % 7) for k in keys], "_bits long, _word string, word int")
    for bits in (64, 1 << 24):
        kept = jaccard.without(rows, "_bits", spark.createDataFrame([(k,) for k in gone], "k long"), jaccard.Plan(bits=bits))
        assert kept.columns == rows.columns
        assert sorted(map(tuple, kept.collect())) == [(k, f"t{k}", k % 7) for k in keys if k not in gone]
