"""Simple-8b words, files and the token store against plain recomputation."""

import io
import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cellweave.llm import queries, simple8b, tokenstore
from cellweave.llm.common import table


def greedy(values):
    """Words of one block by the rule: most values first, each word full."""
    words, escapes, i = [], [], 0
    while i < len(values):
        for selector in range(1, 16):
            n, w = int(simple8b.COUNTS[selector]), int(simple8b.WIDTHS[selector])
            some = values[i : i + n]
            if len(some) == n and all(v < 1 << w for v in some):
                words.append(selector << 60 | sum(v << w * k for k, v in enumerate(some)))
                i += n
                break
        else:
            words.append(0)
            escapes.append(values[i])
            i += 1
    return words, escapes


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 1), st.integers(0, 70000), st.integers(0, 2**64 - 1), st.just(0)), max_size=400), st.integers(1, 12))
def test_words_follow_the_rule_and_come_back(values, times):
    values = (values * times)[:3000]
    words, sizes = simple8b.encode_blocks(np.array(values, np.uint64))
    want, counts = [], []
    for k in range(0, len(values), simple8b.BLOCK):
        a, b = greedy(values[k : k + simple8b.BLOCK])
        want += a + b
        counts.append((len(a), len(b)))
    assert words.tolist() == want and [tuple(x) for x in sizes.tolist()] == counts
    assert simple8b.decode_blocks(words, sizes).tolist() == values


def file_of(docs):
    class Stream(io.BytesIO):
        def size(self):
            return len(self.getvalue())

    s = Stream()
    w = simple8b.FileWriter(s)
    for doc, ids in docs:
        w.add(doc, ids)
    w.close()
    return s


def test_documents_of_a_file(monkeypatch):
    rng = np.random.default_rng(4)
    docs = [(None if k == 3 else k - 5, rng.integers(0, 60000, n).astype("<u4")) for k, n in enumerate([0, 1, 5, 70000, 1023, 1024, 1025, 3, 200000, 0, 17] + [40] * 3000)]
    docs.append((7, np.array([2**32 - 1, 0, 1], "<u4")))
    monkeypatch.setattr(simple8b, "CHUNK", 16)
    reader = simple8b.FileReader(file_of(docs))
    start = np.cumsum([0] + [len(x) for _, x in docs])
    assert list(reader.documents()) == [(d, int(s), x.tobytes()) for (d, x), s in zip(docs, start, strict=False)]
    whole = np.concatenate([x for _, x in docs])
    assert (reader.run(7, 9) == whole[7 * 1024 : 9 * 1024]).all()  # any block is decoded alone


def test_a_broken_file_is_an_error():
    s = file_of([(1, np.arange(9, dtype="<u4"))])
    with pytest.raises(ValueError):
        simple8b.FileReader(type(s)(s.getvalue()[:-3]))


def test_odd_rows(spark, tmp_path):
    rows = [(3, "b b", 1), (None, "x", 2), (3, "a", 3), (3, "b b", 4), (-7, None, 5), (9, "", 6), (2**40, "word " * 40000, 7), (None, None, 8)]
    df = spark.createDataFrame(rows, "doc_id long, text string, start long").withColumn("ids", F.lit("clash"))
    got = tokenstore.digest(tokenstore.store(df, queries.tokenizer_path("word_bpe_49k.json"), str(tmp_path / "s"))).orderBy("start").collect()
    assert [r.doc_id for r in got] == [None, None, -7, 3, 3, 3, 9, 2**40]
    assert [r.start for r in got] == np.cumsum([0] + [r.n_tokens for r in got])[:-1].tolist()
    assert {r.n_tokens for r in got if r.doc_id in (-7, 9)} == {1} and got[-1].n_tokens == 40001
    none = tokenstore.store(df.where("false"), queries.tokenizer_path("word_bpe_49k.json"), str(tmp_path / "none"))
    assert none.collect() == []


def test_a_task_that_ran_twice_leaves_no_trace(spark, tmp_path):
    path = str(tmp_path / "twice")
    writer = simple8b.Writer({"path": path})
    batch = pa.RecordBatch.from_arrays([pa.array([4, 5]), pa.array([b"\1\0\0\0", b"\2\0\0\0"], pa.binary())], ["doc_id", "ids"])

    class Task:
        def partitionId(self):
            return 0

    import pyspark

    before = pyspark.TaskContext.get
    pyspark.TaskContext.get = staticmethod(lambda: Task())
    try:
        writer.write([batch])  # lost
        kept = writer.write([batch])
    finally:
        pyspark.TaskContext.get = before
    writer.commit([kept])
    assert [tuple(r) for r in simple8b.read_tokens(spark, path).select("doc_id", "start").collect()] == [(4, 0), (5, 1)]


def test_ids_are_written_as_they_are(spark, tmp_path):
    rows = [(k, np.arange(k, 3 * k, dtype="<u4").tobytes()) for k in range(300)]
    simple8b.write_tokens(spark.createDataFrame(rows, "doc_id long, ids binary").repartitionByRange(3, "doc_id").sortWithinPartitions("doc_id"), str(tmp_path / "ids"))
    got = simple8b.read_tokens(spark, str(tmp_path / "ids")).orderBy("doc_id").collect()
    assert [(r.doc_id, bytes(r.ids)) for r in got] == rows and [r.start for r in got] == [k * (k - 1) for k in range(300)]


def test_query_on_documents(spark):
    from tokenizers import Tokenizer

    sf, start, want = "/root/testdata/sf0.001", 0, []
    library = Tokenizer.from_file(queries.tokenizer_path("word_bpe_49k.json"))
    library.no_truncation()
    library.no_padding()
    for doc, text in sorted(table(spark, sf, "documents", "doc_id", "text").collect()):
        ids = library.encode(text or "", add_special_tokens=False).ids + [1]
        want.append((doc, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert sorted(tuple(r) for r in queries.op12_token_files(spark, sf).collect()) == want
