"""Limits of packed sequences, loss counts and odd rows."""

import random
import types
from unittest.mock import MagicMock

import pyarrow as pa
import pytest
from test_numbered_operators import LONG, TEXTS, check_packing, docs

from cellweave.llm import packing, pieces
from cellweave.llm.queries import PACKING, tokenizer_path

PATH = tokenizer_path("word_bpe_49k.json")


def test_pieces_of_a_document_keep_the_limits():
    r = random.Random(5)
    for _ in range(500):
        limits = packing.Limits(r.randint(1, 40), 4, r.randint(1, 40))
        n = r.randint(1, 200)
        loss = r.randint(0, n)
        at = 0
        for start, length, part in packing.pieces_of(n, loss, limits):
            assert start == at and 1 <= length <= limits.tokens and part <= limits.loss
            assert part == sum(k >= n - loss for k in range(start, start + length))
            at += length
        assert at == n


def test_sequences_by_brute_force():
    """Every sequence of random pieces keeps three limits, holds each id once, and no piece that waits would still fit."""
    r = random.Random(6)
    for _ in range(30):
        limits = packing.Limits(r.randint(5, 60), r.randint(1, 6), r.randint(1, 60))
        packer, todo = packing.Packer(limits), {}
        for doc in range(40):
            n = r.randint(1, limits.tokens)
            loss = r.randint(0, min(n, limits.loss))
            packer.add(doc, 0, n, loss)
            todo[doc] = (n, loss)
        seen = {doc: [] for doc in todo}
        while packer.size:
            pieces = packer.fill(limits.tokens)
            left = (limits.tokens - sum(p[2] for p in pieces), limits.segments - len(pieces), limits.loss - sum(p[3] for p in pieces))
            assert pieces and min(left) >= 0
            assert not (min(left[:2]) >= 1 and any(n <= left[0] and loss <= left[2] for n, loss in packer.kinds))
            for doc, start, n, loss in pieces:
                seen[doc].append((start, n, loss))
        for doc, (n, loss) in todo.items():
            at = 0
            for start, length, part in sorted(seen[doc]):
                assert start == at and part == sum(k >= n - loss for k in range(start, start + length))
                at += length
            assert at == n


@pytest.mark.parametrize("limits", [(0, 1, 1), (1, 0, 1), (1, 1, 0)])
def test_a_limit_under_one_is_an_error(limits):
    with pytest.raises(ValueError):
        packing.Limits(*limits)


def test_all_limits_bind_in_the_registered_query(spark):
    from cellweave.llm import queries

    rows = queries.op2_packing(spark, "/root/testdata/sf0.01").collect()
    by = {}
    for x in rows:
        by.setdefault(x.sequence_id, []).append(x)
    tokens, loss, size = ([f(s) for s in by.values()] for f in (lambda s: sum(x.length for x in s), lambda s: sum(x.loss_tokens for x in s), len))
    assert max(tokens) == PACKING.tokens and max(loss) == PACKING.loss and max(size) == PACKING.segments
    assert sum(2048 - n for n in tokens if n & (n - 1)) < 0.01 * sum(tokens)


def test_repeated_rows_null_ids_and_long_texts(spark):
    texts = ["a b c", "a b c", None, LONG]
    rows = packing.pack(docs(spark, texts, [1, 1, None, 2]).coalesce(1), PATH).collect()
    one = [x for x in rows if x.doc_id == 1]
    assert len(one) == 2 and len({x.ids_crc32 for x in one}) == 1 and [x.length for x in rows if x.doc_id is None] == [1]
    assert sum(x.length for x in rows if x.doc_id == 2) == next(x.doc_tokens for x in rows if x.doc_id == 2)
    check_packing(packing.pack(docs(spark, TEXTS), PATH).collect(), TEXTS, packing.Limits(), PATH)


def test_texts_are_encoded_some_bytes_at_a_time(monkeypatch):
    """What the encoder holds at once follows bytes of text, not rows; a longer text is taken alone."""
    seen, encode = [], pieces.PieceEncoder.encode
    monkeypatch.setattr(pieces.PieceEncoder, "encode", lambda self, texts: seen.append(texts.to_pylist()) or encode(self, texts))
    texts = ["one two three " * 40_000, *(["four five six " * 2000, None] * 100), "seven " * 500_000]
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts)), pa.int64()), pa.array(texts), pa.array([1.0] * len(texts))], ["doc_id", "text", "share"])
    out = []
    frame = types.SimpleNamespace(select=lambda *_: types.SimpleNamespace(mapInArrow=lambda run, _: out.extend(run([batch]))))
    monkeypatch.setattr(packing.F, "col", MagicMock())
    monkeypatch.setattr(packing.F, "lit", MagicMock())
    packing.pack(frame, PATH)
    assert [t for some in seen for t in some] == [t or "" for t in texts]
    assert all(sum(map(len, some)) <= packing.BYTES or len(some) == 1 for some in seen)
    rows = pa.Table.from_batches(out).to_pydict()
    whole = dict(zip(rows["doc_id"], rows["doc_tokens"], strict=True))
    want = encode(pieces.piece_encoder(PATH), pa.array([t or "" for t in texts]))
    assert whole == {k: len(ids) // 4 + 1 for k, ids in enumerate(want)}
