"""Registered queries over whole tables against plain recomputation."""

import hashlib
import math
import zlib

import numpy as np
import pandas as pd
import pytest

from cellweave.llm import quality, sharding, toxicity, trees
from cellweave.llm.queries import queries, tokenizer_path

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def documents():
    return pd.read_parquet(f"{SF}/documents.parquet")


def labels(name, of, at):
    t = pd.read_parquet(f"{SF}/labels.parquet").dropna(subset=[name])
    return {i: int(y) for i, y in zip(t.doc_id, t[name], strict=True) if zlib.crc32(str(i).encode()) % of != at}


def test_sharding_by_a_plain_feistel_network(spark, documents):
    got = {r.doc_id: r for r in queries()["op3_sharding"](spark, SF).collect()}
    rows = sorted((i, zlib.crc32((t or "").encode()), len((t or "").encode()) + 1) for i, t in zip(documents.doc_id, documents.text, strict=True))
    n, key = len(rows), 20240501
    half = max(1, ((max(n, 2) - 1).bit_length() + 1) // 2)
    for number, (i, crc, size) in enumerate(rows):
        x = number
        while True:
            left, right = x >> half, x & ((1 << half) - 1)
            for k, m in enumerate(sharding.MULTIPLIERS):
                mixed = ((right ^ (key >> (8 * k) & 0xFFFF)) * m + (key & 0x7FFFFFFF)) & 0x7FFFFFFF
                left, right = right, left ^ ((mixed ^ mixed >> 15) & ((1 << half) - 1))
            x = left << half | right
            if x < n:
                break
        r = got[i]
        assert (r.shard, r.slot, r.text_crc32, r.size, r.law, r.grown_shard) == (x % 8, x // 8, crc, size, "rows", None)


def test_quality_scores_by_the_formula_of_the_density(spark, documents):
    got = {r.doc_id: r for r in queries()["op5_quality"](spark, SF).collect()}
    x = {i: np.array(quality.statistics(t or "")) for i, t in zip(documents.doc_id, documents.text, strict=True)}
    known = labels("quality", 4, 2)
    rows = {k: np.stack([x[i] for i, y in known.items() if y == k and i in x]) for k in (0, 1)}
    total, d = sum(map(len, rows.values())), len(quality.NAMES)
    cov = {k: np.cov(r.T, bias=True) for k, r in rows.items()}
    pooled = sum(cov[k] * len(rows[k]) for k in rows) / total
    for i, v in x.items():
        log = {}
        for k, r in rows.items():
            a = min(1.0, 0.3 + d / (len(r) + d))
            c = 0.99 * ((1 - a) * cov[k] + a * pooled) + 0.01 * np.trace(pooled) / d * np.eye(d)
            log[k] = math.log(len(r) / total) - 0.5 * np.linalg.slogdet(c)[1] - 0.5 * (v - r.mean(0)) @ np.linalg.inv(c) @ (v - r.mean(0))
        want = 1 / (1 + math.exp(-max(-500.0, min(500.0, log[1] - log[0]))))
        assert abs(got[i].score - want) < 1e-6 and got[i].predicted == int(got[i].score >= 0.7) and got[i].held_out == (zlib.crc32(str(i).encode()) % 4 == 2)


def test_toxicity_scores_by_walking_each_tree(spark, documents):
    got = {r.doc_id: r for r in queries()["op6_toxicity"](spark, SF).collect()}
    model = toxicity.fit(spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet"), 5, 0, toxicity.BOUND, "doc_id", "text", "toxic")
    features, inner = model.features(), model.trees.feature.shape[1]
    at, fit = model.knots
    for i, t in zip(documents.doc_id, documents.text, strict=True):
        x, raw = features.of(t or ""), model.trees.start
        for f, cut, leaf in zip(model.trees.feature, model.trees.cut, model.trees.leaf, strict=True):
            node = 0
            while node < inner:
                node = 2 * node + (2 if x[f[node]] > cut[node] else 1)
            raw += leaf[node - inner]
        k = int(np.searchsorted(at, raw))
        want = fit[0] if k == 0 else fit[-1] if k == len(at) else fit[k - 1] + (fit[k] - fit[k - 1]) * (raw - at[k - 1]) / (at[k] - at[k - 1])
        assert abs(got[i].score - want) < 1e-9 and got[i].predicted == int(got[i].score >= 0.5)


def test_isotonic_fit_is_the_best_nondecreasing_one():
    rng = np.random.default_rng(2)
    raw, y = rng.normal(size=60), (rng.random(60) < 0.4).astype(float)
    at, fit = trees.isotonic(raw, y)
    assert (np.diff(fit) >= 0).all() and (np.diff(at) > 0).all()
    y = y[np.argsort(raw)]
    # The fit at a row is the largest over starts of the smallest over ends of the mean between.
    best = [max(min(y[a : b + 1].mean() for b in range(k, 60)) for a in range(k + 1)) for k in range(60)]
    pools = np.split(np.arange(60), np.flatnonzero(np.diff(best) > 1e-12) + 1)
    want = [(y[p].sum() + 0.5) / (len(p) + 1) for p in pools]
    assert len(want) == len(fit) and np.allclose(np.maximum.accumulate(want), fit)


def test_bpe_query_is_the_library(spark, documents):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(tokenizer_path("byte_bpe_50k.json"))
    library.no_truncation()
    library.no_padding()
    got = {r.doc_id: r for r in queries()["op9_bpe"](spark, SF).collect()}
    for i, t in zip(documents.doc_id, documents.text, strict=True):
        ids = library.encode(t or "", add_special_tokens=False).ids
        text = library.decode(ids, skip_special_tokens=False)
        assert (got[i].n_tokens, got[i].ids_sha256, got[i].decoded_sha256) == (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(text.encode()).hexdigest())


def test_personal_data_query_holds_every_base_span(spark):
    from test_numbered_operators import base_by_regex

    larger = SF.replace("0.001", "0.01")
    documents = pd.read_parquet(f"{larger}/documents.parquet")
    got = {r.doc_id: r for r in queries()["op8_pii"](spark, larger).collect()}
    more = 0
    for i, t in zip(documents.doc_id, documents.text, strict=True):
        base = [f"{k}:{a}:{b}" for k, a, b in base_by_regex(t or "")]
        assert got[i].base_sha256 == hashlib.sha256(",".join(base).encode()).hexdigest()
        spans = got[i].spans.split(",") if got[i].spans else []
        assert set(base) <= set(spans)
        more += len(spans) - len(base)
    assert more > 0  # secrets, and numbers that a longer failing match hid from the patterns
