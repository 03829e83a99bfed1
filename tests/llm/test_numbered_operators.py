"""The numbered operators on small tables, against plain recomputation."""

import hashlib
import random
import re
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from cellweave.llm import bpe, common, jaccard, licenses, packing, pieces, pii, quality, sharding, tagger, toxicity, trees, vectors
from cellweave.llm.queries import tokenizer_path

DOC = "doc_id long, text string, lang string, predicted int, score double, x string, n long"
LONG = "lorem ipsum dolor " * 20_000
TEXTS = [
    None, "", " ", "one", "MIT License\n", "Released under the MIT License. See the Apache License, Version 2.0", "mit\nlicense mit license",
    "GNU General  Public-License", LONG, "write to a.b@example.com or +1 (555) 010-9999", "same words here for all of us", "same words here for all of us", "日本語 é 🎉 <|endoftext|> x",
]


def docs(spark, texts=TEXTS, ids=None):
    """With columns whose names the operators use themselves."""
    ids = ids or range(len(texts))
    return spark.createDataFrame([(i, t, "en", 7, 0.5, "x", 3) for i, t in zip(ids, texts, strict=True)], DOC)


def near_copies(r: random.Random, n: int, families: int) -> list[str]:
    words = ["w%d" % k for k in range(400)]
    bases = [[r.choice(words) for _ in range(r.randint(8, 60))] for _ in range(families)]
    out = []
    for _ in range(n):
        t = list(r.choice(bases))
        for _ in range(r.choice([0, 0, 1, 2, 5])):
            t[r.randrange(len(t))] = r.choice(words)
        out.append(" ".join(t))
    return out


def brute_components(texts: dict[int, str | None], percent=75) -> dict[int, tuple[int, int]]:
    sets = {}
    for i, t in texts.items():
        w = (t or "").encode().lower().split()
        sets[i] = {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())
    low = {i: i for i in sets}

    def find(x):
        while low[x] != x:
            x = low[x]
        return x

    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                low[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i)) for i in sets}


def test_components_of_a_path_and_a_star(spark):
    path = [(k, k + 1) for k in range(30)] + [(100, k) for k in range(101, 140)] + [(5, 5), (None, 3)]
    got = {r.node: r.component for r in common.components(spark.createDataFrame(path, "a long, b long")).collect()}
    assert got == {k: 0 for k in range(31)} | {k: 100 for k in range(100, 140)}
    assert common.components(spark.createDataFrame([], "a long, b long")).count() == 0


# op1


def base_scan(text):
    low = (text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
    found = [(i, label) for phrase, label in (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl")) for i in range(len(words)) if words[i : i + len(phrase.split())] == phrase.split()]
    starts = [i for i, _ in found]
    return len(words), len(found), min(starts, default=None), max(starts, default=None), ",".join(sorted({x for _, x in found}))


def test_license_scan_base_and_own_labels(spark):
    notice = "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"
    texts = [*TEXTS, notice, "gnu lesser general public license", "MİT LİCENSE mit licenſe", "license mit license apache", "x" * 50_000 + " mit license"]
    rows = {r.doc_id: r for r in licenses.scan(docs(spark, texts)).collect()}
    for i, t in enumerate(texts):
        r = rows[i]
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == base_scan(t)
        assert set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(",")) and 0 <= r.score <= 1
    assert rows[len(TEXTS)].labels == "mit-text" and rows[len(TEXTS)].score == 1
    assert rows[len(TEXTS) + 1].labels == "gpl,lgpl"
    assert "apache-2.0" in rows[5].labels
    assert licenses.scan(docs(spark, [])).count() == 0


# op2


def check_packing(rows, texts, limits, path):
    ids = [x + (1).to_bytes(4, "little") for x in pieces.PieceEncoder(path).encode(pa.array([t or "" for t in texts]))]
    by_doc, by_seq = {}, {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_seq.setdefault(r.sequence_id, []).append(r)
    assert set(by_doc) == set(range(len(texts)))
    for d, rs in by_doc.items():
        rs.sort(key=lambda r: r.start)
        assert [r.start for r in rs] == [sum(x.length for x in rs[:k]) for k in range(len(rs))] and sum(r.length for r in rs) == len(ids[d]) // 4
        assert all(r.ids_crc32 == zlib.crc32(ids[d][4 * r.start : 4 * (r.start + r.length)]) and r.doc_tokens == len(ids[d]) // 4 for r in rs)
    for rs in by_seq.values():
        rs.sort(key=lambda r: r.offset)
        assert [r.offset for r in rs] == [sum(x.length for x in rs[:k]) for k in range(len(rs))]
        assert sum(r.length for r in rs) <= limits.tokens and len(rs) <= limits.segments and sum(r.loss_tokens for r in rs) <= limits.loss
    return by_seq


def test_packing_keeps_all_limits_and_ids(spark):
    path = tokenizer_path("word_bpe_49k.json")
    r = random.Random(3)
    texts = [*TEXTS, *[" ".join(r.choice(["alpha", "beta", "x1"]) for _ in range(r.randint(0, 900))) for _ in range(200)]]
    by_seq = check_packing(packing.pack(docs(spark, texts).coalesce(1), path).collect(), texts, packing.Limits(), path)
    sizes = [sum(x.length for x in rs) for rs in by_seq.values()]
    assert sum(2048 - n for n in sizes if n & (n - 1)) == 0
    tight = packing.Limits(tokens=64, segments=3, loss=40)
    shares = docs(spark, texts).withColumn("share", F.when(F.col("doc_id") % 3 == 0, None).otherwise(F.col("doc_id") % 5 / 4.0))
    check_packing(packing.pack(shares, path, limits=tight, loss_share_col="share").collect(), texts, tight, path)
    assert packing.pack(docs(spark, []), path).count() == 0


def test_piece_encoder_is_the_library():
    from tokenizers import Tokenizer

    path = tokenizer_path("word_bpe_49k.json")
    r = random.Random(5)
    texts = ["".join(r.choice("aBéÉ ÜÍ'İ \n\t's1.!\x1c\xa0") for _ in range(r.randrange(30))) for _ in range(3000)] + ["a <|endoftext|> b"]
    want = [e.ids for e in Tokenizer.from_file(path).encode_batch(texts, add_special_tokens=False)]
    assert [np.frombuffer(x, "<u4").tolist() for x in pieces.PieceEncoder(path).encode(pa.array(texts))] == want


# op3


@pytest.mark.parametrize("size", [1, 2, 3, 7, 100, 4096, 5000])
def test_feistel_is_a_permutation(size):
    assert sorted(sharding.feistel(np.arange(size), size, 77).tolist()) == list(range(size))


def test_shards_are_even_gapless_and_reproducible(spark):
    df = docs(spark, [f"t{k % 9}" for k in range(500)], [*range(498), None, 3])
    narrow = df.select("doc_id", sharding.size_of(F.col("text")).alias("size"), sharding.text_crc(F.col("text")).alias("text_crc32"), "lang")
    a, n = sharding.shuffled_shards(narrow, 8, 5, "doc_id", "text_crc32", "size")
    b, _ = sharding.shuffled_shards(narrow.repartition(7), 8, 5, "doc_id", "text_crc32", "size")
    key = lambda x: sorted((-1 if r.doc_id is None else r.doc_id, r.text_crc32, r.shard, r.slot) for r in x.collect())
    assert n == 500 and key(a) == key(b)
    by = {}
    for r in a.collect():
        by.setdefault(r.shard, []).append(r.slot)
        order = r.row_number
        assert sharding.feistel(np.array([order]), n, 5)[0] == r.place
    assert all(sorted(s) == list(range(len(s))) for s in by.values()) and max(map(len, by.values())) - min(map(len, by.values())) <= 1
    assert sharding.shuffled_shards(narrow.limit(0), 8, 5, "doc_id")[0].count() == 0


# op4


def test_jaccard_components_are_those_of_brute_force(spark):
    texts = [*TEXTS, *near_copies(random.Random(1), 220, 9), "a b c d", "A B C D", "a b c", "\x0ba\tb c d\n", "é É é É é", "É É é É é"]
    rows = jaccard.link_classes(docs(spark, texts)).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in rows} == brute_components(dict(enumerate(texts)))


def test_jaccard_small_matrices_and_chains_lose_no_link(spark):
    words = ["w%d" % k for k in range(300)]
    chain = [" ".join(words[k : k + 60]) for k in range(0, 160, 5)]  # each links with its neighbours only
    texts = chain + near_copies(random.Random(8), 120, 2)
    plan = jaccard.Plan(members=4, queries=3)
    rows = jaccard.link_classes(docs(spark, texts).repartition(3), plan).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in rows} == brute_components(dict(enumerate(texts)))


def test_jaccard_odd_rows(spark):
    rows = jaccard.link_classes(docs(spark, ["a b c d e f", "a b c d e f", None, "a b c d e f"], [4, 4, 1, None])).collect()
    assert sorted((-1 if r.doc_id is None else r.doc_id, r.n_shingles, r.component_id) for r in rows if r.doc_id is not None) == [(1, 0, 1), (4, 2, 4), (4, 2, 4)]
    assert [r.component_id for r in rows if r.doc_id is None] == [None]
    assert jaccard.link_classes(docs(spark, [])).count() == 0
    kept = jaccard.keep_first(docs(spark, ["a b c d e f", "a b c d e f", None, "q w e r t y"], [4, 4, 1, None]))
    assert kept.columns == docs(spark, []).columns and sorted(-1 if r.doc_id is None else r.doc_id for r in kept.collect()) == [-1, 1, 4]


# op5


def labelled(n=400):
    r = random.Random(2)
    texts, good = [], []
    for k in range(n):
        w = [r.choice(["tion", "and", "the", "house", "stream", "of"]) for _ in range(r.randint(20, 120))]
        good.append(int(k % 4 != 0))
        texts.append(" ".join(w) + "." if good[-1] else r.choice([" | ".join(w), "%% ".join(w), (w[0] + " ") * 80, "!! ".join(w).upper()]))
    return texts, good


def test_quality_on_held_out_rows(spark):
    texts, good = labelled()
    labels = spark.createDataFrame([(i, y) for i, y in enumerate(good)] + [(None, 1), (3, None)], "doc_id long, quality int")
    rows = quality.score(docs(spark, texts), labels).collect()
    held = [r for r in rows if r.held_out]
    assert {r.doc_id for r in held} == {i for i in range(len(texts)) if zlib.crc32(str(i).encode()) % 4 == 2}
    assert np.mean([r.predicted == good[r.doc_id] for r in held]) > 0.97
    kept = quality.keep_good(docs(spark, texts), labels)
    assert kept.columns == docs(spark, []).columns and {r.doc_id for r in kept.collect()} == {r.doc_id for r in rows if r.predicted}


def test_quality_without_labels_or_rows(spark):
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert {r.score for r in quality.score(docs(spark), none).collect()} == {0.5}
    one = spark.createDataFrame([(i, 1) for i in range(8)], "doc_id long, quality int")
    assert {r.predicted for r in quality.score(docs(spark), one).collect()} == {1}
    assert quality.score(docs(spark, []), none).count() == 0
    assert len(quality.statistics("")) == len(quality.statistics(LONG)) == len(quality.NAMES)


# op6


def test_boosted_trees_and_isotonic_fit():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(2000, 4))
    y = ((x[:, 0] > 0.3) ^ (x[:, 1] > 0)).astype(float)
    model = trees.boost(x[:1500], y[:1500])
    raw = model.raw(x[1500:])
    assert ((raw > 0) == y[1500:]).mean() > 0.95
    at, fit = trees.isotonic(raw, y[1500:])
    assert (np.diff(at) > 0).all() and (np.diff(fit) >= 0).all() and 0 < fit.min() and fit.max() < 1


def test_toxicity_on_held_out_rows(spark):
    r = random.Random(6)
    texts, bad = [], []
    for k in range(600):
        w = [r.choice(["tion", "and", "the", "house", "stream", "of"]) for _ in range(r.randint(20, 120))]
        bad.append(int(k % 6 == 0))
        for _ in range(3 * bad[-1]):
            w.insert(r.randrange(len(w)), r.choice(["grubling", "snerk", "idiot", "grublings"]))
        texts.append(" ".join(w))
    labels = spark.createDataFrame(list(enumerate(bad)), "doc_id long, toxic int")
    rows = toxicity.score(docs(spark, texts), labels).collect()
    held = [x for x in rows if x.held_out]
    assert {x.doc_id for x in held} == {i for i in range(len(texts)) if zlib.crc32(str(i).encode()) % 5 == 0}
    assert np.mean([x.predicted == bad[x.doc_id] for x in held]) > 0.97 and all(0 <= x.score <= 1 for x in rows)
    few = toxicity.score(docs(spark, texts), labels, bound=200).collect()
    assert np.mean([x.predicted == bad[x.doc_id] for x in few]) > 0.95
    kept = toxicity.keep_clean(docs(spark, texts), labels)
    assert kept.columns == docs(spark, []).columns and {x.doc_id for x in kept.collect()} == {x.doc_id for x in rows if not x.predicted}


def test_toxicity_without_labels_or_rows(spark):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert {r.predicted for r in toxicity.score(docs(spark), none).collect()} == {0}
    assert toxicity.score(docs(spark, []), none).count() == 0


# op7 and op10


def vector_rows(seed=4, n=240, d=24):
    rng = np.random.default_rng(seed)
    centers = rng.normal(size=(30, d))
    rows = []
    for k in range(n):
        c = k % 30
        v = centers[c] + rng.normal(size=d) * rng.choice([0, 0.02, 0.03, 0.2]) * (k >= 30)
        rows.append((k, v.astype(np.float32).astype(float).tolist(), c % 3 if k % 11 else None, "x"))
    rows += [(n, None, 1, "x"), (n + 1, [0.0] * d, 1, "x"), (n + 2, [float("nan")] + [1.0] * (d - 1), 1, "x"), (n + 3, [None] + [1.0] * (d - 1), 1, "x"), (n + 4, [], 1, "x"), (n + 5, [1.0, 2.0], 1, "x"), (n + 6, [float("inf")] * d, 1, "x")]
    return rows


SCHEMA = "vec_id long, embedding array<float>, label int, p string"


def test_near_duplicate_vectors_are_those_of_brute_force(spark):
    rows = vector_rows()
    got = {r.vec_id: r for r in vectors.near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect()}
    good = [(i, np.array(v, np.float32).astype(float), g) for i, v, g, _ in rows if v and None not in v and np.isfinite(v).all() and any(v) and g is not None]
    links = {i: set() for i, *_ in rows}
    for i, v, g in good:
        for j, w, h in good:
            if i != j and g == h and len(v) == len(w) and v @ w / (np.sqrt(v @ v) * np.sqrt(w @ w)) >= 0.98:
                links[i].add(j)
    for i in links:
        seen, todo = {i}, [i]
        while todo:
            for j in links[todo.pop()] - seen:
                seen.add(j)
                todo.append(j)
        assert (got[i].n_links, got[i].component_id, got[i].kept) == (len(links[i]), min(seen), min(seen) == i)
    assert vectors.near_duplicates(spark.createDataFrame([], SCHEMA)).count() == 0


def test_hadamard_keeps_lengths():
    x = np.random.default_rng(1).normal(size=(5, 16))
    assert np.allclose((vectors.hadamard(x) ** 2).sum(1), 16 * (x**2).sum(1)) and np.allclose(vectors.hadamard(vectors.hadamard(x)), 16 * x)


def test_nearest_recall_scores_and_ties(spark):
    rng = np.random.default_rng(9)
    rows = [(k, v.tolist(), 0, "x") for k, v in enumerate(rng.normal(size=(1500, 16)).astype(np.float32).astype(float))]
    rows += [(1500 + k, rows[7][1], 0, "x") for k in range(30)] + vector_rows(n=0)
    df = spark.createDataFrame(rows, SCHEMA)
    plan = vectors.Aq(block=300, queries=40)
    got = vectors.nearest(df, df.where("vec_id % 20 = 0"), plan=plan).toPandas()
    good = [(i, np.array(v, np.float32).astype(float)) for i, v, *_ in rows if v and len(v) == 16]
    ids, x = np.array([i for i, _ in good]), np.stack([v for _, v in good])
    hit = total = 0
    for q, w in good:
        if q % 20 == 0:
            s = x @ w
            order = [k for k in np.lexsort((ids, -s)) if ids[k] != q][:20]
            mine = got[got.query_id == q].sort_values("rank")
            assert mine["rank"].tolist() == list(range(1, 21)) and mine.score.is_monotonic_decreasing
            exact = dict(zip(ids.tolist(), s.tolist(), strict=True))
            assert np.allclose(mine.score, [exact[i] for i in mine.vec_id], rtol=1e-12)
            hit += len(set(ids[order].tolist()) & set(mine.vec_id))
            total += 20
    assert hit / total >= 0.9 and got.query_id.nunique() * 20 == len(got)
    assert vectors.nearest(df.limit(0), df.limit(0)).count() == 0
    few = vectors.nearest(df.where("vec_id < 5"), df.where("vec_id = 0"))
    assert few.count() == 4


# op8


def base_by_regex(t):
    kinds = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}

    def sound(k, s):
        d = [int(c) for c in s if c in "0123456789"]
        if k == "ip":
            return all(int(p) <= 255 for p in s.split("."))
        if k == "card":
            return 13 <= len(d) <= 19 and sum(x if j % 2 == 0 else (2 * x - 9 if 2 * x > 9 else 2 * x) for j, x in enumerate(reversed(d))) % 10 == 0
        return k != "phone" or 9 <= len(d) <= 15

    return [(k, m.start(), m.end()) for k, p in kinds.items() for m in re.finditer(p, t) if sound(k, m[0])]


def test_base_spans_are_those_of_the_patterns():
    r = random.Random(0)
    texts = ["".join(r.choice("0123456789012 -.()+@ab.c@\n%_é") for _ in range(r.randrange(70))) for _ in range(20_000)]
    texts += ["4111 1111 1111 1111", "1.2.3.4.5.6.7.8", "a@b", "a@b.c@d.e", "+123 456 789 0123 456 789 000", "001.002.003.004"]
    assert all(pii.base_spans(t) == base_by_regex(t) for t in texts)


def test_long_texts_take_linear_time():
    for t in ("a" * 300_000 + "@", "1" * 300_000, "+1" * 150_000, "a@" * 150_000, "1." * 150_000):
        pii.base_spans(t)


def test_pii_rows_and_redaction(spark):
    texts = [*TEXTS, "call (555) 123-4567 now", "user [at] example.com", "ip 10.0.0.1 card 4111-1111-1111-1111", "clean text 2024-01-02 1.2.3"]
    rows = {r.doc_id: r for r in pii.find(docs(spark, texts)).collect()}
    for i, t in enumerate(texts):
        base = base_by_regex(t or "")
        assert [rows[i].n_email, rows[i].n_ip, rows[i].n_card, rows[i].n_phone] == [sum(b[0] == k for b in base) for k in tagger.KINDS[:4]]
        assert rows[i].base == ",".join(f"{k}:{a}:{b}" for k, a, b in base)
        assert {x for x in rows[i].base.split(",") if x} <= set(rows[i].spans.split(","))
    assert rows[len(TEXTS)].spans == "phone:5:19" and rows[len(TEXTS) + 3].spans == ""
    red = {r.doc_id: r for r in pii.redact(docs(spark, texts).withColumn("n_chars", F.length("text").cast("long"))).collect()}
    assert red[9].text == "write to [EMAIL] or [PHONE]" and red[9].n_chars == len(red[9].text) and red[0].text is None and red[8].text == LONG
    assert pii.find(docs(spark, [])).count() == 0


def test_redaction_of_overlapping_spans():
    assert pii.redacted("0123456789", [("card", 2, 6), ("phone", 4, 8), ("ip", 8, 9)]) == "01[CARD][IP]9"


# op9


def test_bpe_is_the_library_and_round_trips(spark):
    from tokenizers import Tokenizer

    path = tokenizer_path("byte_bpe_50k.json")
    t, mine = Tokenizer.from_file(path), bpe.ByteBPE(path)
    r = random.Random(4)
    texts = ["".join(r.choice("ab é\n \n\t's1.!\x1c\xa0\x00") for _ in range(r.randrange(30))) for _ in range(4000)]
    texts += [x or "" for x in TEXTS] + ["x" * 5000, "ab" * 700, "<|endoftext|><|endoftext|> a", "it's I'LL 12 34"]
    ids = mine.encode(pa.array(texts))
    want = [e.ids for e in t.encode_batch(texts, add_special_tokens=False)]
    assert [np.frombuffer(x, "<u4").tolist() for x in ids] == want
    assert [mine.decode(x) for x in ids] == [t.decode(x, skip_special_tokens=False) for x in want]
    rows = {x.doc_id: x for x in bpe.codec_digest(docs(spark), path).collect()}
    for i, x in enumerate(TEXTS):
        e = t.encode(x or "", add_special_tokens=False).ids
        assert rows[i].n_tokens == len(e) and rows[i].ids_sha256 == hashlib.sha256(np.array(e, "<u4").tobytes()).hexdigest()
        assert rows[i].decoded_sha256 == hashlib.sha256((x or "").encode()).hexdigest()
    assert bpe.codec_digest(docs(spark, []), path).count() == 0


def test_long_word_merges_like_a_short_one():
    mine = bpe.ByteBPE(tokenizer_path("byte_bpe_50k.json"))
    r = random.Random(1)
    words = [bytes(r.choice(b"abaat h") for _ in range(r.randint(1, 200))) for _ in range(300)]
    assert [mine.merge_long(w) for w in words] == mine.merge(words)


def test_frames_are_what_pandas_reads(spark):
    assert isinstance(sharding.shuffled_shards(docs(spark).select("doc_id"), 3, 1, "doc_id")[0].toPandas(), pd.DataFrame)
