"""Merkle manifests against trees built level by level in plain Python."""

import hashlib
import random
import zlib

import pytest

from cellweave.llm import merkle, queries
from cellweave.llm.common import table

COLUMNS = ["doc_id", "source", "lang", "n_chars", "text"]
SCHEMA = "doc_id long, source string, lang string, n_chars long, text string, g long, n long, leaf string, root int"


def h(parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(row):
    return h("-" if row[c] is None else f"{len(str(row[c]).encode())}:{row[c]}" for c in COLUMNS)


def tree(leaves, fanout):
    """The top, and for each leaf the siblings before and after its ancestors."""
    level, at, paths = list(leaves), list(range(len(leaves))), [[] for _ in leaves]
    while len(level) > 1:
        for leaf, a in enumerate(at):
            first = a - a % fanout
            run = level[first : first + fanout]
            paths[leaf].append((run[: a - first], run[a - first + 1 :]))
        level = [h(level[k : k + fanout]) for k in range(0, len(level), fanout)]
        at = [a // fanout for a in at]
    return level[0], paths


def brute(rows, fanout, tamper):
    by_lang = {}
    for r in rows:
        by_lang.setdefault(r["lang"], []).append(r)
    order = sorted(by_lang, key=lambda x: (x is not None, (x or "").encode()))
    tops = {}
    for lang in order:
        some = sorted(by_lang[lang], key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf_of(r)))
        tops[lang] = (some, *tree([leaf_of(r) for r in some], fanout))
    root, over = tree([tops[x][1] for x in order], fanout)
    out = []
    for k, lang in enumerate(order):
        for r, path in zip(tops[lang][0], tops[lang][2], strict=True):
            steps, digest = path + over[k], leaf_of(tamper(r))
            for left, right in steps:
                digest = h([*left, digest, *right])
            proof = h(x for left, right in steps for x in left + right)
            out.append((r["doc_id"], leaf_of(r), tops[lang][1], root, proof, digest, digest == root))
    return out


def changed(r):
    bad = r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 7 == 0
    return r | {"n_chars": r["n_chars"] + 1} if bad and r["n_chars"] is not None else r


def key(r):
    return tuple(map(str, r))


@pytest.mark.parametrize("fanout,size", [(2, 1), (2, 700), (3, 333), (5, 1000), (200, 450)])
def test_rows_of_any_fanout(spark, fanout, size):
    rng = random.Random(fanout * size)
    rows = [
        (rng.choice([None, *range(-5, size)]), rng.choice([None, "a", "日本"]), rng.choice([None, "en", "en", "en", "é", "z", "", "Z"]), rng.choice([None, 3, 99]), rng.choice([None, "", "x" * 50000, "ü:1"]), 1, 2, "x", 3)
        for _ in range(size)
    ]
    rows += rows[: size // 10]
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    from pyspark.sql import functions as F

    shown = [F.expr("if(crc32(cast(cast(doc_id as string) as binary)) % 7 = 0, n_chars + 1, n_chars)") if c == "n_chars" else F.col(c) for c in COLUMNS]
    got = [tuple(r)[:7] for r in merkle.manifest(df, COLUMNS, fanout=fanout, shown=shown).collect()]
    want = brute([dict(zip(SCHEMA.replace(",", "").split()[::2], r, strict=True)) for r in rows], fanout, changed)
    assert sorted(got, key=key) == sorted(want, key=key)


def test_runs_cut_anywhere_give_the_same_tree(spark, monkeypatch):
    monkeypatch.setattr(merkle, "LEAVES", 8)
    monkeypatch.setattr(merkle, "NODES", 4)
    df = spark.range(500).selectExpr("id as doc_id", "'s' as source", "if(id % 5 = 0, 'a', 'b') as lang", "id as n_chars", "cast(id as string) as text", "1 as g").repartition(7)
    want = brute([r.asDict() for r in df.collect()], 3, lambda r: r)
    got = [tuple(r)[:7] for r in merkle.manifest(df, COLUMNS, fanout=3).collect()]
    assert sorted(got, key=key) == sorted(want, key=key) and all(r[6] for r in got)


def test_empty_table(spark):
    assert merkle.manifest(spark.createDataFrame([], SCHEMA), COLUMNS).collect() == []


def test_query_on_documents(spark):
    sf = "/root/testdata/sf0.001"
    got = [tuple(r) for r in queries.op11_merkle_manifest(spark, sf).collect()]
    want = brute([r.asDict() for r in table(spark, sf, "documents").collect()], 2, changed)
    assert sorted(got, key=key) == sorted(want, key=key)
    assert 0 < sum(not r[6] for r in got) < len(got)
