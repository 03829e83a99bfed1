"""Rings leave the rounds of ring_order when they are done."""

import random

from pyspark.sql import functions as F

from cellweave.operators import graph


def ring_rows(lengths, seed=1):
    rng, rows, at = random.Random(seed), [], 0
    for g, n in enumerate(lengths):
        ids = list(range(at, at + n))
        rng.shuffle(ids)
        rows += [(g % 2, a, b) for a, b in zip(ids, ids[1:] + ids[:1], strict=True)]
        at += n
    return rows


def test_rings_of_all_lengths(spark):
    rows = ring_rows([*range(1, 36), 63, 64, 65])
    got = {r.id: (r.ring, r.place) for r in graph.ring_order(spark.createDataFrame(rows, "g int, id long, next long"), ["g"]).collect()}
    after = {a: b for _, a, b in rows}
    want = {}
    for a in sorted(after):
        if a not in want:
            at, k = a, 0
            while at not in want:
                want[at], at, k = (a, k), after[at], k + 1
    assert got == want
    assert graph.ring_order(spark.createDataFrame([], "g int, id long, next long"), ["g"]).collect() == []


def test_done_rings_are_not_sent_again(spark, monkeypatch):
    sizes, written = [], graph.forget

    def seen(spark, path):
        sizes.append(spark.read.parquet(path).count())
        written(spark, path)

    monkeypatch.setattr(graph, "forget", seen)
    rows = ring_rows([4] * 100 + [100])
    assert graph.ring_order(spark.createDataFrame(rows, "g int, id long, next long"), ["g"]).agg(F.count("*")).first()[0] == 500
    assert sizes == [500] * 3 + [100] * 5  # rings of 4 leave in the third round
