"""The token-group matrix: what prefixes promise, and links that only the matrix finds."""

import random

import numpy as np
import pytest
from test_numbered_operators import brute_components, docs, near_copies

from cellweave.llm import jaccard


def test_sets_that_reach_the_similarity_share_a_prefix_token():
    rng = np.random.default_rng(4)
    for _ in range(400):
        n = int(rng.integers(1, 60))
        x = np.unique(rng.integers(0, 2**63, n, np.uint64))
        y = np.unique(np.concatenate([x[rng.random(len(x)) < 0.9], rng.integers(0, 2**63, int(rng.integers(0, 9)), np.uint64)]))
        common = len(np.intersect1d(x, y))
        levels = rng.integers(0, 3, 16).astype(np.uint8)
        if len(y) and jaccard.alike(len(x), len(y), common, 75):
            assert len(np.intersect1d(jaccard.prefix_of(x, levels, 75), jaccard.prefix_of(y, levels, 75)))
    assert len(jaccard.prefix_of(np.zeros(0, np.uint64), np.zeros(4, np.uint8), 75)) == 0


def test_matrix_opens_only_groups_that_hold_enough():
    sets = [np.arange(k, k + 20, dtype=np.uint64) for k in (0, 2, 100)]
    matrix = jaccard.Matrix(sets)
    assert matrix.linked(np.arange(1, 21, dtype=np.uint64), 75).tolist() == [0, 1]
    assert matrix.linked(np.arange(50, 70, dtype=np.uint64), 75).tolist() == []
    assert matrix.linked(np.array([0, 1, 2, 100, 101, 102], np.uint64), 75).tolist() == []  # the union holds all, no member enough


@pytest.mark.parametrize("seed, plan", [(1, jaccard.Plan(counted=1, slots=8, members=50, queries=90)), (2, jaccard.Plan(counted=2)), (3, jaccard.Plan(percent=60, words=3))])
def test_links_of_random_families(spark, seed, plan):
    """Short texts with a passage in common, chains, and copies at every distance."""
    r = random.Random(seed)
    passage = " ".join("p%d" % k for k in range(12))
    texts = near_copies(r, 120, 4) + [passage + " " + t for t in near_copies(r, 60, 3)]
    words = ["c%d" % k for k in range(120)]
    texts += [" ".join(words[k : k + 30]) for k in range(0, 90, 3)]
    r.shuffle(texts)
    got = {x.doc_id: (x.n_shingles, x.component_id) for x in jaccard.link_classes(docs(spark, texts), plan).collect()}
    if plan.words == 5:
        assert got == brute_components(dict(enumerate(texts)), plan.percent)
    else:
        sets = [{tuple(t.split()[k : k + 3]) for k in range(len(t.split()) - 2)} for t in texts]
        for a in range(len(texts)):
            assert got[a][0] == len(sets[a])
            for b in range(a):
                if 100 * len(sets[a] & sets[b]) >= 60 * len(sets[a] | sets[b]):
                    assert got[a][1] == got[b][1]


def test_texts_under_one_id_are_nodes_of_their_own(spark):
    a, b = "a b c d e f g h", "q w e r t y u i"
    rows = [(9, a), (4, a), (4, b), (3, b + " o"), (4, b), (8, "x")]
    got = sorted((x.doc_id, x.component_id) for x in jaccard.link_classes(docs(spark, [t for _, t in rows], [i for i, _ in rows])).collect())
    assert got == [(3, 3), (4, 3), (4, 3), (4, 4), (8, 8), (9, 4)]


def test_links_that_join_no_more_are_left_out():
    sets = jaccard.Joined(np.array([1, 1, 2, 3]))
    assert not sets.done(1) and sets.join(9, 2) and not sets.join(2, 9) and sets.join(9, 1) and not sets.done(9)
    assert sets.join(3, 1) and all(sets.done(x) for x in (1, 2, 3, 9)) and not sets.done(5) and sets.join(5, 3) and sets.done(5)
