"""The tagger of personal data: gradients, decoding, windows over whole texts, and what it adds to the patterns."""

import itertools
import random
import tracemalloc

import numpy as np
import pytest
from test_numbered_operators import docs

from cellweave.llm import pii, tagger


def test_gradients_are_differences():
    small = tagger.Tagger.fresh(3, 1)
    small.p = {k: v.astype(float) for k, v in small.p.items()}
    x, y = tagger.arrays(tagger.labelled_lines(6, 3), 24)
    x[18:, 1], y[18:, 1] = tagger.PAD, 0
    _, g = small.gradients(x, y)
    for k, w in small.p.items():
        at = np.unravel_index(np.abs(g[k]).argmax(), w.shape)
        w[at] += 1e-2
        up = small.gradients(x, y)[0]
        w[at] -= 2e-2
        down = small.gradients(x, y)[0]
        w[at] += 1e-2
        assert abs((up - down) / 2e-2 - g[k][at]) < 1e-3 + 0.01 * abs(g[k][at])


def test_decoding_finds_the_best_of_all_tag_sequences():
    rng = np.random.default_rng(5)
    model = tagger.Tagger.fresh(4, 2)
    model.p["t"] = rng.normal(size=model.p["t"].shape).astype(np.float32)
    model.p["t0"] = rng.normal(size=model.p["t0"].shape).astype(np.float32)
    model.p["o"] *= 4
    x = rng.integers(1, tagger.CLASSES, (4, 6)).astype(np.uint8)
    x[2:, 0] = tagger.PAD
    x[3:, 1] = tagger.PAD
    e, t, t0 = model.scores(x), model.p["t"] + tagger.ALLOWED, model.p["t0"] + tagger.FIRST
    got = model.decode(x)
    for j in range(x.shape[1]):
        n = int((x[:, j] != tagger.PAD).sum())
        worth = lambda s, j=j, n=n: t0[s[0]] + sum(e[k, s[k], j] for k in range(n)) + sum(t[s[k - 1], s[k]] for k in range(1, n))
        best = max(itertools.product(range(tagger.TAGS), repeat=n), key=worth)
        assert tuple(got[:n, j].tolist()) == best


def test_decoding_of_windows_holds_one_array_of_scores():
    """Windows of many lengths get the tags of a plain search backwards through all transitions, and the scores of a window
    are held once: all other arrays are those of one time."""
    model = pii.default_tagger()
    x, _ = tagger.arrays([(t[: 20 + 7 * k % 400], []) for k, (t, _) in enumerate(tagger.labelled_lines(128, 11, 400))], 400)
    x = x.astype(np.uint8)
    e, t = model.scores(x), model.p["t"] + tagger.ALLOWED
    tracemalloc.start()
    got = model.decode(x)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 2 * e.nbytes
    for j in range(x.shape[1]):
        n = int((x[:, j] != tagger.PAD).sum())
        best, before = e[0, :, j] + model.p["t0"] + tagger.FIRST, []
        for k in range(1, n):
            sums = best[:, None] + t
            before.append(sums.argmax(0))
            best = sums.max(0) + e[k, :, j]
        tags = [int(best.argmax())]
        for b in reversed(before):
            tags.append(int(b[tags[-1]]))
        assert got[:n, j].tolist() == tags[::-1]
    assert len(np.unique(got)) == tagger.TAGS


@pytest.mark.parametrize("n", [0, 1, 47, 511, 512, 513, 928, 929, 5000])
def test_each_character_is_kept_from_one_window(n):
    owner, depth = np.full(n, -1), {}
    for k, (a, b, low, high) in enumerate(pii.windows(n)):
        assert (owner[low:high] == -1).all() and a <= low and high <= b <= n and b - a <= pii.WIDTH
        owner[low:high] = k
        for i in range(a, b):
            depth.setdefault(i, {})[k] = min(i - a if a else n, b - 1 - i if b < n else n)
    assert (owner >= 0).all()
    assert all(d[owner[i]] >= max(d.values()) - 1 for i, d in depth.items())


def test_held_out_lines():
    """Lines of another seed: spans found in whole, before any rule."""
    lines = tagger.labelled_lines(400, 4242)
    found = pii.tagged_spans([t for t, _ in lines], pii.default_tagger())
    right = sum(len(set(s) & set(f)) for (_, s), f in zip(lines, found, strict=True))
    all_, made = sum(len(s) for _, s in lines), sum(map(len, found))
    assert right / all_ > 0.97 and right / made > 0.97


def test_training_learns():
    lines = tagger.labelled_lines(300, 3)
    model = tagger.train(lines, steps=120)
    x, y = tagger.arrays(tagger.labelled_lines(60, 8), 96)
    assert (model.decode(x) == y)[x != tagger.PAD].mean() > 0.8


def test_spans_are_added_wherever_they_stand():
    """At each offset of a text of several windows, seams included, without any number or sign nearby."""
    model, word = pii.default_tagger(), "lorem ipsum dolor sit amet "
    for k in range(350, 950, 37):
        before = (word * 50)[:k] + " "
        for kind, s in (("email", "user [at] example [dot] com"), ("phone", "(555) 123-4567")):
            text = before + s + " " + word * 40
            spans = pii.added_spans(text, pii.tagged_spans([text], model)[0], pii.base_spans(text))
            assert (kind, len(before), len(before) + len(s)) in spans
        text = before + 'token = "0f4ab61c9d3e5f7788aabbccddeeff0011223344" ' + word * 40
        at = text.index("0f4ab")
        assert ("secret", at, at + 40) in pii.added_spans(text, pii.tagged_spans([text], model)[0], [])


def test_texts_decode_alike_alone_and_together():
    model = pii.default_tagger()
    texts = [t * k for (t, _), k in zip(tagger.labelled_lines(12, 31), range(1, 13), strict=True)] + ["", "x"]
    assert pii.tagged_spans(texts, model) == [pii.tagged_spans([t], model)[0] for t in texts]


def test_no_number_is_taken_for_data():
    clean = ["on 2024-01-02 v1.2.3 12:30:55 $123.45", "a | b | c 100 | 200", "commit 3f1c2ab4d5e6f708192a3b4c5d6e7f8091a2b3c4", "the password is not here", "12345678901234567890123"]
    model = pii.default_tagger()
    for t in clean:
        assert pii.added_spans(t, pii.tagged_spans([t], model)[0], pii.base_spans(t)) == []


def test_repeated_rows_null_ids_and_columns(spark):
    texts = ["call (555) 123-4567 now", "call (555) 123-4567 now", None, "", "mail a@b.co"]
    df = docs(spark, texts, [3, 3, None, 5, None])
    got = sorted((r.doc_id is None, r.doc_id or 0, r.spans, r.n_email) for r in pii.find(df).collect())
    assert got == [(False, 3, "phone:5:19", 0), (False, 3, "phone:5:19", 0), (False, 5, "", 0), (True, 0, "", 0), (True, 0, "email:5:11", 1)]
    red = pii.redact(df)
    assert red.columns == df.columns and sorted(str(r.text) for r in red.collect()) == sorted(["call [PHONE] now"] * 2 + ["None", "", "mail [EMAIL]"])
    assert pii.redact(df.limit(0)).count() == 0


def test_windows_without_a_possible_span_are_not_decoded_and_no_span_is_lost():
    class Counted(tagger.Tagger):
        columns = 0

        def decode(self, x):
            Counted.columns += x.shape[1]
            return super().decode(x)

    lines, r = tagger.Lines(77), random.Random(3)
    signs = [" at ", " [at] host [dot] com ", "@", "token = ", "+1 (", "dot com", "a1" * 300 + " ", "1 2 " * 400, ")-", "\n"]
    texts = ["", "a", "x@y.zz"] + ["".join([lines.line(96)[0] if r.random() < 0.15 else r.choice(signs) if r.random() < 0.2 else lines.word() + " " for _ in range(r.randint(1, 700))]) for _ in range(60)]
    trained = pii.default_tagger().p
    wild = tagger.Tagger.fresh(6, 1).p  # tags nearly everything, so that spans go on through windows
    for p in (trained, wild):
        model = Counted(p)
        all_, some = pii.tagged_spans(texts, model), pii.tagged_spans(texts, model, [pii.needed(t) for t in texts])
        for t, a, b in zip(texts, all_, some, strict=True):
            assert pii.added_spans(t, b, []) == pii.added_spans(t, a, [])
            assert set(b) >= {s for s in a if any(x < s[2] and s[1] < y for x, y in pii.needed(t))}
    Counted.columns = 0
    prose = "Words of a long text without any number. " * 100
    texts = [prose, prose + "mail bob (at) host.com now. " + prose]
    spans = pii.tagged_spans(texts, Counted(trained), [pii.needed(t) for t in texts])
    assert ("email", len(prose) + 5, len(prose) + 22) in spans[1] and Counted.columns <= 3
