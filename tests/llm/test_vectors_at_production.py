"""The vector queries with their production parameters, against brute force."""

import numpy as np
import pandas as pd
import pytest

from cellweave.llm import queries, vectors


def exact(ids, x, asks, k=20):
    out = {}
    for q, w in asks:
        s = x @ w
        order = [int(i) for i in np.lexsort((ids, -s)) if ids[i] != q][:k]
        out[int(q)] = [(int(ids[i]), float(s[i])) for i in order]
    return out


def recall(got, want):
    hit = sum(len(set(got[got.query_id == q].vec_id) & {i for i, _ in rows}) for q, rows in want.items())
    return hit / sum(len(rows) for rows in want.values())


def frame(spark, x):
    return spark.createDataFrame(pd.DataFrame({"vec_id": np.arange(len(x)), "embedding": list(x.astype(np.float32)), "label": np.arange(len(x)) % 3}), "vec_id long, embedding array<float>, label int")


def test_registered_search_on_a_whole_table(spark):
    got = queries.op10_nearest(spark, "/root/testdata/sf0.01").toPandas()
    t = pd.read_parquet("/root/testdata/sf0.01/embeddings.parquet").dropna(subset=["embedding"]).sort_values("vec_id")
    ids, x = t.vec_id.to_numpy(), np.stack(t.embedding.to_list()).astype(float)
    good = np.isfinite(x).all(1) & (x != 0).any(1)
    ids, x = ids[good], x[good]
    want = exact(ids, x, [(i, w) for i, w in zip(ids, x, strict=True) if i % 20 == 0])
    assert recall(got, want) >= 0.95 and len(got) == sum(map(len, want.values()))
    assert got.groupby("query_id")["rank"].apply(lambda r: sorted(r) == list(range(1, len(r) + 1))).all()


@pytest.mark.parametrize("n", [2000, 20_000])
def test_search_without_structure(spark, n):
    """Gaussian vectors have no clusters that codebooks could learn."""
    x = np.random.default_rng(n).normal(size=(n, 64)).astype(np.float32).astype(float)
    df = frame(spark, x)
    got = vectors.nearest(df, df.where("vec_id % 200 = 0")).toPandas()
    want = exact(np.arange(n), x, [(i, x[i]) for i in range(0, n, 200)])
    assert recall(got, want) >= 0.9
    scores = {(q, i): s for q, rows in want.items() for i, s in rows}
    assert all(abs(scores[q, i] - s) < 1e-9 for q, i, s in zip(got.query_id, got.vec_id, got.score, strict=True) if (q, i) in scores)


def test_codes_decide_and_not_the_number_of_blocks(spark):
    x = np.random.default_rng(3).normal(size=(1500, 64))
    df = frame(spark, x)
    few, many = (vectors.nearest(df, df.where("vec_id % 50 = 0"), plan=p).toPandas().sort_values(["query_id", "rank"]) for p in (vectors.Aq(), vectors.Aq(block=100, queries=8)))
    assert few.vec_id.tolist() == many.vec_id.tolist()
    least = vectors.nearest(df, df.where("vec_id % 50 = 0"), plan=vectors.Aq(rerank=20)).toPandas()
    want = exact(np.arange(len(x)), x.astype(np.float32).astype(float), [(i, x[i]) for i in range(0, len(x), 50)])
    assert recall(least, want) < recall(few, want)


def test_many_copies_crowd_nothing_out(spark):
    """A vector that a third of the rows repeat is one candidate with its smallest ids."""
    rng = np.random.default_rng(8)
    x = rng.normal(size=(900, 32)).astype(np.float32).astype(float)
    x[300:600] = x[300] * 1.0001
    df = frame(spark, x)
    got = vectors.nearest(df, df.where("vec_id % 60 = 0")).toPandas()
    assert recall(got, exact(np.arange(900), x, [(i, x[i]) for i in range(0, 900, 60)])) >= 0.95
    near = vectors.near_duplicates(df).toPandas().set_index("vec_id")
    assert near.n_links[300:600].tolist() == [99] * 300 and near.component_id[300:600].tolist() == [300 + i % 3 for i in range(300)]


def test_pairs_just_above_the_threshold_are_found(spark):
    rng = np.random.default_rng(11)
    x = rng.normal(size=(1500, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    z = rng.normal(size=x.shape)
    z -= (z * x).sum(1, keepdims=True) * x
    z /= np.linalg.norm(z, axis=1, keepdims=True)
    c = 0.98001
    both = np.concatenate([x, c * x + np.sqrt(1 - c * c) * z])
    df = frame(spark, both).selectExpr("vec_id", "embedding", "1 as label")
    got = vectors.near_duplicates(df).toPandas().set_index("vec_id").sort_index()
    assert got.n_links.tolist() == [1] * 3000 and got.component_id.tolist() == [*range(1500)] * 2


def hard_rows(kind):
    """Rows whose true neighbours are hard to tell apart by codes: groups far larger than what is scored exactly, lengths
    from tiny to huge, and more dimensions than the codes have bits for."""
    rng = np.random.default_rng(21)
    if kind == "groups":
        x = rng.normal(size=(6000, 64))
        x[:3000] = x[rng.integers(0, 6, 3000)] + 0.001 * x[:3000]  # six tight ones among rows without structure
        return x
    if kind == "lengths":
        return rng.normal(size=(6000, 64)) * np.exp(2 * rng.normal(size=(6000, 1)))
    return rng.normal(size=(6000, 384))


@pytest.mark.parametrize("kind", ["groups", "lengths", "wide"])
def test_registered_search_misses_none_on_other_rows(spark, tmp_path, kind):
    x = hard_rows(kind).astype(np.float32)
    x[100:160] = x[100]
    frame(spark, x).drop("label").write.parquet(str(tmp_path / "embeddings.parquet"))
    got = queries.op10_nearest(spark, str(tmp_path)).toPandas().sort_values(["query_id", "rank"])
    x = x.astype(float)
    want = exact(np.arange(len(x)), x, [(i, x[i]) for i in range(0, len(x), 20)])
    assert recall(got, want) == 1 and len(got) == sum(map(len, want.values()))
    for q in (0, 100, 120, 5980):
        mine = got[got.query_id == q]
        assert mine["rank"].tolist() == list(range(1, 21)) and np.allclose(mine.score, [s for _, s in want[q]], rtol=1e-12)
