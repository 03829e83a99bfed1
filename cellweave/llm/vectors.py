"""Near-duplicates of vectors by cross-polytope hashing, and nearest neighbours by additive quantisation."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import components, durable, shuffle_width


def usable(df: DataFrame, id_col: str, vector_col: str, *more: str | Column) -> DataFrame:
    """Rows with an id and a vector that is not null, empty or zero and holds finite numbers only, as id and v. Vectors
    of single precision stay so, to shuffle half as much; tasks widen them before they compute."""
    v = F.col(vector_col)
    if df.schema[vector_col].dataType.simpleString() != "array<float>":
        v = v.cast("array<double>")
    good = F.forall(v, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False))) & F.exists(v, lambda x: x != 0)
    return df.where(F.col(id_col).isNotNull() & F.coalesce(good, F.lit(False))).select(F.col(id_col).cast("bigint").alias("id"), v.alias("v"), *more)


def rows_of(column) -> np.ndarray:
    """A list column without nulls and with lists of one length, as a matrix of doubles."""
    n = len(column)
    return column.flatten().to_numpy(zero_copy_only=False).reshape(n, -1).astype(np.float64) if n else np.zeros((0, 1))


def by_length(batch: pa.RecordBatch, column: str) -> Iterator[pa.RecordBatch]:
    """The rows of a batch, those of each length of the list column apart."""
    size = pc.list_value_length(batch[column]).to_numpy(zero_copy_only=False)
    for d in np.unique(size).tolist():
        yield batch.filter(pa.array(size == d))


def hadamard(x: np.ndarray) -> np.ndarray:
    """The fast Walsh-Hadamard transform of each row, whose length is a power of two."""
    h, x = 1, x.copy()
    while h < x.shape[1]:
        y = x.reshape(len(x), -1, 2, h)
        x = np.stack([y[:, :, 0] + y[:, :, 1], y[:, :, 0] - y[:, :, 1]], 2).reshape(len(x), -1)
        h *= 2
    return x


@dataclass(frozen=True)
class Lsh:
    """tables of hashes cross-polytope hashes each. Rows are looked up in their own bucket and in those where one hash is
    replaced by its second best direction. In 64 dimensions a pair of cosine 0.98 meets in a table with a chance of 0.74,
    so it meets in none of them with one of 2e-6; a nearer pair with less."""

    tables: int = 10
    hashes: int = 3
    seed: int = 3


def polytope_keys(x: np.ndarray, plan: Lsh) -> tuple[np.ndarray, np.ndarray]:
    """Keys of rows of unit length: (rows, tables) buckets and (rows, tables, hashes) more buckets to look up. A hash is
    the axis, with sign, nearest to the vector after three rounds of random signs and Hadamard transforms."""
    d = 1 << max(1, (x.shape[1] - 1).bit_length())
    padded = np.zeros((len(x), d))
    padded[:, : x.shape[1]] = x
    rng = np.random.default_rng(plan.seed + 1000 * d)
    row = np.arange(len(x))
    base, more = np.zeros((len(x), plan.tables), np.int64), np.zeros((len(x), plan.tables, plan.hashes), np.int64)
    for t in range(plan.tables):
        axes = np.zeros((plan.hashes, 2, len(x)), np.int64)
        for k in range(plan.hashes):
            y = padded
            for _ in range(3):
                y = hadamard(y * rng.choice([-1.0, 1.0], d)) / np.sqrt(d)
            size = np.abs(y)
            for place in range(2):
                at = size.argmax(1)
                axes[k, place] = 2 * at + (y[row, at] < 0)
                size[row, at] = -1
        for k in range(-1, plan.hashes):
            key = np.zeros(len(x), np.int64)
            for j in range(plan.hashes):
                key = key * (2 * d) + axes[j, int(j == k)]
            (base[:, t] if k < 0 else more[:, t, k])[:] = key * plan.tables + t
    return base, more


def near_duplicates(df: DataFrame, least: float = 0.98, plan: Lsh = Lsh(), id_col: str = "vec_id", vector_col: str = "embedding", group_col: str = "label") -> DataFrame:
    """Per row: vec_id, n_links, component_id, kept.

    Rows link when their groups are equal and not null and the cosine of their vectors, in double precision, is at least
    least. Equal vectors of a group are one point with a count, known by two 64-bit hashes. Points share a bucket when
    one's own bucket is among those that the other looks up; buckets are numbers of 64 bits, and such pairs, told apart,
    are checked by group, length and cosine. n_links adds the counts of linked points and the point's other copies;
    components join linked points. Vectors that are null, empty, zero, not finite or without a group, and those of other
    lengths, do not link; a null id links with nothing and has a null component; repeated ids count as rows of their own;
    an empty table gives no rows.
    """
    good = usable(df, id_col, vector_col, F.col(group_col).alias("g")).where("g is not null")
    hashes = [F.xxhash64(F.lit(k), F.col("v").cast("array<double>")).alias(f"h{k}") for k in (0, 1)]
    points = durable(good.select("*", *hashes).groupBy("g", "h0", "h1").agg(F.min("id").alias("p"), F.count("*").alias("copies"), F.any_value("v").alias("v")))

    def hashed(batches):
        for batch in batches:
            for part in by_length(batch, "v") if batch.num_rows else ():
                x = rows_of(part["v"])
                base, more = polytope_keys(x / np.linalg.norm(x, axis=1, keepdims=True), plan)
                lists = [pa.ListArray.from_arrays(np.arange(len(x) + 1, dtype=np.int32) * (k.size // len(x)), pa.array(k.ravel())) for k in (base, more)]
                yield pa.RecordBatch.from_arrays([part["g"], pc.list_value_length(part["v"]), part["p"], *lists], ["g", "d", "p", "base", "more"])

    kind = points.schema["g"].dataType.simpleString()
    keys = durable(points.select("g", "v", "p").mapInArrow(hashed, f"g {kind}, d int, p long, base array<long>, more array<long>"))
    bucket = F.xxhash64("g", "d", "key").alias("bucket")
    there = keys.select("g", "d", F.explode("base").alias("key"), "p").select(bucket, "p")
    asked = keys.select("g", "d", F.explode(F.concat("base", "more")).alias("key"), "p").select(bucket, F.col("p").alias("q"))
    pairs = there.join(asked, "bucket").where("p <> q").select(F.least("p", "q").alias("a"), F.greatest("p", "q").alias("b")).distinct()
    left = points.select(F.col("p").alias("a"), F.col("g").alias("ga"), F.col("v").alias("va"), F.col("copies").alias("ca"))
    right = points.select(F.col("p").alias("b"), F.col("g").alias("gb"), F.col("v").alias("vb"), F.col("copies").alias("cb"))

    def check(batches):
        for batch in batches:
            for part in by_length(batch, "va") if batch.num_rows else ():
                x, y = rows_of(part["va"]), rows_of(part["vb"])
                cos = np.einsum("ij,ij->i", x, y) / (np.sqrt(np.einsum("ij,ij->i", x, x)) * np.sqrt(np.einsum("ij,ij->i", y, y)))
                yield part.filter(pa.array(cos >= least)).select(["a", "b", "ca", "cb"])

    met = pairs.join(left, "a").join(right, "b").where("ga = gb and size(va) = size(vb)").select("a", "b", "ca", "cb", "va", "vb")
    links = durable(met.mapInArrow(check, "a long, b long, ca long, cb long"))
    ends = links.select(F.col("a").alias("p"), F.col("cb").alias("n")).unionByName(links.select(F.col("b").alias("p"), F.col("ca").alias("n")))
    counts = ends.groupBy("p").agg(F.sum("n").alias("n"))
    known = points.drop("v").join(counts, "p", "left").join(components(links).withColumnRenamed("node", "p"), "p", "left")
    known = durable(known.select("g", "h0", "h1", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("component", "p").alias("component_id")))
    # Rows that take no part have no point's hashes, or no group or id to meet one.
    part = usable(df, id_col, vector_col).limit(0).select("v")  # for its type
    whole = df.select(F.col(id_col).cast("bigint").alias("id"), F.col(vector_col).cast(part.schema["v"].dataType).alias("v"), F.col(group_col).alias("g"))
    named = whole.select("id", "g", *[F.when(F.col("id").isNotNull(), h).alias(f"h{k}") for k, h in enumerate(hashes)])
    all_ = named.join(known, ["g", "h0", "h1"], "left")
    return all_.select(F.col("id").alias("vec_id"), F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"), F.coalesce("component_id", "id").alias("component_id"), (F.col("id") == F.coalesce("component_id", "id")).alias("kept"))


@dataclass(frozen=True)
class Aq:
    """books of words full-dimensional codewords (at most 256 words, a byte each); beam of partial codes while encoding;
    sample rows to fit on; rerank vectors that are scored exactly for each query; rows of a block and queries of a block.

    With certain, rerank is no cut: all rows are scored exactly whose code cannot rule them out, so none is missed on any
    rows. Without it codes decide, and vectors without any structure are the hardest; the README has measured recall."""

    books: int = 32
    words: int = 64
    beam: int = 4
    sample: int = 16_384
    rerank: int = 128
    block: int = 65_536
    queries: int = 8192
    certain: bool = False


def encode(x: np.ndarray, books: np.ndarray, beam: int) -> np.ndarray:
    """Codes whose codewords' sum is near each row: of each book the best extensions of the best partial codes stay."""
    n, (m, k, d) = len(x), books.shape
    codes, rest, row = np.zeros((n, 1, m), np.uint8), x[:, None, :], np.arange(n)[:, None]
    for level in range(m):
        cost = (rest.reshape(-1, d) @ (-2 * books[level].T)).reshape(n, -1, k)
        cost += (rest**2).sum(2)[:, :, None] + (books[level] ** 2).sum(1)
        flat = cost.reshape(n, -1)
        keep = min(beam if level < m - 1 else 1, flat.shape[1])
        best = np.argpartition(flat, keep - 1, axis=1)[:, :keep]
        parent, word = best // k, best % k
        codes = codes[row, parent]
        codes[:, :, level] = word
        rest = rest[row, parent] - books[level][word]
    return codes[:, 0]


def sums_by(group: np.ndarray, x: np.ndarray, n: int) -> np.ndarray:
    """Sums of the rows of x in each of n groups."""
    out = np.zeros((n, x.shape[1]), x.dtype)
    order = np.argsort(group, kind="stable")
    found, starts = np.unique(group[order], return_index=True)
    out[found] = np.add.reduceat(x[order], starts)
    return out


def fit_books(x: np.ndarray, plan: Aq, rounds: int = 2) -> np.ndarray:
    """Residual k-means gives the first books; then rows are encoded and all books refitted together by least squares."""
    rng = np.random.default_rng(1)
    x = x.astype(np.float32)
    m, k, d = plan.books, plan.words, x.shape[1]
    books, rest = np.zeros((m, k, d), np.float32), x
    for level in range(m):
        centers = rest[rng.choice(len(rest), k, replace=len(rest) < k)]
        for _ in range(6):
            near = ((centers**2).sum(1) - 2 * rest @ centers.T).argmin(1)
            n = np.bincount(near, minlength=k)[:, None]
            centers = np.where(n > 0, sums_by(near, rest, k) / np.maximum(n, 1), centers).astype(np.float32)
        books[level] = centers
        rest = rest - centers[((centers**2).sum(1) - 2 * rest @ centers.T).argmin(1)]
    for _ in range(rounds):
        codes = np.concatenate([encode(x[at : at + 1024], books, plan.beam) for at in range(0, len(x), 1024)]).astype(np.int64)
        pairs = [[np.bincount(codes[:, a] * k + codes[:, b], minlength=k * k).reshape(k, k) for b in range(m)] for a in range(m)]
        right = np.concatenate([sums_by(codes[:, a], x, k) for a in range(m)])
        left = np.block(pairs) + 0.1 * np.eye(m * k)
        books = np.linalg.solve(left, right + 0.1 * books.reshape(-1, d)).reshape(books.shape).astype(np.float32)
    return books


def nearest(df: DataFrame, queries: DataFrame, k: int = 20, plan: Aq = Aq(), id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score: each query's k rows of largest inner product found, its own row apart.

    1. Codebooks are fitted on about plan.sample rows chosen by a hash of their id; every row is encoded. A code, the
       row's stored norm over that of the code's sum, and a hash of the vector are kept, not the vector.
    2. Blocks of codes meet blocks of queries. A table of inner products of queries and codewords scores all codes of a
       block, and the plan.rerank best vectors of each query go on; then the plan.rerank best of all blocks, so that the
       blocks' number and sizes change no result. Equal vectors are one candidate, with its k + 1 smallest ids.
    3. The candidates' vectors are joined, scored exactly in double precision, and the k best kept. Ties go to the
       smaller vec_id.

    With plan.certain a row keeps its vector too, and how far its code's sum is from it, which bounds what the code may be
    wrong by. In each pair of blocks the plan.rerank best vectors by code are scored exactly; the k-th best of them is a
    score that any other row must reach, and all rows whose bound does are scored exactly. The k best of each block go on.

    Vectors that are null, empty, zero or not finite take no part, nor do those whose length is not the sample's most
    frequent one; null ids neither. Of repeated ids each row counts, but a query leaves out all rows with its id. Fewer
    candidates than k give fewer rows, an empty table none.
    """
    spark = df.sparkSession
    rows, asked = usable(df, id_col, vector_col), usable(queries, id_col, vector_col)
    n, nq = rows.count(), asked.count()
    if not n or not nq:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    part = min(1.0, plan.sample / n)
    draw = F.pmod(F.xxhash64("id", F.lit(5)), F.lit(1_000_000)) < max(1, int(part * 1_000_000))
    sample = rows.where(draw).orderBy("id").toPandas()
    if not len(sample):
        sample = rows.orderBy("id").limit(plan.sample).toPandas()
    lengths = sample["v"].map(len)
    d = int(lengths.mode().min())
    fitted = np.stack(sample["v"][lengths == d].to_list()).astype(np.float64)
    if plan.certain:  # directions alone, as a row's factor has its length
        fitted /= np.linalg.norm(fitted, axis=1, keepdims=True)
    books = fit_books(fitted, plan)
    rows, asked = rows.where(F.size("v") == d), asked.where(F.size("v") == d)

    def encoded(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                some = batch.slice(at, 1024)
                x = rows_of(some["v"])
                codes = encode(x.astype(np.float32), books, plan.beam)
                made = sum(books[m][codes[:, m]] for m in range(plan.books))
                factor = np.linalg.norm(x, axis=1) / np.maximum(np.linalg.norm(made, axis=1), 1e-30)
                yield pa.RecordBatch.from_arrays([some["id"], some["h"], pa.array([c.tobytes() for c in codes], pa.binary()), pa.array(factor.astype(np.float32))], ["id", "h", "code", "factor"])

    if plan.certain:
        return certain_nearest(rows, asked, books, k, plan, n, nq)

    # As many pairs of blocks as Spark has tasks for a shuffle, but no blocks so small that their best rows are most of
    # their rows, nor any beyond the plan's sizes.
    width = shuffle_width(spark)
    nb = max(-(-n // plan.block), min(width, n // (16 * plan.rerank)), 1)
    mb = max(-(-nq // plan.queries), min(-(-width // nb), nq // 256), 1)
    coded = durable(rows.select("id", "v", F.xxhash64("v").alias("h")).mapInArrow(encoded, "id long, h long, code binary, factor float"))
    left = coded.select("*", F.expr(f"cast(pmod(xxhash64(id, 1), {nb}) as int)").alias("b"), F.explode(F.sequence(F.lit(0), F.lit(mb - 1))).alias("q"))
    right = asked.select("id", "v", F.explode(F.sequence(F.lit(0), F.lit(nb - 1))).alias("b"), F.expr(f"cast(pmod(xxhash64(id, 2), {mb}) as int)").alias("q"))
    out = "query_id long, h long, vec_id long, near float"

    def search(x: pd.DataFrame, y: pd.DataFrame) -> pd.DataFrame:
        found = []
        if len(x) and len(y):
            x = x.sort_values(["h", "id"])
            x = x[x.groupby("h").cumcount() <= k]
            ids, h = x["id"].to_numpy(), x["h"].to_numpy()
            first = np.flatnonzero(np.r_[True, h[1:] != h[:-1]])
            copies = np.diff(np.r_[first, len(h)])
            code = np.frombuffer(b"".join(x["code"].iloc[first]), np.uint8).reshape(len(first), -1)
            factor = x["factor"].to_numpy(np.float32)[first]
            asks, w = y["id"].to_numpy(), np.stack(y["v"].to_list()).astype(np.float32)
            keep = min(plan.rerank + 1, len(first))  # one more, as a query's own row is not known to be alone in its vector
            for at in range(0, len(w), 128):
                lookup = np.einsum("qd,mkd->mkq", w[at : at + 128], books, optimize=True)
                near = np.zeros((len(first), lookup.shape[2]), np.float32)
                for m in range(plan.books):
                    near += lookup[m].take(code[:, m], axis=0)
                near = np.ascontiguousarray((near * factor[:, None]).T)
                best = np.argpartition(near, len(first) - keep, axis=1)[:, len(first) - keep :]
                least = np.take_along_axis(near, best, 1).min(1)
                for j in range(len(near)):
                    some = np.flatnonzero(near[j] >= least[j])
                    rows_ = np.repeat(first[some] - (np.cumsum(copies[some]) - copies[some]), copies[some]) + np.arange(copies[some].sum())
                    found.append((np.full(len(rows_), asks[at + j]), h[rows_], ids[rows_], np.repeat(near[j][some], copies[some])))
        if not found:
            found = [(np.zeros(0, np.int64),) * 3 + (np.zeros(0, np.float32),)]
        return pd.DataFrame(dict(zip(("query_id", "h", "vec_id", "near"), map(np.concatenate, zip(*found, strict=True)), strict=True)))

    hits = left.groupBy("b", "q").cogroup(right.groupBy("b", "q")).applyInPandas(search, out)
    # Blocks may differ in the last bit of an equal vector's score; its best one counts.
    ranked = hits.where("vec_id <> query_id").repartition(shuffle_width(spark), "query_id").selectExpr(
        "*", "max(near) over (partition by query_id, h) as best", "row_number() over (partition by query_id, h order by vec_id) as copy"
    ).selectExpr("*", "dense_rank() over (partition by query_id order by best desc, h) as place")
    chosen = ranked.where((F.col("place") <= plan.rerank) & (F.col("copy") <= k)).select("query_id", "vec_id").distinct()
    met = chosen.join(rows.select(F.col("id").alias("vec_id"), "v"), "vec_id").join(asked.select(F.col("id").alias("query_id"), F.col("v").alias("w")), "query_id")

    def exact(batches):
        for batch in batches:
            score = np.einsum("ij,ij->i", rows_of(batch["v"]), rows_of(batch["w"])) if batch.num_rows else np.zeros(0)
            yield pa.RecordBatch.from_arrays([batch["query_id"], batch["vec_id"], pa.array(score)], ["query_id", "vec_id", "score"])

    scored = met.select("query_id", "vec_id", "v", "w").mapInArrow(exact, "query_id long, vec_id long, score double")
    best = scored.selectExpr("*", "cast(row_number() over (partition by query_id order by score desc, vec_id) as int) as rank")
    return best.where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def certain_nearest(rows: DataFrame, asked: DataFrame, books: np.ndarray, k: int, plan: Aq, n: int, nq: int) -> DataFrame:
    """The search of nearest() with plan.certain, for n rows and nq queries (id, v) of the codebooks' length, which were
    fitted on vectors of norm 1.

    The inner product of a query with a row is that with its code's sum plus that with the rest, which is at most the
    product of both norms. Codes that fit badly rule out less, and cost time but no row. A task holds a block of rows and
    one of queries, and gives k rows a query at most."""
    spark = rows.sparkSession

    def encoded(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                some = batch.slice(at, 1024)
                x = rows_of(some["v"])
                codes = encode((x / np.linalg.norm(x, axis=1, keepdims=True)).astype(np.float32), books, plan.beam)
                made = sum(books[m][codes[:, m]].astype(np.float64) for m in range(plan.books))
                factor = np.einsum("ij,ij->i", x, made) / np.maximum(np.einsum("ij,ij->i", made, made), 1e-30)
                rest = np.linalg.norm(x - factor[:, None] * made, axis=1)
                yield pa.RecordBatch.from_arrays([some["id"], some["h"], some["v"], pa.array([c.tobytes() for c in codes], pa.binary()), pa.array(factor), pa.array(rest)], ["id", "h", "v", "code", "factor", "rest"])

    # Queries are the fewer rows, so blocks of rows are made smaller before those of queries are, for Spark's tasks.
    width = shuffle_width(spark)
    nb = max(-(-n // plan.block), min(width, n // (64 * plan.rerank)), 1)
    mb = max(-(-nq // plan.queries), min(-(-width // nb), nq // 256), 1)
    kind = rows.schema["v"].dataType.simpleString()
    coded = rows.select("id", F.xxhash64("v").alias("h"), "v").mapInArrow(encoded, f"id long, h long, v {kind}, code binary, factor double, rest double")
    left = coded.select("*", F.expr(f"cast(pmod(xxhash64(id, 1), {nb}) as int)").alias("b"), F.explode(F.sequence(F.lit(0), F.lit(mb - 1))).alias("q"))
    right = asked.select("id", "v", F.explode(F.sequence(F.lit(0), F.lit(nb - 1))).alias("b"), F.expr(f"cast(pmod(xxhash64(id, 2), {mb}) as int)").alias("q"))

    def search(x: pa.Table, y: pa.Table) -> pa.Table:
        found = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))]
        if x.num_rows and y.num_rows:
            ids, h = x["id"].to_numpy(), x["h"].to_numpy()
            order = np.lexsort((ids, h))
            ids, h = ids[order], h[order]
            first = np.flatnonzero(np.r_[True, h[1:] != h[:-1]])
            one, ends = order[first], np.r_[first[1:], len(h)]  # of each vector a row, and where the rows that share it end
            v = rows_of(x["v"].combine_chunks())[one]
            code = np.frombuffer(b"".join(x["code"].take(pa.array(one)).to_pylist()), np.uint8).reshape(len(one), -1)
            factor = x["factor"].to_numpy()[one]
            # Codes are summed in single precision; the codewords' norms bound what that adds.
            longest = np.linalg.norm(books.astype(np.float64), axis=2).max(1).sum()
            rest = x["rest"].to_numpy()[one] + 1e-5 * np.abs(factor) * longest + 1e-9 * np.linalg.norm(v, axis=1)
            asks, w = y["id"].to_numpy(), rows_of(y["v"].combine_chunks())

            def kth(some, score, own) -> float:
                """The k-th best score of rows of other ids than the query's, whose own rows have the vectors own."""
                by_score = np.argsort(-score)
                rows_ = np.cumsum((ends - first)[some[by_score]] - (some[by_score][:, None] == own).sum(1))
                at = np.searchsorted(rows_, k)
                return score[by_score[at]] if at < len(by_score) else -np.inf

            keep = min(plan.rerank, len(one))
            for at in range(0, len(w), 64):
                unit = w[at : at + 64] / np.linalg.norm(w[at : at + 64], axis=1, keepdims=True)
                lookup = np.einsum("qd,mkd->mkq", unit.astype(np.float32), books, optimize=True)
                near = np.zeros((len(one), len(unit)), np.float32)
                for m in range(plan.books):
                    near += lookup[m].take(code[:, m], axis=0)
                near = near.T * factor
                for j in range(len(unit)):
                    q = asks[at + j]
                    own = np.searchsorted(first, np.flatnonzero(ids == q), "right") - 1
                    tried = np.argpartition(near[j], len(one) - keep)[len(one) - keep :]
                    least = kth(tried, np.einsum("ij,j->i", v[tried], unit[j]), own)
                    some = np.flatnonzero(near[j] + rest >= least)
                    score = np.einsum("ij,j->i", v[some], w[at + j])
                    good = score >= kth(some, score, own)
                    best = []
                    for s, o in zip(score[good].tolist(), some[good].tolist(), strict=True):
                        others = ids[first[o] : ends[o]]
                        best += [(-s, i) for i in others[others != q][:k].tolist()]
                    best = sorted(best)[:k]
                    found.append((np.full(len(best), q), np.array([i for _, i in best], np.int64), np.array([-s for s, _ in best])))
        return pa.table(dict(zip(("query_id", "vec_id", "score"), map(np.concatenate, zip(*found, strict=True)), strict=True)))

    hits = left.groupBy("b", "q").cogroup(right.groupBy("b", "q")).applyInArrow(search, "query_id long, vec_id long, score double")
    best = hits.selectExpr("*", "cast(row_number() over (partition by query_id order by score desc, vec_id) as int) as rank")
    return best.where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
