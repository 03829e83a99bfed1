"""Quality scores by regularised quadratic discriminant analysis of document statistics."""

from __future__ import annotations

import math
from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import drop_caches, durable

NAMES = (
    "chars", "words", "lines", "upper", "digits", "blank", "bars", "signs", "bangs", "stops", "beyond_ascii", "word_length",
    "distinct_words", "short_words", "adjacent_repeats", "line_repeats", "capital_words", "words_per_line",
)


def share(part: float, whole: float) -> float:
    """A share on a logarithmic scale that tells none from few."""
    return math.log(part / max(whole, 1) + 0.002)


def statistics(text: str) -> list[float]:
    """The transformed statistics of a whole text, in the order of NAMES; an empty text has those of no characters."""
    data = text.encode("utf-8", "replace")
    n = np.bincount(np.frombuffer(data, np.uint8), minlength=256)
    words, lines = text.split(), [x for x in text.split("\n") if x]
    distinct = len(set(words))
    upper, lower = int(n[65:91].sum()), int(n[97:123].sum())
    size = len(data)
    return [
        math.log1p(size), math.log1p(len(words)), math.log1p(len(lines)), share(upper, upper + lower), share(int(n[48:58].sum()), size),
        share(int(n[9:14].sum() + n[32]), size), share(int(n[124]), size), share(int(n[35:39].sum() + n[42]), size), share(int(n[33]), size),
        share(int(n[44] + n[46]), size), share(int(n[128:].sum()), size), math.log1p((size - len(words)) / max(len(words), 1)),
        math.log1p(distinct) / math.log1p(len(words)) if words else 0.0, share(sum([len(w) <= 3 for w in words]), len(words)),
        share(sum(map(eq, words, words[1:])), len(words)), share(len(lines) - len(set(lines)), len(lines)),
        share(sum([w[0].isupper() for w in words]), len(words)), math.log1p(len(words) / max(len(lines), 1)),
    ]


@dataclass(frozen=True)
class Gauss:
    """A class: its mean, the inverse of its covariance's Cholesky factor, and log prior less half the log determinant."""

    mean: np.ndarray
    whiten: np.ndarray
    constant: float

    def log_density(self, x: np.ndarray) -> np.ndarray:
        return self.constant - 0.5 * (((x - self.mean) @ self.whiten.T) ** 2).sum(1)


def fit(moments: dict[int, tuple[float, np.ndarray, np.ndarray]], to_pooled: float, to_sphere: float) -> dict[int, Gauss]:
    """Classes from counts, sums and sums of outer products. Covariances shrink to the pooled one and to its mean
    variance; a class of few rows shrinks to the pooled one more, in proportion to features by rows."""
    total = sum(n for n, _, _ in moments.values())
    cov = {k: s2 / n - np.outer(s / n, s / n) for k, (n, s, s2) in moments.items()}
    pooled = sum(cov[k] * moments[k][0] for k in cov) / total
    d = len(pooled)
    out = {}
    for k, (n, s, _) in moments.items():
        a = min(1.0, to_pooled + d / (n + d))
        c = (1 - a) * cov[k] + a * pooled
        c = (1 - to_sphere) * c + to_sphere * max(np.trace(pooled) / d, 1e-6) * np.eye(d)
        low = np.linalg.cholesky(c)
        out[k] = Gauss(s / n, np.linalg.inv(low), math.log(n / total) - float(np.log(np.diag(low)).sum()))
    return out


def held_out(id_col: str, of: int, at: int) -> Column:
    """Rows of which no label is learned: crc32 of the id as text, mod of, is at. A null id is not among them."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % of == at, F.lit(False))


def table_of_statistics(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    def run(batches):
        drop_caches()
        for batch in batches:
            made = [statistics(t or "") for t in batch["text"].to_pylist()]
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(made, pa.list_(pa.float64()))], ["doc_id", "x"])

    return df.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, "doc_id long, x array<double>")


class Model:
    """scores(x): how likely label 1 is for each row of statistics."""

    def __init__(self, classes: dict[int, Gauss], constant: float):
        self.classes, self.constant = classes, constant

    @property
    def learned(self) -> bool:
        return bool(self.classes) or self.constant != 0.5

    def scores(self, x: np.ndarray) -> np.ndarray:
        if len(self.classes) < 2 or not len(x):
            return np.full(len(x), self.constant)
        gap = self.classes[1].log_density(x) - self.classes[0].log_density(x)
        return 1 / (1 + np.exp(-np.clip(gap, -500, 500)))


def fit_model(kept: DataFrame, labels: DataFrame, to_pooled: float, to_sphere: float, id_col: str, label_col: str) -> Model:
    """Moments of the classes come from all labelled rows that are not held out, summed by Spark; the driver gets one
    number for each class and pair of statistics. Ids with both labels or a null label teach nothing; with fewer than
    two classes the model is constant: the share of label 1, 0.5 without labels."""
    known = labels.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(label_col).cast("int").alias("y")).where("doc_id is not null and y in (0, 1)")
    known = known.groupBy("doc_id").agg(F.min("y").alias("y"), F.max("y").alias("z")).where("y = z").drop("z")
    rows = kept.where("not held_out").join(known, "doc_id").select("y", F.concat("x", F.array(F.lit(1.0))).alias("x"))

    def partial(batches):
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            y = batch["y"].to_numpy(zero_copy_only=False)
            x = batch["x"].flatten().to_numpy(zero_copy_only=False).reshape(len(y), -1)
            for k in np.unique(y).tolist():
                sums[k] = sums.get(k, 0) + x[y == k].T @ x[y == k]
        for k, s in sums.items():
            i, j = np.indices(s.shape)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(s.size, k), pa.int32()), pa.array(i.ravel(), pa.int32()), pa.array(j.ravel(), pa.int32()), pa.array(s.ravel())], ["y", "i", "j", "s"])

    d = len(NAMES)
    grid: dict[int, np.ndarray] = {}
    summed = rows.mapInArrow(partial, "y int, i int, j int, s double").groupBy("y", "i", "j").agg(F.sum(F.col("s").cast("decimal(38,12)")).alias("s"))
    for y, i, j, s in summed.collect():  # 2 * 19 * 19 rows
        grid.setdefault(y, np.zeros((d + 1, d + 1)))[i, j] = float(s)
    moments = {y: (g[d, d], g[d, :d], g[:d, :d]) for y, g in grid.items()}
    classes = fit(moments, to_pooled, to_sphere) if len(moments) == 2 else {}
    return Model(classes, 0.5 if not moments else float(1 in moments))


def score(df: DataFrame, labels: DataFrame, of: int = 4, at: int = 2, to_pooled: float = 0.3, to_sphere: float = 0.01, threshold: float = 0.7,
          id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> DataFrame:
    """Per row: doc_id, held_out, score (how likely label 1 is), predicted (1 if score >= threshold).

    Statistics of whole texts (null: empty) are made once and written to the shared folder. A score is the logistic of
    the classes' difference in log density and prior. Repeated rows get equal scores, the empty table no rows; see
    fit_model for missing labels.
    """
    kept = durable(table_of_statistics(df, id_col, text_col).withColumn("held_out", held_out("doc_id", of, at)))
    model = fit_model(kept, labels, to_pooled, to_sphere, id_col, label_col)

    def run(batches):
        drop_caches()
        for batch in batches:
            p = model.scores(batch["x"].flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, len(NAMES)))
            yield pa.RecordBatch.from_arrays([batch["doc_id"], batch["held_out"], pa.array(p), pa.array((p >= threshold).astype(np.int32))], ["doc_id", "held_out", "score", "predicted"])

    return kept.mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int")


def keep_good(df: DataFrame, labels: DataFrame, of: int = 4, at: int = 2, to_pooled: float = 0.3, to_sphere: float = 0.01, threshold: float = 0.7,
              id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> DataFrame:
    """The rows of df, with all its columns, whose score is at least the threshold. Their statistics are made again
    rather than joined, so no text is shuffled. All rows where nothing could be learned: without labels, or with none
    left that is not held out."""
    kept = durable(table_of_statistics(df, id_col, text_col).withColumn("held_out", held_out("doc_id", of, at)))
    model = fit_model(kept, labels, to_pooled, to_sphere, id_col, label_col)
    if not model.learned:
        return df

    def run(batches):
        drop_caches()
        for batch in batches:
            for k in range(0, batch.num_rows, 1000):
                some = batch.slice(k, 1000)
                x = np.array([statistics(t or "") for t in some[text_col].to_pylist()])
                yield some.filter(pa.array(model.scores(x) >= threshold))

    return df.mapInArrow(run, df.schema)
