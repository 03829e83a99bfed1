"""Toxicity scores by boosted trees over dense features, calibrated isotonically."""

from __future__ import annotations

import math
import re
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import drop_caches, durable
from .quality import held_out
from .trees import Boosted, boost, isotonic

#: Words that address a reader, in four languages.
SECOND_PERSON = frozenset("you your yours yourself u ur du dich dir dein deine ihr euch tu te toi ton ta tes vous votre vos usted ustedes tú ti tus vosotros".split())
#: Insults that count before anything is learned.
INSULTS = frozenset("idiot moron stupid scum trash loser worthless pathetic disgusting clown dumb imbecile vermin filth".split())
UNMASK = str.maketrans({"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "!": "i", "*": "", ".": "", "-": "", "_": "", "#": "", "%": "", "&": "", "|": ""})
STRIP = ".,;:!?\"'()[]{}<>*%$&#|"
STARTS = (4, 5, 6, 7, 8)
MASKED = re.compile(r"[^\W\d_][\d@$*!][^\W\d_]")
NAMES = (
    "strong_rate", "weight_rate", "top_weight", "strong", "distinct_strong", "medium", "near_reader", "reader_rate", "unmasked", "masked_rate",
    "capitals", "bangs", "questions", "punctuation", "repeats", "words",
)
BOUND = 20_000  # labelled rows that the trees and the lexicon are fitted on, at most
LEAST = 4  # toxic documents of those rows that hold a key of the lexicon, at least
FOLDS = 5
SURE = 3.0  # standard deviations by which they outnumber what chance would give, at least


def keys_of(word: str) -> list[str]:
    """What the lexicon may hold of a word: itself, closed by a blank, and its starts."""
    return [word + " ", *[word[:k] for k in STARTS if len(word) >= k]]


class Features:
    """Features of whole texts under a lexicon of weights (log odds of toxic to clean documents)."""

    def __init__(self, lexicon: dict[str, float]):
        self.lexicon, self.weights = lexicon, {}

    def weight(self, chunk: str) -> float:
        word = chunk.strip(STRIP)
        w = max([self.lexicon.get(k, 0.0) for k in keys_of(word)])
        if word in INSULTS:
            w = max(w, 4.0)
        if len(chunk) <= 40:
            self.weights[chunk] = w
        return w

    def of(self, text: str) -> list[float]:
        chunks = text.lower().split()
        if len(self.weights) > 300_000:
            self.weights = {}
        get, weight = self.weights.get, self.weight
        found = [w if (w := get(c)) is not None else weight(c) for c in chunks]
        hits = [(k, w) for k, w in enumerate(found) if w >= 1.0]
        strong = [k for k, w in hits if w >= 2.5]
        n, size = max(len(chunks), 1), max(len(text), 1)
        near = sum(any(c.strip(STRIP) in SECOND_PERSON for c in chunks[max(0, k - 4) : k + 5]) for k in strong)
        odd = MASKED.findall(text)
        unmasked = 0
        if odd:
            unmasked = sum(self.weight(c.translate(UNMASK)) >= 2.5 for c in chunks if MASKED.search(c))
        upper = sum(map(str.isupper, text)) if not text.isupper() else size
        marks = sum(map(text.count, ".,;:!?*%$&#|"))
        return [
            len(strong) / n, sum([w for _, w in hits]) / n, max([w for _, w in hits], default=0.0), math.log1p(len(strong)), math.log1p(len({chunks[k] for k in strong})),
            math.log1p(len(hits)), near / max(len(strong), 1), sum(map(SECOND_PERSON.__contains__, chunks)) / n, unmasked / n, len(odd) / n,
            upper / size, text.count("!") / size, text.count("?") / size, marks / size, sum(map(eq, chunks, chunks[1:])) / n, math.log1p(len(chunks)),
        ]


def learn_lexicon(counts: list[tuple[str, int, int]], toxic: int, clean: int) -> dict[str, float]:
    """Weights of all keys that are far more frequent in toxic documents than chance would make them. Nothing is ranked
    or cut off: the rows that counts come from bound the keys."""
    out = {}
    for key, t, c in counts:
        w = math.log((t + 0.3) / (toxic + 1)) - math.log((c + 0.3) / (clean + 1))
        chance = (t + c) * toxic / max(toxic + clean, 1)
        if w >= 1.0 and t - chance >= SURE * math.sqrt(max(chance * clean / max(toxic + clean, 1), 0.25)):
            out[key] = min(w, 6.0)
    return out


class Model:
    """scores(texts): how likely label 1 is for each."""

    def __init__(self, lexicon: dict[str, float], trees: Boosted | None, knots: tuple[np.ndarray, np.ndarray] | None, constant: float):
        self.lexicon, self.trees, self.knots, self.constant = lexicon, trees, knots, constant

    def features(self) -> Features:
        return Features(self.lexicon)

    def scores(self, texts: list[str | None], features: Features) -> np.ndarray:
        if self.trees is None or not texts:
            return np.full(len(texts), self.constant)
        return np.interp(self.trees.raw(np.array([features.of(t or "") for t in texts])), *self.knots)


def fit(df: DataFrame, labels: DataFrame, of: int, at: int, bound: int, id_col: str, text_col: str, label_col: str) -> Model:
    """Lexicon, trees and calibration from labelled rows that are not held out: all of them, or about bound rows chosen
    by a hash of the id where there are more. The lexicon comes from document counts that Spark sums. The rows are dealt
    into FOLDS parts by a hash of the id: trees see features made with a lexicon of the other parts, and the calibration
    raw scores of trees fitted on the other parts. So each lexicon and each tree rests on nearly as many rows as those
    that score later, on small tables too. Ids with both labels or a null label teach nothing; with fewer than four rows
    of a class the model is constant: 1 where at least half of the labels are 1, else 0.
    """
    known = labels.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(label_col).cast("int").alias("y")).where("doc_id is not null and y in (0, 1)")
    known = known.groupBy("doc_id").agg(F.min("y").alias("y"), F.max("y").alias("z")).where("y = z").drop("z").where(~held_out("doc_id", of, at))
    part = min(1.0, bound / max(known.count(), 1))
    chosen = known.where(F.pmod(F.xxhash64("doc_id", F.lit(7)), F.lit(1_000_000)) < int(part * 1_000_000))
    chosen = chosen.withColumn("fold", F.pmod(F.xxhash64("doc_id", F.lit(11)), F.lit(FOLDS)).cast("int"))
    docs = df.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    train = durable(docs.join(F.broadcast(chosen), "doc_id"))  # about bound rows of three numbers meet all documents once

    names = [f"{c}{k}" for k in range(FOLDS) for c in "tc"]  # documents of each fold that hold a key, toxic and clean

    def count_keys(batches):
        drop_caches()
        counts: dict[str, list[int]] = {}
        for batch in batches:
            for text, y, fold in zip(batch["text"].to_pylist(), batch["y"].to_pylist(), batch["fold"].to_pylist(), strict=True):
                words = {c.strip(STRIP) for c in (text or "").lower().split()}
                for key in {k for w in words for k in keys_of(w)}:
                    counts.setdefault(key, [0] * len(names))[2 * fold + (1 - y)] += 1
        keys = list(counts)
        for k in range(0, len(keys), 20_000):
            some = keys[k : k + 20_000]
            yield pa.RecordBatch.from_arrays([pa.array(some), *[pa.array([counts[x][j] for x in some], pa.int64()) for j in range(len(names))]], ["key", *names])

    counted = train.mapInArrow(count_keys, "key string, " + ", ".join(f"{c} long" for c in names))
    sums = counted.groupBy("key").agg(*[F.sum(c).alias(c) for c in names])
    size = {(y, k): n for y, k, n in train.groupBy("y", "fold").count().collect()}
    toxic, clean = (sum(n for (y, _), n in size.items() if y == k) for k in (1, 0))
    often = 2.5 * toxic / max(clean, 1)
    all_t, all_c = ("(" + " + ".join(names[j::2]) + ")" for j in (0, 1))
    sums = sums.where(f"{all_t} >= {LEAST} and {all_t} >= {often} * {all_c}")
    if min(toxic, clean) < 4:
        return Model({}, None, None, float(toxic >= clean and toxic > 0))
    rows = [(r[0], np.array(r[1::2]), np.array(r[2::2])) for r in sums.orderBy("key").collect()]  # keys of about bound rows, each in several of them
    whole = learn_lexicon([(key, int(t.sum()), int(c.sum())) for key, t, c in rows], toxic, clean)

    def without(k: int) -> dict[str, float]:
        """The lexicon of all folds but one, under the same conditions."""
        others = [(key, int(t.sum() - t[k]), int(c.sum() - c[k])) for key, t, c in rows]
        return learn_lexicon([x for x in others if x[1] >= LEAST - 1], toxic - size.get((1, k), 0), clean - size.get((0, k), 0))

    lexicons = [without(k) for k in range(FOLDS)]

    def featured(batches):
        by_fold = [Features(x) for x in lexicons]
        for batch in batches:
            made = [by_fold[k].of(t or "") for t, k in zip(batch["text"].to_pylist(), batch["fold"].to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch["doc_id"], batch["y"], batch["fold"], pa.array(made, pa.list_(pa.float64()))], ["doc_id", "y", "fold", "x"])

    got = train.mapInArrow(featured, "doc_id long, y int, fold int, x array<double>").orderBy("doc_id").toPandas()  # about bound rows
    x, y, fold = np.array(got["x"].tolist()), got["y"].to_numpy(float), got["fold"].to_numpy()
    raw = np.zeros(len(y))
    for k in range(FOLDS):
        if (fold == k).any() and (fold != k).any():
            raw[fold == k] = boost(x[fold != k], y[fold != k]).raw(x[fold == k])
    return Model(whole, boost(x, y), isotonic(raw, y), 0.0)


def score(df: DataFrame, labels: DataFrame, of: int = 5, at: int = 0, threshold: float = 0.5, bound: int = BOUND,
          id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> DataFrame:
    """Per row: doc_id, held_out, score (how likely label 1 is), predicted (1 if score >= threshold).

    Each whole text (null: empty) is scored in one pass by the fitted model. Repeated rows get equal scores, the empty
    table no rows; see fit for missing labels.
    """
    model = fit(df, labels, of, at, bound, id_col, text_col, label_col)

    def run(batches):
        drop_caches()
        features = model.features()
        for batch in batches:
            for k in range(0, batch.num_rows, 1000):
                some = batch.slice(k, 1000)
                p = model.scores(some["text"].to_pylist(), features)
                yield pa.RecordBatch.from_arrays([some["doc_id"], some["held_out"], pa.array(p), pa.array((p >= threshold).astype(np.int32))], ["doc_id", "held_out", "score", "predicted"])

    docs = df.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return docs.select("doc_id", held_out("doc_id", of, at).alias("held_out"), "text").mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int")


def keep_clean(df: DataFrame, labels: DataFrame, of: int = 5, at: int = 0, threshold: float = 0.5, bound: int = BOUND,
               id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> DataFrame:
    """The rows of df, with all its columns, whose score is under the threshold. Nothing is shuffled but what fit needs.
    Null texts are scored as empty ones, repeated rows stay or go together, the empty table gives no rows."""
    model = fit(df, labels, of, at, bound, id_col, text_col, label_col)

    def run(batches):
        drop_caches()
        features = model.features()
        for batch in batches:
            for k in range(0, batch.num_rows, 1000):
                some = batch.slice(k, 1000)
                yield some.filter(pa.array(model.scores(some[text_col].to_pylist(), features) < threshold))

    return df.mapInArrow(run, df.schema)
