"""Scoring of tree ensembles and calibration of the cover curve."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def nodes_of(tree: dict, features: list[str], classes: int) -> tuple[np.ndarray, ...]:
    """A decision tree, {"feature", "cut", "low", "high"} or {"shares": [...]} at leaves, as arrays by node: feature (-1 at
    leaves), cut, the nodes below, shares."""
    rows: list[list] = []

    def put(node: dict) -> int:
        at = len(rows)
        rows.append([-1, 0.0, at, at, node.get("shares", [0.0] * classes)])
        if "shares" not in node:
            rows[at][:2] = features.index(node["feature"]), node["cut"]
            rows[at][2], rows[at][3] = put(node["low"]), put(node["high"])
        return at

    put(tree)
    feature, cut, low, high, shares = zip(*rows, strict=True)
    return np.array(feature), np.array(cut, float), np.array(low), np.array(high), np.array(shares, float)


def features_of(tree: dict) -> set[str]:
    return set() if "shares" in tree else {tree["feature"]} | features_of(tree["low"]) | features_of(tree["high"])


def forest(df: DataFrame, trees: list[dict], classes: int) -> DataFrame:
    """Class of the largest mean share over the trees (the first of equal ones) and that share in percent. Trees go to the
    tasks as arrays of nodes, so their number and depth do not grow the plan; all rows of a batch take each step down a
    tree together. A null feature goes to the high side."""
    features = sorted(set().union(*map(features_of, trees)))
    flat = [nodes_of(t, features, classes) for t in trees]

    @F.pandas_udf("cls int, probability double")
    def score(columns: pd.DataFrame) -> pd.DataFrame:
        x = columns.to_numpy(float)
        row, mean = np.arange(len(x)), np.zeros((len(x), classes))
        for feature, cut, low, high, shares in flat:
            at = np.zeros(len(x), int)
            while (feature[at] >= 0).any():
                at = np.where(x[row, feature[at]] <= cut[at], low[at], high[at])
            mean += shares[at]
        mean /= len(flat)
        return pd.DataFrame({"cls": mean.argmax(1).astype("int32"), "probability": 100 * mean.max(1)})

    x = df.withColumn("_s", score(F.struct(*features)))
    return x.withColumn("cls", F.col("_s.cls")).withColumn("probability", F.round("_s.probability", 6)).drop("_s")


def calibrate_cover(df: DataFrame, index: str, cover: str, start: tuple[float, float] = (2.65, -1.42), rounds: int = 12) -> tuple[float, float]:
    """a and b of 0.5 * tanh(a * index + b) + 0.5 with the least squared error, by damped Gauss-Newton steps; each round
    is one aggregation of five sums."""
    a, b = start
    t = lambda p, q: F.tanh(p * F.col(index) + q)
    loss = lambda p, q: df.agg(F.avg((0.5 * t(p, q) + 0.5 - F.col(cover)) ** 2)).first()[0]
    if (best := loss(a, b)) is None:
        return a, b
    for _ in range(rounds):
        x, e, g = F.col(index), 0.5 * t(a, b) + 0.5 - F.col(cover), 0.5 * (1 - t(a, b) ** 2)
        s = df.agg(F.sum(g * x * g * x), F.sum(g * x * g), F.sum(g * g), F.sum(g * x * e), F.sum(g * e)).first()
        p, q, r, u, v = (float(z) for z in s)
        det = p * r - q * q
        if det <= 1e-12:
            break
        da, db, step = (r * u - q * v) / det, (p * v - q * u) / det, 1.0
        while step > 1e-3 and (now := loss(a - step * da, b - step * db)) > best:
            step /= 2
        if step <= 1e-3 or math.isclose(now, best, rel_tol=1e-12):
            break
        a, b, best = a - step * da, b - step * db, now
    return a, b


def simplex_cover(df: DataFrame, index: str, cover: str, start: tuple[float, float] = (3.0, -1.0), rounds: int = 200, within: float = 1e-4) -> tuple[float, float, float]:
    """a and b of 0.5 * tanh(a * index + b) + 0.5 with the least root mean squared error, and that error, by the downhill
    simplex. A round's six candidates (reflected, expanded, contracted on either side, and both shrunk corners) are known
    before it, so each round is one aggregation, whichever is taken. It ends when corners and their errors lie within the
    tolerance of the best. Without rows the start and a null error are given."""

    def losses(points: list[tuple[float, float]]) -> list[float | None]:
        x, y = F.col(index), F.col(cover)
        return list(df.agg(*[F.sqrt(F.avg((0.5 * F.tanh(a * x + b) + 0.5 - y) ** 2)) for a, b in points]).first())

    corners = [start, *[tuple(v * 1.05 if k == j else v for k, v in enumerate(start)) for j in range(2)]]
    found = losses(corners)
    if found[0] is None:
        return (*start, None)
    held = sorted(zip(found, corners, strict=True))
    for _ in range(rounds):
        (low, best), (middle, second), (high, worst) = held
        if max(abs(c - b) for p in (second, worst) for c, b in zip(p, best, strict=True)) <= within and high - low <= within:
            break
        centre = tuple((b + s) / 2 for b, s in zip(best, second, strict=True))
        away = lambda t: tuple(c + t * (c - w) for c, w in zip(centre, worst, strict=True))  # noqa: E731, B023
        shrunk = [tuple((b + v) / 2 for b, v in zip(best, p, strict=True)) for p in (second, worst)]
        points = [away(1.0), away(2.0), away(0.5), away(-0.5), *shrunk]
        reflected, expanded, outside, inside, *small = zip(losses(points), points, strict=True)
        if reflected[0] < low:
            new = [min(reflected, expanded)]
        elif reflected[0] < middle:
            new = [reflected]
        elif reflected[0] < high:
            new = [outside] if outside[0] <= reflected[0] else []
        else:
            new = [inside] if inside[0] < high else []
        held = sorted([*held[:2], *new]) if new else sorted([held[0], *small])
    return (*held[0][1], held[0][0])


def loss_grid(df: DataFrame, index: str, cover: str, test: Column, points: list[tuple[float, float]]) -> DataFrame:
    """The root mean squared error of 0.5 * tanh(a * index + b) + 0.5 on training and test rows at each point (a, b), in
    one aggregation of two sums a point."""
    loss = [F.pow(0.5 * F.tanh(a * F.col(index) + b) + 0.5 - F.col(cover), F.lit(2)) for a, b in points]
    sums = df.agg(*[F.sqrt(F.avg(F.when(test == t, x))).alias(f"{'test' if t else 'train'}{k}") for k, x in enumerate(loss) for t in (False, True)])
    rows = F.array(*[F.struct(F.round(F.lit(a), 6).alias("a"), F.round(F.lit(b), 6).alias("b"), F.round(F.col(f"train{k}"), 6).alias("train"), F.round(F.col(f"test{k}"), 6).alias("test")) for k, (a, b) in enumerate(points)])
    return sums.select(F.explode(rows).alias("p")).select("p.*")
