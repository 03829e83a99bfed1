"""The downhill simplex finds what made the data, and counts its rounds as aggregations."""

import math

import numpy as np
from pyspark.sql import functions as F

from cellweave.operators import models


def test_known_coefficients_come_back(spark):
    x = np.linspace(-0.4, 1.0, 400)
    rows = [(float(v), 0.5 * math.tanh(3.1 * v - 0.9) + 0.5, k % 4 == 0) for k, v in enumerate(x)]
    df = spark.createDataFrame(rows, "x double, y double, test boolean").cache()
    a, b, error = models.simplex_cover(df.where("not test"), "x", "y", within=1e-6)
    assert abs(a - 3.1) < 1e-3 and abs(b + 0.9) < 1e-3 and error < 1e-4
    held = df.where("test").select(F.sqrt(F.avg((0.5 * F.tanh(a * F.col("x") + b) + 0.5 - F.col("y")) ** 2))).first()[0]
    assert held < 1e-3


def test_noise_gives_the_least_error_of_a_grid(spark):
    rng = np.random.default_rng(1)
    x = rng.uniform(-0.3, 0.9, 300)
    y = np.clip(0.5 * np.tanh(2.2 * x - 1.1) + 0.5 + rng.normal(0, 0.05, 300), 0, 1)
    df = spark.createDataFrame([(float(a), float(b)) for a, b in zip(x, y, strict=True)], "x double, y double").cache()
    _, _, error = models.simplex_cover(df, "x", "y")
    grid = min(math.sqrt(np.mean((0.5 * np.tanh(a * x + b) + 0.5 - y) ** 2)) for a in np.arange(1.5, 3, 0.05) for b in np.arange(-1.6, -0.6, 0.05))
    assert error <= grid + 1e-5


def test_no_rows(spark):
    assert models.simplex_cover(spark.createDataFrame([], "x double, y double"), "x", "y") == (3.0, -1.0, None)
