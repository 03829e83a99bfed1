"""Two-dimensional windows over cells: each cell is sent to the places that see it, then one aggregation a place."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import outlines

KEY = ["tile", "r", "c"]
FOUR = ((-1, 0), (1, 0), (0, -1), (0, 1))
EIGHT = tuple((i, j) for i in (-1, 0, 1) for j in (-1, 0, 1) if (i, j) != (0, 0))
NINE = (*EIGHT, (0, 0))


def around(cells: DataFrame, offsets, *columns: str) -> DataFrame:
    """A row for each cell and neighbour: place (tile, r, c), offset (i, j) of the neighbour and its columns as n_*. One
    row an offset and cell, so the volume does not depend on the image."""
    at = F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i, j in offsets])).alias("o")
    far = cells.select(*KEY, *columns, at)
    return far.select("tile", (F.col("r") - F.col("o.i")).cast("int").alias("r"), (F.col("c") - F.col("o.j")).cast("int").alias("c"), F.col("o.i").alias("i"), F.col("o.j").alias("j"), *[F.col(x).alias(f"n_{x}") for x in columns])


def four_vote(cells: DataFrame) -> DataFrame:
    """Cloud cells whose four neighbours all are snow become snow."""
    votes = around(cells, FOUR, "v").groupBy(*KEY).agg(F.count_if(F.expr("n_v = 100")).alias("snow"))
    return cells.join(votes, KEY, "left").select(*KEY, F.when((F.col("v") == 205) & (F.col("snow") == 4), 100).otherwise(F.col("v")).alias("v"))


def downhill_vote(cells: DataFrame) -> DataFrame:
    """Cloud cells with a snow neighbour that lies lower become snow."""
    lowest = around(cells, EIGHT, "v", "z").groupBy(*KEY).agg(F.min(F.when(F.col("n_v") == 100, F.col("n_z"))).alias("low"))
    return cells.join(lowest, KEY, "left").select(*KEY, F.when((F.col("v") == 205) & (F.col("low") < F.col("z")), 100).otherwise(F.col("v")).alias("v"))


def altitude_rule(cells: DataFrame, most_cloud: float = 30.0) -> DataFrame:
    """In tiles with little cloud: cloud under the lowest snow is bare, over the lowest snow above all bare cells snow."""
    v, z = F.col("v"), F.col("z")
    a = cells.groupBy("tile").agg((100.0 * F.count_if(v == 205) / F.count("*")).alias("cloudy"), F.min(F.when(v == 100, z)).alias("low"), F.max(F.when(v == 0, z)).alias("bare"))
    b = cells.join(F.broadcast(a), "tile").groupBy("tile").agg(F.min(F.when((v == 100) & (z > F.col("bare")), z)).alias("high"))
    x = cells.join(F.broadcast(a), "tile").join(F.broadcast(b), "tile")  # a row for each tile
    rule = F.when((v == 205) & (F.col("cloudy") < most_cloud), F.when(z < F.col("low"), 0).when(z > F.col("high"), 100).otherwise(v)).otherwise(v)
    return x.select(*KEY, rule.alias("v"))


def contour(cells: DataFrame) -> DataFrame:
    """Snow cells with a neighbour of the eight that is there and no snow."""
    other = around(cells, EIGHT, "v").groupBy(*KEY).agg(F.bool_or(F.col("n_v") != 100).alias("edge"))
    return cells.join(other, KEY, "left").select(*KEY, F.when((F.col("v") == 100) & F.coalesce("edge", F.lit(False)), 1).otherwise(0).alias("contour"))


def box_deviation(cells: DataFrame, band: str, half: int) -> DataFrame:
    """Local standard deviation in a square window cut at the border and at missing cells: each cell is sent to the rows
    that see it, then sums go along those rows. One shuffle, of as many rows a cell as the window is high."""
    row = Window.partitionBy("tile", "r").orderBy("c").rangeBetween(-half, half)
    sent = cells.select(*KEY, F.col(band).cast("double").alias("x"), F.explode(F.sequence(F.lit(-half), F.lit(half))).alias("i"))
    sent = sent.select("tile", (F.col("r") + F.col("i")).cast("int").alias("r"), "c", "x", (F.col("i") == 0).alias("own"))
    s = sent.select(*KEY, "own", F.count("*").over(row).alias("n"), F.sum("x").over(row).alias("s"), F.sum(F.col("x") * F.col("x")).over(row).alias("q")).where("own")
    m = F.col("s") / F.col("n")
    return s.select(*KEY, F.round(F.sqrt(F.greatest(F.col("q") / F.col("n") - m * m, F.lit(0.0))), 6).alias("deviation"))


def gradient_magnitude(cells: DataFrame, band: str) -> DataFrame:
    """Half the sum of the absolute Sobel responses, kernels divided by 8, plus one; interior cells only."""
    i, j, x = F.col("i"), F.col("j"), F.col(f"n_{band}")
    gx = F.sum(x * j * F.when(i == 0, 2).otherwise(1)) / 8.0
    gy = F.sum(x * i * F.when(j == 0, 2).otherwise(1)) / 8.0
    g = around(cells, NINE, band).groupBy(*KEY).agg(F.count("*").alias("n"), gx.alias("gx"), gy.alias("gy")).where("n = 9")
    return g.select(*KEY, F.round(0.5 * F.abs("gx") + 0.5 * F.abs("gy") + 1, 6).alias("gradient"))


def hillshade(cells: DataFrame, size: float, sun: tuple[float, float, float], least: float = 0.2) -> DataFrame:
    """Surface normal from a cell and its right and lower neighbours (the last row and column repeat themselves), its
    product with the sun's direction, and whether that is under least."""
    right, low = Window.partitionBy("tile", "r").orderBy("c"), Window.partitionBy("tile", "c").orderBy("r")
    z = F.col("z")
    dx, dy = (F.coalesce(F.lead("z").over(right), z) - z) / size, (F.coalesce(F.lead("z").over(low), z) - z) / size
    x = cells.select(*KEY, dx.alias("dx"), dy.alias("dy"))
    shade = (-F.col("dx") * sun[0] - F.col("dy") * sun[1] + sun[2]) / F.sqrt(F.col("dx") ** 2 + F.col("dy") ** 2 + 1)
    return x.select(*KEY, F.round(shade, 6).alias("shade"), (shade < least).cast("int").alias("mask"))


def smooth(cells: DataFrame, band: str, k: int) -> DataFrame:
    """The mean of a cell's k times k block, given back to each cell."""
    b = cells.withColumn("_r", F.expr(f"r div {k}")).withColumn("_c", F.expr(f"c div {k}"))
    means = b.groupBy("tile", "_r", "_c").agg(F.round(F.avg(band), 6).alias("smooth"))
    return b.join(means, ["tile", "_r", "_c"]).select(*KEY, "smooth")


def label(cells: DataFrame, value: Column) -> DataFrame:
    """Four-connected areas of cells with the value: each cell's label is the first cell (r, c) of its area in its tile."""
    return outlines.labels(cells.where(value))


def spans(labels: DataFrame, radius: int) -> DataFrame:
    """tile, label, r, c0, c1: what a disk of the radius (in cells, centre distance at most) covers as it goes over labelled
    cells, as one interval for each stretch of a row. Each run of a row's cells widens to one interval in each of the
    2 * radius + 1 rows that the disk reaches; intervals of a row that meet become one."""
    w = Window.partitionBy("tile", "label", "r").orderBy("c")
    runs = labels.select(*KEY, "label").distinct().withColumn("run", F.col("c") - F.row_number().over(w)).groupBy("tile", "label", "r", "run").agg(F.min("c").alias("c0"), F.max("c").alias("c1"))
    reach = F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.lit(math.isqrt(radius * radius - i * i)).alias("h")) for i in range(-radius, radius + 1)])).alias("o")
    wide = runs.select("tile", "label", "r", "c0", "c1", reach).select("tile", "label", (F.col("r") + F.col("o.i")).cast("int").alias("r"), (F.col("c0") - F.col("o.h")).alias("c0"), (F.col("c1") + F.col("o.h")).alias("c1"))
    row = Window.partitionBy("tile", "label", "r").orderBy("c0", "c1")
    opens = F.when(F.col("c0") <= F.max("c1").over(row.rowsBetween(Window.unboundedPreceding, -1)) + 1, 0).otherwise(1)
    parts = wide.withColumn("opens", opens).withColumn("part", F.sum("opens").over(row))
    return parts.groupBy("tile", "label", "r", "part").agg(F.min("c0").alias("c0"), F.max("c1").alias("c1")).drop("part")


def drop_islands(cells: DataFrame, labels: DataFrame, least_cloud: float, least_size: int, radius: int = 1) -> DataFrame:
    """Snow areas over a size become cloud where over a share of their ring is cloud. The ring is what a disk of the radius
    (1: the four neighbours) adds to an area, snow of other areas left out. All areas are judged by the cells as they came,
    so that none depends on which is judged first; with radius 1 that makes no difference."""
    size = labels.groupBy("tile", "label").agg(F.count("*").alias("size")).where(F.col("size") > least_size)
    large = labels.join(size, ["tile", "label"], "left_semi")
    ring = spans(large, radius).select("tile", "label", "r", F.explode(F.sequence(F.col("c0").cast("int"), F.col("c1").cast("int"))).alias("c"))
    bare = ring.join(labels.select(*KEY), KEY, "left_anti")
    cloudy = bare.join(cells.select(*KEY, "v"), KEY).groupBy("tile", "label").agg(F.avg((F.col("v") == 205).cast("double")).alias("share"))
    bad = cloudy.where(F.col("share") > least_cloud).select("tile", "label")
    hit = labels.join(bad, ["tile", "label"], "left_semi").select(*KEY, F.lit(1).alias("hit"))
    return cells.join(hit, KEY, "left").select(*KEY, F.when(F.col("hit") == 1, 205).otherwise(F.col("v")).alias("v"))
