"""Resampling of images to other sizes by separable kernels, and the coarse smoothing of a band."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def linear(d: Column) -> Column:
    return F.greatest(1 - d, F.lit(0.0))


def cubic(d: Column) -> Column:
    """Through the values, with slopes of the neighbours' difference (a = -0.5)."""
    return F.when(d < 1, (1.5 * d - 2.5) * d * d + 1).when(d < 2, ((-0.5 * d + 2.5) * d - 4) * d + 2).otherwise(0.0)


def spline(d: Column) -> Column:
    """The cubic B-spline of the values themselves, as warping tools have it: it smooths, and is not made to pass through
    them by a filter beforehand."""
    return F.when(d < 1, (0.5 * d - 1) * d * d + 2 / 3).when(d < 2, (2 - d) * (2 - d) * (2 - d) / 6).otherwise(0.0)


#: By name: how far a kernel reaches, and its weight at a distance from 0 on, in cells.
KERNELS: dict[str, tuple[int, Callable[[Column], Column]]] = {"bilinear": (1, linear), "cubic": (2, cubic), "cubicspline": (2, spline)}


def shapes(cells: DataFrame) -> DataFrame:
    """tile, height, width: to the highest row and column. One row a tile."""
    return cells.groupBy("tile").agg((F.max("r") + 1).alias("height"), (F.max("c") + 1).alias("width"))


def along(x: str, size: str, new: str, kernel: str) -> Column:
    """The places of the new size that a cell at x takes part in, with its weight there. A kernel that makes an image
    smaller is stretched, so that every cell counts."""
    reach, weight = KERNELS[kernel]
    step = F.col(size) / F.col(new)
    wide = F.greatest(step, F.lit(1.0))
    at = F.col(x) + 0.5
    low = F.greatest(F.lit(0), F.floor((at - reach * wide) / step - 0.5).cast("int") + 1)
    high = F.least(F.col(new) - 1, F.ceil((at + reach * wide) / step - 0.5).cast("int") - 1)
    found = F.transform(F.sequence(low, high), lambda j: F.struct(j.alias("to"), weight(F.abs((j + 0.5) * step - at) / wide).alias("w")))
    return F.when(low <= high, found)


def resize(cells: DataFrame, band: str, shape: DataFrame, kernel: str) -> DataFrame:
    """tile, r, c, band of images in the sizes of shape (tile, height, width, new_height, new_width), whose corners stay.

    First along rows, then along columns: each cell is sent to the few places along one line that it takes part in, and
    sums of values and of weights are kept apart, so a result is the mean over the cells that there are, at the border and
    around missing ones too. Places whose weights sum to nothing are left out; null values are missing cells. shape has a
    row a tile.
    """
    some = cells.where(F.col(band).isNotNull()).select("tile", "r", "c", F.col(band).cast("double").alias("z"))
    across = some.join(F.broadcast(shape), "tile")  # a row a tile
    first = across.select("tile", "r", "z", "height", "new_height", F.explode(along("c", "width", "new_width", kernel)).alias("o"))
    lines = first.groupBy("tile", "r", F.col("o.to").alias("c"), "height", "new_height").agg(F.sum(F.col("z") * F.col("o.w")).alias("z"), F.sum("o.w").alias("w"))
    second = lines.select("tile", "c", "z", "w", F.explode(along("r", "height", "new_height", kernel)).alias("o"))
    g = second.groupBy("tile", F.col("o.to").alias("r"), "c").agg(F.sum(F.col("z") * F.col("o.w")).alias("z"), F.sum(F.col("w") * F.col("o.w")).alias("w"))
    return g.where("w > 1e-6").select("tile", "r", "c", (F.col("z") / F.col("w")).alias(band))


def nearest(cells: DataFrame, shape: DataFrame) -> DataFrame:
    """Images in the sizes of shape: each place has the cell that its centre lies in. Other columns are kept."""

    def places(x: str, size: str, new: str) -> Column:
        step = F.col(size) / F.col(new)
        low, high = F.ceil(F.col(x) / step - 0.5).cast("int"), F.least(F.col(new), F.ceil((F.col(x) + 1) / step - 0.5).cast("int")) - 1
        return F.when(low <= high, F.sequence(low, high))

    rest = [c for c in cells.columns if c not in ("tile", "r", "c")]
    wide = cells.join(F.broadcast(shape), "tile").withColumn("_r", F.explode(places("r", "height", "new_height"))).withColumn("_c", F.explode(places("c", "width", "new_width")))
    return wide.select("tile", F.col("_r").alias("r"), F.col("_c").alias("c"), *rest)


def enlarge(cells: DataFrame, band: str, k: int, kernel: str) -> DataFrame:
    """Images k times as large either way."""
    shape = shapes(cells).select("*", (F.col("height") * k).alias("new_height"), (F.col("width") * k).alias("new_width"))
    return resize(cells, band, shape, kernel)


def coarse(cells: DataFrame, band: str, k: int = 12) -> DataFrame:
    """A band seen from afar: made k times smaller (whole sizes, at least one cell) by the bilinear kernel, and given back to
    all cells of the image by the nearest place."""
    small = shapes(cells).select("*", *[F.greatest(F.lit(1), F.floor(F.col(x) / k).cast("int")).alias(f"new_{x}") for x in ("height", "width")])
    back = small.select("tile", F.col("new_height").alias("height"), F.col("new_width").alias("width"), F.col("height").alias("new_height"), F.col("width").alias("new_width"))
    return nearest(resize(cells, band, small, "bilinear"), back)
