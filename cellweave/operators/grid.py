"""Aggregation of cells to coarser grids, resampling and overviews."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def block(df: DataFrame, k: int) -> DataFrame:
    """Row and column of the k times k block in place of those of the cell."""
    return df.withColumn("r", F.expr(f"cast(r div {k} as int)")).withColumn("c", F.expr(f"cast(c div {k} as int)"))


def upscale(df: DataFrame, k: int, classes: tuple[int, ...], by: tuple[str, ...] = ("tile", "d"), diagonal: bool = False, least: float = 0.0) -> DataFrame:
    """Blocks of k times k cells: the rounded mean of values up to 100 where there are any and they fill that least share
    of the block, else the class of most cells (the first listed of equal ones), else 255. No class replaces such a mean;
    with least 0 a single value makes one. diagonal takes each block's diagonal cells only, k times each."""
    if diagonal:
        df = df.where(F.expr(f"pmod(r, {k}) = pmod(c, {k})"))
    weight = k if diagonal else 1
    v = F.col("v")
    n = [F.count_if(v == x) * weight for x in classes]
    aggs = [(F.count_if(v.between(0, 100)) * weight).alias("ok"), F.avg(F.when(v.between(0, 100), v)).alias("m")]
    counts = block(df, k).groupBy(*by, "r", "c").agg(*aggs, *[x.alias(f"n{j}") for j, x in enumerate(n)])
    best = F.greatest(*[F.col(f"n{j}") for j in range(len(classes))]) if len(classes) > 1 else F.col("n0")
    pick = F.lit(255)
    for j in reversed(range(len(classes))):
        pick = F.when((F.col(f"n{j}") == best) & (best > 0), classes[j]).otherwise(pick)
    return counts.select(*by, "r", "c", F.when((F.col("ok") > 0) & (F.col("ok") >= least * k * k), F.rint("m").cast("int")).otherwise(pick).alias("v"), F.col("ok").cast("bigint").alias("ok"))


def upscale_bits(df: DataFrame, k: int, band: str, by: tuple[str, ...] = ("tile", "d"), bits: int = 8, diagonal: bool = False) -> DataFrame:
    """Blocks of k times k cells: each bit is set where it is in at least half of the block's cells; missing cells have
    none. diagonal as in upscale."""
    if diagonal:
        df = df.where(F.expr(f"pmod(r, {k}) = pmod(c, {k})"))
    weight = k if diagonal else 1
    n = [(F.count_if(F.col(band).bitwiseAND(1 << b) != 0) * weight).alias(f"n{b}") for b in range(bits)]
    counts = block(df, k).groupBy(*by, "r", "c").agg(*n)
    value = sum((F.when(2 * F.col(f"n{b}") >= k * k, 1 << b).otherwise(0) for b in range(bits)), F.lit(0))
    return counts.select(*by, "r", "c", value.cast("int").alias(band))


def vote(df: DataFrame, k: int, by: tuple[str, ...]) -> DataFrame:
    """State of a block of a scene: 1 observed (more than half of the cells), with the mean's class snow or free; 2 cloud
    or water where that outnumbers the other unobserved cells; 0 else."""
    v = F.col("v")
    agg = block(df, k).groupBy(*by, "r", "c").agg(
        F.count_if(v.between(0, 100)).alias("ok"), F.sum(F.when(v.between(0, 100), v)).alias("s"), F.count_if(v == 205).alias("cloud"), F.count_if(v == 210).alias("water")
    )
    rest = k * k - F.col("ok")
    seen = F.col("ok") > k * k // 2
    state = F.when(seen, 1).when((F.col("cloud") > rest - F.col("cloud")) | (F.col("water") > rest - F.col("water")), 2).otherwise(0)
    value = F.when(seen, F.when(F.col("s") >= 60 * F.col("ok"), 100).otherwise(0)).when(F.col("cloud") > rest - F.col("cloud"), 205).when(F.col("water") > rest - F.col("water"), 210).otherwise(255)
    return agg.select(*by, "r", "c", state.alias("state"), value.alias("v"))


def fold_scenes(votes: DataFrame, order: str) -> DataFrame:
    """Scenes of a block in order: the last observed one; without one, the last cloud or water."""
    at = F.col(order)
    seen, other = F.col("state") == 1, F.col("state") == 2
    return votes.groupBy("tile", "r", "c").agg(
        F.coalesce(F.max_by(F.when(seen, F.col("v")), F.when(seen, at)), F.max_by(F.when(other, F.col("v")), F.when(other, at)), F.lit(255)).alias("v")
    )


def multilook(df: DataFrame, k: int, *bands: str, by: tuple[str, ...] = ("tile", "d")) -> DataFrame:
    """Block means of bands, 0 unless all cells of all bands are positive."""
    aggs = [F.avg(b).alias(b) for b in bands]
    low = F.least(*[F.min(b) for b in bands]) if len(bands) > 1 else F.min(bands[0])
    g = block(df, k).groupBy(*by, "r", "c").agg(*aggs, low.alias("low"))
    return g.select(*by, "r", "c", *[F.when(F.col("low") > 0, F.round(b, 6)).otherwise(0.0).alias(b) for b in bands])


def average(df: DataFrame, k: int, band: str, by: tuple[str, ...]) -> DataFrame:
    return block(df, k).groupBy(*by, "r", "c").agg(F.round(F.avg(band), 6).alias(band))


def replicate(df: DataFrame, k: int) -> DataFrame:
    """Each cell as k times k finer ones."""
    step = F.sequence(F.lit(0), F.lit(k - 1))
    fine = df.withColumn("_i", F.explode(step)).withColumn("_j", F.explode(step))
    return fine.withColumn("r", (F.col("r") * k + F.col("_i")).cast("int")).withColumn("c", (F.col("c") * k + F.col("_j")).cast("int")).drop("_i", "_j")


def overview(df: DataFrame, k: int) -> DataFrame:
    """Every k-th cell of every k-th row, renumbered."""
    return block(df.where(F.expr(f"r % {k} = 0 and c % {k} = 0")), k)


def thumbnail(df: DataFrame, palette: DataFrame, k: int) -> DataFrame:
    """Overview cells as colours; codes that the palette lacks are transparent."""
    return overview(df, k).join(F.broadcast(palette), "v", "left").na.fill(0, ["red", "green", "blue", "alpha"])  # a palette has 256 rows at most
