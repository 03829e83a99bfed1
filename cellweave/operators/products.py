"""Products beside products: block decisions with wet snow, resampling between cells, transitions, outlines of valid areas."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .grid import block

# Codes of the wet and dry snow layer and of the wet-snow mask, and the mean cover from which a block is snow.
WET, DRY, SNOW_FREE, CLOUD, WATER, MASKED, NODATA = 110, 115, 120, 205, 210, 250, 255
MASK_WET, MASK_NOT_WET, SNOWY = 110, 125, 60


def wet_snow(cover: DataFrame, coarse: DataFrame, k: int, order: str = "d") -> DataFrame:
    """State of snow of each coarse cell: value and quality.

    cover holds scenes of fine cells (tile, r, c, v and the order), k times k to a coarse cell (tile, r, c, wet, quality of
    wet, mask, nodata). A scene observes a block when more than half of it is in range; its mean then says snow or free of
    snow. Else cloud, else water, takes the block where it outnumbers the other cells without observation, but not once
    the block was observed. Scenes write in order; a snow block that is neither wet nor not wet writes nothing. Masks
    cover observed blocks, nodata all.
    """
    key = ["tile", "r", "c"]
    v, at = F.col("v"), F.col(order)
    seen, cloud, water = (F.count_if(x) for x in (v.between(0, 100), v == CLOUD, v == WATER))
    agg = block(cover, k).groupBy(*key, order).agg(seen.alias("seen"), cloud.alias("cloud"), water.alias("water"), F.sum(F.when(v.between(0, 100), v)).alias("s"))
    rest, observed = k * k - F.col("seen"), F.col("seen") > k * k // 2
    scenes = agg.join(coarse, key).withColumn("first", F.min(F.when(observed, at)).over(Window.partitionBy(*key)))
    snow, early = F.col("s") >= SNOWY * F.col("seen"), F.col("first").isNull() | (at < F.col("first"))
    value = F.when(observed, F.when(~snow, SNOW_FREE).when(F.col("wet") == MASK_WET, WET).when(F.col("wet") == MASK_NOT_WET, DRY)).when(
        early, F.when(2 * F.col("cloud") > rest, CLOUD).when(2 * F.col("water") > rest, WATER)
    )
    wrote = scenes.withColumn("value", value)
    last = wrote.groupBy(*key).agg(
        F.max_by(F.when(F.col("value").isNotNull(), F.struct("value", "quality")), F.when(F.col("value").isNotNull(), at)).alias("x"),
        F.first("mask").alias("mask"), F.first("nodata").alias("nodata"), F.first(F.col("first").isNotNull()).alias("observed"),
    )
    masked = F.col("observed") & (F.col("mask") != 0)
    quality = F.when(F.col("x.value") == WET, F.col("x.quality")).when(F.col("x").isNotNull(), MASKED).otherwise(NODATA)
    return last.select(
        *key, F.when(F.col("nodata"), NODATA).when(masked, F.col("mask")).otherwise(F.coalesce("x.value", F.lit(NODATA))).cast("int").alias("v"),
        F.when(F.col("nodata"), NODATA).when(masked, MASKED).otherwise(quality).cast("int").alias("quality"),
    )


def macro_class(cls: Column) -> Column:
    """Fourteen classes as layer codes: water 1, ice 100, other 254; nodata and none 255, unknown ones 0."""
    return F.when(cls.isin(6, 8, 9), 1).when(cls.isin(7, 10, 11), 100).when(cls.isin(1, 2, 3, 4, 5, 12, 13, 14), 254).when(cls.isin(0, 255), 255).otherwise(0)


def bilinear(coarse: DataFrame, targets: DataFrame, band: str, k: int) -> DataFrame:
    """Values of coarse cells at the centres of k times finer ones (targets: tile, r, c), linear between the centres of the
    four coarse cells around; beyond the outer centres the nearest ones count, with the weights of what is there.

    Targets between the same four centres share them: each coarse cell is sent to the four places that it is a corner of,
    and targets meet these by one equi-join, after which no row moves. Corners keep sums and counts, so repeated cells
    count as often as they come, and those without a value in the weights alone."""
    at = lambda x: (F.col(x) + 0.5) / k - 0.5
    corners = [(i, j) for i in (0, 1) for j in (0, 1)]
    corner = F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i, j in corners]))
    sent = coarse.select("tile", "r", "c", F.col(band).cast("double").alias("z"), corner.alias("o")).select("tile", (F.col("r") - F.col("o.i")).alias("r0"), (F.col("c") - F.col("o.j")).alias("c0"), (2 * F.col("o.i") + F.col("o.j")).alias("o"), "z")
    places = sent.groupBy("tile", "r0", "c0").agg(*[f.alias(f"{name}{o}") for o in range(4) for name, f in (("z", F.sum(F.when(F.col("o") == o, F.col("z")))), ("n", F.count_if(F.col("o") == o)))])
    low = targets.select("tile", "r", "c", F.floor(at("r")).cast("int").alias("r0"), F.floor(at("c")).cast("int").alias("c0"))
    y, x = at("r") - F.col("r0"), at("c") - F.col("c0")
    w = [(y if i else 1 - y) * (x if j else 1 - x) for i, j in corners]
    met = low.join(places, ["tile", "r0", "c0"])
    above = F.when(F.coalesce(*[F.col(f"z{o}") for o in range(4)]).isNotNull(), sum(F.coalesce(F.col(f"z{o}"), F.lit(0.0)) * w[o] for o in range(4)))
    value = F.round(above / sum(F.col(f"n{o}") * w[o] for o in range(4)), 6)
    return met.groupBy("tile", "r0", "c0", "r", "c").agg(F.first(value).alias(band)).select("tile", "r", "c", band)


def transitions(cells: DataFrame, filled: Column, before: Column, reference: Column, by: list[str]) -> DataFrame:
    """What filling clouds did against a reference: clouds removed where the reference is clear, and of those the four
    ways in which snow and land were met; shares of the removed are 0 where there are none."""
    was = before == 205
    hit = lambda a, b: F.count_if(was & (filled == a) & (reference == b))
    g = cells.groupBy(*by).agg(
        F.count_if(was).alias("clouds"), F.count_if(was & (filled != 205) & (reference != 205)).alias("removed"),
        hit(100, 100).alias("snow_to_snow"), hit(0, 0).alias("land_to_land"), hit(0, 100).alias("snow_to_land"), hit(100, 0).alias("land_to_snow"),
    )
    right = F.col("snow_to_snow") + F.col("land_to_land")
    return g.withColumn("right_share", F.round(F.coalesce(F.try_divide(100.0 * right, F.col("removed")), F.lit(0.0)), 6))


def hulls(extremes: DataFrame, by: list[str]) -> DataFrame:
    """Convex hulls, as polygons in text, of areas given by the leftmost and rightmost cell of each row (r, c0, c1). Only
    the corners of a row's two ends are sent: two numbers a row of the image in a group."""

    def one(pdf):
        ends = pdf.groupby("r").agg(c0=("c0", "min"), c1=("c1", "max")).reset_index()
        points = sorted({(int(c), int(r)) for r0, a, b in zip(ends["r"], ends["c0"], ends["c1"], strict=True) for r in (r0, r0 + 1) for c in (a, b + 1)})
        half = []
        for way in (points, points[::-1]):
            out: list[tuple[int, int]] = []
            for p in way:
                while len(out) > 1 and (out[-1][0] - out[-2][0]) * (p[1] - out[-2][1]) - (out[-1][1] - out[-2][1]) * (p[0] - out[-2][0]) <= 0:
                    out.pop()
                out.append(p)
            half.append(out[:-1])
        ring = half[0] + half[1]
        row = pdf.iloc[:1][by].copy()
        row["wkt"] = "POLYGON((" + ",".join(f"{x} {y}" for x, y in [*ring, ring[0]]) + "))"
        row["area"] = abs(sum(a[0] * b[1] - b[0] * a[1] for a, b in zip(ring, ring[1:] + ring[:1], strict=True))) / 2
        return row

    schema = ", ".join(f"{k} {extremes.schema[k].dataType.simpleString()}" for k in by)
    return extremes.groupBy(*by).applyInPandas(one, f"{schema}, wkt string, area double")


def utm_to_degrees(x: Column, y: Column, zone: Column) -> tuple[Column, Column]:
    """Longitude and latitude on the WGS84 ellipsoid of northern UTM coordinates, by the usual series in the footpoint
    latitude; good to a few millimetres within a zone."""
    # The ellipsoid and the projection.
    a, f, k0 = 6378137.0, 1 / 298.257223563, 0.9996
    e2 = f * (2 - f)
    ep2, e1 = e2 / (1 - e2), (1 - (1 - e2) ** 0.5) / (1 + (1 - e2) ** 0.5)
    mu = y / k0 / (a * (1 - e2 / 4 - 3 * e2**2 / 64 - 5 * e2**3 / 256))
    p = mu + (3 * e1 / 2 - 27 * e1**3 / 32) * F.sin(2 * mu) + (21 * e1**2 / 16 - 55 * e1**4 / 32) * F.sin(4 * mu) + (151 * e1**3 / 96) * F.sin(6 * mu) + (1097 * e1**4 / 512) * F.sin(8 * mu)
    s, c, t = F.sin(p), F.cos(p), F.tan(p)
    n, r = a / F.sqrt(1 - e2 * s * s), a * (1 - e2) / F.pow(1 - e2 * s * s, F.lit(1.5))
    c1, t1, d = ep2 * c * c, t * t, (x - 500000.0) / (n * k0)
    lat = p - n * t / r * (d**2 / 2 - (5 + 3 * t1 + 10 * c1 - 4 * c1**2 - 9 * ep2) * d**4 / 24 + (61 + 90 * t1 + 298 * c1 + 45 * t1**2 - 252 * ep2 - 3 * c1**2) * d**6 / 720)
    lon = (d - (1 + 2 * t1 + c1) * d**3 / 6 + (5 - 2 * c1 + 28 * t1 - 3 * c1**2 + 8 * ep2 + 24 * t1**2) * d**5 / 120) / c
    return F.degrees(lon) + zone * 6 - 183, F.degrees(lat)


def geographic_lookup(cells: DataFrame, zone: Column, transform: tuple[float, ...], grid: DataFrame, grid_transform: tuple[float, ...], band: str) -> DataFrame:
    """tile, r, c of UTM cells with the band of the nearest cell (mr, mc) of a geographic grid.

    transform gives x of the corner, x a column, x a row, y of the corner, y a column, y a row, of a cell's corner as the
    look-up takes it; grid_transform gives longitude and latitude likewise, of the grid's edges. Halves go to the even
    cell. Each cell computes its own place, so this is one equi-join; cells outside the grid are left out.
    """
    x0, sx, _, y0, _, sy = transform
    lon, lat = utm_to_degrees(x0 + F.col("c") * sx, y0 + F.col("r") * sy, zone)
    near = lambda v, first, step: F.bround((v - first - step / 2) / step, 0).cast("int")
    placed = cells.select("tile", "r", "c", near(lat, grid_transform[3], grid_transform[5]).alias("mr"), near(lon, grid_transform[0], grid_transform[1]).alias("mc"))
    return placed.join(grid.select("mr", "mc", band), ["mr", "mc"]).select("tile", "r", "c", "mr", "mc", band)


def geographic_bounds(boxes: DataFrame) -> DataFrame:
    """West, east, south and north in degrees of boxes (x0, y0, x1, y1, zone), from their four corners."""
    corner = [utm_to_degrees(F.col(x), F.col(y), F.col("zone")) for x in ("x0", "x1") for y in ("y0", "y1")]
    lon, lat = [c[0] for c in corner], [c[1] for c in corner]
    rest = [c for c in boxes.columns if c not in ("x0", "y0", "x1", "y1", "zone")]
    return boxes.select(*rest, *[F.round(x, 7).alias(n) for n, x in (("west", F.least(*lon)), ("east", F.greatest(*lon)), ("south", F.least(*lat)), ("north", F.greatest(*lat)))])


def tiles_of_footprints(footprints: DataFrame, tiles: DataFrame, size: int) -> DataFrame:
    """Distinct footprints (x0, y0, x1, y1) with the tiles (name and box) that they overlap. Both are dealt to the squares
    of size that they touch, so this is an equi-join; a pair that meets in several squares counts once."""

    def squares(df: DataFrame, x0: str, y0: str, x1: str, y1: str) -> DataFrame:
        step = lambda a, b: F.explode(F.sequence(F.floor(F.col(a) / size), F.floor(F.col(b) / size)))
        return df.withColumn("_x", step(x0, x1)).withColumn("_y", step(y0, y1))

    f = squares(footprints.select("x0", "y0", "x1", "y1").distinct(), "x0", "y0", "x1", "y1")
    t = squares(tiles.toDF("name", "tx0", "ty0", "tx1", "ty1"), "tx0", "ty0", "tx1", "ty1")
    met = f.join(t, ["_x", "_y"]).where("x0 < tx1 and tx0 < x1 and y0 < ty1 and ty0 < y1")
    return met.select("x0", "y0", "x1", "y1", "name").distinct()


def sun_grid(df: DataFrame, xml: str, *keys: str) -> DataFrame:
    """Cells of sun-angle grids in scene metadata: row, column, angle, and the centre's coordinates. The corner's centre
    is given; columns go east and rows south by their steps."""
    schema = "ulx DOUBLE, uly DOUBLE, step DOUBLE, Values_List STRUCT<VALUES: ARRAY<STRING>>"
    g = df.select(*keys, F.from_xml(xml, F.lit(schema)).alias("g")).select(*keys, "g.*")
    rows = g.select(*keys, "ulx", "uly", "step", F.posexplode("Values_List.VALUES").alias("r", "line"))
    cells = rows.select(*keys, "ulx", "uly", "step", "r", F.posexplode(F.split(F.trim("line"), " +")).alias("c", "angle"))
    return cells.select(*keys, "r", "c", F.col("angle").cast("double").alias("angle"), (F.col("ulx") + F.col("c") * F.col("step")).alias("x"), (F.col("uly") - F.col("r") * F.col("step")).alias("y"))


def outline(cells: DataFrame, by: list[str]) -> DataFrame:
    """The outline of areas of cells (tile, r, c): the sides whose other cell is not of the area, in the direction that has
    the area on its right. Each cell sends its four sides, so holes and parts need nothing of their own."""
    # The step to the other cell of a side, then the side's two ends from the cell's corner, as x and y.
    sides = ((-1, 0, 0, 0, 1, 0), (0, 1, 1, 0, 1, 1), (1, 0, 1, 1, 0, 1), (0, -1, 0, 1, 0, 0))
    names = ("i", "j", "a", "b", "e", "f")
    side = F.explode(F.array(*[F.struct(*[F.lit(v).alias(n) for n, v in zip(names, s, strict=True)]) for s in sides]))
    own = cells.select(*by, "tile", "r", "c").distinct()
    sent = own.select(*by, "tile", "r", "c", side.alias("s"))
    at = sent.select(
        *by, "tile", (F.col("r") + F.col("s.i")).alias("r"), (F.col("c") + F.col("s.j")).alias("c"),
        (F.col("c") + F.col("s.a")).alias("x0"), (F.col("r") + F.col("s.b")).alias("y0"), (F.col("c") + F.col("s.e")).alias("x1"), (F.col("r") + F.col("s.f")).alias("y1"),
    )
    return at.join(own, [*by, "tile", "r", "c"], "left_anti").select(*by, "tile", "x0", "y0", "x1", "y1")
