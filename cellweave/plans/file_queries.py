"""Registered queries of files: catalogue pages, rasters and vector layers, written and read back by tasks."""

from __future__ import annotations

import datetime

from pyspark.sql import functions as F

from ..operators import outlines as O
from ..operators import polygons
from ..registry import query
from ..session import shared_path
from ..sinks import raster as W
from ..sources import catalogue as C
from ..sources import formats as F_
from ..sources import raster as R
from ..sources import vector as V

col = F.col

TILES = [f"T{n}ABC" for n in range(10, 40, 2)]
AREA = [(-20.5, -30.5), (60.5, -30.5), (60.5, 40.5), (-20.5, 40.5)]
TODAY = datetime.date(1996, 6, 30)


def saved_catalogue(t):
    """Pages of 200 order keys each, as a catalogue gives them."""
    o = t("orders").select(
        col("o_orderkey").alias("k"), col("o_custkey").alias("m"), col("o_orderdate").cast("timestamp").alias("d"), F.expr("double(o_custkey % 140 - 70)").alias("x"), F.expr("double(o_orderkey % 120 - 60)").alias("y")
    )
    stamp = lambda c: F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")
    name = F.format_string("S%dA_MSIL1C_%sT101010_N0500_R%03d_T%dABC_%d", 1 + col("m") % 2, F.date_format("d", "yyyyMMdd"), (col("m") % 143).cast("int"), (10 + col("m") % 40).cast("int"), "k")
    corner = lambda a, b: F.array(col("x") + a, col("y") + b)
    entry = F.struct(
        name.alias("Name"), F.concat(F.lit("/eodata/"), col("k").cast("string")).alias("S3Path"), F.struct(stamp("d").alias("Start")).alias("ContentDate"),
        stamp(F.expr("d + make_interval(0, 0, 0, int(k % 9))")).alias("PublicationDate"),
        F.struct(F.lit("Polygon").alias("type"), F.array(F.array(corner(0, 0), corner(3, 0), corner(3, 2), corner(0, 2), corner(0, 0))).alias("coordinates")).alias("GeoFootprint"),
    )
    path = shared_path(t.spark, "catalogue")
    last = o.agg(F.max(F.expr("k div 200"))).first()[0]
    C.write_pages(o.withColumn("p", F.expr("k div 200")), path, "p", entry, int(last or 0))
    return path


@query("s12_catalogue_source", """SELECT 'GRS_PC' AS processing_condition_name, d AS date, tile, CAST(strftime(d, '%Y%m%d') AS BIGINT) AS measurement_day, concat('/eodata/', CAST(k AS VARCHAR)) AS input_path, concat('S', CAST(1 + m % 2 AS VARCHAR)) AS mission
    FROM (SELECT o_orderkey AS k, o_custkey AS m, o_orderdate::TIMESTAMP AS d, concat('T', CAST(10 + o_custkey % 40 AS VARCHAR), 'ABC') AS tile, o_custkey % 140 - 70 AS x, o_orderkey % 120 - 60 AS y FROM orders)
    WHERE CAST(substr(tile, 2, 2) AS INT) < 40 AND CAST(substr(tile, 2, 2) AS INT) % 2 = 0 AND d > TIMESTAMP '1995-02-16' AND d < TIMESTAMP '1996-06-30 23:59:59.999'
    AND d + INTERVAL 1 DAY * CAST(k % 9 AS INT) > TIMESTAMP '1995-08-05' AND d + INTERVAL 1 DAY * CAST(k % 9 AS INT) < TIMESTAMP '1996-06-30 23:59:59.999' AND x <= 60.5 AND x + 3 >= -20.5 AND y <= 40.5 AND y + 2 >= -30.5""")
def _(t):
    return C.candidate_inputs(C.read_catalogue(t.spark, saved_catalogue(t), pages=4), "GRS_PC", "MSIL1C", TODAY, 330, 500, TILES, AREA)


#: Cells of the images that water and obs fill, with what is missing in the rectangle.
WATER_IMAGE = "image AS (SELECT tile, unnest(range(mr + 1)) AS r, mc FROM (SELECT tile, max(r) AS mr, max(c) AS mc FROM water GROUP BY tile)), cell AS (SELECT tile, r, unnest(range(mc + 1)) AS c FROM image)"


def saved_raster(t, cells, bands, layout):
    path = shared_path(t.spark, "raster")
    W.write_rasters(cells.withColumn("name", F.concat(F.lit("T"), col("tile").cast("string"))), path, bands, layout, "name")
    return path


@query("s01_k01_raster", f"WITH {WATER_IMAGE} SELECT concat('T', CAST(cell.tile AS VARCHAR)) AS file, CAST(cell.r AS INT) AS r, CAST(cell.c AS INT) AS c, CAST(coalesce(wl, 255) AS INT) AS b1 FROM cell LEFT JOIN water w ON w.tile = cell.tile AND w.r = cell.r AND w.c = cell.c", "water")
def _(t):
    return R.read_raster(t.spark, saved_raster(t, t("water"), ("wl",), W.Layout(block=16, overviews=(2, 4))))


@query("k01_raster_overview", f"WITH {WATER_IMAGE} SELECT concat('T', CAST(cell.tile AS VARCHAR)) AS file, CAST(cell.r // 4 AS INT) AS r, CAST(cell.c // 4 AS INT) AS c, CAST(coalesce(wl, 255) AS INT) AS b1 FROM cell LEFT JOIN water w ON w.tile = cell.tile AND w.r = cell.r AND w.c = cell.c WHERE cell.r % 4 = 0 AND cell.c % 4 = 0", "water")
def _(t):
    return R.read_raster(t.spark, saved_raster(t, t("water"), ("wl",), W.Layout(block=32, overviews=(2, 4))), level=2)


@query("s02_raster_bands", """WITH one AS (SELECT tile, r, c, max(red) AS red, max(green) AS green, max(nir) AS nir FROM bands GROUP BY 1, 2, 3)
    SELECT concat('T', CAST(tile AS VARCHAR)) AS file, r, c, CAST(red AS INT) AS b1, CAST(nir AS INT) AS b3 FROM one WHERE r BETWEEN 5 AND 30 AND c > 10""", "bands")
def _(t):
    one = t("bands").groupBy("tile", "r", "c").agg(F.max("red").alias("red"), F.max("green").alias("green"), F.max("nir").alias("nir"))
    path = saved_raster(t, one, ("red", "green", "nir"), W.Layout("i2", 16, (), predictor=2, no_data=-1))
    return R.read_raster(t.spark, path, bands=(1, 3)).where("r between 5 and 30 and c > 10 and b1 <> -1")


#: Areas of equal value in an uneven ground, and what Euler's formula says of their holes.
CLASSES = "CASE WHEN (z * 7 + r * 13 + c * 29) % 100 < 50 THEN 1 WHEN (z * 7 + r * 13 + c * 29) % 100 >= 85 THEN 2 ELSE 0 END"
POLYGONS = f"""WITH RECURSIVE x AS (SELECT tile, r, c, {CLASSES} AS v FROM dem), p AS (SELECT *, r * 1000000 + c AS id FROM x WHERE v <> 0),
    reach AS (SELECT id, tile, r, c, v, id AS label FROM p UNION SELECT p.id, p.tile, p.r, p.c, p.v, reach.label FROM reach JOIN p ON p.tile = reach.tile AND p.v = reach.v AND abs(p.r - reach.r) + abs(p.c - reach.c) = 1),
    l AS (SELECT tile, r, c, v, min(label) AS label FROM reach GROUP BY tile, r, c, v),
    n AS (SELECT l.tile, l.label, l.v, count(*) AS cells, count(a.label) + count(b.label) AS pairs, count(CASE WHEN d.label IS NOT NULL AND a.label IS NOT NULL AND b.label IS NOT NULL THEN 1 END) AS squares FROM l
        LEFT JOIN l a ON (a.tile, a.label, a.r, a.c) = (l.tile, l.label, l.r + 1, l.c) LEFT JOIN l b ON (b.tile, b.label, b.r, b.c) = (l.tile, l.label, l.r, l.c + 1) LEFT JOIN l d ON (d.tile, d.label, d.r, d.c) = (l.tile, l.label, l.r + 1, l.c + 1) GROUP BY 1, 2, 3)
    SELECT tile, v AS value, CAST(label // 1000000 AS INT) AS r, CAST(label % 1000000 AS INT) AS c, CAST(cells AS DOUBLE) AS area, 1 - (cells - pairs + squares) AS holes FROM n"""


@query("k10_polygons", POLYGONS, "dem")
def _(t):
    return O.polygons(t("dem").selectExpr("tile", "r", "c", f"{CLASSES} as v"), block=16).drop("wkt")


@query("s08_vector_cells", """SELECT p, CAST(r AS INT) AS r, CAST(c AS INT) AS c FROM (SELECT s_suppkey AS p, s_suppkey % 13 AS x, s_suppkey % 11 AS y FROM supplier) s, generate_series(0, 45) a(r), generate_series(0, 45) b(c)
    WHERE (c + 0.5 > x AND c + 0.5 < x + 10 AND r + 0.5 > y AND r + 0.5 < y + 8 AND NOT (c + 0.5 > x + 3 AND c + 0.5 < x + 6 AND r + 0.5 > y + 2 AND r + 0.5 < y + 5))
    OR (r + 0.5 > y + 10 AND r + 0.5 < y + 18 AND c + 0.5 - x > (r + 0.5 - y - 10) / 2 AND c + 0.5 - x < 9 - (r + 0.5 - y - 10) / 2)""")
def _(t):
    """Polygons of two parts, one with a hole, as WKB in metres of a grid of 20 with its corner at (600000, 5100000)."""
    at = lambda x, y: F.array(600000 + 20.0 * (col("x") + x), 5100000 - 20.0 * (col("y") + y))
    ring = lambda part, *points: F.struct(F.lit(part).alias("part"), F.array(*[at(*p) for p in points]).alias("points"))
    rings = F.array(
        ring(0, (0, 0), (10, 0), (10, 8), (0, 8), (0, 0)), ring(0, (3, 2), (3, 5), (6, 5), (6, 2), (3, 2)), ring(1, (0, 10), (9, 10), (5, 18), (4, 18), (0, 10)),
    )
    shapes = t("supplier").select(col("s_suppkey").alias("p"), F.expr("s_suppkey % 13").alias("x"), F.expr("s_suppkey % 11").alias("y")).select("p", V.wkb_of(rings).alias("wkb"))
    path = shared_path(t.spark, "layer")
    shapes.write.parquet(path)
    layer = t.spark.read.parquet(path).select("p", V.parsed_wkb("wkb").alias("rings"))
    return polygons.cells_inside(V.sides(layer, ["p"], transform=(600000.0, 20.0, 0.0, 5100000.0, 0.0, -20.0)), ["p"])


@query("s15_objects", "SELECT o_custkey % 20 AS k, CAST(1 AS BIGINT) AS files, CAST(sum(strlen(CAST(o_orderkey AS VARCHAR)) + 1) AS BIGINT) AS length FROM orders GROUP BY 1")
def _(t):
    path = shared_path(t.spark, "objects")
    lines = t("orders").select((col("o_custkey") % 20).alias("k"), col("o_orderkey").cast("string").alias("value"))
    lines.repartition("k").write.partitionBy("k").text(path)  # one object a key
    found = F_.read_objects(t.spark, path, "*.txt").withColumn("k", F.regexp_extract("path", "k=([0-9]+)/", 1).cast("bigint"))
    return found.groupBy("k").agg(F.count("*").alias("files"), F.sum("length").alias("length"))


@query("s19_lines", "SELECT concat('P', CAST(o_orderkey AS VARCHAR)) AS line FROM orders WHERE o_orderkey % 5 > 0")
def _(t):
    path = shared_path(t.spark, "lines")
    name = F.concat(F.lit("P"), col("o_orderkey").cast("string"))
    t("orders").select(F.when(col("o_orderkey") % 5 == 0, "  ").when(col("o_orderkey") % 3 == 0, F.concat(F.lit(" "), name, F.lit("  "))).otherwise(name).alias("value")).write.text(path)
    return F_.read_lines(t.spark, path)
