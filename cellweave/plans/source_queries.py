"""Registered queries of sources, sinks, models and streams."""

from __future__ import annotations

import datetime

from pyspark.sql import functions as F

from ..operators import models, polygons, selections
from ..registry import query
from ..sinks import formats as K
from ..sources import formats as S
from ..sources import missions as M
from ..session import SPLIT, shared_path
from ..streaming import status as ST
from ..streaming import timers as TM

col = F.col


@query("s01_blocks", "SELECT tile, r, c, wl FROM water", "water")
def _(t):
    return S.blocks_to_cells(S.cells_to_blocks(t("water"), 5, 5, "wl"), "wl").where("wl is not null")


@query("s02_s04_band_stack", "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate, swir, red, green, blue, nir FROM bands", "bands")
def _(t):
    b, key = t("bands"), ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate"]
    return b.select(*key, "swir", "red").join(b.select(*key, "green", "blue", "nir"), key)


@query("s03_one_band", "SELECT tile, r, c, CAST(max(red) AS SMALLINT) AS red FROM bands GROUP BY 1, 2, 3", "bands")
def _(t):
    return t("bands").groupBy("tile", "r", "c").agg(F.max("red").cast("smallint").alias("red"))


@query("s05_date_stack", "SELECT mission, count(*) AS n, sum(v)::BIGINT AS s FROM obs_raw GROUP BY mission", "obs_raw")
def _(t):
    o = t("obs_raw")
    a, b = o.where("mission = 'S1'"), o.where("mission = 'S2'")
    return a.unionByName(b).groupBy("mission").agg(F.count("*").alias("n"), F.sum("v").alias("s"))


NAMES = "n AS (SELECT o_orderkey AS id, concat('KIND', CAST(o_custkey % 3 AS VARCHAR), '_', strftime(o_orderdate, '%Y%m%dT%H%M%S'), '_S', CAST(1 + o_custkey % 2 AS VARCHAR), '_T', CAST(10 + o_custkey % 40 AS VARCHAR), 'ABC_V1_0') AS name FROM orders)"


def names(t):
    return t("orders").select(col("o_orderkey").alias("id"), F.concat(F.lit("KIND"), (col("o_custkey") % 3).cast("string"), F.lit("_"), F.date_format("o_orderdate", "yyyyMMdd'T'HHmmss"), F.lit("_S"), (1 + col("o_custkey") % 2).cast("string"), F.lit("_T"), (10 + col("o_custkey") % 40).cast("string"), F.lit("ABC_V1_0")).alias("name"))


@query("s17_name_parts", f"WITH {NAMES} SELECT id, split_part(name, '_', 1) AS kind, strptime(split_part(name, '_', 2), '%Y%m%dT%H%M%S') AS time, split_part(name, '_', 3) AS mission, substr(split_part(name, '_', 4), 2) AS tile, 'V1' AS version, '0' AS mode FROM n")
def _(t):
    return names(t).select("id", *[x.alias(k) for k, x in S.name_parts(col("name")).items()])


@query("s22_platform", """SELECT id, CASE WHEN k = 0 THEN 'sen2cor' WHEN k = 1 THEN 'sentinel-2' WHEN k = 2 THEN 'take5' WHEN k = 3 THEN 'landsat-8' ELSE 'unknown' END AS platform FROM (SELECT o_orderkey AS id, o_custkey % 5 AS k FROM orders)""")
def _(t):
    path = F.get(F.array(*map(F.lit, ("/x/S2A_MSIL2A_1", "/x/SENTINEL2B_2", "/x/SPOT4_Take5", "/x/LANDSAT8-OLI", "/x/other"))), (col("o_custkey") % 5).cast("int"))
    return t("orders").select(col("o_orderkey").alias("id"), S.platform(path).alias("platform"))


#: Scenes of all missions, two files of each, and what layers they hold.
SCENE_FILES = """(0, '/in/S2A_MSIL2A_', '.SAFE', 'a_B03_10m.jp2', 'a_B11_20m.jp2'), (1, '/in/S2B_OPER_', '.DBL.DIR', 'S2B_FRE_R1.DBL.TIF', 'S2B_CLD_R2.DBL.TIF'), (2, '/in/SENTINEL2B_', '', 'x_FRE_B3.tif', 'x_MTD_ALL.xml'),
    (3, '/in/SPOT4_Take5_', '', 'ORTHO_SURF_CORR_PENTE_1.TIF', 'y_NUA.TIF'), (4, '/in/LANDSAT8-OLITIRS-XS_', '', 'z_SRE_B5.tif', 'z_CLM_XS.tif'), (5, '/in/LANDSAT8_OLI_', '', 'ORTHO_SURF_CORR_PENTE.TIF', 'w_DIV.TIF'), (6, '/in/LC08_L1TP_', '', 'v_sr_band4.tif', 'v_pixel_qa.xml'), (7, '/in/SPOT5_', '', 'x_FRE_B3.tif', 'x_FRE_B4.tif')"""
SCENE_LAYERS = """(0, 'SEN2COR', 'green', 'a_B03_10m.jp2', 1), (0, 'SEN2COR', 'swir', 'a_B11_20m.jp2', 1), (1, 'MAJA', 'green', 'S2B_FRE_R1.DBL.TIF', 2), (1, 'MAJA', 'red', 'S2B_FRE_R1.DBL.TIF', 3), (1, 'MAJA', 'cloud', 'S2B_CLD_R2.DBL.TIF', NULL),
    (2, 'S2', 'green', 'x_FRE_B3.tif', 1), (2, 'S2', 'metadata', 'x_MTD_ALL.xml', NULL), (3, 'Take5', 'green', 'ORTHO_SURF_CORR_PENTE_1.TIF', 1), (3, 'Take5', 'red', 'ORTHO_SURF_CORR_PENTE_1.TIF', 2), (3, 'Take5', 'swir', 'ORTHO_SURF_CORR_PENTE_1.TIF', 4), (3, 'Take5', 'cloud', 'y_NUA.TIF', NULL),
    (4, 'LANDSAT8_new_format', 'nir', 'z_SRE_B5.tif', 1), (4, 'LANDSAT8_new_format', 'cloud', 'z_CLM_XS.tif', NULL), (5, 'LANDSAT8', 'blue', 'ORTHO_SURF_CORR_PENTE.TIF', 2), (5, 'LANDSAT8', 'green', 'ORTHO_SURF_CORR_PENTE.TIF', 3), (5, 'LANDSAT8', 'red', 'ORTHO_SURF_CORR_PENTE.TIF', 4), (5, 'LANDSAT8', 'nir', 'ORTHO_SURF_CORR_PENTE.TIF', 5),
    (5, 'LANDSAT8', 'swir', 'ORTHO_SURF_CORR_PENTE.TIF', 6), (5, 'LANDSAT8', 'div', 'w_DIV.TIF', NULL), (6, 'LANDSAT8_LASRC', 'red', 'v_sr_band4.tif', 1), (6, 'LANDSAT8_LASRC', 'dem', 'v_sr_band4.tif', NULL)"""


@query("s22_layer_paths", f"""WITH s(k, head, tail, a, b) AS (VALUES {SCENE_FILES}), l(k, mission, layer, file, band) AS (VALUES {SCENE_LAYERS}), o AS (SELECT o_orderkey AS id, o_custkey % 8 AS k FROM orders)
    SELECT concat(head, CAST(id AS VARCHAR), tail) AS scene, mission, layer, concat(head, CAST(id AS VARCHAR), tail, '/IMG/', file) AS path, CAST(band AS INT) AS band FROM o JOIN s ON s.k = o.k JOIN l ON l.k = o.k""")
def _(t):
    kinds = t.spark.sql(f"SELECT * FROM VALUES {SCENE_FILES} AS s(k, head, tail, a, b)")
    o = t("orders").select(col("o_orderkey").alias("id"), (col("o_custkey") % 8).alias("k")).join(F.broadcast(kinds), "k")  # eight rows
    scene = F.concat("head", col("id").cast("string"), "tail")
    return M.layer_paths(o.select(scene.alias("scene"), F.explode(F.array("a", "b")).alias("file")).select("scene", F.concat("scene", F.lit("/IMG/"), "file").alias("path")))


@query("s12_catalogue_pages", """SELECT concat('P', CAST(o_orderkey AS VARCHAR)) AS name, concat('/p/', CAST(o_orderkey AS VARCHAR)) AS input_path, o_orderdate::TIMESTAMP AS date, CAST(strftime(o_orderdate, '%Y%m%d') AS BIGINT) AS measurement_day, o_custkey AS size, o_custkey % 2 = 0 AS online FROM orders""")
def _(t):
    item = F.struct(
        F.concat(F.lit("P"), col("o_orderkey").cast("string")).alias("Name"), F.concat(F.lit("/p/"), col("o_orderkey").cast("string")).alias("S3Path"), col("o_custkey").alias("ContentLength"),
        (col("o_custkey") % 2 == 0).alias("Online"), F.struct(F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("Start")).alias("ContentDate"),
    )
    pages = t("orders").groupBy(F.expr("o_orderkey div 50").alias("p")).agg(F.to_json(F.struct(F.collect_list(item).alias("value"))).alias("page"))
    return S.catalogue_pages(pages)


@query("s09_k08_scene_metadata", "SELECT o_orderkey AS id, CAST(o_custkey % 3000 AS DOUBLE) AS zs, CAST(o_custkey % 101 AS DOUBLE) AS snow, CAST(o_orderkey % 101 AS DOUBLE) AS cloud FROM orders")
def _(t):
    x = t("orders").select(col("o_orderkey").alias("id"), K.scene_xml(col("o_custkey") % 3000, col("o_custkey") % 101, col("o_orderkey") % 101).alias("xml"))
    return S.scene_metadata(x, "xml", "id")


@query("s10_k07_lineage", "SELECT o_custkey AS product, concat('in', CAST(o_orderkey % 9 AS VARCHAR)) AS title FROM orders GROUP BY 1, 2")
def _(t):
    x = t("orders").select(col("o_custkey").alias("product"), F.concat(F.lit("in"), (col("o_orderkey") % 9).cast("string")).alias("title"))
    return S.lineage(K.lineage_xml(x, ["product"], "title"), "xml", "product")


@query("s11_reference_candidates", "SELECT o_orderkey AS id FROM orders WHERE o_custkey % 101 BETWEEN 20 AND 80 AND o_orderkey % 101 BETWEEN 0 AND 10")
def _(t):
    x = t("orders").selectExpr("o_orderkey as id", "o_custkey % 101 as snow", "o_orderkey % 101 as cloud")
    return S.reference_candidates(x, (20, 80), (0, 10)).select("id")


@query("s18_availability", "SELECT o_orderkey AS id, CASE WHEN o_orderkey % 3 = 0 THEN 'available' WHEN o_orderkey % 3 = 1 AND o_custkey % 2 = 0 THEN 'needs processing' ELSE 'needs download' END AS status FROM orders")
def _(t):
    o = t("orders").selectExpr("o_orderkey as id", "o_custkey")
    return S.availability(o, o.where("id % 3 = 0"), o.where("id % 3 = 1 and o_custkey % 2 = 0"), "id").select("id", "status")


@query("s24_header_values", "SELECT o_orderkey AS id, CAST(o_custkey % 3000 AS DOUBLE) AS mean, CAST(o_orderkey % 500 AS DOUBLE) / 2 AS std FROM orders")
def _(t):
    text = F.format_string("Files: x\nSTATISTICS_MEAN=%d\nSTATISTICS_STD=%s\n", col("o_custkey") % 3000, ((col("o_orderkey") % 500).cast("double") / 2).cast("string"))
    x = t("orders").select(col("o_orderkey").alias("id"), text.alias("text"))
    return S.header_values(x, "text", "STATISTICS_MEAN", "STATISTICS_STD").select("id", col("statistics_mean").alias("mean"), col("statistics_std").alias("std"))


@query("s26_radar_takes", """SELECT o_custkey AS take, min(o_orderdate)::TIMESTAMP AS start, max(o_orderdate + INTERVAL 30 SECOND)::TIMESTAMP AS stop, CAST(32600 + min(1 + o_custkey % 60) AS BIGINT) AS epsg,
    CASE WHEN DATE '1997-01-01' - CAST(min(o_orderdate) AS DATE) > 22 THEN 'Precise' ELSE 'Restituted' END AS orbit, string_agg(CAST(o_orderkey AS VARCHAR), ',' ORDER BY o_orderdate, CAST(o_orderkey AS VARCHAR)) AS slices FROM orders GROUP BY 1""")
def _(t):
    s = t("orders").select(col("o_custkey").alias("take"), col("o_orderdate").cast("timestamp").alias("start"), (col("o_orderdate").cast("timestamp") + F.expr("interval 30 seconds")).alias("stop"), (1 + col("o_custkey") % 60).alias("zone"), col("o_orderkey").cast("string").alias("name"))
    return S.assemble_takes(s, "1997-01-01")


@query("k06_catalogue_entry", """SELECT o_orderkey AS id, concat('{"name":"P', CAST(o_orderkey AS VARCHAR), '","size":', CAST(o_custkey AS VARCHAR), ',"start":"', strftime(o_orderdate, '%Y-%m-%d'), '","stop":"', strftime(o_orderdate, '%Y-%m-%d'), '","cloud_cover":', CAST(o_orderkey % 101 AS VARCHAR), ',"extent":"POINT(0 0)"}') AS entry FROM orders""")
def _(t):
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    return t("orders").select(col("o_orderkey").alias("id"), K.catalogue_entry(F.concat(F.lit("P"), col("o_orderkey").cast("string")), col("o_custkey"), day, day, col("o_orderkey") % 101, F.lit("POINT(0 0)")).alias("entry"))


@query("k09_merge_features", "SELECT fid, tile, count(*) AS n, NULL::BIGINT AS area FROM feature_cells GROUP BY 1, 2 UNION ALL SELECT n_nationkey + 100, NULL, NULL, n_regionkey FROM nation", "feature_cells")
def _(t):
    a = t("feature_cells").groupBy("fid", "tile").agg(F.count("*").alias("n"))
    return K.merge_features(a, t("nation").selectExpr("n_nationkey + 100 as fid", "cast(n_regionkey as bigint) as area"))


@query("k09_upsert_features", """SELECT coalesce(o.fid, n.fid) AS fid, coalesce(n.n, o.n) AS n, o.tile, n.name FROM (SELECT fid, max(tile) AS tile, count(*) AS n FROM feature_cells GROUP BY fid) o
    FULL JOIN (SELECT n_nationkey + 5 AS fid, CASE WHEN n_regionkey > 1 THEN n_regionkey END AS n, n_name AS name FROM nation) n ON n.fid = o.fid""", "feature_cells")
def _(t):
    old = t("feature_cells").groupBy("fid").agg(F.max("tile").alias("tile"), F.count("*").alias("n"))
    return selections.upsert_features(old, t("nation").selectExpr("n_nationkey + 5 as fid", "case when n_regionkey > 1 then bigint(n_regionkey) end as n", "n_name as name"), ["fid"])


@query("k10_bounding_polygons", """SELECT fid, count(*) AS cells, format('POLYGON(({} {},{} {},{} {},{} {},{} {}))', min(c), min(r), max(c) + 1, min(r), max(c) + 1, max(r) + 1, min(c), max(r) + 1, min(c), min(r)) AS wkt FROM feature_cells GROUP BY fid""", "feature_cells")
def _(t):
    return K.bounding_boxes(t("feature_cells"), ["fid"])


@query("k14_row_extremes", "SELECT tile, r, min(c) AS c0, max(c) AS c1 FROM water WHERE wl <> 255 GROUP BY 1, 2", "water")
def _(t):
    return K.row_extremes(t("water"), col("wl") != 255)


@query("k13_job_spec", "SELECT id, concat('job \"', CAST(id AS VARCHAR), '\" on vm', CAST(virtual_machine_id AS VARCHAR)) AS spec FROM processing_tasks", "processing_tasks")
def _(t):
    return t("processing_tasks").select("id", K.job_spec('job "{id}" on vm{vm}', id=col("id"), vm=col("virtual_machine_id")).alias("spec"))


@query("k18_layers", "SELECT tile, r, c, 'v' AS layer, CAST(max(v) AS INT) AS value FROM obs GROUP BY 1, 2, 3 UNION ALL SELECT tile, r, c, 'qc', CAST(max(qc) AS INT) FROM obs GROUP BY 1, 2, 3", "obs")
def _(t):
    x = t("obs").groupBy("tile", "r", "c").agg(F.max("v").alias("v"), F.max("qc").alias("qc"))
    return x.unpivot(["tile", "r", "c"], ["v", "qc"], "layer", "value")


TREES = [
    {"feature": "red", "cut": 300, "low": {"shares": [0.75, 0.25, 0.0]}, "high": {"feature": "nir", "cut": 400, "low": {"shares": [0.25, 0.5, 0.25]}, "high": {"shares": [0.0, 0.25, 0.75]}}},
    {"feature": "green", "cut": 600, "low": {"shares": [0.5, 0.5, 0.0]}, "high": {"shares": [0.25, 0.25, 0.5]}},
]


@query("m01_forest", """WITH s AS (SELECT *, CASE WHEN red <= 300 THEN 0.75 WHEN nir <= 400 THEN 0.25 ELSE 0.0 END AS a0, CASE WHEN red <= 300 THEN 0.25 WHEN nir <= 400 THEN 0.5 ELSE 0.25 END AS a1, CASE WHEN red <= 300 THEN 0.0 WHEN nir <= 400 THEN 0.25 ELSE 0.75 END AS a2,
    CASE WHEN green <= 600 THEN 0.5 ELSE 0.25 END AS b0, CASE WHEN green <= 600 THEN 0.5 ELSE 0.25 END AS b1, CASE WHEN green <= 600 THEN 0.0 ELSE 0.5 END AS b2 FROM bands), m AS (SELECT *, (a0 + b0) / 2 AS m0, (a1 + b1) / 2 AS m1, (a2 + b2) / 2 AS m2 FROM s)
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate, CASE WHEN m0 >= m1 AND m0 >= m2 THEN 0 WHEN m1 >= m2 THEN 1 ELSE 2 END AS cls, CAST(round(100 * greatest(m0, m1, m2), 6) AS DOUBLE) AS probability FROM m""", "bands")
def _(t):
    return models.forest(t("bands"), TREES, 3).select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "cls", "probability")


@query("m02_calibrate_cover")
def _(t):
    b = t("bands").selectExpr("(green - swir) / double(greatest(green + swir, 1)) as x", "double((green * 7 + red) % 101) / 100 as y")
    p, q = models.calibrate_cover(b, "x", "y")
    return t.spark.createDataFrame([(round(p, 4), round(q, 4))], "a double, b double")


@query("m02_simplex")
def _(t):
    """Coefficients from three quarters of the orders, with the errors on both parts."""
    b = t("bands").selectExpr("l_orderkey % 4 = 0 as test", "(green - swir) / double(greatest(green + swir, 1)) as x", "double((green * 7 + red) % 101) / 100 as y")
    p, q, error = models.simplex_cover(b.where("not test"), "x", "y")
    held = F.sqrt(F.avg((0.5 * F.tanh(p * col("x") + q) + 0.5 - col("y")) ** 2))
    return b.where("test").agg(F.lit(round(p, 3)).alias("a"), F.lit(round(q, 3)).alias("b"), F.lit(error).alias("train"), held.alias("test"))


@query("n12_polygon_cells", """SELECT p, CAST(r AS INT) AS r, CAST(c AS INT) AS c FROM (SELECT n_nationkey AS p, n_nationkey % 7 AS x, n_nationkey % 5 AS y FROM nation) n, generate_series(0, 30) a(r), generate_series(0, 30) b(c)
    WHERE c + 0.5 > x AND c + 0.5 < x + 10 AND r + 0.5 > y AND r + 0.5 < y + 8 AND NOT (c + 0.5 > x + 3 AND c + 0.5 < x + 6 AND r + 0.5 > y + 2 AND r + 0.5 < y + 5)""")
def _(t):
    n = t("nation").selectExpr("n_nationkey as p", "double(n_nationkey % 7) as x", "double(n_nationkey % 5) as y")
    ring = lambda x, y, w, h: f"struct({x} as x0, {y} as y0, {x} as x1, {y} + {h} as y1), struct({x} as x0, {y} + {h} as y0, {x} + {w} as x1, {y} + {h} as y1), struct({x} + {w} as x0, {y} + {h} as y0, {x} + {w} as x1, {y} as y1), struct({x} + {w} as x0, {y} as y0, {x} as x1, {y} as y1)"
    edges = n.select("p", F.explode(F.expr(f"array({ring('x', 'y', 10, 8)}, {ring('(x + 3)', '(y + 2)', 3, 3)})")).alias("e")).select("p", "e.*")
    return polygons.cells_inside(edges, ["p"])


def stream(t):
    return ST.read_folder(t.spark, t.sf_dir, "events*.parquet")


def in_parts(t, rows, part, parts: int):
    """A stream of rows that came in parts, one after the other: a batch each. A part is one file, in groups of rows of
    bounded size, which tasks read apart."""
    path = shared_path(t.spark, "parts")
    kept = rows.withColumn("_part", col(part) if isinstance(part, str) else part)
    for k in range(parts):
        kept.where(col("_part") == k).drop("_part").coalesce(1).write.option("parquet.block.size", SPLIT).parquet(f"{path}/{k}.parquet")
    return t.spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", "true").parquet(path)


def closing(t, late: str = "1 day"):
    """Events as a stream with a watermark, and a heartbeat after them that lets all windows close."""
    e = t("events")
    rows = e.withColumn("_beat", F.lit(0)).unionByName(ST.heartbeat(e, "60 days").withColumn("_beat", F.lit(1)))
    return ST.timed(in_parts(t, rows, "_beat", 2)).withWatermark("ts", late)


@query("t01_inserted", "SELECT event_id, concat('R', CAST(user_id % 25 AS VARCHAR), '_PC') AS condition FROM events")
def _(t):
    return ST.run_available(ST.inserted(stream(t)))


@query("t02_processed", "SELECT event_id, user_id, ts FROM events WHERE event_type = 'purchase'")
def _(t):
    return ST.run_available(ST.processed(stream(t)))


@query("t03_once_a_batch", "SELECT event_type, count(*) AS n FROM events GROUP BY 1")
def _(t):
    found = ST.run_available(stream(t), each=lambda batch, _: batch.groupBy("event_type").agg(F.count("*").alias("n")))
    return found.groupBy("event_type").agg(F.sum("n").alias("n"))


@query("t04_all_processed", "SELECT user_id, bool_and(event_type IN ('purchase', 'view')) AS ready, count(*) AS n FROM events GROUP BY 1")
def _(t):
    return ST.run_available(ST.all_processed(stream(t)), "update", keys=["user_id"])


@query("t05_bursts", """WITH l AS (SELECT *, CASE WHEN ts - lag(ts) OVER w < INTERVAL 6 HOUR THEN 0 ELSE 1 END AS first FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)), g AS (SELECT *, sum(first) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS k FROM l)
    SELECT user_id, min(ts) AS start, max(ts) + INTERVAL 6 HOUR AS idle_at, count(*) AS n FROM g GROUP BY user_id, k""")
def _(t):
    return ST.run_available(ST.bursts(closing(t), "6 hours"))


@query("t07_daily_counts", "SELECT date_trunc('day', ts)::TIMESTAMP AS start, event_type, count(*) AS n FROM events GROUP BY 1, 2")
def _(t):
    return ST.run_available(ST.per_window(closing(t), "1 day"))


@query("t07_sliding_counts", "SELECT date_trunc('day', ts)::TIMESTAMP - INTERVAL 1 DAY * k AS start, event_type, count(*) AS n FROM events, generate_series(0, 6) g(k) GROUP BY 1, 2")
def _(t):
    return ST.run_available(ST.per_window(closing(t), "7 days", "1 day"))


@query("t08_new_keys", "SELECT DISTINCT user_id, event_type FROM events")
def _(t):
    return ST.run_available(ST.new_keys(stream(t), ["user_id", "event_type"], "3650 days"))


@query("t10_volume_gate", "SELECT date_trunc('day', ts)::TIMESTAMP AS start, count(*) AS n FROM events GROUP BY 1 HAVING count(*) >= 30")
def _(t):
    return ST.run_available(ST.volume_gate(closing(t), "1 day", 30))


@query("t11_current_status", "SELECT user_id, max_by(event_type, ts) AS status, max(ts) AS since FROM events GROUP BY 1")
def _(t):
    return ST.run_available(ST.current_status(stream(t)), "update", keys=["user_id"])


#: Each event is a task of one of 25 keys: created at its time, and ended some hours later unless it fails.
NOTICES = """b AS (SELECT event_id, CAST(user_id % 25 AS VARCHAR) AS key, event_type IN ('purchase', 'view') AS feeds, event_id % 7 > 0 AS ends, date_trunc('second', ts)::TIMESTAMP AS ts FROM events),
    n AS (SELECT key, event_id, feeds, FALSE AS ended, ts FROM b UNION ALL SELECT key, event_id, feeds, TRUE, ts + INTERVAL 1 HOUR * CAST(1 + event_id % 50 AS INT) FROM b WHERE ends)"""


@query("t05_harvest_runs", f"""WITH {NOTICES}, s AS (SELECT *, sum(CASE WHEN ended THEN -1 ELSE 1 END) OVER w AS open, sum(CASE WHEN NOT feeds THEN 0 WHEN ended THEN -1 ELSE 1 END) OVER w AS feeding, coalesce(lead(ts) OVER w, (SELECT max(ts) - INTERVAL 6 HOUR FROM n)) AS until
        FROM n WINDOW w AS (PARTITION BY key ORDER BY ts, ended, CAST(event_id AS VARCHAR))),
    f AS (SELECT key, ts + INTERVAL 1 HOUR * (13 * k) AS ts, 'force' AS action, open FROM (SELECT *, unnest(range(1, 1 + CAST(floor(greatest(0, epoch(until) - epoch(ts)) / 46800) AS BIGINT))) AS k FROM s WHERE feeding > 0))
    SELECT key, ts, action, CAST(open AS BIGINT) AS open FROM (SELECT * FROM f UNION ALL SELECT key, ts + INTERVAL 13 HOUR, 'stop', open FROM s WHERE feeding = 0 AND ts + INTERVAL 13 HOUR <= until UNION ALL SELECT key, ts, 'harvest', open FROM s WHERE ended AND open = 0)""")
def _(t):
    e = t("events")
    base = e.select((col("user_id") % 25).cast("string").alias("key"), col("event_id").alias("task"), col("event_type").isin("purchase", "view").alias("feeds"), F.date_trunc("second", "ts").alias("ts"))
    later = F.expr("ts + make_interval(0, 0, 0, 0, int(1 + task % 50))")
    rows = base.withColumn("ended", F.lit(False)).unionByName(base.where("task % 7 > 0").withColumn("ended", F.lit(True)).withColumn("ts", later))
    low, high = rows.agg(F.min("ts"), F.max("ts")).first()
    middle = F.lit(low + (high - low) / 2) if low else F.lit(None).cast("timestamp")
    stream = in_parts(t, rows, F.when(col("ts") < middle, 0).otherwise(1), 2)
    return ST.run_available(TM.harvest_runs(stream, datetime.timedelta(hours=13), "6 hours"))


@query("t09_day_cursor", """WITH i AS (SELECT CAST(user_id % 40 AS VARCHAR) AS key, CAST(ts AS DATE) AS day, CAST(event_id AS VARCHAR) AS item, least(2, CAST(epoch(ts) - (SELECT min(epoch(ts)) FROM events) AS BIGINT) * 3 // (1 + CAST((SELECT max(epoch(ts)) - min(epoch(ts)) FROM events) AS BIGINT)) + CAST(event_id % 9 = 0 AS INT)) AS part FROM events),
    m AS (SELECT key, part, max(max(day)) OVER (PARTITION BY key ORDER BY part) - 2 AS cursor FROM i GROUP BY key, part),
    l AS (SELECT i.*, (SELECT max(cursor) FROM m WHERE m.key = i.key AND m.part < i.part) AS before, (SELECT min(part) FROM m WHERE m.key = i.key AND m.cursor >= i.day) AS closes FROM i)
    SELECT key, day, 'late' AS kind, CAST(1 AS BIGINT) AS n, item FROM l WHERE before >= day UNION ALL SELECT key, day, 'computed', count(*), NULL FROM l WHERE (before IS NULL OR before < day) AND closes IS NOT NULL GROUP BY key, day""")
def _(t):
    e = t("events")
    seconds = F.unix_micros(col("ts").cast("timestamp")) / 1e6
    low, high = e.agg(F.min(seconds), F.max(seconds)).first()
    since = lambda s: F.rint(s - F.lit(low or 0.0)).cast("bigint")  # noqa: E731  # to the nearest whole second
    rows = e.select((col("user_id") % 40).cast("string").alias("key"), F.to_date("ts").alias("day"), col("event_id").cast("string").alias("item"), since(seconds).alias("s"))
    part = F.least(F.lit(2), F.expr(f"s * 3 div {1 + round((high or 0.0) - (low or 0.0))}") + F.when(col("item").cast("bigint") % 9 == 0, 1).otherwise(0))
    return ST.run_available(TM.day_cursor(in_parts(t, rows, part, 3), 2))
