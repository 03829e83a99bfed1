"""Registered queries of products beside products: wet snow, resampling, pairing, outlines, indexation, look-back."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import solar
from ..operators import catalogue as K
from ..operators import models
from ..operators import products as P
from ..operators import resample
from ..operators import selections as X
from ..operators import stats as S
from ..registry import query
from ..session import shared_path
from ..sinks import formats as KF
from ..sources import formats as SF
from ..streaming import status as ST
from .source_queries import NAMES, closing, names, stream
from .space_queries import SCENES, scenes

col = F.col
BANDS = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate"]
KS = ", ".join(BANDS)

COARSE = """coarse AS (SELECT tile, r, c, CASE (r * 3 + c + tile) % 3 WHEN 0 THEN 110 WHEN 1 THEN 125 ELSE 200 END AS wet, (r + c) % 4 AS quality, CASE WHEN (r + 2 * c) % 7 = 0 THEN 240 ELSE 0 END AS mask,
    (r * 5 + c) % 11 = 0 AS nodata FROM (SELECT DISTINCT tile, CAST(r // 2 AS INT) AS r, CAST(c // 2 AS INT) AS c FROM grid))"""


@query("p34_wet_snow", f"""WITH {COARSE}, b AS (SELECT tile, d, CAST(r // 2 AS INT) AS r, CAST(c // 2 AS INT) AS c, count(*) FILTER (v <= 100) AS ok, sum(v) FILTER (v <= 100) AS s, count(*) FILTER (v = 205) AS cl, count(*) FILTER (v = 210) AS wa FROM obs GROUP BY 1, 2, 3, 4),
    f AS (SELECT b.*, wet, quality, mask, nodata, min(CASE WHEN ok > 2 THEN d END) OVER (PARTITION BY b.tile, b.r, b.c) AS first FROM b JOIN coarse USING (tile, r, c)),
    w AS (SELECT *, CASE WHEN ok > 2 THEN CASE WHEN s < 60 * ok THEN 120 WHEN wet = 110 THEN 110 WHEN wet = 125 THEN 115 END WHEN first <= d THEN NULL WHEN cl > 4 - ok - cl THEN 205 WHEN wa > 4 - ok - wa THEN 210 END AS val FROM f),
    l AS (SELECT tile, r, c, max_by(val, d) FILTER (val IS NOT NULL) AS val, any_value(quality) AS quality, any_value(mask) AS mask, any_value(nodata) AS nodata, count(first) > 0 AS seen FROM w GROUP BY 1, 2, 3)
    SELECT tile, r, c, CAST(CASE WHEN nodata THEN 255 WHEN seen AND mask <> 0 THEN mask ELSE coalesce(val, 255) END AS INT) AS v, CAST(CASE WHEN nodata THEN 255 WHEN seen AND mask <> 0 THEN 250 WHEN val = 110 THEN quality WHEN val IS NOT NULL THEN 250 ELSE 255 END AS INT) AS quality FROM l""", "grid obs")
def _(t):
    g = t("grid").selectExpr("tile", "cast(r div 2 as int) as r", "cast(c div 2 as int) as c").distinct()
    coarse = g.selectExpr("tile", "r", "c", "case (r * 3 + c + tile) % 3 when 0 then 110 when 1 then 125 else 200 end as wet", "(r + c) % 4 as quality", "case when (r + 2 * c) % 7 = 0 then 240 else 0 end as mask", "(r * 5 + c) % 11 = 0 as nodata")
    return P.wet_snow(t("obs").select("tile", "r", "c", "d", "v"), coarse, 2)


@query("p29_macro_classes", f"SELECT {KS}, CASE WHEN red % 17 IN (6, 8, 9) THEN 1 WHEN red % 17 IN (7, 10, 11) THEN 100 WHEN red % 17 = 0 THEN 255 WHEN red % 17 < 15 THEN 254 ELSE 0 END AS cls FROM bands", "bands")
def _(t):
    return t("bands").select(*BANDS, P.macro_class(col("red") % 17).alias("cls"))


@query("j14_bilinear", """WITH t AS (SELECT tile, CAST(r * 2 + i AS INT) AS r, CAST(c * 2 + j AS INT) AS c FROM water, generate_series(0, 1) a(i), generate_series(0, 1) b(j)), p AS (SELECT *, (r + 0.5::DOUBLE) / 2 - 0.5 AS y, (c + 0.5::DOUBLE) / 2 - 0.5 AS x FROM t),
    n AS (SELECT p.tile, p.r, p.c, g.z, (1 - abs(y - g.r)) * (1 - abs(x - g.c)) AS w FROM p JOIN dem g ON g.tile = p.tile AND g.r BETWEEN floor(y) AND floor(y) + 1 AND g.c BETWEEN floor(x) AND floor(x) + 1)
    SELECT tile, r, c, CAST(round(sum(z * w) / sum(w), 6) AS DOUBLE) AS z FROM n GROUP BY 1, 2, 3""", "water dem")
def _(t):
    from ..operators.grid import replicate

    return P.bilinear(t("dem"), replicate(t("water").select("tile", "r", "c"), 2), "z", 2)


@query("a18_transitions", """SELECT tile, clouds, removed, ss AS snow_to_snow, ll AS land_to_land, sl AS snow_to_land, ls AS land_to_snow, CAST(round(CASE WHEN removed = 0 THEN 0 ELSE 100.0 * (ss + ll) / removed END, 6) AS DOUBLE) AS right_share FROM (SELECT tile, count(*) FILTER (v = 205) AS clouds,
    count(*) FILTER (v = 205 AND f <> 205 AND ref <> 205) AS removed, count(*) FILTER (v = 205 AND f = 100 AND ref = 100) AS ss, count(*) FILTER (v = 205 AND f = 0 AND ref = 0) AS ll, count(*) FILTER (v = 205 AND f = 0 AND ref = 100) AS sl, count(*) FILTER (v = 205 AND f = 100 AND ref = 0) AS ls
    FROM (SELECT *, CASE WHEN qf % 3 = 0 THEN 0 WHEN qf % 3 = 1 THEN 100 ELSE 205 END AS ref, CASE WHEN v = 205 AND qc > 0 THEN qf % 2 * 100 ELSE v END AS f FROM obs) GROUP BY tile)""", "obs")
def _(t):
    x = t("obs").selectExpr("*", "case when qf % 3 = 0 then 0 when qf % 3 = 1 then 100 else 205 end as ref", "case when v = 205 and qc > 0 then qf % 2 * 100 else v end as f")
    return P.transitions(x, col("f"), col("v"), col("ref"), ["tile"])


@query("a19_quartiles", """SELECT band, CAST(q[1] AS INT) AS q0, CAST(q[2] AS INT) AS q1, CAST(q[3] AS INT) AS q2, CAST(q[4] AS INT) AS q3, CAST(q[5] AS INT) AS q4 FROM (SELECT CASE WHEN z < 500 THEN 0 WHEN z < 1000 THEN 500 WHEN z < 1500 THEN 1000 WHEN z < 2000 THEN 1500 ELSE 2000 END AS band,
    quantile_disc(v, [0, 0.25, 0.5, 0.75, 1]) AS q FROM obs JOIN dem USING (tile, r, c) WHERE v <= 100 GROUP BY 1)""", "obs dem")
def _(t):
    band = F.when(col("z") < 500, 0).when(col("z") < 1000, 500).when(col("z") < 1500, 1000).when(col("z") < 2000, 1500).otherwise(2000)
    x = t("obs").where("v <= 100").join(t("dem"), ["tile", "r", "c"]).withColumn("band", band)
    return x.groupBy("band").agg(*[F.expr(f"cast(percentile_disc({q}) within group (order by v) as int)").alias(f"q{k}") for k, q in enumerate((0, 0.25, 0.5, 0.75, 1))])


@query("a21_by_period_and_source", """SELECT mission, period, count(*) AS n, CAST(round(sqrt(avg((y - x) * (y - x))), 6) AS DOUBLE) AS rmse, CAST(round(avg(y - x), 6) AS DOUBLE) AS bias, CAST(round(corr(x, y), 6) AS DOUBLE) AS r, CAST(round(regr_slope(y, x), 6) AS DOUBLE) AS slope,
    CAST(round(regr_intercept(y, x), 6) AS DOUBLE) AS intercept, CAST(round(stddev(y - x), 6) AS DOUBLE) AS sd FROM (SELECT mission, CAST(year(d) AS INT) AS period, v AS x, v + qf % 20 AS y FROM obs_raw WHERE v <= 100) GROUP BY 1, 2""", "obs_raw")
def _(t):
    return S.agreement(t("obs_raw").where("v <= 100").selectExpr("mission", "year(d) as period", "v as x", "v + qf % 20 as y"), "x", "y", ["mission", "period"])


@query("k14_hull")
def _(t):
    from ..sinks.formats import row_extremes

    return P.hulls(row_extremes(t("water"), col("wl") != 255), ["tile"])


def degrees_sql(q: str, keys: str) -> str:
    """CTEs that end in w: keys, lon and lat of q, which gives keys, zone, x and y."""
    return f"""q AS ({q}), e AS (SELECT 0.0066943799901413165::DOUBLE AS e2, 0.006739496742276434::DOUBLE AS ep2, 0.0016792203863837047::DOUBLE AS e1),
    mu AS (SELECT *, y / 0.9996 / (6378137.0 * (1 - e2 / 4 - 3 * e2 ** 2 / 64 - 5 * e2 ** 3 / 256)) AS mu FROM q, e),
    f AS (SELECT *, mu + (3 * e1 / 2 - 27 * e1 ** 3 / 32) * sin(2 * mu) + (21 * e1 ** 2 / 16 - 55 * e1 ** 4 / 32) * sin(4 * mu) + 151 * e1 ** 3 / 96 * sin(6 * mu) + 1097 * e1 ** 4 / 512 * sin(8 * mu) AS p FROM mu),
    g AS (SELECT *, 6378137.0 / sqrt(1 - e2 * sin(p) ** 2) AS n_, 6378137.0 * (1 - e2) / (1 - e2 * sin(p) ** 2) ** 1.5 AS r_, ep2 * cos(p) ** 2 AS c1, tan(p) ** 2 AS t1 FROM f), h AS (SELECT *, (x - 500000) / (n_ * 0.9996) AS d FROM g),
    w AS (SELECT {keys}, degrees((d - (1 + 2 * t1 + c1) * d ** 3 / 6 + (5 - 2 * c1 + 28 * t1 - 3 * c1 ** 2 + 8 * ep2 + 24 * t1 ** 2) * d ** 5 / 120) / cos(p)) + zone * 6 - 183 AS lon,
    degrees(p - n_ * tan(p) / r_ * (d ** 2 / 2 - (5 + 3 * t1 + 10 * c1 - 4 * c1 ** 2 - 9 * ep2) * d ** 4 / 24 + (61 + 90 * t1 + 298 * c1 + 45 * t1 ** 2 - 252 * ep2 - 3 * c1 ** 2) * d ** 6 / 720)) AS lat FROM h)"""


K15 = f"""WITH b AS (SELECT o_orderkey AS id, 300000.0::DOUBLE + o_custkey % 400 * 1000 AS x0, 4000000.0::DOUBLE + o_orderkey % 900 * 1000 AS y0, 31 + o_custkey % 3 AS zone FROM orders),
    {degrees_sql("SELECT id, zone, x0 + i * 20000 AS x, y0 + j * 10000 AS y FROM b, generate_series(0, 1) s(i), generate_series(0, 1) u(j)", "id")}
    SELECT id, CAST(round(min(lon), 7) AS DOUBLE) AS west, CAST(round(max(lon), 7) AS DOUBLE) AS east, CAST(round(min(lat), 7) AS DOUBLE) AS south, CAST(round(max(lat), 7) AS DOUBLE) AS north FROM w GROUP BY id"""


@query("k15_geographic_bounds", K15)
def _(t):
    b = t("orders").selectExpr("o_orderkey as id", "double(300000 + o_custkey % 400 * 1000) as x0", "double(4000000 + o_orderkey % 900 * 1000) as y0", "31 + o_custkey % 3 as zone")
    return P.geographic_bounds(b.selectExpr("id", "x0", "y0", "x0 + 20000 as x1", "y0 + 10000 as y1", "zone"))


@query("s23_tile_search", """WITH f AS (SELECT DISTINCT o_custkey % 50 * 7 AS x0, o_orderkey % 40 * 9 AS y0, o_custkey % 50 * 7 + 11 AS x1, o_orderkey % 40 * 9 + 13 AS y1 FROM orders), t AS (SELECT n_name AS name, n_nationkey % 5 * 80 AS tx0, n_nationkey // 5 * 80 AS ty0, n_nationkey % 5 * 80 + 85 AS tx1, n_nationkey // 5 * 80 + 85 AS ty1 FROM nation)
    SELECT x0, y0, x1, y1, name FROM f JOIN t ON x0 < tx1 AND tx0 < x1 AND y0 < ty1 AND ty0 < y1""")
def _(t):
    f = t("orders").selectExpr("o_custkey % 50 * 7 as x0", "o_orderkey % 40 * 9 as y0", "o_custkey % 50 * 7 + 11 as x1", "o_orderkey % 40 * 9 + 13 as y1")
    tiles = t("nation").selectExpr("n_name", "n_nationkey % 5 * 80", "n_nationkey div 5 * 80", "n_nationkey % 5 * 80 + 85", "n_nationkey div 5 * 80 + 85")
    return P.tiles_of_footprints(f, tiles, 100)


@query("s09_sun_grid", """SELECT o_orderkey AS id, CAST(i AS INT) AS r, CAST(j AS INT) AS c, CAST(20 + (o_custkey + i * 3 + j) % 50 AS DOUBLE) AS angle, CAST(300000 + o_custkey % 9 * 5000 + j * 5000 AS DOUBLE) AS x, CAST(5000000 - i * 5000 AS DOUBLE) AS y FROM orders, generate_series(0, 2) a(i), generate_series(0, 2) b(j)""")
def _(t):
    line = lambda i: F.concat_ws(" ", *[(20 + (col("o_custkey") + i * 3 + j) % 50).cast("string") for j in range(3)])
    grid = F.struct((300000 + col("o_custkey") % 9 * 5000).alias("ulx"), F.lit(5000000).alias("uly"), F.lit(5000).alias("step"), F.struct(F.array(*map(line, range(3))).alias("VALUES")).alias("Values_List"))
    return P.sun_grid(t("orders").select(col("o_orderkey").alias("id"), F.to_xml(grid).alias("xml")), "xml", "id")


@query("j17_date_pairs", f"""WITH {NAMES}, days AS (SELECT d, row_number() OVER (ORDER BY d) - 1 AS day_index FROM (SELECT DISTINCT d FROM obs)) SELECT name, d, day_index FROM n JOIN days ON contains(name, strftime(d, '%Y%m%d'))""", "obs")
def _(t):
    return X.date_pairs(names(t), t("obs")).select("name", "d", "day_index")


@query("o06_drop_obsolete", "SELECT o_orderkey AS id FROM orders WHERE o_custkey % 7 <> 0")
def _(t):
    o = t("orders")
    return K.without(o.select(col("o_orderkey").alias("id")), o.where("o_custkey % 7 = 0").select(col("o_orderkey").alias("obsolete")), "id", "obsolete")


@query("s06_band_rows", f"SELECT {KS}, red, green, blue FROM bands WHERE green > red", "bands")
def _(t):
    return X.band_rows(t("bands"), BANDS, ["red", "green", "blue"], "green > red")


@query("s07_all_dates", "SELECT tile, r, c, count(*) AS n, string_agg(CAST(v AS VARCHAR), ' ' ORDER BY d) AS series FROM obs GROUP BY 1, 2, 3", "obs")
def _(t):
    return X.date_series(t("obs"), ["tile", "r", "c"])


@query("s14_products_as_inputs", """SELECT 'TURB_PC' AS processing_condition_name, o_orderdate::TIMESTAMP AS creation_date, i.tile, i.measurement_day, p.product_path AS input_path, i.mission FROM products p JOIN orders ON o_orderkey = p.id JOIN input i ON i.id = p.input_fk_id
    WHERE o_orderdate >= TIMESTAMP '1995-01-01' AND p.product_type_id IN (SELECT r_regionkey FROM region WHERE concat('L', CAST(1 + r_regionkey % 3 AS VARCHAR)) IN (SELECT input_type FROM routine))""", "products input routine")
def _(t):
    created = t("orders").select(col("o_orderkey").alias("id"), col("o_orderdate").cast("timestamp").alias("creation_date"))
    types = t("region").select(col("r_regionkey").alias("id"), F.concat(F.lit("L"), (1 + col("r_regionkey") % 3).cast("string")).alias("data_type"))
    return X.products_as_inputs(t("products").join(created, "id"), t("input"), types, t("routine"), "TURB_PC", "1995-01-01")


@query("j01_cell_join", "SELECT tile, r, c, d, v, wl, z, tcd FROM obs JOIN water USING (tile, r, c) JOIN dem USING (tile, r, c) JOIN tcd USING (tile, r, c)", "obs water dem tcd")
def _(t):
    cell = ["tile", "r", "c"]
    return t("obs").join(t("water"), cell).join(t("dem"), cell).join(t("tcd"), cell).select(*cell, "d", "v", "wl", "z", "tcd")


@query("l01_newest_first", "SELECT tile, r, c, d, CAST(row_number() OVER (PARTITION BY tile, r, c ORDER BY d DESC) AS INT) AS place FROM obs", "obs")
def _(t):
    return X.newest_first(t("obs"), ["tile", "r", "c"])


@query("l04_sorted_names", f"WITH {NAMES} SELECT id, CAST(row_number() OVER (PARTITION BY substr(name, 1, 5) ORDER BY name, id) AS INT) AS place FROM n")
def _(t):
    return X.places(names(t), F.substring("name", 1, 5), "name", "id").select("id", "place")


@query("l07_nearest_to_may", "SELECT tile, CAST(year(d) AS INT) AS year, min_by(d, abs(d - make_date(year(d), 5, 1)) * 1000 + dayofyear(d)) AS d FROM obs GROUP BY 1, 2", "obs")
def _(t):
    return X.nearest_to_day(t("obs"), ["tile"], 5, 1)


@query("o02_all_candidates", "SELECT id, 'S1' AS source FROM input WHERE mission = 'S1' UNION ALL SELECT id, 'products' FROM products", "input products")
def _(t):
    return X.all_candidates({"S1": t("input").where("mission = 'S1'"), "products": t("products")})


INDEX = """iw AS (SELECT event_id AS id, 1 + event_id % 500 AS product_fk_id, CASE WHEN event_type = 'purchase' THEN ts END AS indexation_date, CASE WHEN event_type = 'error' THEN ts END AS failure_date FROM events),
    ij AS (SELECT o_orderkey AS product_fk_id, 1 + o_custkey % 3 AS indexation_file_type_id, concat('/json/', CAST(o_orderkey AS VARCHAR)) AS path FROM orders), ift AS (SELECT r_regionkey AS id, r_name AS name FROM region)"""


def indexation(t):
    return t("events").selectExpr("event_id as id", "1 + event_id % 500 as product_fk_id", "case when event_type = 'purchase' then ts end as indexation_date", "case when event_type = 'error' then ts end as failure_date")


@query("f_is_product_indexed", f"WITH {INDEX} SELECT p.id, coalesce(x.done, false) AS indexed, coalesce(x.failed, false) AS failed FROM products p LEFT JOIN (SELECT product_fk_id, bool_or(indexation_date IS NOT NULL) AS done, max_by(failure_date IS NOT NULL, id) AS failed FROM iw GROUP BY 1) x ON x.product_fk_id = p.id", "products")
def _(t):
    return K.indexation_state(t("products"), indexation(t))


@query("f_indexation_file_path", f"WITH {INDEX} SELECT p.id, ij.path FROM ij JOIN products p ON p.id = ij.product_fk_id JOIN ift ON ift.id = ij.indexation_file_type_id WHERE ift.name = 'ASIA'", "products")
def _(t):
    files = t("orders").selectExpr("o_orderkey as product_fk_id", "1 + o_custkey % 3 as indexation_file_type_id", "concat('/json/', o_orderkey) as path")
    return K.indexation_files(t("products"), files, t("region").selectExpr("r_regionkey as id", "r_name as name"), "ASIA")


SINCE = "(SELECT max(ts) FROM events)"


@query("t07_look_back", f"SELECT event_id, event_type FROM events WHERE (event_type = 'view' AND ts >= {SINCE} - INTERVAL 7 DAY) OR (event_type <> 'view' AND ts >= {SINCE} - INTERVAL 30 DAY)")
def _(t):
    now = t("events").agg(F.max("ts")).first()[0]
    return ST.run_available(ST.look_back(stream(t), now, {"view": 7}, 30).select("event_id", "event_type"))


@query("t04_recent_gate", """SELECT count(*) AS tasks, count(*) FILTER (NOT done) AS open, bool_and(done) AS go FROM (SELECT p.id, bool_or(coalesce(w.processing_status_id = 2, false)) AS done FROM processing_tasks p LEFT JOIN dispatch d ON d.processing_task_fk_id = p.id
    LEFT JOIN workflow w ON w.dispatch_fk_id = d.id WHERE p.creation_date >= TIMESTAMP '1998-01-01' GROUP BY p.id)""", "processing_tasks dispatch workflow")
def _(t):
    return K.gate(K.with_status(t("processing_tasks"), t("dispatch"), t("workflow")), "1998-01-01")


@query("t08_new_against_history", "SELECT DISTINCT user_id FROM events WHERE user_id NOT IN (SELECT c_custkey FROM customer WHERE c_custkey % 3 = 0)")
def _(t):
    history = t("customer").where("c_custkey % 3 = 0").select(col("c_custkey").alias("user_id"))
    return ST.run_available(ST.new_keys(stream(t), ["user_id"], "3650 days"), each=lambda batch, _: batch.join(history, "user_id", "left_anti"))


@query("t03_debounced", """WITH l AS (SELECT *, CASE WHEN ts - lag(ts) OVER w < INTERVAL 30 MINUTE THEN 0 ELSE 1 END AS first FROM events WINDOW w AS (PARTITION BY event_type ORDER BY ts)), g AS (SELECT *, sum(first) OVER (PARTITION BY event_type ORDER BY ts ROWS UNBOUNDED PRECEDING) AS k FROM l)
    SELECT event_type, min(ts) AS start, max(ts) + INTERVAL 30 MINUTE AS run_at, count(*) AS n FROM g GROUP BY event_type, k""")
def _(t):
    return ST.run_available(ST.debounced(closing(t), "30 minutes"))


@query("n12_outside", """SELECT g.tile, g.r, g.c FROM grid g WHERE NOT EXISTS (SELECT 1 FROM feature_cells f WHERE (f.tile, f.r, f.c) = (g.tile, g.r, g.c))""", "grid feature_cells")
def _(t):
    return X.outside(t("grid"), t("feature_cells"))


@query("s26_take_boxes", "SELECT o_custkey AS take, min(o_orderkey % 97 * 100) - 120 AS x0, max(o_orderkey % 97 * 100 + 900) + 120 AS x1 FROM orders GROUP BY 1")
def _(t):
    return X.take_boxes(t("orders").selectExpr("o_custkey as take", "o_orderkey % 97 * 100 as x0", "o_orderkey % 97 * 100 + 900 as x1"), ["take"], 120)


@query("k05_colours", "SELECT tile, r, c, d, CASE v WHEN 205 THEN 8421504 WHEN 210 THEN 255 WHEN 255 THEN 0 ELSE v * 65793 END AS colour FROM obs WHERE v IN (0, 100, 205, 210, 255)", "obs")
def _(t):
    palette = t.spark.createDataFrame([(205, 8421504), (210, 255), (255, 0), (0, 0), (100, 6579300)], "v int, colour int")
    return X.coloured(t("obs"), palette).select("tile", "r", "c", "d", "colour")


@query("k11_plan_json", """SELECT id, concat('{"id":', id, ',"vm":', virtual_machine_id, ',"t0":', CAST((id * 7) % 200 AS INT), '}') AS plan FROM processing_tasks""", "processing_tasks")
def _(t):
    return t("processing_tasks").select("id", KF.plan_json(id=col("id"), vm=col("virtual_machine_id"), t0=((col("id") * 7) % 200).cast("int")).alias("plan"))


@query("k17_confusion_csv", "SELECT tile, concat_ws(',', tile, count(*) FILTER (v > 0 AND qc > 1), count(*) FILTER (v > 0 AND qc <= 1), count(*) FILTER (v = 0 AND qc > 1), count(*) FILTER (v = 0 AND qc <= 1)) AS line FROM obs WHERE v <= 100 GROUP BY tile", "obs")
def _(t):
    pairs = t("obs").where("v <= 100").selectExpr("tile", "cast(v > 0 as int) as ref", "cast(qc > 1 as int) as est")
    return S.confusion(pairs, "ref", "est", ["tile"]).select("tile", F.to_csv(F.struct("tile", "tp", "fn", "fp", "tn")).alias("line"))


@query("m02_loss_grid", f"""WITH x AS (SELECT (green - swir) / greatest(green + swir, 1)::DOUBLE AS x, ((green * 7 + red) % 101)::DOUBLE / 100 AS y, l_orderkey % 4 = 0 AS test FROM bands), p AS (SELECT 1.0::DOUBLE + i * 0.55 AS a, -2.0::DOUBLE + j * 0.29 AS b FROM generate_series(0, 6) s(i), generate_series(0, 6) u(j))
    SELECT CAST(round(a, 6) AS DOUBLE) AS a, CAST(round(b, 6) AS DOUBLE) AS b, CAST(round(sqrt(avg((0.5 * tanh(a * x + b) + 0.5 - y) ** 2) FILTER (NOT test)), 6) AS DOUBLE) AS train, CAST(round(sqrt(avg((0.5 * tanh(a * x + b) + 0.5 - y) ** 2) FILTER (test)), 6) AS DOUBLE) AS test FROM x, p GROUP BY p.a, p.b""", "bands")
def _(t):
    x = t("bands").selectExpr("(green - swir) / double(greatest(green + swir, 1)) as x", "double((green * 7 + red) % 101) / 100 as y", "l_orderkey % 4 = 0 as test")
    return models.loss_grid(x, "x", "y", col("test"), [(1.0 + i * 0.55, -2.0 + j * 0.29) for i in range(7) for j in range(7)])


@query("s12_search", f"""WITH {NAMES}, x AS (SELECT n.id, name, o_orderdate::TIMESTAMP AS date, o_custkey % 90 AS x0, o_orderkey % 70 AS y0 FROM n JOIN orders ON o_orderkey = id)
    SELECT id, name, date FROM x WHERE contains(name, 'KIND1') AND date >= TIMESTAMP '1994-01-01' AND date < TIMESTAMP '1997-01-01' AND x0 < 60 AND x0 + 8 > 20 AND y0 < 50 AND y0 + 6 > 10 ORDER BY date, name LIMIT 40 OFFSET 5""")
def _(t):
    place = t("orders").selectExpr("o_orderkey as id", "cast(o_orderdate as timestamp) as date", "o_custkey % 90 as x0", "o_orderkey % 70 as y0", "o_custkey % 90 + 8 as x1", "o_orderkey % 70 + 6 as y1")
    return SF.catalogue_filter(names(t).join(place, "id"), "KIND1", "1994-01-01", "1997-01-01", (20, 10, 60, 50), 40, 5).select("id", "name", "date")


@query("j10_overlapping_scene", f"""WITH {SCENES} SELECT qid, rid, rd FROM (SELECT qid, rid, rd, row_number() OVER (PARTITION BY qid ORDER BY abs(rd - d), ratio, rd, rid) AS k FROM q JOIN s ON s.tile = q.tile AND abs(rd - d) <= 4
    AND qid % 50 < rid % 50 + 20 AND rid % 50 < qid % 50 + 20) WHERE k = 1""")
def _(t):
    s, q = scenes(t)
    s, q = s.withColumn("y", col("rid") % 50), q.withColumn("x", col("qid") % 50)
    return S.nearest_in_time(q, s, ["tile"], 4, ["qid"], where="x < y + 20 and y < x + 20", seen=(["x"], ["y"]))


@query("k10_outline", """WITH s AS (SELECT * FROM (VALUES (-1, 0, 0, 0, 1, 0), (0, 1, 1, 0, 1, 1), (1, 0, 1, 1, 0, 1), (0, -1, 0, 1, 0, 0)) v(i, j, a, b, e, f))
    SELECT fid, tile, c + a AS x0, r + b AS y0, c + e AS x1, r + f AS y1 FROM feature_cells x, s WHERE NOT EXISTS (SELECT 1 FROM feature_cells y WHERE (y.fid, y.tile, y.r, y.c) = (x.fid, x.tile, x.r + i, x.c + j))""", "feature_cells")
def _(t):
    return P.outline(t("feature_cells"), ["fid"])


@query("k01_written_cells", "SELECT tile, r, c, d, v, CAST(year(d) AS INT) AS year FROM obs", "obs")
def _(t):
    path = shared_path(t.spark, "cells")
    KF.write_cells(t("obs").select("tile", "r", "c", "d", "v", F.year("d").alias("year")), path, by=("tile", "year"))
    return t.spark.read.parquet(path).select("tile", "r", "c", "d", "v", "year")


@query("k12_appended_batches", "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate, mission, v FROM obs_raw", "obs_raw")
def _(t):
    path, rows = shared_path(t.spark, "batches"), t("obs_raw").select(*BANDS, "mission", "v")
    for mission in ("S1", "S2", "S1"):  # the first one again: it takes its own place
        KF.append_batch(rows.where(col("mission") == mission), path, mission)
    return t.spark.read.parquet(path).drop("batch")


def enlarged(near: str, far: str) -> str:
    """SQL: images of the ground twice as large, from all cells within two of a place; near and far are the kernel's weight
    at distances under 1 and under 2."""
    w = lambda d: f"(CASE WHEN {d} < 1 THEN {near.replace('D', d)} WHEN {d} < 2 THEN {far.replace('D', d)} ELSE 0 END)"
    return f"""WITH m AS (SELECT tile, max(r) + 1 AS h, max(c) + 1 AS w FROM dem GROUP BY tile), p AS (SELECT tile, r, unnest(range(2 * w)) AS c FROM (SELECT tile, w, unnest(range(2 * h)) AS r FROM m)),
    q AS (SELECT *, (r + 0.5::DOUBLE) / 2 - 0.5 AS y, (c + 0.5::DOUBLE) / 2 - 0.5 AS x FROM p), n AS (SELECT q.tile, q.r, q.c, g.z, {w("abs(y - g.r)")} * {w("abs(x - g.c)")} AS w FROM q JOIN dem g ON g.tile = q.tile AND g.r BETWEEN floor(y) - 1 AND floor(y) + 2 AND g.c BETWEEN floor(x) - 1 AND floor(x) + 2)
    SELECT tile, CAST(r AS INT) AS r, CAST(c AS INT) AS c, CAST(round(sum(z * w) / sum(w), 4) AS DOUBLE) AS z FROM n GROUP BY tile, r, c HAVING sum(w) > 1e-6"""


@query("j14_cubic", enlarged("(1.5 * D * D * D - 2.5 * D * D + 1)", "(-0.5 * D * D * D + 2.5 * D * D - 4 * D + 2)"), "dem")
def _(t):
    return resample.enlarge(t("dem"), "z", 2, "cubic").withColumn("z", F.round("z", 4))


@query("j14_cubic_spline", enlarged("(0.5 * D * D * D - D * D + 2e0 / 3)", "((2 - D) * (2 - D) * (2 - D) / 6)"), "dem")
def _(t):
    return resample.enlarge(t("dem"), "z", 2, "cubicspline").withColumn("z", F.round("z", 4))


@query("n11_coarse_red", """WITH m AS (SELECT tile, max(r) + 1 AS h, max(c) + 1 AS w, greatest(1, (max(r) + 1) // 12) AS hs, greatest(1, (max(c) + 1) // 12) AS ws FROM dem GROUP BY tile),
    p AS (SELECT tile, h, w, hs, ws, i, unnest(range(ws)) AS j FROM (SELECT *, unnest(range(hs)) AS i FROM m)),
    n AS (SELECT p.tile, i, j, z, greatest(0, 1 - abs((i + 0.5::DOUBLE) * h / hs - r - 0.5) / (h / hs::DOUBLE)) * greatest(0, 1 - abs((j + 0.5::DOUBLE) * w / ws - c - 0.5) / (w / ws::DOUBLE)) AS k FROM p JOIN dem g ON g.tile = p.tile),
    s AS (SELECT tile, i, j, round(sum(z * k) / sum(k), 4) AS z FROM n GROUP BY tile, i, j), q AS (SELECT tile, h, w, hs, ws, r, unnest(range(w)) AS c FROM (SELECT *, unnest(range(h)) AS r FROM m))
    SELECT q.tile, CAST(r AS INT) AS r, CAST(c AS INT) AS c, CAST(z AS DOUBLE) AS z FROM q JOIN s ON s.tile = q.tile AND s.i = CAST(floor((r + 0.5) * hs / h) AS BIGINT) AND s.j = CAST(floor((c + 0.5) * ws / w) AS BIGINT)""", "dem")
def _(t):
    return resample.coarse(t("dem").select("tile", "r", "c", "z"), "z").withColumn("z", F.round("z", 4))


#: A grid of 0.1 degrees, north up, whose north-west corner is at 6 degrees east and 48 north; and cells of 2 km in zone 32.
GRID = (6.0, 0.1, 0.0, 48.0, 0.0, -0.1)


@query("j13_geographic_lookup", f"""WITH {degrees_sql("SELECT tile, r, c, 32 AS zone, 300000.0::DOUBLE + 2000 * c AS x, 5300000.0::DOUBLE - 2000 * r AS y FROM water", "tile, r, c")},
    k AS (SELECT tile, r, c, CAST(round_even((lat - 48 + 0.05) / -0.1, 0) AS INT) AS mr, CAST(round_even((lon - 6 - 0.05) / 0.1, 0) AS INT) AS mc FROM w)
    SELECT tile, r, c, mr, mc, mr * 1000 + mc AS temperature FROM k WHERE mr BETWEEN 0 AND 24 AND mc BETWEEN 0 AND 39""", "water")
def _(t):
    grid = t("nation").select(col("n_nationkey").cast("int").alias("mr"), F.explode(F.sequence(F.lit(0), F.lit(39))).alias("mc")).withColumn("temperature", col("mr") * 1000 + col("mc"))
    return P.geographic_lookup(t("water"), F.lit(32), (300000.0, 2000.0, 0.0, 5300000.0, 0.0, -2000.0), grid, GRID, "temperature")


SUN = """WITH o AS (SELECT o_orderkey AS id, o_orderdate + INTERVAL 1 HOUR * CAST(o_custkey % 24 AS INT) AS t, o_custkey % 360 - 180.0::DOUBLE AS lon, o_orderkey % 140 - 70.0::DOUBLE AS lat FROM orders),
    a AS (SELECT *, 2 * pi() / (CASE WHEN year(t) % 4 = 0 AND (year(t) % 100 <> 0 OR year(t) % 400 = 0) THEN 366 ELSE 365 END) * (dayofyear(t) - 1 + (hour(t) - 12) / 24.0::DOUBLE) AS g FROM o),
    b AS (SELECT *, 229.18 * (0.000075 + 0.001868 * cos(g) - 0.032077 * sin(g) - 0.014615 * cos(2 * g) - 0.040849 * sin(2 * g)) AS eq, 0.006918 - 0.399912 * cos(g) + 0.070257 * sin(g) - 0.006758 * cos(2 * g) + 0.000907 * sin(2 * g) - 0.002697 * cos(3 * g) + 0.00148 * sin(3 * g) AS d FROM a),
    c AS (SELECT *, hour(t) * 60 + lon * 4 + eq AS minutes, radians(lat) AS p FROM b), h AS (SELECT *, radians(minutes / 4 - 180) AS h FROM c)"""


@query("s09_solar_position", f"""{SUN} SELECT id, CAST(round(eq, 6) AS DOUBLE) AS equation, CAST(round(minutes, 3) AS DOUBLE) AS minutes, CAST(round(((degrees(atan2(-cos(d) * sin(h), cos(p) * sin(d) - sin(p) * cos(d) * cos(h))) % 360) + 360) % 360, 4) AS DOUBLE) AS azimuth,
    CAST(round(degrees(asin(sin(p) * sin(d) + cos(p) * cos(d) * cos(h))), 4) AS DOUBLE) AS elevation FROM h""")
def _(t):
    o = t("orders").select(col("o_orderkey").alias("id"), F.expr("timestamp(o_orderdate) + make_interval(0, 0, 0, 0, int(o_custkey % 24))").alias("t"), F.expr("double(o_custkey % 360 - 180)").alias("lon"), F.expr("double(o_orderkey % 140 - 70)").alias("lat"))
    azimuth, elevation = solar.position(col("t"), col("lon"), col("lat"))
    since = F.unix_micros(solar.local_solar_time(col("t"), col("lon"))) - F.unix_micros(F.date_trunc("day", "t"))
    return o.select("id", F.round(solar.equation_of_time(col("t")), 6).alias("equation"), F.round(since / 6e7, 3).alias("minutes"), F.round(azimuth, 4).alias("azimuth"), F.round(elevation, 4).alias("elevation"))
