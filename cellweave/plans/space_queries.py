"""Registered queries of neighbourhoods, zones, altitude and validation."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import selections
from ..operators import neighbours as N
from ..operators import stats as S
from ..registry import query

col = F.col
#: One value a cell: the newest of each cell, with snow as 100.
LATEST = """x AS (SELECT o.tile, o.r, o.c, max_by(CASE WHEN v BETWEEN 1 AND 100 THEN 100 WHEN v = 0 THEN 0 WHEN v = 205 THEN 205 ELSE 255 END, d) AS v, max_by(qc, d) AS qc, any_value(z) AS z FROM obs o JOIN dem USING (tile, r, c) GROUP BY o.tile, o.r, o.c)"""
USES = "obs dem"


def latest(t):
    code = F.when(col("v").between(1, 100), 100).when(col("v") == 0, 0).when(col("v") == 205, 205).otherwise(255)
    x = t("obs").groupBy("tile", "r", "c").agg(F.max_by(code, "d").alias("v"), F.max_by("qc", "d").alias("qc"))
    return x.join(t("dem"), ["tile", "r", "c"]).select("tile", "r", "c", "v", "qc", "z")


NEAR = "n AS (SELECT a.tile, a.r, a.c, a.v, a.z, b.v AS nv, b.z AS nz, b.r - a.r AS i, b.c - a.c AS j FROM x a LEFT JOIN x b ON b.tile = a.tile AND abs(b.r - a.r) <= 1 AND abs(b.c - a.c) <= 1)"


@query("n01_four_vote", f"WITH {LATEST}, {NEAR} SELECT tile, r, c, CASE WHEN v = 205 AND count(*) FILTER (abs(i) + abs(j) = 1 AND nv = 100) = 4 THEN 100 ELSE v END AS v FROM n GROUP BY tile, r, c, v", USES)
def _(t):
    return N.four_vote(latest(t))


@query("n02_downhill_vote", f"WITH {LATEST}, {NEAR} SELECT tile, r, c, CASE WHEN v = 205 AND coalesce(bool_or((i <> 0 OR j <> 0) AND nv = 100 AND nz < z), false) THEN 100 ELSE v END AS v FROM n GROUP BY tile, r, c, v", USES)
def _(t):
    return N.downhill_vote(latest(t))


@query("n03_altitude_rule", f"""WITH {LATEST}, a AS (SELECT tile, 100.0 * count(*) FILTER (v = 205) / count(*) AS cl, min(z) FILTER (v = 100) AS low, max(z) FILTER (v = 0) AS bare FROM x GROUP BY tile),
    b AS (SELECT x.tile, min(z) FILTER (v = 100 AND z > bare) AS high FROM x JOIN a ON a.tile = x.tile GROUP BY x.tile)
    SELECT x.tile, r, c, CASE WHEN v = 205 AND cl < 30 THEN CASE WHEN z < low THEN 0 WHEN z > high THEN 100 ELSE v END ELSE v END AS v FROM x JOIN a ON a.tile = x.tile JOIN b ON b.tile = x.tile""", USES)
def _(t):
    return N.altitude_rule(latest(t))


@query("n06_contour", f"WITH {LATEST}, {NEAR} SELECT tile, r, c, CASE WHEN v = 100 AND bool_or((i <> 0 OR j <> 0) AND nv <> 100) THEN 1 ELSE 0 END AS contour FROM n GROUP BY tile, r, c, v", USES)
def _(t):
    return N.contour(latest(t))


@query("n07_gradient", f"""WITH {LATEST}, {NEAR} SELECT tile, r, c, CAST(round(0.5 * abs(sum(nz * j * CASE WHEN i = 0 THEN 2 ELSE 1 END) / 8.0) + 0.5 * abs(sum(nz * i * CASE WHEN j = 0 THEN 2 ELSE 1 END) / 8.0) + 1, 6) AS DOUBLE) AS gradient
    FROM n GROUP BY tile, r, c HAVING count(*) = 9""", USES)
def _(t):
    return N.gradient_magnitude(latest(t), "z")


@query("n08_box_deviation", f"""WITH {LATEST} SELECT a.tile, a.r, a.c, CAST(round(sqrt(greatest(sum(b.z * b.z)::DOUBLE / count(*) - (sum(b.z)::DOUBLE / count(*)) * (sum(b.z)::DOUBLE / count(*)), 0)), 6) AS DOUBLE) AS deviation
    FROM x a JOIN x b ON b.tile = a.tile AND abs(b.r - a.r) <= 2 AND abs(b.c - a.c) <= 2 GROUP BY a.tile, a.r, a.c""", USES)
def _(t):
    return N.box_deviation(latest(t), "z", 2)


SHADE = "(-dx * 0.5 - dy * 0.3 + 0.8) / sqrt(dx * dx + dy * dy + 1)"


@query("n09_n10_hillshade", f"""WITH {LATEST}, g AS (SELECT tile, r, c, (coalesce(lead(z) OVER (PARTITION BY tile, r ORDER BY c), z) - z) / 500.0::DOUBLE AS dx, (coalesce(lead(z) OVER (PARTITION BY tile, c ORDER BY r), z) - z) / 500.0::DOUBLE AS dy FROM x)
    SELECT tile, r, c, CAST(round({SHADE}, 6) AS DOUBLE) AS shade, CAST({SHADE} < 0.2 AS INT) AS mask FROM g""", USES)
def _(t):
    return N.hillshade(latest(t), 500.0, (0.5, 0.3, 0.8))


@query("n11_smooth", f"WITH {LATEST} SELECT tile, r, c, CAST(round(avg(z) OVER (PARTITION BY tile, r // 5, c // 5), 6) AS DOUBLE) AS smooth FROM x", USES)
def _(t):
    return N.smooth(latest(t), "z", 5)


LABEL = """snow AS (SELECT tile, r, c, r * 1000000 + c AS id FROM x WHERE v = 100), reach AS (SELECT id, tile, r, c, id AS label FROM snow UNION SELECT s.id, s.tile, s.r, s.c, reach.label FROM reach JOIN snow s
    ON s.tile = reach.tile AND abs(s.r - reach.r) + abs(s.c - reach.c) = 1), labels AS (SELECT tile, r, c, min(label) AS label FROM reach GROUP BY tile, r, c)"""


def recursive(body: str) -> str:
    return f"WITH RECURSIVE {LATEST}, {LABEL} {body}"


@query("n05_label", recursive("SELECT tile, r, c, CAST(label // 1000000 AS INT) AS label_r, CAST(label % 1000000 AS INT) AS label_c FROM labels"), USES)
def _(t):
    return N.label(latest(t), col("v") == 100).select("tile", "r", "c", col("label.r").alias("label_r"), col("label.c").alias("label_c"))


@query("a27_area_sizes", recursive("SELECT tile, CAST(label // 1000000 AS INT) AS label_r, CAST(label % 1000000 AS INT) AS label_c, count(*) AS size FROM labels GROUP BY ALL"), USES)
def _(t):
    return N.label(latest(t), col("v") == 100).groupBy("tile", col("label.r").alias("label_r"), col("label.c").alias("label_c")).agg(F.count("*").alias("size"))


@query("n04_drop_islands", recursive("""SELECT x.tile, x.r, x.c, CASE WHEN (l.tile, l.label) IN (SELECT (tile, label) FROM (SELECT tile, label, avg(CASE WHEN v = 205 THEN 1.0 ELSE 0.0 END) AS share FROM (SELECT DISTINCT l.label, o.tile, o.r, o.c, o.v FROM labels l
    JOIN x o ON o.tile = l.tile AND (o.r - l.r) * (o.r - l.r) + (o.c - l.c) * (o.c - l.c) <= 4 LEFT JOIN labels m ON (m.tile, m.r, m.c) = (o.tile, o.r, o.c) WHERE m.label IS NULL)
    WHERE (tile, label) IN (SELECT (tile, label) FROM labels GROUP BY tile, label HAVING count(*) > 1) GROUP BY tile, label) WHERE share > 0.3)
    THEN 205 ELSE x.v END AS v FROM x LEFT JOIN labels l ON (l.tile, l.r, l.c) = (x.tile, x.r, x.c)"""), USES)
def _(t):
    x = latest(t)
    return N.drop_islands(x, N.label(x, col("v") == 100), 0.3, 1, radius=2)


@query("n13_clip_and_pad", f"""WITH {LATEST} SELECT g.tile, g.r, g.c, coalesce(x.v, 255) AS v FROM (SELECT tile, CAST(i AS INT) AS r, CAST(j AS INT) AS c FROM (SELECT DISTINCT tile FROM x), generate_series(7, 11) p(i), generate_series(-1, 3) q(j)) g
    LEFT JOIN x ON (x.tile, x.r, x.c) = (g.tile, g.r, g.c)""", USES)
def _(t):
    s = lambda a, b: F.explode(F.sequence(F.lit(a), F.lit(b)))
    cells = latest(t)
    frame = cells.select("tile").distinct().select("tile", s(7, 11).alias("r")).select("*", s(-1, 3).alias("c"))
    return frame.join(cells, ["tile", "r", "c"], "left").select("tile", "r", "c", F.coalesce("v", F.lit(255)).alias("v"))


HISTOGRAM = """h0 AS (SELECT *, min(z) OVER (PARTITION BY tile) AS low FROM x), h AS (SELECT tile, low, CAST((z - low) // 200 AS INT) AS bin, count(*) AS total, count(*) FILTER (v >= 205) AS clouds, count(*) FILTER (v = 100) AS snows, count(*) FILTER (v = 0) AS bare FROM h0 GROUP BY 1, 2, 3)"""


def histogram(t):
    return S.altitude_histogram(latest(t).selectExpr("*", "cast(v >= 205 as int) as cloud", "cast(v = 100 as int) as snow"), 200, ["tile"])


@query("a08_altitude_histogram", f"WITH {LATEST}, {HISTOGRAM} SELECT * FROM h", USES)
def _(t):
    return histogram(t)


@query("a07_snow_line", f"""WITH {LATEST}, {HISTOGRAM} SELECT tile, CAST(CASE WHEN a IS NULL THEN -1000 ELSE floor(low + greatest(a - 2, 0) * 200) END AS INT) AS line, CAST(CASE WHEN b IS NULL THEN -1000 ELSE floor(low + greatest(b - 2, 0) * 200) END AS INT) AS top_line
    FROM (SELECT tile, low, min(bin) FILTER (low + bin * 200 + 100 >= -413 AND total - clouds > 0.2 * total AND snows > 0.3 * (total - clouds)) AS a, max(bin) FILTER (low + bin * 200 + 100 >= -413 AND total - clouds > 0.2 * total AND snows > 0.3 * (total - clouds)) AS b FROM h GROUP BY tile, low)""", USES)
def _(t):
    h = histogram(t)
    return S.snow_line(h, 200, 0.2, 0.3, ["tile"]).join(S.snow_line(h, 200, 0.2, 0.3, ["tile"], reverse=True).withColumnRenamed("line", "top_line"), "tile")


@query("a09_count_in_range", "SELECT tile, count(*) FILTER (v BETWEEN 1 AND 100) AS n FROM obs GROUP BY tile", "obs")
def _(t):
    return t("obs").groupBy("tile").agg(F.count_if(col("v").between(1, 100)).alias("n"))


@query("a10_percent", "SELECT tile, CAST(round(100.0 * count(*) FILTER (v = 205) / nullif(count(*) FILTER (v <> 255), 0), 6) AS DOUBLE) AS percent FROM obs GROUP BY tile", "obs")
def _(t):
    return S.percent(t("obs"), col("v") == 205, col("v") != 255, ["tile"])


@query("j12_a17_zonal", """WITH z AS (SELECT tile, r, c, d, CASE WHEN v = 0 THEN 1 WHEN v BETWEEN 1 AND 100 THEN 100 WHEN v = 210 THEN 254 ELSE v END AS v, CASE WHEN v = 205 THEN 205 ELSE qc END AS qc FROM obs),
    m AS (SELECT fid, count(*) AS cells FROM feature_cells GROUP BY fid), p AS (SELECT fid, d, CAST(round_even(100.0 * count(*) FILTER (v = 1) / any_value(cells), 0) AS INT) AS water, CAST(round_even(100.0 * count(*) FILTER (v = 100) / any_value(cells), 0) AS INT) AS ice,
    CAST(round_even(100.0 * count(*) FILTER (v = 205) / any_value(cells), 0) AS INT) AS cloud, CAST(round_even(100.0 * count(*) FILTER (v = 254) / any_value(cells), 0) AS INT) AS other,
    CAST(coalesce(round_even(avg(CASE WHEN qc = 205 THEN 0 ELSE qc END) FILTER (qc IN (0, 1, 2, 3, 205)), 0), 255) AS INT) AS quality
    FROM feature_cells f JOIN z o ON (o.tile, o.r, o.c) = (f.tile, f.r, f.c) JOIN m USING (fid) GROUP BY fid, d) SELECT *, 100 - water - ice - cloud - other AS left_over FROM p WHERE 100 - water - ice - cloud - other <> 100""", "feature_cells obs")
def _(t):
    layer = F.when(col("v") == 0, 1).when(col("v").between(1, 100), 100).when(col("v") == 210, 254).otherwise(col("v"))
    return S.zonal(t("obs").select("tile", "r", "c", "d", layer.alias("v"), F.when(col("v") == 205, 205).otherwise(col("qc")).alias("qc")), t("feature_cells"), ["d"])


PAIRS = "pr AS (SELECT *, CAST(v > 0 AS INT) AS ref, CAST((v + qc) % 5 > 1 AS INT) AS est FROM obs WHERE v <= 100)"


@query("a18_confusion", f"""WITH {PAIRS}, g AS (SELECT tile, count(*) FILTER (ref = 1 AND est = 1) AS tp, count(*) FILTER (ref = 0 AND est = 0) AS tn, count(*) FILTER (ref = 0 AND est = 1) AS fp, count(*) FILTER (ref = 1 AND est = 0) AS fn FROM pr GROUP BY tile),
    h AS (SELECT *, (tp + tn)::DOUBLE / (tp + tn + fp + fn) AS po, ((tp + fn) * (tp + fp) + (tn + fp) * (tn + fn))::DOUBLE / ((tp + tn + fp + fn)::DOUBLE * (tp + tn + fp + fn)) AS pe FROM g)
    SELECT tile, tp, tn, fp, fn, CAST(round(100 * po, 6) AS DOUBLE) AS agreement, CAST(round(100 * CASE WHEN pe = 1 THEN 0 ELSE (po - pe) / (1 - pe) END, 6) AS DOUBLE) AS kappa FROM h""", "obs")
def _(t):
    pairs = t("obs").where("v <= 100").selectExpr("*", "cast(v > 0 as int) as ref", "cast((v + qc) % 5 > 1 as int) as est")
    return S.confusion(pairs, "ref", "est", ["tile"])


@query("a19_altitude_bands", """SELECT band, count(*) AS n, min(v) AS low, max(v) AS high, CAST(quantile_disc(v, 0.5) AS INT) AS median FROM (SELECT v, CASE WHEN z < 500 THEN 0 WHEN z < 1000 THEN 500 WHEN z < 1500 THEN 1000 WHEN z < 2000 THEN 1500 ELSE 2000 END AS band
    FROM obs JOIN dem USING (tile, r, c) WHERE v <= 100) GROUP BY band""", "obs dem")
def _(t):
    band = F.when(col("z") < 500, 0).when(col("z") < 1000, 500).when(col("z") < 1500, 1000).when(col("z") < 2000, 1500).otherwise(2000)
    x = t("obs").where("v <= 100").join(t("dem"), ["tile", "r", "c"]).withColumn("band", band)
    return x.groupBy("band").agg(F.count("*").alias("n"), F.min("v").alias("low"), F.max("v").alias("high"), F.expr("cast(percentile_disc(0.5) within group (order by v) as int)").alias("median"))


@query("a20_days_of_value", "SELECT tile, r, c, count(*) FILTER (v = 100 OR v = 50) AS days FROM obs WHERE d BETWEEN DATE '1995-10-01' AND DATE '1996-09-30' GROUP BY 1, 2, 3", "obs")
def _(t):
    return t("obs").where("d between date'1995-10-01' and date'1996-09-30'").groupBy("tile", "r", "c").agg(F.count_if(col("v").isin(50, 100)).alias("days"))


@query("a21_agreement", """SELECT tile, count(*) AS n, CAST(round(sqrt(avg((y - x) * (y - x))), 6) AS DOUBLE) AS rmse, CAST(round(avg(y - x), 6) AS DOUBLE) AS bias, CAST(round(corr(x, y), 6) AS DOUBLE) AS r, CAST(round(regr_slope(y, x), 6) AS DOUBLE) AS slope,
    CAST(round(regr_intercept(y, x), 6) AS DOUBLE) AS intercept, CAST(round(stddev(y - x), 6) AS DOUBLE) AS sd FROM (SELECT tile, v AS x, v + qf % 20 AS y FROM obs WHERE v <= 100) GROUP BY tile""", "obs")
def _(t):
    return S.agreement(t("obs").where("v <= 100").selectExpr("tile", "v as x", "v + qf % 20 as y"), "x", "y", ["tile"])


@query("a22_altitude_extremes", f"WITH {LATEST}, a AS (SELECT tile, min(z) FILTER (v = 100) AS low, max(z) FILTER (v = 0) AS bare FROM x GROUP BY tile) SELECT x.tile, min(a.low) AS low, min(z) FILTER (v = 100 AND z > bare) AS high FROM x JOIN a ON a.tile = x.tile GROUP BY x.tile", USES)
def _(t):
    x = latest(t)
    a = x.groupBy("tile").agg(F.min(F.when(col("v") == 100, col("z"))).alias("low"), F.max(F.when(col("v") == 0, col("z"))).alias("bare"))
    return x.join(F.broadcast(a), "tile").groupBy("tile").agg(F.min("low").alias("low"), F.min(F.when((col("v") == 100) & (col("z") > col("bare")), col("z"))).alias("high"))


@query("a28_masked_histogram", "SELECT tile, CAST(v // 10 AS INT) AS bin, count(*) AS n FROM obs WHERE v <= 100 AND qf % 2 = 0 GROUP BY 1, 2", "obs")
def _(t):
    return t("obs").where("v <= 100 and qf % 2 = 0").groupBy("tile", F.expr("cast(v div 10 as int)").alias("bin")).agg(F.count("*").alias("n"))


SCENES = "s AS (SELECT o_orderkey AS rid, o_custkey % 40 AS tile, CAST(o_orderdate AS DATE) AS rd, o_custkey % 100 AS ratio FROM orders WHERE o_orderkey % 2 = 0), q AS (SELECT o_orderkey AS qid, o_custkey % 40 AS tile, CAST(o_orderdate AS DATE) AS d FROM orders WHERE o_orderkey % 2 = 1)"


def scenes(t):
    o = t("orders")
    s = o.where("o_orderkey % 2 = 0").selectExpr("o_orderkey as rid", "o_custkey % 40 as tile", "cast(o_orderdate as date) as rd", "o_custkey % 100 as ratio")
    return s, o.where("o_orderkey % 2 = 1").selectExpr("o_orderkey as qid", "o_custkey % 40 as tile", "cast(o_orderdate as date) as d")


@query("j10_closest_scene", f"WITH {SCENES} SELECT qid, rid, rd FROM (SELECT qid, rid, rd, row_number() OVER (PARTITION BY qid ORDER BY abs(rd - d), ratio, rd, rid) AS k FROM q JOIN s ON s.tile = q.tile AND abs(rd - d) <= 4) WHERE k = 1")
def _(t):
    s, q = scenes(t)
    return S.nearest_in_time(q, s, ["tile"], 4, ["qid"])


@query("j10_cleanest_scene", f"WITH {SCENES} SELECT qid, rid, rd FROM (SELECT qid, rid, rd, row_number() OVER (PARTITION BY qid ORDER BY ratio, abs(rd - d), rd, rid) AS k FROM q JOIN s ON s.tile = q.tile AND abs(rd - d) <= 4) WHERE k = 1")
def _(t):
    s, q = scenes(t)
    return S.nearest_in_time(q, s, ["tile"], 4, ["qid"], "cleanest")


@query("j11_point_in_cell", """SELECT p.pid, max_by(o.v, -abs(o.d - p.d) * 100000 - CAST(strftime(o.d, '%j') AS INT)) AS v, min(abs(o.d - p.d)) AS lag FROM (SELECT o_orderkey AS pid, CAST(o_custkey % 4 AS INT) AS tile, CAST(floor((o_orderkey % 100) / 10.0) AS INT) AS r, CAST(floor((o_custkey % 100) / 10.0) AS INT) AS c,
    CAST(o_orderdate AS DATE) AS d FROM orders) p JOIN obs o ON (o.tile, o.r, o.c) = (p.tile, p.r, p.c) AND abs(o.d - p.d) < 5 GROUP BY p.pid""", "obs")
def _(t):
    p = t("orders").selectExpr("o_orderkey as pid", "cast(o_custkey % 4 as int) as tile", "cast(floor((o_orderkey % 100) / 10.0) as int) as r", "cast(floor((o_custkey % 100) / 10.0) as int) as c", "cast(o_orderdate as date) as pd")
    width = 5
    a = p.withColumn("b", F.explode(F.expr(f"array(floor(unix_date(pd) / {width}) - 1, floor(unix_date(pd) / {width}), floor(unix_date(pd) / {width}) + 1)")))
    near = a.join(t("obs").withColumn("b", F.expr(f"floor(unix_date(d) / {width})")), ["tile", "r", "c", "b"]).where(F.abs(F.datediff("d", "pd")) < 5)
    lag = F.abs(F.datediff("d", "pd"))
    return near.groupBy("pid").agg(F.max_by("v", -lag * 100000 - F.dayofyear("d")).alias("v"), F.min(lag).cast("bigint").alias("lag"))


@query("j13_coarse_lookup", "SELECT w.tile, w.r, w.c, m.z FROM water w JOIN dem m ON m.tile = w.tile AND m.r = CAST(round_even(w.r / 3.0, 0) AS INT) AND m.c = CAST(round_even(w.c / 3.0, 0) AS INT)", "water dem")
def _(t):
    m = t("dem").withColumnRenamed("r", "mr").withColumnRenamed("c", "mc")
    w = t("water").withColumn("mr", F.bround(col("r") / 3.0, 0).cast("int")).withColumn("mc", F.bround(col("c") / 3.0, 0).cast("int"))
    return w.join(m, ["tile", "mr", "mc"]).select("tile", "r", "c", "z")


@query("j16_overlapping_boxes", """WITH f AS (SELECT fid, tile, min(r) AS r0, max(r) AS r1, min(c) AS c0, max(c) AS c1 FROM feature_cells GROUP BY 1, 2) SELECT a.fid AS a, b.fid AS b, (b.r0 >= a.r0 AND b.r1 <= a.r1 AND b.c0 >= a.c0 AND b.c1 <= a.c1) AS inside
    FROM f a JOIN f b ON a.tile = b.tile AND a.fid <> b.fid AND a.r0 <= b.r1 AND b.r0 <= a.r1 AND a.c0 <= b.c1 AND b.c0 <= a.c1""", "feature_cells")
def _(t):
    f = t("feature_cells").groupBy("fid", "tile").agg(F.min("r").alias("r0"), F.max("r").alias("r1"), F.min("c").alias("c0"), F.max("c").alias("c1"))
    return selections.overlapping_boxes(f, 8)


@query("j15_densified_dates", """SELECT tile, r, c, d, coalesce(min_by(v, p) FILTER (v <= 100), max_by(v, p)) AS v FROM (SELECT tile, r, c, d, v, CASE WHEN mission = 'S2' THEN 0 ELSE 1 END * 1000000000000 + l_orderkey * 100000 + l_partkey * 10 + l_linenumber AS p FROM obs_raw) GROUP BY 1, 2, 3, 4""", "obs_raw")
def _(t):
    from ..operators.timeseries import merge_by_priority

    p = F.expr("case when mission = 'S2' then 0 else 1 end * 1000000000000 + l_orderkey * 100000 + l_partkey * 10 + l_linenumber")
    return merge_by_priority(t("obs_raw"), p, ["tile", "r", "c", "d"])
