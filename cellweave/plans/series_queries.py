"""Registered queries of time series and grids."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import grid, timeseries as ts
from ..registry import query

col = F.col
BIG = lambda df, *names: df.select(*[F.col(c).cast("bigint").alias(c) if c in names else F.col(c) for c in df.columns])

FILLED = """SELECT tile, r, c, coalesce(max_by(v, d) FILTER (v NOT IN (205, 255)), min_by(v, d) FILTER (v <> 255), 255) AS v,
    coalesce(max_by(qc, d) FILTER (v NOT IN (205, 255)), min_by(qc, d) FILTER (v <> 255), 255) AS qc, coalesce(max_by(qf, d) FILTER (v NOT IN (205, 255)), min_by(qf, d) FILTER (v <> 255), 0) AS qf,
    coalesce(max_by(d, d) FILTER (v NOT IN (205, 255)), min_by(d, d) FILTER (v <> 255)) AS d
    FROM (SELECT *, max(d) OVER (PARTITION BY tile) AS last FROM obs) WHERE d > last - INTERVAL {n} DAY OR (d = last - INTERVAL {n} DAY AND d = last) GROUP BY tile, r, c"""


@query("w01_fill_newest_first", """SELECT tile, r, c, coalesce(max_by(v, d) FILTER (v NOT IN (205, 255)), max_by(v, d)) AS v, coalesce(max_by(qc, d) FILTER (v NOT IN (205, 255)), max_by(qc, d)) AS qc,
    coalesce(max_by(qf, d) FILTER (v NOT IN (205, 255)), max_by(qf, d)) AS qf, coalesce(max(d) FILTER (v NOT IN (205, 255)), max(d)) AS d FROM obs GROUP BY tile, r, c""", "obs")
def _(t):
    return ts.fill_newest_first(t("obs"))


@query("w02_fill_window", FILLED.format(n=60), "obs")
def _(t):
    return ts.fill_window(t("obs"), 60)


@query("flagship_gap_filled_snow", f"""SELECT f.tile, f.r, f.c, CASE WHEN wl IN (1, 2) THEN 210 ELSE v END AS v, CASE WHEN wl IN (1, 2) THEN 210 ELSE qc END AS qc, qf, d
    FROM ({FILLED.format(n=60)}) f JOIN water USING (tile, r, c)""", "obs water")
def _(t):
    """The gap-filled composite of each tile's last 60 days, with water."""
    from ..functions.cells import water_fill

    out = ts.fill_window(t("obs"), 60).join(t("water"), ["tile", "r", "c"])
    return out.select("tile", "r", "c", water_fill(col("v"), col("wl")).alias("v"), water_fill(col("qc"), col("wl")).alias("qc"), "qf", "d")


@query("w03_merge_by_priority", """SELECT tile, r, c, d, coalesce(min_by(v, p) FILTER (v <= 100), max_by(v, p)) AS v FROM (SELECT tile, r, c, d, v, l_orderkey * 100000000 + l_partkey * 1000 + l_linenumber * 100 + l_suppkey % 100 AS p FROM obs_raw)
    GROUP BY tile, r, c, d""", "obs_raw")
def _(t):
    p = F.expr("l_orderkey * 100000000 + l_partkey * 1000 + l_linenumber * 100 + l_suppkey % 100")
    return ts.merge_by_priority(t("obs_raw"), p, ["tile", "r", "c", "d"])


@query("w04_latest_clear", "SELECT tile, r, c, coalesce(max_by(v, d) FILTER (v <= 100), min_by(v, d)) AS v FROM obs WHERE d >= DATE '1996-01-01' GROUP BY tile, r, c", "obs")
def _(t):
    return ts.merge_by_priority(t("obs").where("d >= date'1996-01-01'"), -F.unix_date("d"), ["tile", "r", "c"])


DAILY = """cal AS (SELECT g.tile, g.r, g.c, CAST(x AS DATE) AS d FROM (SELECT DISTINCT tile, r, c FROM obs) g, generate_series(DATE '1995-09-16', DATE '1996-10-15', INTERVAL 1 DAY) s(x)),
    j AS (SELECT cal.*, CASE WHEN o.v > 0 THEN 100 WHEN o.v = 0 THEN 0 END AS v, CASE WHEN o.v IS NOT NULL THEN cal.d END AS od FROM cal LEFT JOIN (SELECT * FROM obs WHERE v <= 100) o ON (cal.tile, cal.r, cal.c, cal.d) = (o.tile, o.r, o.c, o.d)),
    n AS (SELECT tile, r, c, d, last_value(v IGNORE NULLS) OVER b AS av, last_value(od IGNORE NULLS) OVER b AS ad, first_value(v IGNORE NULLS) OVER f AS bv, first_value(od IGNORE NULLS) OVER f AS bd FROM j
          WINDOW b AS (PARTITION BY tile, r, c ORDER BY d ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), f AS (PARTITION BY tile, r, c ORDER BY d ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)),
    days AS (SELECT tile, r, c, d, CAST(CASE WHEN av IS NULL AND bv IS NULL THEN 0 WHEN av IS NULL THEN bv >= 50 WHEN bv IS NULL OR ad = bd THEN av >= 50
          ELSE av * (bd - d) + bv * (d - ad) >= 50 * (bd - ad) END AS INT) AS snow FROM n WHERE d BETWEEN DATE '1995-10-01' AND DATE '1996-09-30')"""


SEASON = ("1995-10-01", "1996-09-30")
MARGIN = 15


@query("w05_daily_interpolation", f"WITH {DAILY} SELECT tile, r, c, d, snow FROM days", "obs")
def _(t):
    return ts.daily(t("obs"), *SEASON, MARGIN)


@query("w06_season", f"""WITH {DAILY}, k AS (SELECT *, row_number() OVER (PARTITION BY tile, r, c ORDER BY d) AS k FROM days), i AS (SELECT *, k - row_number() OVER (PARTITION BY tile, r, c ORDER BY d) AS island FROM k WHERE snow = 1),
    runs AS (SELECT tile, r, c, island, count(*) AS n, min(k) AS a, max(k) AS b FROM i GROUP BY ALL), best AS (SELECT *, row_number() OVER (PARTITION BY tile, r, c ORDER BY n DESC, a) AS rn FROM runs),
    tot AS (SELECT tile, r, c, CAST(sum(snow) AS BIGINT) AS snow_days FROM days GROUP BY tile, r, c)
    SELECT tot.tile, tot.r, tot.c, snow_days, CAST(CASE WHEN snow_days > 10 THEN a - 1 ELSE 0 END AS INT) AS onset, CAST(CASE WHEN snow_days > 10 THEN b - 1 ELSE 0 END AS INT) AS melt, snow_days > 10 AS has_season
    FROM tot LEFT JOIN (SELECT * FROM best WHERE rn = 1) x USING (tile, r, c)""", "obs")
def _(t):
    return ts.season_of_runs(ts.snow_runs(t("obs"), *SEASON, MARGIN))


@query("w07_periods", f"""WITH {DAILY}, l AS (SELECT tile, r, c, snow - lag(snow) OVER (PARTITION BY tile, r, c ORDER BY d) AS s FROM days)
    SELECT tile, r, c, count(*) FILTER (s > 0) AS periods, count(*) FILTER (s <> 0) AS both_ways FROM l GROUP BY tile, r, c""", "obs")
def _(t):
    return ts.periods_of_runs(ts.snow_runs(t("obs"), *SEASON, MARGIN))


PASS = "SELECT tile, r, c, d, CASE WHEN v = 205 AND lag(v, {a}) OVER w = lead(v, {b}) OVER w AND lag(v, {a}) OVER w IN (0, 100) THEN lag(v, {a}) OVER w ELSE v END AS v FROM {t} WINDOW w AS (PARTITION BY tile, r, c ORDER BY d)"


BINARY = "SELECT tile, r, c, d, CASE WHEN v BETWEEN 1 AND 100 THEN 100 ELSE v END AS v FROM obs"


@query("w08_temporal_cloud_filter", f"WITH bin AS ({BINARY}), p1 AS ({PASS.format(a=1, b=1, t='bin')}), p2 AS ({PASS.format(a=2, b=1, t='p1')}) {PASS.format(a=1, b=2, t='p2')}", "obs")
def _(t):
    return ts.temporal_cloud_filter(t("obs").select("tile", "r", "c", "d", F.when(col("v").between(1, 100), 100).otherwise(col("v")).alias("v")))


@query("a11_a13_day_counts", """SELECT tile, r, c, count(*) FILTER (v > 0 AND v <= 100) AS snow_days, count(*) FILTER (v IN (205, 255, 254)) AS cloud_days, count(*) - count(*) FILTER (v IN (205, 255, 254)) AS observations,
    count(*) FILTER (v <= 100 AND qf < 128) AS clear_sky, count(*) FILTER (v <= 100 AND qf >= 128) AS by_radar, count(*) FILTER (v <= 100) AS valid FROM obs GROUP BY tile, r, c""", "obs")
def _(t):
    return ts.day_counts(t("obs"))


@query("a14_perennial", """WITH s AS (SELECT tile, r, c, d, v, CAST(year(d) + CASE WHEN month(d) >= 9 THEN 1 ELSE 0 END AS INT) AS season, CAST(strftime(d, '%Y%m%d') AS INT) AS k FROM obs),
    e AS (SELECT tile, season, year(max(d)) * 10000 + 501 AS may FROM s GROUP BY tile, season), n AS (SELECT tile, season, min(abs(k - may) * 100000000 + k) % 100000000 AS first FROM s JOIN e USING (tile, season) GROUP BY tile, season)
    SELECT tile, r, c, season, bool_and(v BETWEEN 1 AND 100 OR v IN (205, 254, 255)) AS perennial FROM s JOIN n USING (tile, season) WHERE k >= first GROUP BY tile, r, c, season""", "obs")
def _(t):
    return ts.perennial(t("obs"))


@query("a15_quality_stats", """WITH q AS (SELECT tile, r, c, CASE WHEN v > 100 AND qf % 3 > 0 THEN v ELSE qc END AS qc FROM obs)
    SELECT tile, r, c, CAST(coalesce(round(avg(qc) FILTER (qc <= 3), 6), 255) AS DOUBLE) AS mean_qc, CAST(coalesce(quantile_disc(qc, 0.5) FILTER (qc <= 3), 255) AS INT) AS median_qc FROM q GROUP BY tile, r, c""", "obs")
def _(t):
    return ts.quality_stats(t("obs").withColumn("qc", F.expr("case when v > 100 and qf % 3 > 0 then v else qc end")))


@query("a16_distance_to_observation", """SELECT m.tile, m.r, m.c, CAST(coalesce(min(abs(o.d - m.mark)), 65535) AS INT) AS days FROM (SELECT tile, r, c, CAST(DATE '1995-11-01' + (r * 7 + c) AS DATE) AS mark FROM grid) m
    LEFT JOIN (SELECT * FROM obs WHERE v BETWEEN 1 AND 100) o ON (m.tile, m.r, m.c) = (o.tile, o.r, o.c) GROUP BY m.tile, m.r, m.c""", "grid obs")
def _(t):
    marks = t("grid").select("tile", "r", "c", F.expr("date_add(date'1995-11-01', r * 7 + c)").alias("mark"))
    return ts.distance_to_observation(t("obs"), marks, "mark")


BLOCK = "tile, d, CAST(r // {k} AS INT) AS r, CAST(c // {k} AS INT) AS c"


@query("a03_upscale", f"""SELECT tile, d, r, c, CASE WHEN ok > 0 THEN CAST(round_even(m, 0) AS INT) WHEN n1 > 0 AND n1 >= n2 AND n1 >= n3 THEN 205 WHEN n2 > 0 AND n2 >= n3 THEN 210 ELSE 255 END AS v, ok
    FROM (SELECT {BLOCK.format(k=2)}, count(*) FILTER (v <= 100) AS ok, avg(v) FILTER (v <= 100) AS m, count(*) FILTER (v = 205) AS n1, count(*) FILTER (v = 210) AS n2, count(*) FILTER (v = 255) AS n3 FROM obs GROUP BY 1, 2, 3, 4)""", "obs")
def _(t):
    return grid.upscale(t("obs"), 2, (205, 210, 255), least=0)


BITS = " + ".join(f"CASE WHEN 2 * count(*) FILTER ((qf & {1 << b}) <> 0) >= 4 THEN {1 << b} ELSE 0 END" for b in range(8))


@query("a03_upscale_bits", f"SELECT tile, d, r, c, CAST({BITS} AS INT) AS qf FROM (SELECT {BLOCK.format(k=2)}, qf FROM obs) GROUP BY tile, d, r, c", "obs")
def _(t):
    return grid.upscale_bits(t("obs"), 2, "qf")


VOTE = f"""v0 AS (SELECT {BLOCK.format(k=2)}, count(*) FILTER (v <= 100) AS ok, sum(v) FILTER (v <= 100) AS s, count(*) FILTER (v = 205) AS cl, count(*) FILTER (v = 210) AS wa FROM obs GROUP BY 1, 2, 3, 4),
    v1 AS (SELECT tile, d, r, c, CASE WHEN ok > 2 THEN 1 WHEN cl > 4 - ok - cl OR wa > 4 - ok - wa THEN 2 ELSE 0 END AS state, CASE WHEN ok > 2 THEN CASE WHEN s >= 60 * ok THEN 100 ELSE 0 END WHEN cl > 4 - ok - cl THEN 205 WHEN wa > 4 - ok - wa THEN 210 ELSE 255 END AS v FROM v0)"""


@query("a04_block_vote", f"WITH {VOTE} SELECT tile, d, r, c, state, v FROM v1", "obs")
def _(t):
    return grid.vote(t("obs"), 2, ("tile", "d"))


@query("w13_fold_scenes", f"WITH {VOTE} SELECT tile, r, c, coalesce(max_by(v, d) FILTER (state = 1), max_by(v, d) FILTER (state = 2), 255) AS v FROM v1 GROUP BY tile, r, c", "obs")
def _(t):
    return grid.fold_scenes(grid.vote(t("obs"), 2, ("tile", "d")), "d")


@query("a05_multilook", f"""SELECT tile, d, r, c, CASE WHEN low > 0 THEN CAST(round(a, 6) AS DOUBLE) ELSE 0 END AS red, CASE WHEN low > 0 THEN CAST(round(b, 6) AS DOUBLE) ELSE 0 END AS nir FROM
    (SELECT {BLOCK.format(k=5)}, avg(red - 60) AS a, avg(nir - 60) AS b, least(min(red - 60), min(nir - 60)) AS low FROM bands GROUP BY 1, 2, 3, 4)""", "bands")
def _(t):
    return grid.multilook(t("bands").withColumn("red", col("red") - 60).withColumn("nir", col("nir") - 60), 5, "red", "nir")


@query("a06_average", f"SELECT {BLOCK.format(k=5)}, CAST(round(avg(green), 6) AS DOUBLE) AS green FROM bands GROUP BY 1, 2, 3, 4", "bands")
def _(t):
    return grid.average(t("bands"), 5, "green", ("tile", "d"))


@query("j14_replicate", "SELECT tile, CAST(r * 3 + i AS INT) AS r, CAST(c * 3 + j AS INT) AS c, wl FROM water, generate_series(0, 2) a(i), generate_series(0, 2) b(j)", "water")
def _(t):
    return grid.replicate(t("water"), 3)


@query("k02_overview", "SELECT tile, CAST(r // 2 AS INT) AS r, CAST(c // 2 AS INT) AS c, d, v FROM obs WHERE r % 2 = 0 AND c % 2 = 0", "obs")
def _(t):
    return grid.overview(t("obs").select("tile", "r", "c", "d", "v"), 2)


@query("k04_thumbnail", """SELECT v, tile, CAST(r // 2 AS INT) AS r, CAST(c // 2 AS INT) AS c, d, CASE v WHEN 205 THEN 128 WHEN 210 THEN 0 WHEN 100 THEN 255 ELSE 0 END AS red, CASE v WHEN 205 THEN 128 WHEN 210 THEN 0 WHEN 100 THEN 255 ELSE 0 END AS green,
    CASE v WHEN 205 THEN 128 WHEN 210 THEN 255 WHEN 100 THEN 255 ELSE 0 END AS blue, CASE WHEN v IN (205, 210, 100) THEN 255 ELSE 0 END AS alpha FROM obs WHERE r % 2 = 0 AND c % 2 = 0""", "obs")
def _(t):
    palette = t.spark.createDataFrame([(205, 128, 128, 128, 255), (210, 0, 0, 255, 255), (100, 255, 255, 255, 255)], "v int, red int, green int, blue int, alpha int")
    return grid.thumbnail(t("obs").select("tile", "r", "c", "d", "v"), palette, 2)


@query("s25_constant_grid", "SELECT tile, r, c, 0 AS v FROM grid", "grid")
def _(t):
    return t("grid").withColumn("v", F.lit(0))
