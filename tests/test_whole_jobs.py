"""Queries and operators that once did less than the whole job."""

import random
from functools import reduce

import pytest
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from test_operators import image, picture, series
from test_queries import SF, duck, rows_of  # noqa: F401

from cellweave import plans
from cellweave.fixtures import Tables
from cellweave.operators import catalogue, grid, models, products, stats
from cellweave.operators import timeseries as ts
from cellweave.registry import ORACLES, QUERIES
from cellweave.sinks import formats as K
from cellweave.sources import formats

plans.load()


def same_rows(df, relation):
    cols = sorted(df.columns)
    assert sorted(relation.columns) == cols
    theirs = dict(zip(relation.columns, zip(*relation.fetchall()), strict=False))
    assert rows_of({k: v.to_pylist() for k, v in zip(df.columns, df.toArrow().columns, strict=True)}, cols) == rows_of(theirs, cols)


def test_daily_interpolation_of_all_tiles(spark):
    df = QUERIES["w05_daily_interpolation"](spark, SF)
    cells = Tables(spark, SF)("obs").select("tile", "r", "c").distinct().count()
    assert df.count() == 366 * cells and {r.tile for r in df.select("tile").distinct().collect()} == {0, 1, 2, 3}


def test_upscale_keeps_the_mean_of_few_values(spark, duck):  # noqa: F811
    x = image(spark, [[40, 205, 205, 210], [205, 205, 210, 210], [255, 7, 255, 205], [255, 8, 255, 255]]).withColumn("d", F.lit(1))
    assert picture(grid.upscale(x, 2, (205, 210, 255), least=0)) == [[40, 210], [8, 255]]
    same_rows(QUERIES["a03_upscale"](spark, SF), duck.sql(ORACLES["a03_upscale"]))


@pytest.mark.parametrize("diagonal, expected", [(False, [[7, 0]]), (True, [[7, 0]])])
def test_upscale_of_bits(spark, diagonal, expected):
    x = image(spark, [[1 | 2, 0, 0, 8], [2 | 4, 4 | 1, 0, 0]], name="qf").withColumn("d", F.lit(1))
    assert picture(grid.upscale_bits(x, 2, "qf", diagonal=diagonal), "qf") == expected


PLAN = "id long, vm long, t0 int, duration int, cpu int, ram int, storage_space int, input long, preceding long"


@pytest.mark.parametrize(
    "task, broken",
    [
        ((3, 2, None, 1, 1, 1, 1, 30, None), {"unplanned": 1}),
        ((3, 2, -1, 1, 1, 1, 1, 30, None), {"start": 1}),
        ((3, 2, 10, 1, 1, 1, 1, 30, None), {"time": 1}),
        ((3, 2, 4, 1, 1, 1, 1, 30, 20), {"order": 1}),
        ((3, 2, 5, 1, 1, 1, 1, 30, 20), {}),
        ((3, 2, 2, 2, 1, 1, 9, 30, None), {"storage": 2}),
        ((3, 2, 2, 2, 9, 9, 1, 30, None), {"cpu": 2, "ram": 2}),
        ((1, 2, 7, 1, 1, 1, 1, 10, None), {"order": 1, "twice": 1}),
        ((3, 1, 4, 1, 1, 1, 1, 30, None), {"overlap": 1}),
    ],
)
def test_each_rule_of_a_plan(spark, task, broken):
    good = [(1, 1, 0, 2, 1, 1, 1, 10, None), (2, 1, 2, 3, 1, 1, 1, 20, 10)]
    got = {r.rule: r.broken for r in catalogue.plan_checks(spark.createDataFrame([*good, task], PLAN), 10, 4, 4, 4, 2).collect()}
    assert set(got) == {"cpu", "ram", "storage", "machines", "time", "unplanned", "start", "order", "overlap", "twice"}
    assert {k: n for k, n in got.items() if n} == broken


@pytest.mark.parametrize("margin, snow", [(0, [0, 0, 0, 0]), (1, [1, 0, 0, 1]), (3, [1, 0, 0, 1])])
def test_daily_margin(spark, margin, snow):
    """Clear on day 2 (none), 4 (snow), 6 (none), 9 (snow) and 10 (none); the calendar is 5 to 8."""
    obs = series(spark, [205, 0, 205, 100, 205, 0, 205, 205, 100, 0])
    got = ts.daily(obs, "1996-01-05", "1996-01-08", margin).orderBy("d").collect()
    assert [r.d.day for r in got] == [5, 6, 7, 8] and [r.snow for r in got] == snow


def test_runs_are_those_of_days(spark):
    """Runs from interval arithmetic against a plain walk over the days."""
    r = random.Random(3)
    for margin in (0, 4):
        values = [[r.choice([0, 100, 205, 205, 255, 40]) for _ in range(31)] for _ in range(12)] + [[205] * 31]
        obs = reduce(DataFrame.unionByName, [series(spark, v, c=k) for k, v in enumerate(values)])
        got = {}
        for x in ts.daily(obs, "1996-01-06", "1996-01-26", margin).collect():
            got.setdefault(x.c, {})[x.d.day] = x.snow
        for k, v in enumerate(values):
            clear = [(i + 1, 100 if v[i] else 0) for i in range(31) if v[i] <= 100 and 6 - margin <= i + 1 <= 26 + margin]
            for day in range(6, 27):
                before, after = [c for c in clear if c[0] <= day], [c for c in clear if c[0] >= day]
                if before and after and before[-1][0] < after[0][0]:
                    (p, x), (q, y) = before[-1], after[0]
                    want = int(x * (q - day) + y * (day - p) >= 50 * (q - p))
                else:
                    want = int((before[-1][1] if before else after[0][1] if after else 0) >= 50)
                assert got[k][day] == want


def test_zonal_classes_of_the_ice_layer(spark):
    """Five of six cells are observed: one water, two ice, one cloud of quality 205, one other of quality 9."""
    cells = spark.createDataFrame([(0, 0, 0, 1, 1), (0, 0, 1, 100, 2), (0, 0, 2, 100, 3), (0, 0, 3, 205, 205), (0, 0, 4, 254, 9), (0, 5, 5, 0, 1)], "tile int, r int, c int, v int, qc int").withColumn("d", F.lit(1))
    members = spark.createDataFrame([(7, 0, 0, c) for c in range(6)] + [(8, 0, 5, 5), (9, 0, 8, 8)], "fid int, tile int, r int, c int")
    rows = stats.zonal(cells, members, ["d"]).collect()
    assert [(x.fid, x.water, x.ice, x.cloud, x.other, x.left_over, x.quality) for x in rows] == [(7, 17, 33, 17, 17, 16, 2)]


def test_snow_line_skips_bins_below_all_land(spark):
    cells = spark.createDataFrame([(0, z, 0, 1) for z in (-900, -890, 300, 310)], "tile int, z int, cloud int, snow int")
    assert stats.snow_line(stats.altitude_histogram(cells, 100, ["tile"]), 100, 0.2, 0.3, ["tile"], offset=0).first().line == 300


def test_deep_forest_is_walked_like_a_single_tree(spark):
    r = random.Random(9)

    def grow(depth):
        if not depth or r.random() < 0.2:
            p = r.random()
            return {"shares": [p, (1 - p) / 2, (1 - p) / 2]}
        return {"feature": r.choice("xyz"), "cut": r.randint(0, 20), "low": grow(depth - 1), "high": grow(depth - 1)}

    trees = [grow(7) for _ in range(40)]
    rows = [(k, r.randint(0, 20), r.randint(0, 20), None if k % 9 == 0 else r.randint(0, 20)) for k in range(200)]
    got = {x.k: x for x in models.forest(spark.createDataFrame(rows, "k int, x int, y int, z int"), trees, 3).collect()}
    for k, *v in rows:
        total = [0.0] * 3
        for node in trees:
            while "shares" not in node:
                value = v["xyz".index(node["feature"])]
                node = node["low"] if value is not None and value <= node["cut"] else node["high"]
            total = [a + b for a, b in zip(total, node["shares"], strict=True)]
        mean = [x / len(trees) for x in total]
        assert got[k].cls == mean.index(max(mean)) and abs(got[k].probability - 100 * max(mean)) < 1e-5


def test_bounds_of_known_places(spark):
    """A zone's central meridian at the equator, and a tower of which both coordinates are published."""
    x = spark.createDataFrame([(1, 500000.0, 0.0, 31), (2, 448251.8, 5411932.7, 31)], "id int, x double, y double, zone int")
    lon, lat = products.utm_to_degrees(F.col("x"), F.col("y"), F.col("zone"))
    got = {r.id: (r.lon, r.lat) for r in x.select("id", lon.alias("lon"), lat.alias("lat")).collect()}
    assert got[1] == pytest.approx((3.0, 0.0), abs=1e-9) and got[2] == pytest.approx((2.2945, 48.8582), abs=2e-4)


def test_hull_holds_all_corners(spark):
    r = random.Random(1)
    rows = [(t, a, b, b + r.randint(0, 9)) for t in (1, 2) for a in range(12) for b in [r.randint(0, 30)]]
    for x in products.hulls(spark.createDataFrame(rows, "tile int, r int, c0 int, c1 int"), ["tile"]).collect():
        ring = [tuple(map(float, p.split())) for p in x.wkt[len("POLYGON((") : -2].split(",")]
        cross = lambda o, a, b: (a[0] - o[0]) * (b[1] - o[1]) - (a[1] - o[1]) * (b[0] - o[0])
        corners = [(c, q) for t, a, b, e in rows if t == x.tile for c in (b, e + 1) for q in (a, a + 1)]
        assert ring[0] == ring[-1] and set(ring) <= set(corners)
        assert all(cross(a, b, p) >= 0 for a, b in zip(ring, ring[1:], strict=False) for p in corners)


def test_wet_snow_of_scenes_in_order(spark):
    """One block of four cells: cloud, then snow that is neither wet nor dry, then cloud again, then free of snow."""
    def state(scenes, wet=110, mask=0, nodata=False):
        cover = spark.createDataFrame([(0, k // 2, k % 2, d, v) for d, four in enumerate(scenes) for k, v in enumerate(four)], "tile int, r int, c int, d int, v int")
        coarse = spark.createDataFrame([(0, 0, 0, wet, 2, mask, nodata)], "tile int, r int, c int, wet int, quality int, mask int, nodata boolean")
        row = products.wet_snow(cover, coarse, 2).first()
        return row.v, row.quality

    cloud, snow, free, water = [205] * 4, [100, 90, 80, 205], [0, 10, 20, 205], [210, 210, 210, 0]
    assert state([snow]) == (110, 2) and state([snow], wet=125) == (115, 250) and state([snow, free]) == (120, 250)
    assert state([cloud, snow, cloud], wet=0) == (205, 250) and state([snow, cloud]) == (110, 2) and state([water]) == (210, 250)
    assert state([snow, cloud], mask=240) == (240, 250) and state([cloud], mask=240) == (205, 250) and state([snow], nodata=True) == (255, 255)
    assert state([[205, 205, 50, 50]]) == (205, 250) and state([[255] * 4]) == (255, 255)


def test_xml_of_any_title_parses(spark):
    titles = ["a & b <c>", "d", "a & b <c>"]
    x = K.lineage_xml(spark.createDataFrame([(1, t) for t in titles], "product int, title string"), ["product"], "title")
    assert sorted(r.title for r in formats.lineage(x, "xml", "product").collect()) == ["a & b <c>", "d"]


def test_day_cursor_takes_parts_of_a_second_as_its_sql_does(spark, tmp_path):
    """Event 4 begins the second third of the time by whole seconds, and by the nearest one does not."""
    import duckdb

    rows = [(1, 7, "2024-01-01 00:00:00.9"), (2, 7, "2024-01-31 00:00:00.9"), (4, 3, "2024-01-11 00:00:01.2"), (9, 3, "2024-01-06 12:00:00.0")]
    df = spark.createDataFrame(rows, "event_id long, user_id long, ts string").withColumn("ts", F.expr("cast(ts as timestamp_ntz)"))
    df.coalesce(1).write.parquet(str(tmp_path / "events.parquet"))
    con = duckdb.connect()
    con.sql(f"create view events as select * from '{tmp_path}/events.parquet/*.parquet'")
    found = QUERIES["t09_day_cursor"](spark, str(tmp_path))
    assert [(r.key, r.item) for r in found.where("kind = 'late'").collect()] == [("3", "9")]
    same_rows(found, con.sql(ORACLES["t09_day_cursor"]))


def test_search_takes_entries_of_one_name_by_id(spark):
    entries = spark.range(0, 200, 1, 4).selectExpr("199 - id as id", "'KIND1_x' as name", "timestamp'1995-01-01' as date", "1 as x0", "1 as y0", "2 as x1", "2 as y1")
    got = formats.catalogue_filter(entries, "KIND1", "1994-01-01", "1997-01-01", (0, 0, 3, 3), 40, 5).collect()
    assert [r.id for r in got] == list(range(5, 45))


def test_parts_of_shuffles_grow_in_number_and_not_in_size(spark, monkeypatch):
    """Tasks of a larger table hold no more: first parts follow the bytes that are read, and parts are joined to a bound."""
    from cellweave import session

    names = ["spark.sql.adaptive.coalescePartitions.initialPartitionNum", "spark.sql.adaptive.advisoryPartitionSizeInBytes", "spark.sql.files.maxPartitionBytes"]
    before = [spark.conf.get(n, None) for n in names]
    monkeypatch.setattr(session, "PER_PART", 2000, raising=False)
    try:
        t = Tables(spark, SF)
        one = t("lineitem").groupBy("l_orderkey").count()
        assert one.collect() and int(spark.conf.get(names[0])) > 20
        width = int(spark.conf.get(names[0]))
        t("orders")
        assert int(spark.conf.get(names[0])) > width
        assert spark.conf.get(names[1]) == f"{16 << 20}b" and spark.conf.get(names[2]) == f"{8 << 20}b"
        assert spark.conf.get("spark.sql.shuffle.partitions") == "4"
    finally:
        for n, v in zip(names, before, strict=True):
            spark.conf.unset(n) if v is None else spark.conf.set(n, v)


def test_parts_of_the_part_table_are_bounded(spark, tmp_path):
    """A file of few bytes a row, whose rows become many, is spread over parts, and the shuffles after it have as many."""
    name = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    before = spark.conf.get(name, None)
    try:
        spark.range(1 << 20).selectExpr("id as p_partkey", "cast(rand(1) * 2e9 as int) as p_size").coalesce(1).write.parquet(f"{tmp_path}/part.parquet")
        t = Tables(spark, str(tmp_path))
        rows = t("part").groupBy(F.spark_partition_id()).count().collect()
        assert len(rows) >= 16 and sum(r["count"] for r in rows) == 1 << 20 and max(r["count"] for r in rows) < 1 << 17
        assert int(spark.conf.get(name)) >= 16
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def test_bilinear_moves_no_row_after_its_join(spark):
    """Repeated and null cells count as in a sum over all that are met, and targets are shuffled once."""
    coarse = spark.createDataFrame([(0, 0, 0, 8), (0, 0, 0, 16), (0, 0, 1, None), (0, 1, 1, 4), (0, 5, 5, None)], "tile int, r int, c int, z int")
    targets = spark.createDataFrame([(0, r, c) for r in range(12) for c in range(12)] + [(0, 1, 1)], "tile int, r int, c int")
    df = products.bilinear(coarse, targets, "z", 2)
    got = {(x.r, x.c): x.z for x in df.collect()}
    cells = [(x.r, x.c, x.z) for x in coarse.collect()]
    want = {}
    for r, c in {(x.r, x.c) for x in targets.collect()}:
        y, x = (r + 0.5) / 2 - 0.5, (c + 0.5) / 2 - 0.5
        met = [(z, (1 - abs(y - a)) * (1 - abs(x - b))) for a, b, z in cells if a - y <= 1 and y - a < 1 and b - x <= 1 and x - b < 1]
        if met:
            some = [z * w for z, w in met if z is not None]
            want[r, c] = round(sum(some) / sum(w for _, w in met), 6) if some else None
    assert got == want and None in want.values()
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Aggregate") == 2 and plan.count("explode") == 1
