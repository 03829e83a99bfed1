"""Operators on small tables worked out by hand, and their laws."""

import datetime
import io
import random
import zipfile

import pytest
from pyspark.sql import functions as F

from cellweave.functions import cells as C
from cellweave.operators import catalogue, grid, models, neighbours, polygons, stats
from cellweave.operators import timeseries as ts
from cellweave.sinks import formats as sinks
from cellweave.sources import formats as sources
from cellweave.streaming import status


def one(spark, expression, **values):
    row = ", ".join(f"{v!r} as {k}" if not isinstance(v, str) else f"'{v}' as {k}" for k, v in values.items())
    return spark.sql(f"select {row}").select(expression).first()[0]


def series(spark, values, tile=0, r=0, c=0, start=1):
    rows = [(tile, r, c, f"1996-01-{start + k:02d}", v, k % 4, k) for k, v in enumerate(values)]
    return spark.createDataFrame(rows, "tile int, r int, c int, d string, v int, qc int, qf int").withColumn("d", F.to_date("d"))


def image(spark, rows, tile=0, name="v"):
    return spark.createDataFrame([(tile, i, j, v) for i, row in enumerate(rows) for j, v in enumerate(row)], f"tile int, r int, c int, {name} int")


def picture(df, name="v"):
    got = {(x.r, x.c): x[name] for x in df.collect()}
    return [[got.get((i, j)) for j in range(1 + max(k[1] for k in got))] for i in range(1 + max(k[0] for k in got))]


@pytest.mark.parametrize("mask, value, expected", [(192, 192, 1), (64, 192, 1), (2, 4, 0)])
def test_all_bits(spark, mask, value, expected):
    assert one(spark, C.all_bits(F.col("x"), mask), x=value) == expected


@pytest.mark.parametrize("bits, expected", [(0, 0), (128, 1), (130, 1), (2, 2), (34, 2), (32, 3), (64, 3), (160, 1)])
def test_cloud_class(spark, bits, expected):
    assert one(spark, C.cloud_class(F.col("x"), F.lit(0)), x=bits) == expected


def test_later_rules_overwrite(spark):
    assert one(spark, C.overwrite(0, (F.col("x") > 0, 1), (F.col("x") > 5, 2)), x=7) == 2


@pytest.mark.parametrize("x", [0, 1, 37, 128, 255])
def test_pack_reverses_unpack(spark, x):
    assert one(spark, C.pack(C.unpack(F.col("x"))), x=x) == x


@pytest.mark.parametrize("optical, radar, expected", [(1, 100, 1), (205, 100, 100), (205, 200, 205), (255, 1, 1), (255, 255, 255), (254, 1, 254)])
def test_merge_ice(spark, optical, radar, expected):
    assert one(spark, C.merge_ice(F.col("a"), F.col("b")), a=optical, b=radar) == expected


def test_index_without_signal(spark):
    assert one(spark, C.index_mask(F.col("a"), F.col("b"), 0.1), a=3, b=-3) == -9999


def test_newest_value_then_newest_gap(spark):
    got = ts.fill_newest_first(series(spark, [10, 205, 30, 255]).unionByName(series(spark, [205, 255], c=1)))
    assert {x.c: x.v for x in got.collect()} == {0: 30, 1: 255}


def test_window_takes_the_oldest_cloud(spark):
    x = series(spark, [50, 255, 205, 205, 255]).unionByName(series(spark, [20, 255, 255, 255, 60], c=1))
    got = {r.c: (r.v, r.qf) for r in ts.fill_window(x, 3).collect()}
    assert got == {0: (205, 2), 1: (60, 4)}
    again = ts.fill_window(ts.fill_window(x, 3), 3)
    assert {r.c: r.v for r in again.collect()} == {0: 205, 1: 60}


def test_interpolation_season_and_periods(spark):
    days = ts.daily(series(spark, [0, 205, 205, 90, 205, 50, 255, 0, 205, 205, 205, 40, 0]), "1996-01-01", "1996-01-13")
    assert [x.snow for x in days.orderBy("d").collect()] == [0, 0, 1, 1, 1, 1, 1, 0, 0, 1, 1, 1, 0]
    row = ts.season(days, least=5).first()
    assert (row.snow_days, row.onset, row.melt, row.has_season) == (8, 2, 6, True)
    assert (ts.season(days, least=8).first().onset, ts.season(days, least=8).first().has_season) == (0, False)
    assert (ts.periods(days).first().periods, ts.periods(days, True).first().periods) == (2, 4)
    none = ts.daily(series(spark, [205, 255]), "1996-01-01", "1996-01-03")
    assert {x.snow for x in none.collect()} == {0}


def test_temporal_filter_passes_see_each_other(spark):
    got = ts.temporal_cloud_filter(series(spark, [100, 205, 205, 100, 205, 0]))
    assert [x.v for x in got.orderBy("d").collect()] == [100, 100, 100, 100, 205, 0]


def test_median_quality_is_the_lower_one(spark):
    got = ts.quality_stats(series(spark, [1, 1, 1, 1, 205])).first()
    assert (got.mean_qc, got.median_qc) == (1.2, 1)  # 0, 1, 2, 3, 0: quality counts whatever the value
    assert ts.quality_stats(series(spark, [205]).withColumn("qc", F.lit(205))).first().median_qc == 255


def test_upscale_modes(spark):
    x = image(spark, [[10, 205, 205, 210], [205, 21, 205, 210], [255, 255, 1, 2], [255, 255, 3, 4]]).withColumn("d", F.lit(1))
    assert picture(grid.upscale(x, 2, (205, 210, 255))) == [[16, 205], [255, 2]]
    assert picture(grid.upscale(x, 2, (205, 210, 255), diagonal=True)) == [[16, 205], [255, 2]]
    flat = image(spark, [[205, 1], [210, 210]]).withColumn("d", F.lit(1))
    assert picture(grid.upscale(flat, 2, (205, 210), least=0.5)) == [[210]] and picture(grid.upscale(flat, 2, (205, 210), diagonal=True)) == [[205]]


def test_replicate_then_overview_is_the_image(spark):
    x = image(spark, [[1, 2], [3, 4]])
    assert picture(grid.overview(grid.replicate(x, 3), 3)) == [[1, 2], [3, 4]]


def test_blocks_and_cells(spark):
    x = image(spark, [[k * 4 + j for j in range(4)] for k in range(4)])
    assert picture(sources.blocks_to_cells(sources.cells_to_blocks(x, 2, 2, "v"), "v")) == picture(x)


def test_votes_of_neighbours(spark):
    x = image(spark, [[0, 100, 0], [100, 205, 100], [205, 100, 205]])
    assert picture(neighbours.four_vote(x))[1][1] == 100 and picture(neighbours.four_vote(x))[2][0] == 205
    z = image(spark, [[9, 5, 9], [9, 6, 9], [1, 9, 9]], name="z")
    got = picture(neighbours.downhill_vote(x.join(z, ["tile", "r", "c"])))
    assert got[1][1] == 100 and got[2][0] == 205 and got[2][2] == 205


def test_labels_of_a_spiral(spark):
    rows = [[1, 1, 1, 1, 1], [0, 0, 0, 0, 1], [1, 1, 1, 0, 1], [1, 0, 0, 0, 1], [1, 1, 1, 1, 1], [0, 0, 0, 0, 0], [1, 0, 1, 0, 1]]
    got = neighbours.label(image(spark, rows), F.col("v") == 1)
    assert sorted(x.n for x in got.groupBy("label").agg(F.count("*").alias("n")).collect()) == [1, 1, 1, 17]


def test_snow_line(spark):
    cells = [(0, 0, k, 100 + 10 * k, 0, int(k >= 6)) for k in range(20)]
    h = stats.altitude_histogram(spark.createDataFrame(cells, "tile int, r int, c int, z int, cloud int, snow int"), 20, ["tile"])
    assert stats.snow_line(h, 20, 0.1, 0.1, ["tile"]).first().line == 120
    assert stats.snow_line(h.where("snows < 0"), 20, 0.1, 0.1, ["tile"]).count() == 0
    bare = stats.altitude_histogram(spark.createDataFrame([(0, 0, 0, 5, 0, 0)], "tile int, r int, c int, z int, cloud int, snow int"), 20, ["tile"])
    assert stats.snow_line(bare, 20, 0.1, 0.1, ["tile"]).first().line == -1000


def test_gradient_of_a_ramp(spark):
    ramp = image(spark, [[3 * j for j in range(4)] for _ in range(4)])
    assert {x.gradient for x in neighbours.gradient_magnitude(ramp, "v").collect()} == {2.5}


def test_polygon_with_a_hole(spark):
    def ring(x, y, w, h):
        p = [(x, y), (x, y + h), (x + w, y + h), (x + w, y), (x, y)]
        return [(1, *map(float, a), *map(float, b)) for a, b in zip(p, p[1:], strict=False)]

    edges = spark.createDataFrame(ring(0, 0, 5, 5) + ring(1, 1, 2, 2), "p int, x0 double, y0 double, x1 double, y1 double")
    got = {(x.r, x.c) for x in polygons.cells_inside(edges, ["p"]).collect()}
    assert got == {(i, j) for i in range(5) for j in range(5)} - {(1, 1), (1, 2), (2, 1), (2, 2)}


def catalogue_seed(spark):
    """Three inputs, three tasks, three dispatches and five statuses."""
    inputs = spark.createDataFrame([(1, "A"), (2, "B"), (3, "A")], "id long, processing_condition_name string")
    tasks = spark.createDataFrame([(1, 1, "vm1", "2024-01-09 12:16:11", None, True), (3, 3, "vm2", "2024-01-09 12:16:11", None, True), (2, 2, "vm2", "2024-01-10 12:16:12", 3, False)],
                                  "id long, input_fk_id long, virtual_machine_id string, creation_date string, preceding_input_id long, has_ended boolean")
    dispatches = spark.createDataFrame([(1, 1, 0), (2, 1, 1), (4, 3, 2)], "id long, processing_task_fk_id long, dispatch_date int")
    workflow = spark.createDataFrame([(1, 1, 1), (2, 1, 3), (3, 2, 1), (4, 2, 3), (5, 4, 2)], "id long, dispatch_fk_id long, processing_status_id int").withColumn("date", F.col("id"))
    return inputs, tasks.withColumn("creation_date", F.to_timestamp("creation_date")), dispatches, workflow


def test_catalogue_functions_on_the_seed(spark):
    inputs, tasks, dispatches, workflow = catalogue_seed(spark)
    s = catalogue.with_status(tasks, dispatches, workflow)
    by = {r.id: r for r in s.collect()}
    assert by[1].errors == 2 and by[3].processed and not by[2].processed
    assert {r.status_id for r in catalogue.status_history(dispatches, workflow).where("task_id = 1").collect()} == {1, 2, 3, 4}
    assert {r.task_id: r.dispatch_id for r in catalogue.current_dispatch(dispatches).collect()} == {1: 2, 3: 4}
    assert {r.virtual_machine_id: r.all_processed for r in catalogue.machines_processed(s).collect()} == {"vm1": False, "vm2": False}
    assert [(r.task_id, r.predecessor_id) for r in catalogue.predecessors(tasks).collect()] == [(2, 3)]
    p = {r.input_id: r for r in catalogue.inputs_progress(inputs, s).collect()}
    assert p[3].any_processed and p[1].all_ended and not p[2].all_ended
    assert [r.id for r in catalogue.ready_tasks(tasks, dispatches, workflow).collect()] == [2]
    assert [r.input_id for r in catalogue.unprocessed_inputs(inputs, s, "2024-01-09").collect()] == [1]


@pytest.mark.parametrize("candidates, known, expected", [(["a", "b"], ["a"], ["b"]), ([], ["a"], []), (["a"], [], ["a"]), ([None, "b"], ["b"], [None]), ([None, "b"], [None], ["b"]), (["a", "a"], ["b"], ["a", "a"])])
def test_new_candidates(spark, candidates, known, expected):
    a, b = (spark.createDataFrame([(x,) for x in xs], "k string") for xs in (candidates, known))
    assert sorted((r.k for r in catalogue.without(a, b, "k", "k", True).collect()), key=str) == sorted(expected, key=str)


def test_time_needed_beyond_a_limit(spark):
    r = spark.createDataFrame([("a", 2, 1, 1, 3, 5), ("b", 9, 1, 1, 1, 1)], "name string, cpu int, ram int, storage_space int, duration int, n int")
    assert {x.name: x.time for x in catalogue.time_needed(r, 4, 4, 4, 4).collect()} == {"a": 9, "b": None}


def test_closest_and_cleanest_scene(spark):
    q = spark.createDataFrame([(1, 0, "1996-01-10")], "qid int, tile int, d string").withColumn("d", F.to_date("d"))
    s = spark.createDataFrame([(1, 0, "1996-01-09", 5), (2, 0, "1996-01-14", 1), (3, 0, "1996-01-15", 0)], "rid int, tile int, rd string, ratio int").withColumn("rd", F.to_date("rd"))
    assert stats.nearest_in_time(q, s, ["tile"], 4, ["qid"]).first().rid == 1 and stats.nearest_in_time(q, s, ["tile"], 4, ["qid"], "cleanest").first().rid == 2


def test_calibration_finds_the_curve(spark):
    df = spark.range(200).selectExpr("(id - 60) / 140.0 as x").selectExpr("double(x) as x", "0.5 * tanh(2.2 * x - 1.1) + 0.5 as y")
    a, b = models.calibrate_cover(df, "x", "y")
    assert abs(a - 2.2) < 1e-3 and abs(b + 1.1) < 1e-3


def test_pages_zip_and_lines(spark, tmp_path):
    page = '{"value": [{"Name": "P1", "S3Path": "/a", "ContentLength": 3, "Online": true, "ContentDate": {"Start": "2022-05-03T10:00:00.000Z"}}], "@odata.nextLink": "n"}'
    (tmp_path / "pages").mkdir()
    (tmp_path / "pages" / "1.json").write_text(page)
    (tmp_path / "pages" / "2.json").write_text("not json")
    rows = sources.read_catalogue_pages(spark, str(tmp_path / "pages")).collect()
    assert [(r.name, r.measurement_day) for r in rows] == [("P1", 20220503)]
    z = io.BytesIO()
    with zipfile.ZipFile(z, "w") as f:
        f.writestr("x/mask.tif", b"12")
        f.writestr("x/other.txt", b"3")
    (tmp_path / "a.zip").write_bytes(z.getvalue())
    (tmp_path / "b.zip").write_bytes(b"no zip")
    got = sources.unzip_members(spark, str(tmp_path), "mask.tif").collect()
    assert [(r.name, bytes(r.content)) for r in got] == [("x/mask.tif", b"12")]
    assert sources.read_objects(spark, str(tmp_path), "*.zip").count() == 2
    (tmp_path / "list.txt").write_text(" a \n\nb\n")
    assert [r.line for r in sources.read_lines(spark, str(tmp_path / "list.txt")).collect()] == ["a", "b"]


def test_cells_are_written_by_tile_and_day(spark, tmp_path):
    x = image(spark, [[1, 2], [3, 4]]).withColumn("d", F.to_date(F.lit("1996-01-01")))
    sinks.write_cells(x, str(tmp_path / "cells"))
    back = spark.read.parquet(str(tmp_path / "cells"))
    assert back.where("tile = 0 and d = date'1996-01-01'").count() == 4 and back.inputFiles()[0].count("tile=0/d=1996-01-01") == 1


def test_a_stream_gives_what_the_batch_gives_and_each_file_once(spark, tmp_path):
    e = spark.createDataFrame([(k, f"2024-01-01 00:{k:02d}:00", k % 3, "purchase" if k % 2 else "view") for k in range(40)], "event_id long, ts string, user_id long, event_type string").withColumn("ts", F.to_timestamp("ts"))
    for k in range(4):
        e.where(f"event_id % 4 = {k}").coalesce(1).write.mode("append").parquet(str(tmp_path / "events"))
    read = lambda: status.read_folder(spark, str(tmp_path / "events"), "*.parquet", files_per_batch=1)
    key = lambda df: sorted(map(str, df.collect()))
    assert key(status.run_available(status.current_status(read()), "complete")) == key(status.current_status(e))
    assert key(status.run_available(status.processed(read()))) == key(status.processed(e))
    assert key(status.run_available(status.new_keys(read(), ["user_id"], "1 hour"))) == key(e.select("user_id").distinct())
    assert status.run_available(status.bursts(read(), "5 minutes"), "complete").count() == status.bursts(e, "5 minutes").count()


@pytest.mark.parametrize("best", ["closest", "cleanest"])
@pytest.mark.parametrize("where,seen", [(None, None), ("x < y + 2 and y < x + 2", None), ("x < y + 2 and y < x + 2", (["x"], ["y"]))])
def test_scenes_meet_by_their_days_and_not_row_by_row(spark, best, where, seen):
    rng = random.Random(5)
    day = lambda k: datetime.date(2024, 3, 1) + datetime.timedelta(k)
    q = [(k, rng.randrange(2), rng.choice([None, *map(day, range(12))]), rng.randrange(6)) for k in range(300)]
    s = [(k, rng.choice([0, 0, None]), day(rng.randrange(12)), rng.choice([None, 1, 2, 3]), rng.randrange(6)) for k in range(300)]
    left, right = spark.createDataFrame(q, "qid long, tile long, d date, x long"), spark.createDataFrame(s, "rid long, tile long, rd date, ratio long, y long")
    found = stats.nearest_in_time(left, right, ["tile"], 2, ["qid"], best, where, **({"seen": seen} if seen else {}))
    want = {}
    for qid, tile, d, x in q:
        near = [(abs((rd - d).days), -1 if ratio is None else ratio, rd, rid) for rid, t2, rd, ratio, y in s if d and t2 == tile and abs((rd - d).days) <= 2 and (not where or abs(x - y) < 2)]
        if near:
            want[qid] = min(near, key=lambda k: k if best == "closest" else (k[1], k[0], k[2], k[3]))[3]
    assert {r.qid: r.rid for r in found.collect()} == want


def joined_rows(spark):
    """The rows that joins of the last query gave at most, by Spark's own metrics."""
    store = spark._jsparkSession.sharedState().statusStore()
    last = max((e.executionId() for e in iterated(store.executionsList())), default=None)
    values, most = store.executionMetrics(last), 0
    for node in iterated(store.planGraph(last).allNodes()):
        for m in iterated(node.metrics()) if "Join" in node.name() else ():
            if m.name() == "number of output rows" and values.contains(m.accumulatorId()):
                most = max(most, int(values.apply(m.accumulatorId()).replace(",", "")))
    return most


def iterated(sequence):
    i = sequence.iterator()
    while i.hasNext():
        yield i.next()


def test_scenes_of_one_day_are_not_paired(spark):
    one = spark.range(3000).selectExpr("id as qid", "id % 2 as tile", "date'2024-03-05' as d")
    other = spark.range(3000).selectExpr("id as rid", "id % 2 as tile", "date'2024-03-06' as rd", "id % 7 as ratio")
    found = stats.nearest_in_time(one, other, ["tile"], 2, ["qid"]).collect()
    assert {(r.qid % 2, r.rid) for r in found} == {(0, 0), (1, 7)} and len(found) == 3000
    assert 0 < joined_rows(spark) <= 3000
