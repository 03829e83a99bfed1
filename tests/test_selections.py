"""Selections on odd rows: nulls, ties, repeated rows, empty tables and clashing names."""

import datetime
import random

from pyspark.sql import functions as F

from cellweave.operators import selections as X
from cellweave.session import shared_path
from cellweave.sinks import formats as K

D = datetime.date


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=str)


def test_series_rows_and_newest(spark):
    df = spark.createDataFrame([("a", D(2024, 1, 2), 5, 1), ("a", D(2024, 1, 1), 7, 1), ("a", None, 1, 1), ("a", D(2024, 1, 2), 3, 1), ("b", D(2024, 1, 1), None, 1), (None, D(2024, 1, 1), 2, 1)], "k string, d date, v int, n int")
    assert rows(X.date_series(df, ["k"]), "k", "n", "series") == sorted([("a", 4, "1 7 3 5"), ("b", 1, ""), (None, 1, "2")], key=str)
    assert rows(X.band_rows(df, ["k"], ["v"], "v > 4"), "k", "v") == [("a", 5), ("a", 7)]
    assert rows(X.newest_first(df, ["k"]).where("k = 'a'"), "d", "place") == sorted([(D(2024, 1, 2), 1), (D(2024, 1, 2), 2), (D(2024, 1, 1), 3), (None, 4)], key=str)
    assert X.date_series(df.where("false"), ["k"]).count() == 0
    assert rows(X.nearest_to_day(df.withColumn("d", F.expr("if(v = 7, date'2023-04-30', if(v = 3, date'2023-05-02', d))")), ["k"], 5, 1).where("k = 'a'"), "year", "d") == [(2023, D(2023, 4, 30)), (2024, D(2024, 1, 2))]


def test_names_pair_with_days(spark):
    names = spark.createDataFrame([(n,) for n in ("X_20240102T101010_A", "X_20240103T1_B", "X_20241399T1_C", "none", None, "X_20240102T101010_A")], "name string")
    days = spark.createDataFrame([(D(2024, 1, 2), 0), (D(2024, 1, 1), 0), (D(2024, 1, 2), 1), (None, 2)], "d date, name int")
    assert rows(X.date_pairs(names, days), "name", "d", "day_index") == [("X_20240102T101010_A", D(2024, 1, 2), 1)] * 2


def test_places_of_groups_that_span_tasks(spark):
    rng = random.Random(1)
    data = [(rng.choice(["big", "big", "big", "s", None]), rng.choice([None, *range(40)]), k) for k in range(3000)]
    df = spark.createDataFrame(data, "g string, x int, id int").repartition(7)
    got = X.places(df, F.col("g"), "x", "id")
    want = []
    for g in {d[0] for d in data}:
        some = sorted((d for d in data if d[0] == g), key=lambda d: (d[1] is not None, d[1] or 0, d[2]))
        want += [(*d, k + 1) for k, d in enumerate(some)]
    assert got.columns == ["g", "x", "id", "place"] and rows(got, "*") == sorted(want, key=str)
    assert X.places(df.where("false"), F.col("g"), "id").count() == 0


def test_products_as_inputs(spark):
    products = spark.createDataFrame([(1, 10, 1, "/a", "2024-01-05"), (2, 10, 2, "/b", "2024-01-05"), (3, 11, 1, "/c", "2023-12-01"), (4, 99, 1, "/d", "2024-02-01"), (5, 11, 3, "/e", None), (6, 11, 3, "/f", "2024-01-01")], "id int, input_fk_id int, product_type_id int, product_path string, creation_date string").withColumn("creation_date", F.to_timestamp("creation_date"))
    inputs = spark.createDataFrame([(10, "T1", 20240101, "S2", 7), (11, "T2", 20240102, "S1", 7)], "id int, tile string, measurement_day long, mission string, product_type_id int")
    types = spark.createDataFrame([(1, "L2A"), (2, "FSC"), (3, "L2A"), (4, None)], "id int, data_type string")
    routines = spark.createDataFrame([("L2A",), ("L2A",), (None,), ("L1C",)], "input_type string")
    got = X.products_as_inputs(products, inputs, types, routines, "P", "2024-01-01")
    assert rows(got, "processing_condition_name", "tile", "measurement_day", "input_path", "mission") == [("P", "T1", 20240101, "/a", "S2"), ("P", "T2", 20240102, "/f", "S1")]


def test_candidates_outside_colours_and_boxes(spark):
    a, b = spark.createDataFrame([(1,), (None,)], "id int"), spark.createDataFrame([(1, "x")], "id int, source string")
    assert rows(X.all_candidates({"a": a, "b": b}), "*") == sorted([(1, "a"), (None, "a"), (1, "b")], key=str)
    grid = spark.createDataFrame([(1, 0, 0), (1, 0, 1), (1, 0, None)], "tile int, r int, c int")
    assert rows(X.outside(grid, grid.where("c = 1").withColumn("v", F.lit(1))), "*") == sorted([(1, 0, 0), (1, 0, None)], key=str)
    palette = spark.createDataFrame([(205, 7)], "v int, colour int")
    assert rows(X.coloured(spark.createDataFrame([(205,), (None,), (3,)], "v int"), palette), "*") == [(205, 7)]
    slices = spark.createDataFrame([(1, 5.0, 9.0), (1, None, 20.0), (2, None, None)], "take int, x0 double, x1 double")
    assert rows(X.take_boxes(slices, ["take"], 2), "*") == sorted([(1, 3.0, 22.0), (2, None, None)], key=str)


def test_boxes_meet_once_whatever_the_squares(spark):
    rng = random.Random(4)
    data = [(k, rng.randrange(2), r := rng.randrange(-20, 40), r + rng.randrange(0, 30), c := rng.randrange(-20, 40), c + rng.randrange(0, 30)) for k in range(60)] + [(99, 0, None, 1, 1, 1)]
    df = spark.createDataFrame(data, "fid int, tile int, r0 int, r1 int, c0 int, c1 int")
    want = sorted((a[0], b[0], a[2] <= b[2] and b[3] <= a[3] and a[4] <= b[4] and b[5] <= a[5]) for a in data[:-1] for b in data[:-1] if a[0] != b[0] and a[1] == b[1] and a[2] <= b[3] and b[2] <= a[3] and a[4] <= b[5] and b[4] <= a[5])
    for size in (3, 16, 1000):
        assert sorted(map(tuple, X.overlapping_boxes(df, size).collect())) == want


def test_features_are_upserted_by_key(spark):
    old = spark.createDataFrame([(1, "a", 5), (2, "b", 6), (None, "n", 7)], "fid int, name string, area int")
    new = spark.createDataFrame([("B", 2, None, 1.5), ("c", 3, 8, None), ("N", None, 9, None)], "name string, fid int, area int, slope double")
    got = X.upsert_features(old, new, ["fid"])
    assert got.columns == ["fid", "name", "area", "slope"]
    assert rows(got, "*") == sorted([(1, "a", 5, None), (2, "B", 6, 1.5), (3, "c", 8, None), (None, "N", 9, None)], key=str)


def test_batches_and_plans(spark):
    path = shared_path(spark, "batches")
    df = spark.range(5)
    for name, some in (("a", df), ("b", df.where("id < 2")), ("a", df)):
        K.append_batch(some, path, name)
    assert rows(spark.read.parquet(path).groupBy("batch").count(), "batch", "count") == [("a", 5), ("b", 2)]
    assert df.where("id = 1").select(K.plan_json(id=F.col("id"), vm=F.lit(None).cast("int"), name=F.lit('q"'))).first()[0] == '{"id":1,"name":"q\\""}'
