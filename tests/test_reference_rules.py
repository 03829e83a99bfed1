"""Layer rules by cases worked out by hand."""

import datetime

import pytest
from pyspark.sql import functions as F

from cellweave.functions import cells as C
from cellweave.operators import grid, neighbours
from cellweave.operators import timeseries as ts

NAN = float("nan")


def table(spark, names, *rows):
    return spark.createDataFrame(rows, names)


def column(df, x):
    return [r[0] for r in df.orderBy("n").select(x).collect()]


def test_bit_0_of_cover_flags_is_the_low_sun_bit(spark):
    df = table(spark, "n int, bits int, water int, seen boolean", (0, 64, 0, True), (1, 32, 0, True), (2, 128, 0, True), (3, 192, 253, True), (4, 64, 1, False), (5, 224, 2, True))
    zero = F.lit(0)
    assert column(df, C.cover_flags(F.col("bits"), F.col("water"), zero, zero, zero, zero, zero, F.col("seen"))) == [1, 0, 2, 0, 0, 3]


def test_radar_ice_stands_on_water_alone(spark):
    rows = [(k, w, x, s, d, t) for k, (w, x, s, d, t) in enumerate([(1, 5, 0, 0, 0), (2, 15, 0, 0, 0), (0, 5, 0, 0, 0), (253, 5, 0, 0, 1), (254, 5, 1, 0, 0), (255, 5, 0, 0, 0), (1, 5, 1, 0, 0), (2, 5, 1, 1, 0), (1, 5, 1, 1, 1), (0, 5, 0, 0, 1)])]
    df = table(spark, "n int, water int, x int, shadow int, missing int, warm int", *rows)
    got = column(df, C.radar_ice(F.col("x"), F.lit(10), F.lit(False), F.lit(True), F.col("shadow") == 1, F.col("missing") == 1, F.col("warm") == 1, F.col("water")))
    assert got == [100, 1, 255, 255, 255, 255, 200, 255, 1, 255]


def test_radar_flags_by_water_body(spark):
    rows = [(k, digit * 100000 + 12345, ice) for k, (digit, ice) in enumerate([(0, 1), (1, 1), (2, 1), (3, 100), (4, 1), (5, 1), (9, 1), (11, 1), (1, 200)])]
    df = table(spark, "n int, category int, ice int", *rows)
    none = F.lit(NAN)
    got = column(df, C.radar_flags(F.col("ice"), F.lit(1), F.col("category"), none, F.lit(0), F.lit(0), F.lit(0), none))
    assert got == [2, 2, 0, 2, 2, 0, 0, 2, 0]  # lake 1, uncategorised 0, 3, 4; the sixth digit alone counts; none off ice and water


def test_all_radar_flags_and_their_quality(spark):
    df = table(spark, "n int, water int, t double, sealed int, trees int, grass int, wind double", (0, 2, 50.0, 75, 100, 1, 5.0), (1, 1, 49.9, 74, 74, 2, 4.9), (2, 1, None, 100, 75, 1, NAN), (3, 2, NAN, 101, 101, 0, None))
    flags = C.radar_flags(F.lit(100), F.col("water"), F.lit(200000), F.col("t"), F.col("sealed"), F.col("trees"), F.col("grass"), F.col("wind"))
    assert column(df, flags) == [1 + 4 + 8 + 16 + 32 + 64 + 128 + 256, 4 + 128, 16 + 32 + 64, 1]
    assert column(df, C.radar_quality(flags, F.lit(100))) == [0, 0, 3, 1]


@pytest.mark.parametrize("optical,radar,q,flags", [(1, 100, 1, 7), (100, 255, 1, 7), (254, 1, 1, 7), (205, 1, 2, 256 + 9), (205, 200, 2, 256 + 9), (205, 255, 2, 256 + 9), (255, 200, 2, 256 + 9), (255, 255, 2, 256 + 9), (200, 1, 0, 0)])
def test_quality_and_flags_of_merged_ice(spark, optical, radar, q, flags):
    row = spark.range(1).select(C.merge_quality(F.lit(optical), F.lit(radar), F.lit(1), F.lit(2)).alias("q"), C.merge_flags(F.lit(optical), F.lit(radar), F.lit(7), F.lit(9)).alias("f")).first()
    assert (row.q, row.f) == (q, flags)


def test_merged_flags_without_radar_flags_and_with_the_ninth_bit(spark):
    df = table(spark, "n int, optical int, f int", (0, 255, 0), (1, 205, 0), (2, 255, 256), (3, 205, 257))
    assert column(df, C.merge_flags(F.col("optical"), F.lit(1), F.lit(7), F.col("f"))) == [0, 256, 512, 513]
    water = table(spark, "n int, w int", *enumerate([0, 1, 2, 253, 254, 255]))
    assert column(water, C.on_water(F.lit(100), F.col("w"))) == [255, 100, 100, 255, 255, 255]
    assert column(water, C.on_water(F.lit(5), F.col("w"), 0)) == [0, 5, 5, 0, 0, 0]


def test_wet_snow_needs_signal_over_the_noise_and_an_angle(spark):
    low_vh, low_vv = 10**-4.2, 10**-4.0
    rows = [(0, 0.1, 0.1, 0.1, 0.1, 10.0), (1, 0.05, 0.1, 0.1, 0.1, 10.0), (2, 0.1, 0.05, 0.1, 0.1, 60.0), (3, low_vh / 2, 0.1, 0.1, 0.1, 10.0), (4, 0.1, low_vv / 2, 0.1, 0.1, 10.0), (5, 0.1, 0.1, 0.0, 0.1, 10.0), (6, 0.1, 0.1, 0.1, 0.1, -180.0), (7, 0.1, 0.1, 0.1, 0.1, 180.0), (8, 0.1, None, 0.1, 0.1, 30.0), (9, 0.1 * 10**-0.34, 0.1, 0.1, 0.1, 19.9)]
    df = table(spark, "n int, vh double, vv double, rh double, rv double, angle double", *rows)
    ratio = C.wet_ratio(*map(F.col, ("vh", "vv", "rh", "rv", "angle")))
    code, quality = C.wet_snow(ratio)
    got = column(df, F.round(ratio, 3))
    assert got[:3] == [0.0, -3.01, -1.505] and got[3:9] == [None] * 6 and got[9] == -3.4
    assert column(df, code) == [125, 110, 125, *[255] * 6, 110] and column(df, quality) == [250, 2, 250, *[255] * 6, 2]


def stack(spark, rows):
    return spark.createDataFrame([(1, 0, c, datetime.date.fromisoformat(d), v, q) for c, d, v, q in rows], "tile int, r int, c int, d date, v int, qc int")


def test_perennial_begins_at_one_date_of_the_tile(spark):
    days = ["2017-09-10", "2018-04-27", "2018-05-02", "2018-06-15", "2018-08-30"]
    rows = [(0, d, v, 0) for d, v in zip(days, [0, 0, 50, 205, 100], strict=True)]  # bare before the date alone
    rows += [(1, days[1], 0, 0), (1, days[2], 100, 0), (1, days[4], 0, 0)]  # bare at the end
    rows += [(2, days[3], 10, 0)]  # first seen in June: judged from 2 May on
    rows += [(3, days[1], 100, 0)]  # not seen from then on
    rows += [(4, "2018-10-01", 0, 0), (4, "2018-12-30", 100, 0)]  # the next season ends in the year before its May
    got = {(r.c, r.season): r.perennial for r in ts.perennial(stack(spark, rows)).collect()}
    assert got == {(0, 2018): True, (1, 2018): False, (2, 2018): True, (4, 2019): False}


def test_dates_are_nearest_as_numbers(spark):
    rows = [(0, "2018-04-30", 0, 0), (0, "2018-05-30", 100, 0)]  # 20180430 is 71 from 20180501, 20180530 is 29
    assert ts.perennial(stack(spark, rows)).first().perennial is True


def test_quality_counts_whatever_the_value(spark):
    got = {r.c: (r.mean_qc, r.median_qc) for r in ts.quality_stats(stack(spark, [(0, f"2018-01-0{k + 1}", 205, q) for k, q in enumerate([1, 3, 255])] + [(1, "2018-01-01", 50, 205), (1, "2018-01-02", 50, 255)])).collect()}
    assert got == {0: (2.0, 1), 1: (255.0, 255)}


def picture(df, value="v"):
    cells = {(r.r, r.c): r[value] for r in df.collect()}
    return [[cells.get((r, c)) for c in range(max(k[1] for k in cells) + 1)] for r in range(max(k[0] for k in cells) + 1)]


def image(spark, rows):
    return spark.createDataFrame([(1, r, c, v) for r, row in enumerate(rows) for c, v in enumerate(row)], "tile int, r int, c int, v int")


def test_islands_are_judged_by_a_disk(spark):
    x = image(spark, [[205, 205, 205, 0, 0], [205, 100, 205, 0, 0], [205, 205, 205, 0, 0], [0, 0, 0, 0, 100], [0, 0, 0, 100, 100]])
    snow = neighbours.label(x, F.col("v") == 100)
    assert picture(neighbours.drop_islands(x, snow, 0.85, 0))[1][1] == 205
    assert picture(neighbours.drop_islands(x, snow, 0.85, 1)) == picture(x)  # too small
    wide = picture(neighbours.drop_islands(x, snow, 0.79, 0, radius=2))  # 8 of 10 cells of the ring within the image
    assert wide[1][1] == 205 and wide[4][4] == 100
    assert picture(neighbours.drop_islands(x, snow, 0.8, 0, radius=2))[1][1] == 100


def test_other_snow_is_no_part_of_a_ring(spark):
    x = image(spark, [[205, 205, 205, 205], [205, 100, 205, 100], [205, 205, 205, 205]])
    snow = neighbours.label(x, F.col("v") == 100)
    assert {r.v for r in neighbours.drop_islands(x, snow, 0.99, 0, radius=2).collect()} == {205}


def test_upscale_keeps_any_mean(spark):
    x = image(spark, [[7, 205], [205, 205]]).withColumn("d", F.lit(1))
    assert picture(grid.upscale(x, 2, (205, 210, 255))) == [[7]]
