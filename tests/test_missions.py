"""Missions by path and layers by file name."""

from pyspark.sql import functions as F

from cellweave.sources import missions as M


def test_missions_and_names(spark):
    cases = {
        "/a/S2A_MSIL2A_20170815T105021.SAFE": "SEN2COR", "/a/S2A_OPER_X.DBL.DIR": "MAJA", "/a/LC08_X.DBL.DIR": None, "/a/SENTINEL2A_20170815-105021-461_L2A_T32TLS_D": "S2", "/a/SPOT5_Take5": "Take5",
        "/a/LANDSAT8-OLITIRS-XS_20170101_X": "LANDSAT8_new_format", "/a/LANDSAT8_OLITIRS_XS_20150101_N1_D32": "LANDSAT8", "/a/LC08_L1TP_1": "LANDSAT8_LASRC", "/a/other": None, None: None,
    }
    df = spark.createDataFrame([(k,) for k in cases], "path string").withColumn("m", M.mission(F.col("path")))
    assert {r.path: r.m for r in df.collect()} == cases
    tile, time = M.tile_and_time(F.regexp_extract("path", "[^/]*$", 0), F.col("m"))
    got = {r.m: (r.tile, r.time) for r in df.select("m", tile.alias("tile"), time.alias("time")).collect()}
    assert got["S2"] == ("T32TLS", "20170815T105021") and got["LANDSAT8"] == ("D32", "20150101") and got["Take5"] == (None, None)


def test_the_first_file_of_a_layer(spark):
    files = [("/x/S2A_1", p) for p in ("/x/S2A_1/b/p_FRE_B4_2.tif", "/x/S2A_1/a/p_FRE_B4.tif", "/x/S2A_1/a/p_FRE_B4.tif", "/x/S2A_1/FRE_B4/none.txt", None)] + [("/x/none", "/x/none/p_FRE_B4.tif"), (None, "/x/p_FRE_B4.tif")]
    df = spark.createDataFrame([(*f, "m", 3) for f in files], "scene string, path string, mission string, band int")
    assert [tuple(r) for r in M.layer_paths(df).collect()] == [("/x/S2A_1", "S2", "red", "/x/S2A_1/a/p_FRE_B4.tif", 1)]
    assert M.layer_paths(df.where("false")).collect() == []
