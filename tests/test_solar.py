"""Solar time and position, and the look-up in a geographic grid, against plain formulas."""

import datetime
import math

from pyspark.sql import functions as F

from cellweave.functions import solar
from cellweave.operators import products


def test_local_solar_time_and_position(spark):
    # Noon by the sun at Greenwich: about 12:14 UTC in mid February, 11:44 in early November (the year's extremes).
    rows = [(1, datetime.datetime(2023, 2, 11, 12), 0.0, 51.48), (2, datetime.datetime(2023, 11, 3, 12), 0.0, 51.48), (3, datetime.datetime(2024, 6, 20, 12), 0.0, 0.0), (4, datetime.datetime(2024, 3, 20, 6), 90.0, 10.0), (5, None, 0.0, 0.0)]
    df = spark.createDataFrame(rows, "k int, t timestamp, lon double, lat double")
    a, e = solar.position(F.col("t"), F.col("lon"), F.col("lat"))
    got = {r.k: r for r in df.select("k", solar.local_solar_time(F.col("t"), F.col("lon")).alias("s"), a.alias("a"), e.alias("e"), solar.declination(F.col("t")).alias("d")).collect()}
    assert abs((got[1].s - datetime.datetime(2023, 2, 11, 12)).total_seconds() / 60 + 14.2) < 0.3
    assert abs((got[2].s - datetime.datetime(2023, 11, 3, 12)).total_seconds() / 60 - 16.4) < 0.3
    assert abs(math.degrees(got[3].d) - 23.44) < 0.05 and abs(got[3].e - 66.56) < 0.2 and (got[3].a < 5 or got[3].a > 355)
    assert abs(got[4].e - 79.8) < 0.6 and 160 < got[4].a < 200  # noon at 90 degrees east on the equinox, seen from 10 north
    assert got[5].s is None
    x = df.where("k = 1").select(*[v.alias(n) for n, v in zip("xyz", solar.direction(F.lit(90.0), F.lit(0.0)), strict=True)]).first()
    assert (round(x.x, 9), round(x.y, 9), round(x.z, 9)) == (1, 0, 0)


def test_lookup_finds_the_cell_around_a_place(spark):
    cells = spark.createDataFrame([("t", r, c) for r in range(0, 50, 7) for c in range(0, 50, 7)], "tile string, r int, c int")
    grid = spark.createDataFrame([(i, j, i * 100 + j) for i in range(20) for j in range(30)], "mr int, mc int, v int")
    transform, edges = (400000.0, 2000.0, 0.0, 5300000.0, 0.0, -2000.0), (7.0, 0.1, 0.0, 48.0, 0.0, -0.1)
    found = products.geographic_lookup(cells, F.lit(32), transform, grid, edges, "v")
    at = products.utm_to_degrees(400000.0 + F.col("c") * 2000.0, 5300000.0 - F.col("r") * 2000.0, F.lit(32))
    for r in found.join(cells.select("tile", "r", "c", at[0].alias("lon"), at[1].alias("lat")), ["tile", "r", "c"]).collect():
        assert (r.mr, r.mc) == (round((48 - r.lat) / 0.1 - 0.5), round((r.lon - 7) / 0.1 - 0.5)) and r.v == r.mr * 100 + r.mc
        assert abs(48 - 0.1 * r.mr - 0.05 - r.lat) <= 0.0501 and abs(7 + 0.1 * r.mc + 0.05 - r.lon) <= 0.0501
    assert found.count() > 30
