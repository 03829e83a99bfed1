"""The catalogue source: links, broken pages, ranges of pages, pushed filters, names and footprints."""

import datetime
import json

import pytest
from pyspark.sql import functions as F

from cellweave.sources import catalogue as C


def entry(name, day=1, **more):
    return {"Name": name, "S3Path": f"/p/{name}", "ContentDate": {"Start": f"2024-01-{day:02d}T10:00:00.000Z"}, "PublicationDate": f"2024-01-{day:02d}T12:00:00Z"} | more


def save(folder, pages):
    for skip, page in pages.items():
        d = folder / f"skip={skip}"
        d.mkdir(parents=True)
        (d / "page.json").write_text(page if isinstance(page, str) else json.dumps(page))
    return str(folder)


def page(entries, after=None):
    return {"value": entries} | ({"@odata.nextLink": f"https://x/Products?$filter=a&$skip={after}"} if after is not None else {})


def names(df):
    return sorted(r.name for r in df.select("name").collect())


@pytest.mark.parametrize("pages", [1, 2, 16])
def test_links_are_followed_in_any_ranges(spark, tmp_path, pages):
    path = save(tmp_path / "a", {0: page([entry("A")], 20), 20: page([entry("B"), entry("C")], 40), 40: page([]), 60: page([entry("stale")])})
    save(tmp_path / "a" / "other", {0: page([entry("D")])})
    got = names(C.read_catalogue(spark, path, pages=pages))
    assert got == ["A", "B", "C", "D"]


def test_a_page_that_no_link_names_is_left_out(spark, tmp_path):
    path = save(tmp_path, {0: page([entry("A" * 9000)], 40), 20: page([entry("old")], 40), 40: page([entry("B")])})
    assert names(C.read_catalogue(spark, path, pages=1)) == ["A" * 9000, "B"]


def test_broken_pages_and_links(spark, tmp_path):
    path = save(tmp_path, {0: page([entry("A")], 1), 1: "<html>busy</html>", 2: page([entry("B")], 3), 3: json.dumps([1]), 4: page([entry("C")], 9)})
    with pytest.raises(Exception, match="broken"):
        C.read_catalogue(spark, path).collect()
    assert names(C.read_catalogue(spark, path, broken="skip")) == ["A", "B", "C"]
    lost = save(tmp_path / "lost", {0: page([entry("A")], 7)})
    with pytest.raises(Exception, match="not there"):
        C.read_catalogue(spark, lost).collect()


def test_filters_are_tested_by_the_reader(spark, tmp_path, capsys):
    path = save(tmp_path, {0: page([entry(f"S2A_MSIL1C_202401{k:02d}T101010_N0500_R001_T3{k % 10}ABC_X", k) for k in range(1, 29)])})
    df = C.read_catalogue(spark, path).where("name like '%MSIL1C%' and tile in ('T32ABC', 'T35ABC') and date >= timestamp'2024-01-10 00:00:00' and measurement_day < 20240126")
    df.explain("formatted")
    plan = capsys.readouterr().out
    assert "Filter" not in plan.split("BatchScan")[0] and "PushedFilters" in plan or "Pushed" in plan
    assert sorted(r.measurement_day for r in df.collect()) == [20240112, 20240115, 20240122, 20240125]
    assert all(r.mission == "S2" for r in df.collect())


def test_odd_entries(spark, tmp_path):
    ring = {"type": "Polygon", "coordinates": [[[0, 0], [2, 0], [2, 1], [0, 0]]]}
    text = "geography'SRID=4326;POLYGON ((10.5 -1, 11 -1, 11 2.5e0, 10.5 -1))'"
    path = save(tmp_path, {0: page([{}, entry("x"), entry("S1A_B_bad_D_E_F", GeoFootprint=ring), entry("S1A_B_20240102_D_E_T32ABC", 2, Footprint=text, Online=True, ContentLength=5), entry("n", PublicationDate="soon", Footprint="POINT(1 2)")])})
    got = {r.name: r for r in C.read_catalogue(spark, path).collect()}
    assert got[None].date is None and got["x"].tile is None and got["x"].mission == "x" and got["n"].published is None and got["n"].x0 is None
    assert (got["S1A_B_bad_D_E_F"].measurement_day, got["S1A_B_bad_D_E_F"].tile, got["S1A_B_bad_D_E_F"].y1) == (None, "F", 1.0)
    x = got["S1A_B_20240102_D_E_T32ABC"]
    assert (x.measurement_day, x.x0, x.y0, x.x1, x.y1, x.online, x.size) == (20240102, 10.5, -1.0, 11.0, 2.5, True, 5)
    (tmp_path / "none").mkdir()
    assert C.read_catalogue(spark, str(tmp_path / "none")).collect() == []


def test_candidates_lie_within_days_tiles_and_area(spark, tmp_path):
    def box(x, y):
        return {"type": "Polygon", "coordinates": [[[x, y], [x + 2, y], [x + 2, y + 2], [x, y + 2], [x, y]]]}

    rows = [("S2A_K_20240101_N_R_T31ABC", 10, (0, 0)), ("S2A_K_20240102_N_R_T31ABC", 11, (8, 8)), ("S2A_K_20240103_N_R_T32ABC", 12, (0, 1)), ("S2A_K_20240104_N_R_T31ABC", 1, (0, 0)), ("S2A_L_20240105_N_R_T31ABC", 12, (0, 0)), ("S2A_K_20240106_N_R_T31ABC", 12, (3.2, 3.2))]
    path = save(tmp_path, {0: page([entry(n, d, GeoFootprint=box(*at)) for n, d, at in rows])})
    triangle = [(-1, -1), (5, -1), (-1, 7)]
    got = C.candidate_inputs(C.read_catalogue(spark, path), "P", "_K_", datetime.date(2024, 1, 12), 3, 5, ["T31ABC"], triangle).collect()
    assert [(r.measurement_day, r.mission, r.processing_condition_name) for r in got] == [(20240101, "S2", "P")]
    all_ = C.candidate_inputs(C.read_catalogue(spark, path), "P", "_K_", datetime.date(2024, 1, 12), 30, 30)
    assert all_.count() == 5


def test_rings_meet(spark):
    square = [(0.0, 0.0), (4.0, 0.0), (4.0, 4.0), (0.0, 4.0)]
    cases = {
        "inside": ([[1.0, 1.0], [2.0, 1.0], [2.0, 2.0]], True), "around": ([[-9.0, -9.0], [9.0, -9.0], [9.0, 9.0], [-9.0, 9.0]], True), "apart": ([[5.0, 5.0], [6.0, 5.0], [6.0, 6.0]], False),
        "cross": ([[-1.0, 1.0], [5.0, 1.0], [5.0, 2.0], [-1.0, 2.0]], True), "near its box": ([[3.0, 6.0], [6.0, 3.0], [6.0, 6.0]], False), "null": (None, False), "line": ([[1.0, 1.0], [2.0, 2.0]], False),
    }
    df = spark.createDataFrame([(k, v[0]) for k, v in cases.items()], "k string, ring array<array<double>>")
    got = {r.k: r.m for r in df.select("k", F.coalesce(C.meets(F.col("ring"), square), F.lit(False)).alias("m")).collect()}
    assert got == {k: v[1] for k, v in cases.items()}
