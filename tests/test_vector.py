"""WKB and shapefiles: kinds of values, parts and holes, attributes, broken bytes, and their cells."""

import struct

import pytest

from cellweave.operators.polygons import cells_inside
from cellweave.sources import vector as V

SQUARE = [[0.0, 0.0], [4.0, 0.0], [4.0, 4.0], [0.0, 4.0], [0.0, 0.0]]
HOLE = [[1.0, 1.0], [1.0, 2.0], [2.0, 2.0], [2.0, 1.0], [1.0, 1.0]]


def wkb(rings, order="<", kind=3, extra=(), srid=None):
    code = kind | (0x20000000 if srid is not None else 0)
    out = struct.pack(order + "BI", order == "<", code) + (struct.pack(order + "I", srid) if srid is not None else b"") + struct.pack(order + "I", len(rings))
    for ring in rings:
        out += struct.pack(order + "I", len(ring)) + b"".join(struct.pack(f"{order}{2 + len(extra)}d", *p, *extra) for p in ring)
    return out


def test_kinds_of_wkb():
    both = [{"part": 0, "points": SQUARE}, {"part": 0, "points": HOLE}]
    for data in (wkb([SQUARE, HOLE]), wkb([SQUARE, HOLE], ">"), wkb([SQUARE, HOLE], kind=1003, extra=(9.0,)), wkb([SQUARE, HOLE], kind=3003, extra=(9.0, 8.0)), wkb([SQUARE, HOLE], kind=3 | 0x80000000, extra=(1.0,)), wkb([SQUARE, HOLE], srid=4326)):
        assert V.wkb_rings(data) == both
    many = struct.pack("<BII", 1, 6, 2) + wkb([SQUARE, HOLE], ">") + wkb([HOLE])
    assert [r["part"] for r in V.wkb_rings(many)] == [0, 0, 1]
    assert [r["part"] for r in V.wkb_rings(struct.pack("<BII", 1, 7, 1) + many)] == [0, 0, 1]
    assert V.wkb_rings(wkb([])) == [] and V.wkb_rings(None) is None
    for bad in (b"", b"\1", wkb([SQUARE])[:-1], struct.pack("<BIdd", 1, 1, 0.0, 0.0), wkb([SQUARE], kind=99)):
        assert V.wkb_rings(bad) is None


def test_wkb_comes_back(spark):
    rings = [{"part": 0, "points": SQUARE}, {"part": 0, "points": HOLE}, {"part": 1, "points": [[9.0, 9.5], [8.0, 9.0], [9.0, 8.0]]}]
    df = spark.createDataFrame([(1, rings), (2, rings[:1]), (3, None)], f"k int, rings {V.RINGS}")
    back = {r.k: r.rings and [(x.part, x.points) for x in r.rings] for r in df.select("k", V.parsed_wkb(V.wkb_of("rings")).alias("rings")).collect()}
    assert back == {1: [(x["part"], x["points"]) for x in rings], 2: [(0, SQUARE)], 3: None}


def test_sides_feed_cells(spark):
    df = spark.createDataFrame([("a", "z", [{"part": 0, "points": SQUARE}, {"part": 0, "points": HOLE[:-1]}]), ("b", "z", None), ("c", "z", []), ("d", "z", [{"part": 0, "points": SQUARE[:2]}])], f"k string, x0 string, rings {V.RINGS}")
    got = {(r.k, r.r, r.c) for r in cells_inside(V.sides(df.drop("x0"), ["k"]), ["k"]).collect()}
    assert got == {("a", r, c) for r in range(4) for c in range(4)} - {("a", 1, 1)}
    turned = V.sides(df.drop("x0"), ["k"], transform=(4.0, 0.0, -2.0, 0.0, 2.0, 0.0))  # columns along y, rows along -x
    assert {(0, 0), (0, 1), (1, 1)} <= {(r.r, r.c) for r in cells_inside(turned, ["k"]).collect()} <= {(0, 0), (0, 1), (1, 0), (1, 1)}
    sides = [(s.x0, s.y0) for s in turned.where("k = 'a'").collect()]
    assert (0.0, 2.0) in sides and (2.0, 0.0) in sides


def shapefile(path, records, fields):
    """records: list of rings (or None) with a row of text for each field."""
    body, index, at = b"", b"", 50
    for k, (rings, _) in enumerate(records):
        if rings is None:
            content = struct.pack("<i", 0)
        else:
            points = [p for r in rings for p in r]
            xs, ys = zip(*points, strict=True)
            starts = [sum(map(len, rings[:j])) for j in range(len(rings))]
            content = struct.pack("<i4d2i", 5, min(xs), min(ys), max(xs), max(ys), len(rings), len(points)) + struct.pack(f"<{len(starts)}i", *starts) + b"".join(struct.pack("<2d", *p) for p in points)
        body += struct.pack(">ii", k + 1, len(content) // 2) + content
        index += struct.pack(">ii", at, len(content) // 2)
        at += 4 + len(content) // 2
    head = lambda size: struct.pack(">i20xi", V.SHAPE_MAGIC, size // 2) + struct.pack("<ii8d", 1000, 5, *[0.0] * 8)
    path.with_suffix(".shp").write_bytes(head(100 + len(body)) + body)
    path.with_suffix(".shx").write_bytes(head(100 + len(index)) + index)
    width = sum(w for _, w in fields) + 1
    table = struct.pack("<B3xIHH20x", 3, len(records), 32 + 32 * len(fields) + 1, width) + b"".join(n.encode().ljust(11, b"\0") + b"C" + bytes(4) + bytes([w, 0]) + bytes(14) for n, w in fields) + b"\r"
    table += b"".join(b" " + b"".join(str(v).encode("latin-1").ljust(w) for v, (_, w) in zip(row, fields, strict=True)) for _, row in records)
    path.with_suffix(".dbf").write_bytes(table)


@pytest.mark.parametrize("records", [1, 2, 100])
def test_features_of_a_shapefile(spark, tmp_path, records):
    clockwise, far = SQUARE[::-1], [[p[0] + 10, p[1]] for p in SQUARE[::-1]]
    counter = HOLE[::-1]
    shapefile(tmp_path / "river", [([clockwise, counter, far], ("one", 5)), (None, ("", "")), ([far], ("Häv", 7))], [("NAME", 8), ("CLASS", 3)])
    got = V.read_shapes(spark, str(tmp_path), records).orderBy("fid").collect()
    assert [r.file for r in got] == ["river"] * 3 and [r.attributes for r in got] == [{"NAME": "one", "CLASS": "5"}, {"NAME": None, "CLASS": None}, {"NAME": "Häv", "CLASS": "7"}]
    assert [x.part for x in got[0].rings] == [0, 0, 1] and got[1].rings is None and got[2].rings[0].points == far


def test_a_cut_shapefile_is_an_error(spark, tmp_path):
    shapefile(tmp_path / "x", [([SQUARE[::-1]], ("a",))], [("N", 2)])
    whole = (tmp_path / "x.shp").read_bytes()
    (tmp_path / "x.shp").write_bytes(whole[:-9])
    with pytest.raises(Exception, match="cut short"):
        V.read_shapes(spark, str(tmp_path)).collect()
    (tmp_path / "none").mkdir()
    assert V.read_shapes(spark, str(tmp_path / "none")).collect() == []
