"""Raster files: cells and blocks both ways, kinds of files that others write, broken ones, and tasks that run twice."""

import struct
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from cellweave.session import shared_path
from cellweave.sinks import raster as W
from cellweave.sources import raster as R
from cellweave.sources import tiff


def classic(image, order="<", tiled=None, rows=None, codec=8, predictor=1, planar=1, tags=()):
    """A small file of 32-bit offsets, written here tag by tag; image is rows, columns, bands."""
    h, w, n = image.shape
    image = image.astype(image.dtype.newbyteorder(order))
    bh, bw = tiled or (rows or h, w)
    planes = [image[:, :, k : k + 1] for k in range(n)] if planar == 2 else [image]
    blocks = []
    for plane in planes:
        for r in range(0, h, bh):
            for c in range(0, w, bw):
                b = plane[r : r + bh, c : c + bw]
                if tiled:
                    b = np.pad(b, ((0, bh - b.shape[0]), (0, bw - b.shape[1]), (0, 0)))
                if predictor == 2:
                    b = np.concatenate([b[:, :1], np.diff(b, axis=1)], 1).astype(image.dtype)
                raw = np.ascontiguousarray(b).tobytes()
                blocks.append(zlib.compress(raw) if codec != 1 else raw)
    offsets, at = [], 8
    for b in blocks:
        offsets.append(at)
        at += len(b)
    sort = {"u": 1, "i": 2, "f": 3}[image.dtype.kind]
    found = {256: ("I", [w]), 257: ("I", [h]), 258: ("H", [8 * image.dtype.itemsize] * n), 259: ("H", [codec]), 262: ("H", [1]), 277: ("H", [n]), 284: ("H", [planar]), 317: ("H", [predictor]), 339: ("H", [sort] * n)}
    found |= {322: ("I", [bw]), 323: ("I", [bh]), 324: ("I", offsets), 325: ("I", [len(b) for b in blocks])} if tiled else {278: ("I", [bh]), 273: ("I", offsets), 279: ("I", [len(b) for b in blocks])}
    found |= dict(tags)
    kinds = {"I": 4, "H": 3, "d": 12, "s": 2}
    table, more, base = b"", b"", at + 2 + 12 * len(found) + 4
    for tag in sorted(found):
        kind, values = found[tag]
        raw = values if kind == "s" else struct.pack(f"{order}{len(values)}{kind}", *values)
        table += struct.pack(order + "HHI", tag, kinds[kind], len(values)) + (raw.ljust(4, b"\0") if len(raw) <= 4 else struct.pack(order + "I", base + len(more)))
        more += raw if len(raw) > 4 else b""
    return {"<": b"II", ">": b"MM"}[order] + struct.pack(order + "HI", 42, at) + b"".join(blocks) + struct.pack(order + "H", len(found)) + table + struct.pack(order + "I", 0) + more


def array_of(df, name, shape, bands):
    out = np.full((*shape, bands), -99.0)
    for r in df.where(F.col("file") == name).collect():
        out[r.r, r.c] = [r[f"b{k + 1}"] for k in range(bands)]
    return out


@pytest.mark.parametrize("order,dtype,more", [
    ("<", "u1", {}), (">", "u2", {"rows": 4}), ("<", "i2", {"tiled": (16, 16), "predictor": 2}), (">", "i4", {"tiled": (16, 32), "predictor": 2, "codec": 32946}), ("<", "f4", {"codec": 1, "rows": 7}),
    ("<", "f8", {"planar": 2, "tiled": (16, 16)}), ("<", "u4", {"planar": 2, "rows": 5, "predictor": 2}), (">", "u1", {"predictor": 2}),
])
def test_files_of_many_kinds(spark, tmp_path, order, dtype, more):
    rng = np.random.default_rng(1)
    image = (rng.normal(size=(23, 37, 3)) * 1e4).astype(dtype) if dtype[0] == "f" else rng.integers(0, 250, (23, 37, 3)).astype(dtype)
    (tmp_path / "a.tif").write_bytes(classic(image, order, **more))
    df = R.read_raster(spark, str(tmp_path))
    assert df.count() == 23 * 37 and (array_of(df, "a", (23, 37), 3) == image.astype(float)).all()


def test_header_of_a_file(spark, tmp_path):
    tags = {33550: ("d", [20.0, 20.0, 0.0]), 33922: ("d", [0.0, 0.0, 0.0, 600000.0, 5100000.0, 0.0]), 34735: ("H", [1, 1, 0, 2, 1024, 0, 1, 1, 3072, 0, 1, 32632]), 42113: ("s", b"255\0")}
    (tmp_path / "g.tif").write_bytes(classic(np.zeros((4, 6, 1), "u1"), tags=tags))
    got = R.raster_info(spark, str(tmp_path)).first()
    assert (got.width, got.height, got.bands, got.sort, got.no_data, got.epsg) == (6, 4, 1, "u1", 255.0, 32632)
    assert list(got.transform) == [600000.0, 20.0, 0.0, 5100000.0, 0.0, -20.0]


def test_broken_files_are_errors(spark, tmp_path):
    whole = classic(np.arange(900, dtype="u1").reshape(30, 30, 1), rows=10)
    for k, bad in enumerate([b"no raster", whole[:-30], whole[:20] + b"\xff" * 20 + whole[40:], classic(np.zeros((4, 4, 1), "u1"), tags={259: ("H", [5])})]):
        d = tmp_path / str(k)
        d.mkdir()
        (d / "x.tif").write_bytes(bad)
        with pytest.raises(Exception, match="(?i)tiff|cut short|broken|DEFLATE"):
            R.read_raster(spark, str(d)).collect()
    (tmp_path / "none").mkdir()
    assert R.read_raster(spark, str(tmp_path / "none")).collect() == []


def test_only_blocks_within_the_filters_are_read(tmp_path):
    image = np.arange(64 * 64, dtype="u2").reshape(64, 64, 1)
    (tmp_path / "a.tif").write_bytes(classic(image, tiled=(16, 16)))
    from pyspark.sql.datasource import EqualTo, GreaterThan, LessThanOrEqual

    reader = R.RasterReader(str(tmp_path), "*.tif", 0, [0], ["int"])
    assert len(list(reader.pushFilters([GreaterThan(("r",), 31), LessThanOrEqual(("c",), 15), EqualTo(("b1",), 7)]))) == 3
    read = [b for p in reader.partitions() for b in reader.read(p)]
    assert sum(b.num_rows for b in read) == 2 * 256 and {v for b in read for v in b["c"].to_pylist()} == set(range(16))


def test_shares_of_a_file_hold_all_blocks_once(tmp_path, monkeypatch):
    monkeypatch.setattr(R, "BYTES", 500)
    image = np.random.default_rng(2).integers(0, 255, (50, 50, 1)).astype("u1")
    (tmp_path / "a.tif").write_bytes(classic(image, tiled=(16, 16)))
    reader = R.RasterReader(str(tmp_path), "*.tif", 0, [0], ["int"])
    parts = reader.partitions()
    cells = [(r, c) for p in parts for b in reader.read(p) for r, c in zip(b["r"].to_pylist(), b["c"].to_pylist(), strict=True)]
    assert len(parts) > 3 and sorted(cells) == [(r, c) for r in range(50) for c in range(50)]


def test_written_files_come_back(spark):
    rng = np.random.default_rng(3)
    image = rng.integers(-300, 300, (45, 70, 2))
    rows = [("x/y" if False else "one", r, c, *map(int, image[r, c]), 5) for r in range(45) for c in range(70) if (r * 7 + c) % 5]
    rows += [("two", 3, 2, 9, None, 1), ("two", 3, 2, 4, 4, 1), (None, 0, 0, 1, 1, 1), ("two", None, 0, 1, 1, 1)]
    df = spark.createDataFrame(rows, "tile string, r int, c int, band0 int, b int, k int").repartition(5)
    path = shared_path(spark, "raster")
    layout = W.Layout("i2", 16, (2, 4, 8), 2, -999, (500000.0, 10.0, 0.0, 4e6, 0.0, -10.0), 32631)
    W.write_rasters(df, path, ("band0", "b"), layout)
    want = np.full((45, 70, 2), -999)
    for name, r, c, *v, _ in rows:
        if name == "one":
            want[r, c] = v
    for level, k in enumerate((1, 2, 4, 8)):
        got = R.read_raster(spark, path, level)
        part = want[::k, ::k]
        assert (array_of(got, "one", part.shape[:2], 2) == part).all()
    two = {(r.r, r.c): (r.b1, r.b2) for r in R.read_raster(spark, path).where("file = 'two'").collect()}
    assert len(two) == 12 and two[3, 2] == (9, -999) and two[0, 0] == (-999, -999)
    info = {(r.file, r.image): r for r in R.raster_info(spark, path).collect()}
    assert (info["one", 0].epsg, info["one", 0].no_data, list(info["one", 0].transform)) == (32631, -999.0, [500000.0, 10.0, 0.0, 4e6, 0.0, -10.0])
    assert (info["one", 3].height, info["one", 3].width) == (6, 9)
    W.write_rasters(df.where("false"), path + "-none", ("band0",), layout)


def test_colours_and_gaps(spark, tmp_path):
    df = spark.createDataFrame([("a", 0, 0, 1), ("a", 40, 40, 2)], "tile string, r int, c int, v int")
    W.write_rasters(df, str(tmp_path), layout=W.Layout(block=16, overviews=(), colours={1: (255, 0, 7)}))
    with (tmp_path / "a.tif").open("rb") as f:
        data = f.read()

    class Stream:
        def read_at(self, n, at):
            return data[at : at + n]

    image = tiff.directories(Stream(), len(data))[0]
    assert image.tags[tiff.COLOURS][1] == 65535 and image.tags[tiff.COLOURS][513] == 7 * 257 and image.one(tiff.PHOTOMETRIC) == 3
    assert image.sizes.count(0) == 7  # blocks without cells are not in the file
    assert {(r.r, r.c): r.b1 for r in R.read_raster(spark, str(tmp_path)).where("b1 <> 255").collect()} == {(0, 0): 1, (40, 40): 2}


def test_a_lost_task_leaves_no_trace(tmp_path):
    import pyarrow as pa

    data = tiff.encode_block(np.zeros((16, 16, 1), "u1"), 1)
    batch = pa.RecordBatch.from_pylist([{"file": "a", "k": 1, "brow": 0, "bcol": 0, "data": data, "height": 4, "width": 4, "total": len(data)}])
    writer = W.RasterWriter({"path": str(tmp_path)}, W.Layout(block=16, overviews=()), 1)
    writer.write([batch])
    writer.commit([writer.write([batch])])
    assert [p.name for p in tmp_path.iterdir()] == ["a.tif"]
    writer.write([batch])
    writer.abort([])
    assert [p.name for p in tmp_path.iterdir()] == ["a.tif"]
