"""Vector layers: polygons of WKB values and of shapefiles, as rings and as the sides that polygons.cells_inside takes."""

from __future__ import annotations

import struct
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from .files import listed, place

RINGS = "array<struct<part: int, points: array<array<double>>>>"
RING_TYPE = pa.list_(pa.struct([("part", pa.int32()), ("points", pa.list_(pa.list_(pa.float64())))]))
#: Kinds of geometry in WKB, and of polygons in shapefiles (plain, with measures, with heights).
POLYGON, MULTI_POLYGON, COLLECTION = 3, 6, 7
SHAPE_POLYGONS, SHAPE_NULL, SHAPE_MAGIC = (5, 15, 25), 0, 9994
RECORDS = 20_000  # of a shapefile for a task


def wkb_rings(data: bytes | None) -> list[dict] | None:
    """Rings of a polygon, of several, or of those in a collection: the part each belongs to and its points, outer ring
    first. Heights and measures are dropped, in both ways of writing them; other kinds, and bytes that end early, give
    null."""
    out: list[dict] = []
    parts = 0

    def read(at: int) -> int:
        nonlocal parts
        order = "<" if data[at] else ">"
        kind = struct.unpack_from(order + "I", data, at + 1)[0]
        high = kind & 0xE0000000
        wide = 2 + bool(high & 0x80000000) + bool(high & 0x40000000)
        at += 5 + 4 * bool(high & 0x20000000)  # a reference system of its own
        kind &= 0x1FFFFFFF
        wide += (0, 1, 1, 2)[kind // 1000] if kind < 4000 else 0
        kind %= 1000
        n = struct.unpack_from(order + "I", data, at)[0]
        at += 4
        if kind == POLYGON:
            for _ in range(n):
                size = struct.unpack_from(order + "I", data, at)[0]
                points = np.frombuffer(data, order + "f8", size * wide, at + 4).reshape(size, wide)[:, :2]
                out.append({"part": parts, "points": points.astype(float).tolist()})
                at += 4 + 8 * size * wide
            parts += 1
        elif kind in (MULTI_POLYGON, COLLECTION):
            for _ in range(n):
                at = read(at)
        else:
            raise ValueError(kind)
        return at

    if data is None:
        return None
    try:
        read(0)
    except (ValueError, struct.error, IndexError):
        return None
    return out


def parsed_wkb(column: str | Column) -> Column:
    """Rings of WKB values, as wkb_rings has them."""

    @F.arrow_udf(RINGS)
    def parse(values: pa.Array) -> pa.Array:
        return pa.array([wkb_rings(v) for v in values.to_pylist()], RING_TYPE)

    return parse(column)


def wkb_of(rings: Column) -> Column:
    """WKB of rings (part, points): a polygon where there is one part, else several; null for null."""

    def written(parts: list[list]) -> bytes:
        polygons = []
        for rings_ in parts:
            body = struct.pack("<BII", 1, POLYGON, len(rings_))
            for points in rings_:
                body += struct.pack("<I", len(points)) + np.array([list(p) for p in points], "<f8").tobytes()
            polygons.append(body)
        return polygons[0] if len(polygons) == 1 else struct.pack("<BII", 1, MULTI_POLYGON, len(polygons)) + b"".join(polygons)

    @F.arrow_udf("binary")
    def write(values: pa.Array) -> pa.Array:
        def one(found):
            if found is None:
                return None
            parts: dict[int, list] = {}
            for ring in found:
                parts.setdefault(ring["part"], []).append(ring["points"])
            return written([parts[k] for k in sorted(parts)])

        return pa.array([one(v) for v in values.to_pylist()], pa.binary())

    return write(rings)


def shape_rings(content: bytes) -> list[dict] | None:
    """Rings of a shapefile's record, each closed; a new part begins with each ring that runs clockwise. Null shapes, and
    kinds that are no polygons, give null."""
    kind = struct.unpack_from("<i", content)[0]
    if kind not in SHAPE_POLYGONS:
        return None
    n, size = struct.unpack_from("<ii", content, 36)
    starts = [*struct.unpack_from(f"<{n}i", content, 44), size]
    points = np.frombuffer(content, "<f8", 2 * size, 44 + 4 * n).reshape(size, 2)
    out, part = [], -1
    for a, b in zip(starts, starts[1:], strict=False):
        ring = points[a:b]
        x, y = ring[:, 0] - ring[:1, 0], ring[:, 1] - ring[:1, 1]
        outer = (x[:-1] * y[1:] - x[1:] * y[:-1]).sum() <= 0
        part += outer or part < 0
        out.append({"part": int(part), "points": ring.tolist()})
    return out


def dbf_fields(head: bytes) -> tuple[int, int, list[tuple[str, int, int]]]:
    """Where rows begin, their size, and name, offset and size of each field of a table of attributes."""
    begin, size = struct.unpack_from("<HH", head, 8)
    fields, at = [], 1
    for k in range(32, begin - 1, 32):
        if head[k] == 0x0D:
            break
        fields.append((head[k : k + 11].split(b"\0")[0].decode("latin-1"), at, head[k + 16]))
        at += head[k + 16]
    return begin, size, fields


@dataclass
class RecordRun(InputPartition):
    """Records first to last - 1 of a shapefile."""

    path: str
    size: int
    first: int
    last: int


SHAPES = "file string, fid long, attributes map<string,string>, rings " + RINGS


@dataclass
class ShapeReader(DataSourceReader):
    path: str
    records: int

    def partitions(self) -> list[RecordRun]:
        """By the sizes of the indexes (.shx) alone, which tell how many records there are."""
        out = []
        for index, size in listed(self.path, "*.shx"):
            n = max(0, size - 100) // 8
            out += [RecordRun(index[:-4], size, k, min(k + self.records, n)) for k in range(0, n, self.records)]
        return out or [RecordRun("", 0, 0, 0)]

    def read(self, partition: RecordRun) -> Iterator[pa.RecordBatch]:
        if not partition.path:
            return
        system, _ = place(self.path)
        name, n = partition.path.rsplit("/", 1)[-1], partition.last - partition.first
        with system.open_input_file(partition.path + ".shx") as f:
            spots = np.frombuffer(f.read_at(8 * n, 100 + 8 * partition.first), ">i4").reshape(n, 2) * 2
        attributes: list[list[tuple[str, str | None]]] = [[] for _ in range(n)]
        if any(p == partition.path + ".dbf" for p, _ in listed(partition.path.rsplit("/", 1)[0], "*.dbf")):
            with system.open_input_file(partition.path + ".dbf") as f:
                begin, size, fields = dbf_fields(f.read_at(struct.unpack("<H", f.read_at(2, 8))[0], 0))
                rows = f.read_at(size * n, begin + size * partition.first)
            for k in range(n):
                row = rows[k * size : (k + 1) * size]
                attributes[k] = [(name_, row[at : at + w].decode("latin-1").strip() or None) for name_, at, w in fields]
        with system.open_input_file(partition.path + ".shp") as f:
            for k in range(0, n, 256):
                rings = []
                for offset, size in spots[k : k + 256].tolist():
                    content = f.read_at(size, offset + 8)
                    if len(content) < size or size < 4:
                        raise ValueError(f"{partition.path}.shp is cut short")
                    rings.append(shape_rings(content))
                fids = list(range(partition.first + k, partition.first + k + len(rings)))
                types = [pa.string(), pa.int64(), pa.map_(pa.string(), pa.string()), RING_TYPE]
                columns = [[name] * len(rings), fids, attributes[k : k + 256], rings]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], ["file", "fid", "attributes", "rings"])


class Shapes(DataSource):
    """`shapes`: features of the shapefiles under a folder. fid counts the records of a file from 0."""

    @classmethod
    def name(cls) -> str:
        return "shapes"

    def schema(self) -> str:
        return SHAPES

    def reader(self, schema) -> ShapeReader:
        return ShapeReader(self.options["path"], int(self.options.get("records", RECORDS)))


def read_shapes(spark: SparkSession, path: str, records: int = RECORDS) -> DataFrame:
    spark.dataSource.register(Shapes)
    return spark.read.format("shapes").option("records", str(records)).load(path)


def sides(features: DataFrame, by: list[str], rings: str = "rings", transform: tuple[float, ...] = (0.0, 1.0, 0.0, 0.0, 0.0, 1.0)) -> DataFrame:
    """by, part, x0, y0, x1, y1 of each side of each ring, in columns and rows of the grid that the transform has (x of the
    corner, a column, a row; y likewise). Rings that are not closed are closed; points that repeat make no side."""
    x, sx, bx, y, by_, sy = transform
    det = sx * sy - bx * by_
    ring = features.select(*by, F.explode(rings).alias("ring")).select(*by, "ring.part", F.col("ring.points").alias("_points")).where("size(_points) > 2")
    n = F.size("_points")

    def grid(k: Column) -> list[Column]:
        at = F.get("_points", F.pmod(k, n))
        dx, dy = F.get(at, F.lit(0)) - x, F.get(at, F.lit(1)) - y
        return [(dx * sy - dy * bx) / det, (dy * sx - dx * by_) / det]

    def side(k: Column) -> Column:
        (a, b), (c, d) = grid(k), grid(k + 1)
        return F.struct(a.alias("x0"), b.alias("y0"), c.alias("x1"), d.alias("y1"))

    every = ring.select(*by, "part", F.explode(F.transform(F.sequence(F.lit(0), n - 1), side)).alias("s")).select(*by, "part", "s.*")
    return every.where("x0 <> x1 or y0 <> y1")
