"""Raster files as cells: a data source over TIFF files, a task for a run of blocks."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, InputPartition, LessThan, LessThanOrEqual

from .files import listed, place
from .tiff import Directory, TiffError, directories

BYTES = 32 << 20  # of a file for a task, about
CELLS = 1 << 20  # of an Arrow batch
#: What a band is in Spark, by sort of sample.
COLUMN = {"u1": "int", "i1": "int", "u2": "int", "i2": "int", "i4": "int", "u4": "long", "i8": "long", "f4": "float", "f8": "double"}
ARROW = {"int": pa.int32(), "long": pa.int64(), "float": pa.float32(), "double": pa.float64()}
INFO = "file string, image int, width int, height int, bands int, sort string, block_w int, block_h int, no_data double, epsg int, transform array<double>"


def stem(path: str) -> str:
    return path.rsplit("/", 1)[-1].rsplit(".", 1)[0]


def opened(system, path: str, size: int, level: int) -> tuple[object, Directory]:
    stream = system.open_input_file(path)
    images = directories(stream, size)
    if level >= len(images):
        stream.close()
        raise TiffError(f"{path} has no overview {level}")
    return stream, images[level]


@dataclass
class BlockRun(InputPartition):
    """One of several equal shares of a file's blocks."""

    path: str
    size: int
    share: int
    of: int


@dataclass
class RasterReader(DataSourceReader):
    path: str
    pattern: str
    level: int
    bands: list[int]
    kinds: list[str]
    limits: dict[str, list[int]] = field(default_factory=lambda: {"r": [0, 1 << 62], "c": [0, 1 << 62]})

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        """Comparisons of r and c bound the blocks that are read; all filters are left for Spark to apply to cells."""
        for f in filters:
            if (name := ".".join(getattr(f, "attribute", ()))) in self.limits and isinstance(getattr(f, "value", None), int):
                at, v = self.limits[name], f.value
                if isinstance(f, EqualTo | GreaterThan | GreaterThanOrEqual):
                    at[0] = max(at[0], v + isinstance(f, GreaterThan))
                if isinstance(f, EqualTo | LessThan | LessThanOrEqual):
                    at[1] = min(at[1], v - isinstance(f, LessThan))
            yield f

    def partitions(self) -> list[BlockRun]:
        """By names and sizes alone; no file is opened here."""
        out = []
        for path, size in listed(self.path, self.pattern):
            of = max(1, -(-size // BYTES))
            out += [BlockRun(path, size, k, of) for k in range(of)]
        return out or [BlockRun("", 0, 0, 1)]

    def read(self, partition: BlockRun) -> Iterator[pa.RecordBatch]:
        if not partition.path:
            return
        system, _ = place(self.path)
        stream, image = opened(system, partition.path, partition.size, self.level)
        with stream:
            if max(self.bands) >= image.bands or [COLUMN[image.sort]] * len(self.bands) != self.kinds:
                raise TiffError(f"{partition.path} has other bands than the first file")
            first, last = (image.blocks * k // partition.of for k in (partition.share, partition.share + 1))
            name = stem(partition.path)
            for block in range(first, last):
                r, c, h, w = image.place(block)
                (r0, r1), (c0, c1) = self.limits["r"], self.limits["c"]
                if r > r1 or r + h <= r0 or c > c1 or c + w <= c0:
                    continue
                cells = [image.read(stream, block, b) for b in self.bands]
                step = max(1, CELLS // w)
                for k in range(0, h, step):
                    n = min(step, h - k)
                    rows, columns = np.repeat(np.arange(r + k, r + k + n, dtype=np.int32), w), np.tile(np.arange(c, c + w, dtype=np.int32), n)
                    file = pa.DictionaryArray.from_arrays(pa.array(np.zeros(n * w, np.int32)), pa.array([name])).cast(pa.string())
                    values = [pa.array(x[k : k + n].ravel()).cast(ARROW[t]) for x, t in zip(cells, self.kinds, strict=True)]
                    yield pa.RecordBatch.from_arrays([file, pa.array(rows), pa.array(columns), *values], ["file", "r", "c", *[f"b{b + 1}" for b in self.bands]])


class Raster(DataSource):
    """`raster`: file (its name without ending), r, c, and a column for each band (b1, b2, ...). Options: pattern of
    names, level (0: the image, k: its k-th overview), bands (numbers from 1, joined by commas; default all)."""

    @classmethod
    def name(cls) -> str:
        return "raster"

    def chosen(self) -> tuple[list[int], list[str]]:
        """Bands and their types, as the first file has them."""
        files = listed(self.options["path"], self.options.get("pattern", "*.tif"))
        asked = [int(b) - 1 for b in self.options.get("bands", "").split(",") if b]
        if not files:
            return asked or [0], ["int"] * (len(asked) or 1)
        system, _ = place(self.options["path"])
        stream, image = opened(system, *files[0], int(self.options.get("level", 0)))
        stream.close()
        bands = asked or list(range(image.bands))
        return bands, [COLUMN[image.sort]] * len(bands)

    def schema(self) -> str:
        return ", ".join(["file string, r int, c int", *[f"b{b + 1} {t}" for b, t in zip(*self.chosen(), strict=True)]])

    def reader(self, schema) -> RasterReader:
        bands = [int(x.name[1:]) - 1 for x in schema.fields[3:]]
        kinds = [{"integer": "int", "bigint": "long", "long": "long"}.get(x.dataType.typeName(), x.dataType.typeName()) for x in schema.fields[3:]]
        return RasterReader(self.options["path"], self.options.get("pattern", "*.tif"), int(self.options.get("level", 0)), bands, kinds)


def read_raster(spark: SparkSession, path: str, level: int = 0, bands: tuple[int, ...] = (), pattern: str = "*.tif") -> DataFrame:
    """Cells of the files of a folder (or of one file) whose names match. Filters on r and c bound the blocks that are
    read; cells without data have the file's own value for it (see raster_info)."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(Raster)
    reader = spark.read.format("raster").option("level", str(level)).option("pattern", pattern)
    return (reader.option("bands", ",".join(map(str, bands))) if bands else reader).load(path)


def raster_info(spark: SparkSession, path: str, pattern: str = "*.tif") -> DataFrame:
    """A row for each image of each file (0: the whole one, then overviews): size, bands, blocks, no-data value, reference
    system and transform (x of the corner, a column, a row; y likewise). Files are opened by tasks."""
    files = spark.createDataFrame(listed(path, pattern), "path string, size long")  # names and sizes

    def run(batches):
        system, _ = place(path)
        for batch in batches:
            out = []
            for name, size in zip(batch["path"].to_pylist(), batch["size"].to_pylist(), strict=True):
                with system.open_input_file(name) as stream:
                    for k, d in enumerate(directories(stream, size)):
                        out.append((stem(name), k, d.width, d.height, d.bands, d.sort, d.block_w, d.block_h, d.no_data, d.epsg, d.transform))
            types = [pa.string(), *[pa.int32()] * 4, pa.string(), pa.int32(), pa.int32(), pa.float64(), pa.int32(), pa.list_(pa.float64())]
            columns = zip(*out, strict=True) if out else [()] * len(types)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], [x.split()[0] for x in INFO.split(", ")])

    return files.mapInArrow(run, INFO)
