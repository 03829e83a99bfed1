"""Cells into tiled raster files with overviews.

Tasks make blocks of all levels and write them, packed, to the shared folder. Then each file is put together by one task,
which copies its blocks in order and never unpacks them. Files are written under names of their own; what the commit lists
is moved to its place, so a task that is lost or run twice leaves no trace.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

from ..session import durable, setting
from ..sources import tiff
from ..sources.files import place

OVERVIEWS = (2, 4, 8, 16, 32)
ROWS = 16  # blocks that a task holds at once


@dataclass(frozen=True)
class Layout:
    """How files are laid out. sort is that of samples (u1, i2, f4, ...); no_data fills cells that are missing or null
    (default: the highest value of integers); colours gives red, green and blue of values."""

    sort: str = "u1"
    block: int = 1024
    overviews: tuple[int, ...] = OVERVIEWS
    predictor: int = 1
    no_data: float | None = None
    transform: tuple[float, ...] | None = None
    epsg: int | None = None
    colours: dict[int, tuple[int, int, int]] | None = None

    @property
    def missing(self) -> float:
        return self.no_data if self.no_data is not None else tiff.MISSING.get(self.sort, float("nan"))


BLOCKS = "file string, k int, brow int, bcol int, data binary"


def packed_blocks(cells: DataFrame, bands: tuple[str, ...], layout: Layout) -> DataFrame:
    """A row for each block of each level: file, k (its overview's factor; 1: the image), place and packed bytes. Cells
    of a block meet in one task and are put in their places as they come; of cells that repeat the largest stays."""
    factors = F.array(*[F.lit(k) for k in (1, *layout.overviews)])
    some = F.filter(factors, lambda k: (F.col("r") % k == 0) & (F.col("c") % k == 0))
    wide = cells.select("file", "r", "c", *bands, F.explode(some).alias("k"))
    at = lambda x: F.expr(f"cast({x} div k div {layout.block} as int)")
    inside = lambda x: F.expr(f"cast({x} div k % {layout.block} as int)")
    key = ["file", "k", "brow", "bcol"]
    placed = wide.select("file", "k", at("r").alias("brow"), at("c").alias("bcol"), inside("r").alias("y"), inside("c").alias("x"), *bands)
    ordered = placed.repartition(*key).sortWithinPartitions(*key, *bands)
    dtype, missing = np.dtype("<" + layout.sort), layout.missing

    def run(batches):
        now, block = None, None

        def done():
            data = tiff.encode_block(block, layout.predictor)
            return pa.RecordBatch.from_arrays([pa.array([now[0]]), *[pa.array([v], pa.int32()) for v in now[1:]], pa.array([data], pa.binary())], ["file", "k", "brow", "bcol", "data"])

        for batch in batches:
            if not batch.num_rows:
                continue
            names = batch["file"].dictionary_encode()
            codes = names.indices.to_numpy()
            k, brow, bcol, y, x = (batch[c].to_numpy() for c in ("k", "brow", "bcol", "y", "x"))
            values = np.stack([np.where(np.isnan(v := batch[b].cast(pa.float64()).to_numpy(zero_copy_only=False)), missing, v) if batch[b].null_count or dtype.kind == "f" else batch[b].to_numpy() for b in bands], 1)
            new = np.flatnonzero(np.concatenate([[True], (np.diff(codes) != 0) | (np.diff(k) != 0) | (np.diff(brow) != 0) | (np.diff(bcol) != 0)]))
            for a, b in zip(new, [*new[1:], batch.num_rows], strict=True):
                here = (names.dictionary[int(codes[a])].as_py(), int(k[a]), int(brow[a]), int(bcol[a]))
                if here != now:
                    if now:
                        yield done()
                    now, block = here, np.full((layout.block, layout.block, len(bands)), missing, dtype)
                block[y[a:b], x[a:b]] = values[a:b].astype(dtype)
        if now:
            yield done()

    return ordered.mapInArrow(run, BLOCKS)


@dataclass
class Finished(WriterCommitMessage):
    files: list


class RasterWriter(DataSourceArrowWriter):
    """Takes blocks of whole files in order of file, factor and place."""

    def __init__(self, options: dict, layout: Layout, bands: int):
        self.path, self.layout, self.bands = options["path"], layout, bands
        self.folder = f"_files-{uuid.uuid4().hex}"

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Finished:
        system, path = place(self.path)
        system.create_dir(f"{path}/{self.folder}")
        done, now, stream, at, found, shape, index_at = [], None, None, 0, {}, None, 0

        def close():
            images, lay = [], self.layout
            for k in (1, *lay.overviews):
                h, w = (-(-n // k) for n in shape)
                across, down = -(-w // lay.block), -(-h // lay.block)
                spots = [found.get((k, r, c), (0, 0)) for r in range(down) for c in range(across)]
                offsets, sizes = zip(*spots, strict=True)
                images.append(tiff.image_tags(w, h, self.bands, lay.sort, lay.block, list(offsets), list(sizes), lay.predictor, k > 1, lay.missing, lay.transform, lay.epsg, lay.colours))
            if at != index_at:
                raise ValueError("the blocks of a file did not come together")
            stream.write(tiff.index_bytes(images, at))
            stream.close()
            done.append((temporary, now))

        for batch in iterator:
            for file, k, brow, bcol, data, height, width, total in zip(*[batch[c].to_pylist() for c in ("file", "k", "brow", "bcol", "data", "height", "width", "total")], strict=True):
                if file != now:
                    if now is not None:
                        close()
                    now, found, shape, at, index_at = file, {}, (height, width), 16, 16 + total
                    temporary = f"{uuid.uuid4().hex}.tif"
                    stream = system.open_output_stream(f"{path}/{self.folder}/{temporary}")
                    stream.write(tiff.header_bytes(index_at))
                found[k, brow, bcol] = at, len(data)
                stream.write(data)
                at += len(data)
        if now is not None:
            close()
        return Finished(done)

    def commit(self, messages: list) -> None:
        """Moves the files of tasks that succeeded to their places, and deletes what others left."""
        system, path = place(self.path)
        for temporary, name in [f for m in messages if m for f in m.files]:
            system.move(f"{path}/{self.folder}/{temporary}", f"{path}/{name}.tif")
        system.create_dir(f"{path}/{self.folder}")
        system.delete_dir(f"{path}/{self.folder}")

    def abort(self, messages: list) -> None:
        system, path = place(self.path)
        system.create_dir(f"{path}/{self.folder}")
        system.delete_dir(f"{path}/{self.folder}")


def file_source(layout: Layout, bands: int) -> type[DataSource]:
    class RasterFiles(DataSource):
        @classmethod
        def name(cls) -> str:
            return "rasterfiles"

        def writer(self, schema, overwrite: bool) -> RasterWriter:
            return RasterWriter(self.options, layout, bands)

    return RasterFiles


def write_rasters(cells: DataFrame, path: str, bands: tuple[str, ...] = ("v",), layout: Layout = Layout(), file_col: str = "tile") -> None:
    """Writes the cells (r, c from 0, and bands) of each file to path/file.tif. An image reaches to its highest row and
    column. Overviews take every k-th cell of every k-th row. Cells of null file, row or column are left out; other
    columns are too, whatever their names; a table without cells writes no file."""
    spark = cells.sparkSession
    some = cells.select(F.col(file_col).cast("string").alias("file"), F.col("r").cast("int").alias("r"), F.col("c").cast("int").alias("c"), *[F.col(b).alias(f"band{j}") for j, b in enumerate(bands)])
    some = some.where("file is not null and r >= 0 and c >= 0")
    names = tuple(f"band{j}" for j in range(len(bands)))
    blocks = durable(packed_blocks(some, names, layout))
    shape = some.groupBy("file").agg((F.max("r") + 1).alias("height"), (F.max("c") + 1).alias("width"))
    heads = blocks.groupBy("file").agg(F.sum(F.octet_length("data")).alias("total")).join(shape, "file")
    spark.dataSource.register(file_source(layout, len(bands)))
    with setting(spark, "spark.sql.execution.arrow.maxRecordsPerBatch", ROWS), setting(spark, "spark.sql.parquet.columnarReaderBatchSize", ROWS):
        whole = blocks.join(heads, "file").repartition("file").sortWithinPartitions("file", "k", "brow", "bcol")
        whole.write.format("rasterfiles").mode("append").save(path)
