"""TIFF files as bytes: directories, blocks (tiles or strips) and their codecs, by numpy and zlib."""

from __future__ import annotations

import struct
import zlib
from dataclasses import dataclass

import numpy as np

#: Tags of the format, and of its geographic and no-data extensions.
WIDTH, HEIGHT, BITS, COMPRESSION, PHOTOMETRIC, STRIP_OFFSETS, SAMPLES, ROWS, STRIP_SIZES = 256, 257, 258, 259, 262, 273, 277, 278, 279
PLANAR, PREDICTOR, COLOURS, TILE_WIDTH, TILE_HEIGHT, TILE_OFFSETS, TILE_SIZES, SUBFILE, FORMAT = 284, 317, 320, 322, 323, 324, 325, 254, 339
PIXEL_SCALE, TIE_POINT, TRANSFORM, GEO_KEYS, NO_DATA = 33550, 33922, 34264, 34735, 42113
#: Codecs by number, and types of tag values by number.
NONE, DEFLATE, OLD_DEFLATE = 1, 8, 32946
KINDS = {1: "B", 2: "s", 3: "H", 4: "I", 5: "II", 6: "b", 7: "s", 8: "h", 9: "i", 11: "f", 12: "d", 16: "Q", 17: "q"}
SORTS = {1: "u", 2: "i", 3: "f"}  # of samples
PROJECTED, GEOGRAPHIC = 3072, 2048  # keys of the reference system
MISSING = {"u1": 255, "u2": 65535, "i2": 32767, "u4": 4294967295, "i4": 2147483647}


class TiffError(ValueError):
    """A file that is no TIFF, or of a kind that is not read here."""


@dataclass
class Directory:
    """One image of a file: its tags, and where its blocks lie."""

    order: str
    tags: dict[int, tuple]

    def one(self, tag: int, default=None):
        return self.tags[tag][0] if tag in self.tags else default

    def __post_init__(self):
        self.width, self.height, self.bands = self.one(WIDTH), self.one(HEIGHT), self.one(SAMPLES, 1)
        bits, sorts = set(self.tags.get(BITS, (1,))), set(self.tags.get(FORMAT, (1,)))
        self.codec, self.predictor, self.planar = self.one(COMPRESSION, NONE), self.one(PREDICTOR, 1), self.one(PLANAR, 1)
        if None in (self.width, self.height) or len(bits) != 1 or len(sorts) != 1 or bits - {8, 16, 32, 64} or not sorts <= set(SORTS):
            raise TiffError("bands of one type of 8 to 64 bits are read")
        if self.codec not in (NONE, DEFLATE, OLD_DEFLATE) or self.predictor not in (1, 2) or (self.predictor == 2 and sorts == {3}):
            raise TiffError("no compression and DEFLATE, with predictor 1 or 2, are read")
        self.sort = f"{SORTS[sorts.pop()]}{bits.pop() // 8}"
        self.dtype = np.dtype(self.order + self.sort)
        self.tiled = TILE_WIDTH in self.tags
        self.block_w = self.one(TILE_WIDTH) if self.tiled else self.width
        self.block_h = self.one(TILE_HEIGHT) if self.tiled else min(self.one(ROWS, self.height), self.height)
        self.across, self.down = -(-self.width // self.block_w), -(-self.height // self.block_h)
        self.offsets, self.sizes = (self.tags.get(t, ()) for t in ((TILE_OFFSETS, TILE_SIZES) if self.tiled else (STRIP_OFFSETS, STRIP_SIZES)))
        self.planes = self.bands if self.planar == 2 else 1
        if len(self.offsets) < self.blocks * self.planes or len(self.sizes) < self.blocks * self.planes:
            raise TiffError("blocks are missing from the file's index")

    @property
    def blocks(self) -> int:
        return self.across * self.down

    @property
    def no_data(self) -> float | None:
        text = self.tags[NO_DATA][0].split(b"\0")[0].strip() if NO_DATA in self.tags else b""
        return float(text) if text else None

    @property
    def transform(self) -> tuple[float, ...] | None:
        """x of the corner, x a column, x a row, y of the corner, y a column, y a row."""
        if TRANSFORM in self.tags:
            m = self.tags[TRANSFORM]
            return m[3], m[0], m[1], m[7], m[4], m[5]
        if PIXEL_SCALE in self.tags and TIE_POINT in self.tags:
            (sx, sy), (c, r, _, x, y) = self.tags[PIXEL_SCALE][:2], self.tags[TIE_POINT][:5]
            return x - c * sx, sx, 0.0, y + r * sy, 0.0, -sy
        return None

    @property
    def epsg(self) -> int | None:
        keys = self.tags.get(GEO_KEYS, ())
        found = {keys[k]: keys[k + 3] for k in range(4, len(keys) - 3, 4) if keys[k + 1] == 0}
        return found.get(PROJECTED, found.get(GEOGRAPHIC))

    def place(self, block: int) -> tuple[int, int, int, int]:
        """First row and column of a block, and how many of either lie in the image."""
        r, c = block // self.across * self.block_h, block % self.across * self.block_w
        return r, c, min(self.block_h, self.height - r), min(self.block_w, self.width - c)

    def read(self, stream, block: int, band: int) -> np.ndarray:
        """The cells of a block's band that lie in the image; a block that the file leaves out has no data (or zeros)."""
        r, _, h, w = self.place(block)
        plane = band * self.blocks if self.planes > 1 else 0
        offset, size = self.offsets[plane + block], self.sizes[plane + block]
        depth = 1 if self.planes > 1 else self.bands
        rows = self.block_h if self.tiled else min(self.block_h, self.height - r)
        if not size:
            return np.full((h, w), self.no_data or 0, self.dtype.newbyteorder("="))
        raw = stream.read_at(size, offset)
        if self.codec != NONE:
            try:
                raw = zlib.decompress(raw)
            except zlib.error as e:
                raise TiffError(f"block {block} is broken: {e}") from e
        if len(raw) < rows * self.block_w * depth * self.dtype.itemsize:
            raise TiffError(f"block {block} is cut short")
        cells = np.frombuffer(raw, self.dtype, rows * self.block_w * depth).reshape(rows, self.block_w, depth)
        if self.predictor == 2:
            cells = np.cumsum(cells, 1, dtype=self.dtype.newbyteorder("="))
        return cells[:h, :w, 0 if self.planes > 1 else band].astype(self.dtype.newbyteorder("="))


def directories(stream, size: int) -> list[Directory]:
    """The images of a file in order: the whole one, then its overviews. Only the index is read."""
    head = stream.read_at(min(16, size), 0)
    order = {b"II": "<", b"MM": ">"}.get(head[:2])
    if order is None or len(head) < 8:
        raise TiffError("no TIFF")
    big = struct.unpack(order + "H", head[2:4])[0] == 43
    at = struct.unpack(order + ("Q" if big else "I"), head[8:16] if big else head[4:8])[0]
    count, entry, offset = ("Q", 20, "Q") if big else ("H", 12, "I")
    wide, out = struct.calcsize(offset), []
    while at and len(out) < 64:
        n = struct.unpack(order + count, stream.read_at(struct.calcsize(count), at))[0]
        table = stream.read_at(n * entry + wide, at + struct.calcsize(count))
        if len(table) < n * entry + wide:
            raise TiffError("the file is cut short")
        tags = {}
        for k in range(n):
            tag, kind, length = struct.unpack_from(order + "HH" + offset, table, k * entry)
            if kind not in KINDS:
                continue
            form = order + (f"{length}s" if KINDS[kind] == "s" else KINDS[kind] * length if len(KINDS[kind]) > 1 else f"{length}{KINDS[kind]}")
            need, value_at = struct.calcsize(form), k * entry + 4 + wide
            raw = table[value_at : value_at + need] if need <= wide else stream.read_at(need, struct.unpack_from(order + offset, table, value_at)[0])
            if len(raw) < need:
                raise TiffError("the file is cut short")
            tags[tag] = struct.unpack(form, raw)
        out.append(Directory(order, tags))
        at = struct.unpack_from(order + offset, table, n * entry)[0]
    if not out:
        raise TiffError("the file holds no image")
    return out


def encode_block(cells: np.ndarray, predictor: int, level: int = 4) -> bytes:
    """A block (rows, columns, bands) by DEFLATE."""
    if predictor == 2:
        cells = np.concatenate([cells[:, :1], np.diff(cells, axis=1)], 1)
    return zlib.compress(np.ascontiguousarray(cells).tobytes(), level)


def index_bytes(images: list[dict], at: int) -> bytes:
    """Directories of a little-endian file of large offsets: tags of each image, chained, to stand at an offset."""
    types = {"B": 1, "s": 2, "H": 3, "I": 4, "d": 12, "Q": 16}
    out = b""
    for k, tags in enumerate(images):
        start = at + len(out)
        table, more = struct.pack("<Q", len(tags)), b""
        values_at = start + 8 + 20 * len(tags) + 8
        for tag in sorted(tags):
            kind, values = tags[tag]
            raw = values if kind == "s" else struct.pack(f"<{len(values)}{kind}", *values)
            table += struct.pack("<HHQ", tag, types[kind], len(values))
            if len(raw) <= 8:
                table += raw.ljust(8, b"\0")
            else:
                more += b"\0" * (-len(more) % 8)
                table += struct.pack("<Q", values_at + len(more))
                more += raw
        more += b"\0" * (-len(more) % 8)
        out += table + struct.pack("<Q", values_at + len(more) if k + 1 < len(images) else 0) + more
    return out


HEADER = struct.Struct("<2sHHHQ")


def header_bytes(index_at: int) -> bytes:
    return HEADER.pack(b"II", 43, 8, 0, index_at)


def image_tags(width: int, height: int, bands: int, sort: str, block: int, offsets: list[int], sizes: list[int], predictor: int, overview: bool,
               no_data: float | None = None, transform: tuple[float, ...] | None = None, epsg: int | None = None, colours: dict[int, tuple[int, int, int]] | None = None) -> dict:
    """Tags of a tiled image by DEFLATE, bands of a cell together."""
    tags = {
        SUBFILE: ("I", [int(overview)]), WIDTH: ("I", [width]), HEIGHT: ("I", [height]), BITS: ("H", [8 * int(sort[1:])] * bands), COMPRESSION: ("H", [DEFLATE]), PHOTOMETRIC: ("H", [3 if colours else 1]),
        SAMPLES: ("H", [bands]), PLANAR: ("H", [1]), PREDICTOR: ("H", [predictor]), TILE_WIDTH: ("I", [block]), TILE_HEIGHT: ("I", [block]),
        TILE_OFFSETS: ("Q", offsets), TILE_SIZES: ("Q", sizes), FORMAT: ("H", [{"u": 1, "i": 2, "f": 3}[sort[0]]] * bands),
    }
    if colours:
        tags[COLOURS] = "H", [257 * colours.get(v, (0, 0, 0))[k] for k in range(3) for v in range(256)]
    if no_data is not None:
        tags[NO_DATA] = "s", f"{no_data:.17g}".encode() + b"\0"
    if transform and not overview:
        x, sx, bx, y, by, sy = transform
        if bx == by == 0 and sy < 0:
            tags |= {PIXEL_SCALE: ("d", [sx, -sy, 0.0]), TIE_POINT: ("d", [0.0, 0.0, 0.0, x, y, 0.0])}
        else:
            tags[TRANSFORM] = "d", [sx, bx, 0.0, x, by, sy, 0.0, y, 0.0, 0.0, 0.0, 0.0, 0.0, 0.0, 0.0, 1.0]
    if epsg and not overview:
        geographic = 4000 <= epsg < 5000
        tags[GEO_KEYS] = "H", [1, 1, 0, 3, 1024, 0, 1, 2 if geographic else 1, 1025, 0, 1, 1, GEOGRAPHIC if geographic else PROJECTED, 0, 1, epsg]
    return tags
