"""Token ids in files: Simple-8b words in blocks, with a table of documents.

A word of 64 bits holds a selector in its four high bits and so many values of so many bits in the others. Values over 60
bits are escapes: their word has selector 0, and they follow the block's words in whole. Blocks hold BLOCK values but for a
file's last one, and stand apart: the index has the place of each, so any can be decoded alone. All blocks of a chunk are
coded side by side: at each step numpy chooses the next word of every block.

A file is MAGIC, words, and an index: three 64-bit numbers a block (first word, words, escapes), then id, validity and size
of each document, then the counts of blocks and documents, the number of values, and MAGIC again.
"""

from __future__ import annotations

import json
import struct
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage

from ..sources.files import place
from .pieces import piece_encoder

MAGIC = b"S8BTOK01"
BLOCK = 1024  # values
ROWS = 2000  # texts that are encoded at once
CHUNK = 512  # blocks that are coded at once
FILE = 1 << 24  # values of a file, about: a task goes on in a new file
#: How many values of how many bits a word holds, by selector; 0 is an escape.
COUNTS = np.array([1, 120, 60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1])
WIDTHS = np.array([64, 0, 1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60])
SCHEMA = "doc_id long, start long, ids binary"
SMALL = np.ceil(np.log2(np.arange(1, (1 << 16) + 1))).astype(np.uint8)  # bits that values below 2**16 need


def bits_of(values: np.ndarray) -> np.ndarray:
    """How many bits each value needs."""
    if len(values) and values.max() < 1 << 16:
        return SMALL[values.astype(np.uint16)]
    out = np.zeros(values.shape, np.uint8)
    rest = values.copy()
    for k in (32, 16, 8, 4, 2, 1):
        high = rest >= np.uint64(1 << k)
        out += high.astype(np.uint8) * np.uint8(k)
        rest = np.where(high, rest >> np.uint64(k), rest)
    return out + (rest > 0)


def chosen(need: np.ndarray) -> np.ndarray:
    """For each place of each block (a row) the selector of the word that would begin there: of those whose values all fit
    and lie in the block, the one with most values. Places beyond a block need 255 bits."""
    best = np.zeros(need.shape, np.uint8)
    reach, span = need, 1  # the most bits of so many values from each place on
    powers = [(1, need)]
    while span < COUNTS.max():
        shifted = np.full(reach.shape, 255, np.uint8)
        shifted[:, :-span] = reach[:, span:]
        reach, span = np.maximum(reach, shifted), span * 2
        powers.append((span, reach))
    for selector in range(15, 0, -1):  # from one value a word to most
        count, width = int(COUNTS[selector]), int(WIDTHS[selector])
        span, reach = max(p for p in powers if p[0] <= count)
        fits = reach <= width
        if count > span:
            fits[:, : -(count - span)] &= reach[:, count - span :] <= width
            fits[:, -(count - span) :] = False
        best[fits] = selector
    return best


def encode_blocks(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Words of values (unsigned 64-bit) in blocks of BLOCK, and words and escapes of each block (a row each)."""
    blocks = -(-len(values) // BLOCK)
    grid = np.zeros(blocks * BLOCK, np.uint64)
    grid[: len(values)] = values
    need = np.full(blocks * BLOCK, 255, np.uint8)
    need[: len(values)] = bits_of(grid[: len(values)])
    select = chosen(need.reshape(blocks, BLOCK)).ravel()
    size = np.minimum(np.arange(1, blocks + 1) * BLOCK, len(values)) - np.arange(blocks) * BLOCK
    at, end = np.arange(blocks) * BLOCK, np.arange(blocks) * BLOCK + size
    found = [np.zeros(0, np.int64)]
    while len(at):
        found.append(at)
        at = at + COUNTS[select[at]]
        open_ = at < end
        if not open_.all():
            at, end = at[open_], end[open_]
    starts = np.sort(np.concatenate(found))
    rows = starts // BLOCK
    kind = select[starts]
    words = kind.astype(np.uint64) << np.uint64(60)
    for selector in range(2, 16):
        here = np.flatnonzero(kind == selector)
        width = np.uint64(WIDTHS[selector])
        for k in range(int(COUNTS[selector]) if len(here) else 0):
            words[here] |= grid[starts[here] + k] << np.uint64(k) * width
    packed, escapes = np.bincount(rows, minlength=blocks), np.bincount(rows[kind == 0], minlength=blocks)
    if escapes.any():
        order = np.argsort(np.concatenate([rows * 2, rows[kind == 0] * 2 + 1]), kind="stable")
        words = np.concatenate([words, grid[starts[kind == 0]]])[order]
    return words, np.stack([packed, escapes], 1)


def decode_blocks(words: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The values of consecutive blocks, given words and escapes of each."""
    whole = np.ones(len(words), bool)
    if sizes[:, 1].any():  # escaped values stand behind the words of their block
        ends = np.cumsum(sizes.sum(1))
        for end, n in zip(ends[sizes[:, 1] > 0], sizes[sizes[:, 1] > 0, 1], strict=True):
            whole[end - n : end] = False
    packed = words[whole]
    kind = (packed >> np.uint64(60)).astype(np.int64)
    count = COUNTS[kind]
    first = np.cumsum(count) - count
    out = np.zeros(int(count.sum()), np.uint64)
    for selector in range(2, 16):
        here = np.flatnonzero(kind == selector)
        if len(here):
            n, width = int(COUNTS[selector]), np.uint64(WIDTHS[selector])
            shift = np.arange(n, dtype=np.uint64) * width
            out[first[here, None] + np.arange(n)] = packed[here, None] >> shift & (np.uint64(1) << width) - np.uint64(1)
    out[first[kind == 0]] = words[~whole]
    return out


class FileWriter:
    """One file: documents are added in order; chunks of blocks are written as they fill."""

    def __init__(self, stream):
        self.stream, self.values, self.words = stream, 0, 0
        self.held, self.waiting = [], 0
        self.blocks, self.docs = [], []
        stream.write(MAGIC)

    def add(self, doc: int | None, ids: np.ndarray) -> None:
        self.docs.append((doc or 0, doc is not None, len(ids)))
        self.values += len(ids)
        self.held.append(ids)
        self.waiting += len(ids)
        if self.waiting >= BLOCK * CHUNK:
            self.put(self.waiting // BLOCK * BLOCK)

    def put(self, n: int) -> None:
        all_ = np.concatenate(self.held)
        for k in range(0, n, BLOCK * CHUNK):
            words, sizes = encode_blocks(all_[k : min(k + BLOCK * CHUNK, n)].astype(np.uint64))
            self.stream.write(words.astype("<u8").tobytes())
            starts = self.words + np.cumsum(sizes.sum(1)) - sizes.sum(1)
            self.blocks.append(np.column_stack([starts, sizes]))
            self.words += len(words)
        self.held, self.waiting = [all_[n:]], self.waiting - n

    def close(self) -> None:
        if self.waiting:
            self.put(self.waiting)
        blocks = np.concatenate(self.blocks) if self.blocks else np.zeros((0, 3))
        docs, valid, sizes = zip(*self.docs, strict=True) if self.docs else ((), (), ())
        self.stream.write(blocks.astype("<i8").tobytes() + np.array(docs, "<i8").tobytes() + np.array(valid, np.uint8).tobytes() + np.array(sizes, "<i8").tobytes())
        self.stream.write(struct.pack("<4q", len(blocks), len(self.docs), self.values, self.words) + MAGIC)


class FileReader:
    """The documents of a file and the values of any run of its blocks."""

    def __init__(self, stream):
        self.stream, size = stream, stream.size()
        stream.seek(size - 40)
        tail = stream.read(40)
        if tail[32:] != MAGIC:
            raise ValueError("not a whole token file")
        n_blocks, n_docs, self.values, n_words = struct.unpack("<4q", tail[:32])
        stream.seek(8 + 8 * n_words)
        index = stream.read(24 * n_blocks + 17 * n_docs)
        self.blocks = np.frombuffer(index, "<i8", 3 * n_blocks).reshape(-1, 3)
        self.docs = np.frombuffer(index, "<i8", n_docs, 24 * n_blocks)
        self.valid = np.frombuffer(index, np.uint8, n_docs, 24 * n_blocks + 8 * n_docs)
        self.sizes = np.frombuffer(index, "<i8", n_docs, 24 * n_blocks + 9 * n_docs)

    def run(self, first: int, last: int) -> np.ndarray:
        """Values of blocks first to last - 1."""
        some = self.blocks[first:last]
        self.stream.seek(8 + 8 * int(some[0, 0]))
        n = int(some[-1].sum() - some[0, 0])
        return decode_blocks(np.frombuffer(self.stream.read(8 * n), "<u8"), some[:, 1:])

    def documents(self) -> Iterator[tuple[int | None, int, bytes]]:
        """Id, values before it in the file, and ids as little-endian unsigned 32-bit integers."""
        ends = np.cumsum(self.sizes)
        held, base, block = np.zeros(0, "<u4"), 0, 0  # held begins with the value numbered base
        for doc, valid, size, end in zip(self.docs.tolist(), self.valid.tolist(), self.sizes.tolist(), ends.tolist(), strict=True):
            parts = [held]
            while base + sum(map(len, parts)) < end:
                parts.append(self.run(block, min(block + CHUNK, len(self.blocks))).astype("<u4"))
                block += CHUNK
            held = np.concatenate(parts) if len(parts) > 1 else held
            at = end - size - base
            yield (doc if valid else None), end - size, held[at : at + size].tobytes()
            if at + size > 1 << 16:
                held, base = held[at + size :], end


@dataclass
class Written(WriterCommitMessage):
    files: list


class Writer(DataSourceArrowWriter):
    """Each task writes files under names of its own; only what the driver's commit lists is part of the store, so a task
    that is run twice leaves nothing in it. With a tokenizer, rows hold texts and are encoded here, so that ids go nowhere
    but into the file."""

    def __init__(self, options: dict):
        self.path, self.tokenizer, self.end = options["path"], options.get("tokenizer"), int(options.get("end", 1)).to_bytes(4, "little")

    def documents(self, batch: pa.RecordBatch) -> Iterator[tuple[int | None, bytes]]:
        if not self.tokenizer:
            yield from zip(batch["doc_id"].to_pylist(), batch["ids"].to_pylist(), strict=True)
            return
        encoder = piece_encoder(self.tokenizer)
        for at in range(0, batch.num_rows, ROWS):
            some = batch.slice(at, ROWS)
            ids = encoder.encode(pc.coalesce(some["text"], pa.scalar("", some["text"].type)))
            yield from zip(some["doc_id"].to_pylist(), [x + self.end for x in ids], strict=True)

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        from pyspark import TaskContext

        system, path = place(self.path)
        system.create_dir(path)
        number, done, open_ = TaskContext.get().partitionId(), [], None

        def close():
            writer, stream, name = open_
            writer.close()
            stream.close()
            done.append([number, len(done), name, writer.values, len(writer.docs)])

        for batch in iterator:
            for doc, ids in self.documents(batch):
                if open_ is None:
                    name = f"part-{number:06d}-{uuid.uuid4().hex}.s8b"
                    stream = system.open_output_stream(f"{path}/{name}")
                    open_ = FileWriter(stream), stream, name
                open_[0].add(doc, np.frombuffer(ids, "<u4"))
                if open_[0].values >= FILE:
                    close()
                    open_ = None
        if open_:
            close()
        return Written(done)

    def commit(self, messages: list) -> None:
        system, path = place(self.path)
        system.create_dir(path)
        files = sorted(f for m in messages if m for f in m.files)  # a few rows a task
        with system.open_output_stream(f"{path}/_files.json") as out:
            out.write(json.dumps(files).encode())

    def abort(self, messages: list) -> None:
        system, path = place(self.path)
        for name in [f[2] for m in messages if m for f in m.files]:
            system.delete_file(f"{path}/{name}")


@dataclass
class OneFile(InputPartition):
    name: str
    start: int


class Reader(DataSourceReader):
    """One task a file. start counts the ids of all documents before, over all files."""

    def __init__(self, options: dict):
        self.path = options["path"]

    def partitions(self) -> list[OneFile]:
        system, path = place(self.path)
        with system.open_input_stream(f"{path}/_files.json") as f:
            files, start, out = json.loads(f.read()), 0, []
        for _, _, name, values, _ in files:
            out.append(OneFile(name, start))
            start += values
        return out or [OneFile("", 0)]

    def read(self, partition: OneFile) -> Iterator[pa.RecordBatch]:
        if not partition.name:
            return
        system, path = place(self.path)
        with system.open_input_file(f"{path}/{partition.name}") as stream:
            rows, size = [], 0
            for doc, at, ids in FileReader(stream).documents():
                rows.append((doc, partition.start + at, ids))
                size += len(ids)
                if size > 1 << 24 or len(rows) == 4096:
                    yield self.batch(rows)
                    rows, size = [], 0
            if rows:
                yield self.batch(rows)

    @staticmethod
    def batch(rows: list[tuple]) -> pa.RecordBatch:
        docs, starts, ids = zip(*rows, strict=True)
        return pa.RecordBatch.from_arrays([pa.array(docs, pa.int64()), pa.array(starts, pa.int64()), pa.array(ids, pa.binary())], ["doc_id", "start", "ids"])


class TokenFiles(DataSource):
    """`simple8b`: written from columns doc_id and ids (little-endian unsigned 32-bit integers), or doc_id and text with
    the option tokenizer (and end, the id after each document), in the order of tasks and their rows; read as doc_id,
    start and ids."""

    @classmethod
    def name(cls) -> str:
        return "simple8b"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> Reader:
        return Reader(self.options)

    def writer(self, schema, overwrite: bool) -> Writer:
        return Writer(self.options)


def write_tokens(ordered: DataFrame, path: str) -> None:
    """Writes rows (doc_id, ids) as they are ordered."""
    ordered.sparkSession.dataSource.register(TokenFiles)
    ordered.select("doc_id", "ids").write.format("simple8b").mode("append").save(path)


def write_texts(ordered: DataFrame, path: str, tokenizer: str, end_id: int = 1) -> None:
    """Writes the ids of rows (doc_id, text) as they are ordered, each document with the end id; null texts are empty."""
    ordered.sparkSession.dataSource.register(TokenFiles)
    ordered.select("doc_id", "text").write.format("simple8b").option("tokenizer", tokenizer).option("end", str(end_id)).mode("append").save(path)


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    spark.dataSource.register(TokenFiles)
    return spark.read.format("simple8b").load(path)
