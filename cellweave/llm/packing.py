"""Vector bin packing of tokenised documents into training sequences."""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import portions, release_unused
from .pieces import piece_encoder

SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, loss_tokens long"
ROWS, BYTES = 2000, 2_000_000  # packed at once; of texts encoded at once, unless one has more
POOL = 4096  # pieces that wait at once in a task


@dataclass(frozen=True)
class Limits:
    """Of one sequence, each at least 1. tokens is the padded length; segments counts pieces; loss counts ids that bear
    loss."""

    tokens: int = 2048
    segments: int = 256
    loss: int = 2048

    def __post_init__(self):
        if min(self.tokens, self.segments, self.loss) < 1:
            raise ValueError("a sequence must hold one token, one piece and one loss-bearing id at least")


class Packer:
    """Fills one sequence at a time from a pool of waiting pieces (document, start, length, loss-bearing ids at its end).

    Of the pieces that fit under all three limits, the one with the largest dot product of demand and what the sequence
    has left (each as a share of its limit) comes next. When none fits, the longest is cut to what is left. The last
    sequences of a task are cut at powers of two, which need no padding.
    """

    def __init__(self, limits: Limits):
        self.limits, self.cap = limits, np.array([limits.tokens, limits.segments, limits.loss], float)
        self.kinds: dict[tuple[int, int], int] = {}  # pieces of one length and loss are alike: their place
        self.demand, self.wait = np.zeros((2, 1024)), []  # by kind: tokens and loss (segments are always 1); and its pieces
        self.size, self.tokens, self.sequence = 0, 0, 0

    def add(self, doc: int, start: int, length: int, loss: int) -> None:
        row = self.kinds.setdefault((length, loss), len(self.wait))
        if row == len(self.wait):
            if row == self.demand.shape[1]:
                self.demand = np.concatenate([self.demand, self.demand], 1)
            self.demand[:, row] = length, loss
            self.wait.append([])
        self.wait[row].append((doc, start))
        self.size, self.tokens = self.size + 1, self.tokens + length

    def take(self, row: int) -> list[int]:
        length, loss = self.demand[:, row].astype(int).tolist()
        doc, start = self.wait[row].pop()
        if not self.wait[row]:  # the last kind takes its place
            del self.kinds[length, loss]
            last = self.wait.pop()
            if row < len(self.wait):
                self.wait[row], self.demand[:, row] = last, self.demand[:, len(self.wait)]
                self.kinds[int(self.demand[0, row]), int(self.demand[1, row])] = row
        self.size, self.tokens = self.size - 1, self.tokens - length
        return [doc, start, length, loss]

    def fill(self, tokens: int) -> list[list[int]]:
        """Pieces of the next sequence of so many tokens, or of fewer when segments or loss run out first."""
        left, out = np.array([tokens, self.limits.segments, self.limits.loss], float), []
        while self.size and left[0] >= 1 and left[1] >= 1:
            length, loss = self.demand[:, : len(self.wait)]
            by = left / self.cap**2  # the dot product of shares demanded and shares left
            score = length * by[0] + loss * by[2] + by[1]
            score[(length > left[0]) | (loss > left[2])] = -1
            best = int(score.argmax())
            if score[best] >= 0:
                piece = self.take(best)
            else:
                room = np.minimum(left[0], length - loss + left[2])
                best = int(np.where(room >= 1, length, -1).argmax())
                if room[best] < 1:
                    break
                n = int(room[best])
                piece = self.take(best)
                rest = min(piece[3], piece[2] - n)  # loss-bearing ids stand at the end
                self.add(piece[0], piece[1] + n, piece[2] - n, rest)
                piece[2:] = n, piece[3] - rest
            out.append(piece)
            left -= [piece[2], 1, piece[3]]
        return out

    def sequences(self, least: int) -> Iterator[list[list[int]]]:
        """Sequences until at most so many pieces wait."""
        while self.size > least:
            yield self.fill(min(self.limits.tokens, 1 << (self.tokens.bit_length() - 1)))


def pieces_of(n: int, loss: int, limits: Limits) -> Iterator[tuple[int, int, int]]:
    """Start, length and loss of pieces of a document of n ids, the last of which bear loss: as long as a sequence takes."""
    start = 0
    while start < n:
        length = min(n - start, limits.tokens, max(0, n - loss - start) + limits.loss)
        yield start, length, max(0, start + length - max(start, n - loss))
        start += length


def pack(df: DataFrame, tokenizer: str, end_id: int = 1, limits: Limits = Limits(), id_col: str = "doc_id", text_col: str = "text",
         loss_share_col: str | None = None) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, loss_tokens.

    Each document's ids (null text: none) end with end_id. loss_share_col names a column with the share of a document's
    ids that bear loss (null: all, kept within 0 to 1): so many of its last ids, rounded, as of the answers in instruction
    data. No sequence passes any of the limits. Tasks pack what they read, POOL pieces at a time, so nothing is shuffled
    and memory is bounded; a lost task gives the same rows again, as its input comes in the same order. sequence_id holds
    the task above 2**40. Repeated rows are packed as often as they come, also under a null id; very long texts are cut
    into whole sequences; other columns are left out; an empty table gives no rows.
    """

    def run(batches):
        from pyspark import TaskContext

        release_unused()
        encoder, packer = piece_encoder(tokenizer), Packer(limits)
        base = (TaskContext.get().partitionId() if TaskContext.get() else 0) << 40
        held: dict[int, list] = {}  # by number in this task: doc_id, ids, ids not yet in a piece
        number = 0

        def rows(pieces: list[list[int]]) -> list[tuple]:
            out, at = [], 0
            for doc, start, length, loss in pieces:
                entry = held[doc]
                ids = entry[1][start * 4 : (start + length) * 4]
                out.append((entry[0], start, length, zlib.crc32(ids), len(entry[1]) // 4, base + packer.sequence, at, loss))
                at += length
                entry[2] -= length
                if not entry[2]:
                    del held[doc]
            packer.sequence += 1
            return out

        def frame(out: list[tuple]) -> pa.RecordBatch:
            columns = zip(*out, strict=True) if out else [()] * 8
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], [c.split()[0] for c in SCHEMA.split(", ")])

        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                some, out = batch.slice(at, ROWS), []
                encoded = [ids for part in portions([some], "text", BYTES) for ids in encoder.encode(pc.coalesce(part["text"], pa.scalar("", part["text"].type)))]
                for doc, ids, share in zip(some["doc_id"].to_pylist(), encoded, some["share"].to_pylist(), strict=True):
                    ids += end_id.to_bytes(4, "little")
                    n = len(ids) // 4
                    held[number] = [doc, ids, n]
                    for start, length, loss in pieces_of(n, round(n * share), limits):
                        if length == limits.tokens:  # a sequence of its own
                            out += rows([[number, start, length, loss]])
                        else:
                            packer.add(number, start, length, loss)
                    number += 1
                for pieces in packer.sequences(POOL):
                    out += rows(pieces)
                yield frame(out)
        out = []
        for pieces in packer.sequences(0):
            out += rows(pieces)
        yield frame(out)

    share = F.least(F.greatest(F.coalesce(F.col(loss_share_col).cast("double"), F.lit(1.0)), F.lit(0.0)), F.lit(1.0)) if loss_share_col else F.lit(1.0)
    return df.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"), share.alias("share")).mapInArrow(run, SCHEMA)
