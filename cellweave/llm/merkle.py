"""Merkle manifests of datasets: leaves, subroots by group, one root, and a proof for every row.

Rows are indexed in order of group and key. Each task goes through its sorted run of rows with a stack of nodes: as soon
as the last of `fanout` siblings is there, they are carried into their parent. What a run completes below a cap leaves the
task as a peak, with its leaves and the records of the nodes inside; what a run's edges leave unfinished leaves as smaller
peaks. Peaks of all tasks are then merged in blocks of aligned indexes, level by level, each block a small group. The last
node of each level is made of the siblings that there are, without padding. Proofs go the other way: the path of a peak is
joined to it, and its own records give the paths of its leaves.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import durable
from .sharding import number_rows

LEAVES = 128  # of a peak, at least where its run has them
NODES = 1024  # of a block of the merge, about
STEP = "array<struct<left: binary, right: binary>>"
RESULT = "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean, steps int"
STEP_TYPE = pa.list_(pa.struct([("left", pa.binary()), ("right", pa.binary())]))


def joined_hash(parts: list[bytes]) -> bytes:
    """H of nodes: SHA-256 of their digests written as lowercase hex."""
    return hashlib.sha256(b"".join(parts).hex().encode()).digest()


def height(n: int, fanout: int) -> int:
    """Levels above the leaves of a tree of n leaves."""
    level = 0
    while n > 1:
        n, level = -(-n // fanout), level + 1
    return level


def level_size(n: int, fanout: int, level: int) -> int:
    return -(-n // fanout**level)


def levels_for(count: int, fanout: int) -> int:
    """The lowest level, 1 at least, whose nodes have so many leaves."""
    level = 1
    while fanout**level < count:
        level += 1
    return level


def leaf_bytes(columns: list[Column]) -> Column:
    """The text that a leaf hashes: for each value `-` if null, else its size in UTF-8, a colon and the value."""
    parts = [F.coalesce(F.concat(F.octet_length(c.cast("string")).cast("string"), F.lit(":"), c.cast("string")), F.lit("-")) for c in columns]
    return F.concat(*parts)


class Range:
    """The stack over one run of consecutive leaves of a tree of n leaves, up to the level of the cap."""

    def __init__(self, n: int, fanout: int, cap: int):
        self.n, self.fanout = n, fanout
        self.cap = min(cap, height(n, fanout))
        self.sizes = [level_size(n, fanout, k) for k in range(self.cap + 1)]
        self.stack: list[tuple[int, int, bytes, int]] = []  # level, index, digest, place of its first leaf
        self.leaves: list[tuple] = []
        self.records: list[tuple[int, int, bytes]] = []  # level, index, digest of completed inner nodes and of leaves

    def add(self, index: int, digest: bytes, leaf: tuple) -> Iterator[tuple]:
        """Takes the next leaf and gives the peaks of the cap's level that it completes."""
        self.stack.append((0, index, digest, len(self.leaves)))
        self.leaves.append(leaf)
        self.records.append((0, index, digest))
        while True:
            level, j, _, _ = self.stack[-1]
            if level == self.cap:
                yield from self.flush()
                return
            last = j + 1 == self.sizes[level]
            if (j + 1) % self.fanout and not last:
                return
            k = j % self.fanout + 1  # siblings of the parent so far
            run = self.stack[-k:]
            if len(run) < k or run[0][:2] != (level, j - k + 1):
                return  # the first ones lie before this run
            del self.stack[-k:]
            node = (level + 1, j // self.fanout, joined_hash([x[2] for x in run]))
            self.stack.append((*node, run[0][3]))
            self.records.append(node)

    def flush(self) -> Iterator[tuple]:
        """What stands on the stack, as (level, index, digest, leaves, records)."""
        if not self.stack:
            return
        ends = [x[3] for x in self.stack[1:]] + [len(self.leaves)]
        for (level, j, digest, start), end in zip(self.stack, ends, strict=True):
            inside = [r for r in self.records if r[0] < level and r[1] // self.fanout ** (level - r[0]) == j] if len(self.stack) > 1 else [r for r in self.records if r[0] < level]
            yield level, j, digest, self.leaves[start:end], inside
        self.stack, self.leaves, self.records = [], [], []


def path_steps(nodes: dict[tuple[int, int], bytes], level: int, index: int, top: int, sizes: list[int], fanout: int) -> list[tuple[bytes, bytes]]:
    """Siblings left and right of a node and of its ancestors, below the level of the top."""
    out = []
    while level < top:
        first = index - index % fanout
        run = range(first, min(first + fanout, sizes[level]))
        out.append((b"".join([nodes[level, j] for j in run if j < index]), b"".join([nodes[level, j] for j in run if j > index])))
        level, index = level + 1, index // fanout
    return out


def fold(digest: bytes, steps: list[tuple[bytes, bytes]]) -> bytes:
    for left, right in steps:
        digest = joined_hash([left, digest, right])
    return digest


PEAKS = pa.schema([
    ("g", pa.int64()), ("n", pa.int64()), ("level", pa.int32()), ("idx", pa.int64()), ("digest", pa.binary()),
    ("ids", pa.list_(pa.int64())), ("own", pa.list_(pa.binary())), ("shown", pa.list_(pa.binary())),
    ("levels", pa.list_(pa.int32())), ("at", pa.list_(pa.int64())), ("nodes", pa.list_(pa.binary())),
])
PEAKS_DDL = "g long, n long, level int, idx long, digest binary, ids array<long>, own array<binary>, shown array<binary>, levels array<int>, at array<long>, nodes array<binary>"


def peaks(rows: DataFrame, fanout: int, cap: int) -> DataFrame:
    """Peaks of sorted rows (g, n, idx, doc_id, leaf, shown), with their leaves and records. A gap in the indexes ends a
    run, so any cut of the rows into tasks gives the same tree."""

    def run(batches):
        tree, group, due, out = None, None, None, []

        def take(found):
            for level, j, digest, leaves, records in found:
                ids, own, shown = zip(*leaves, strict=True)
                levels, at, nodes = zip(*records, strict=True) if records else ((), (), ())
                out.append((group[0], group[1], level, j, digest, ids, own, shown, levels, at, nodes))

        def batch_of():
            made = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True) if out else [()] * len(PEAKS), PEAKS.types, strict=True)], schema=PEAKS)
            out.clear()
            return made

        for batch in batches:
            for g, n, idx, doc, leaf, shown in zip(*[batch[c].to_pylist() for c in ("g", "n", "idx", "doc_id", "leaf", "shown")], strict=True):
                if (g, idx) != due or tree is None:
                    if tree:
                        take(tree.flush())
                    tree, group = Range(n, fanout, cap), (g, n)
                take(tree.add(idx, leaf, (doc, leaf, shown)))
                due = (g, idx + 1)
                if len(out) >= 256:
                    yield batch_of()
        if tree:
            take(tree.flush())
        yield batch_of()

    return rows.select("g", "n", "idx", "doc_id", "leaf", "shown").mapInArrow(run, PEAKS_DDL)


def merge_blocks(nodes: DataFrame, fanout: int, top: int) -> DataFrame:
    """One round of the merge: nodes (g, n, level, idx, digest) that tile their trees below the level top, in blocks of one
    node of that level (or of the tree's own top). Gives g, n, top, block, digest of it, level, idx and steps of each node
    that went in."""
    wide = nodes.withColumn("block", F.floor(F.col("idx") / F.pow(F.lit(float(fanout)), F.lit(top) - F.col("level"))).cast("bigint"))
    grouped = wide.groupBy("g", "n", "block").agg(F.collect_list(F.struct("level", "idx", "digest")).alias("x"))

    def run(batches):
        for batch in batches:
            out = []
            for g, n, block, x in zip(*[batch[c].to_pylist() for c in ("g", "n", "block", "x")], strict=True):
                end = min(top, height(n, fanout))
                sizes = [level_size(n, fanout, k) for k in range(end + 1)]
                known = {(r["level"], r["idx"]): r["digest"] for r in x}
                by_level: list[set[int]] = [set() for _ in range(end + 1)]
                for level, j in known:
                    by_level[level].add(j)
                for level in range(end):
                    for j in {i // fanout for i in by_level[level]}:
                        parts = [known[level, i] for i in range(j * fanout, min((j + 1) * fanout, sizes[level]))]
                        known[level + 1, j] = joined_hash(parts)
                        by_level[level + 1].add(j)
                for r in x:
                    steps = path_steps(known, r["level"], r["idx"], end, sizes, fanout)
                    out.append((g, n, end, block, known[end, block], r["level"], r["idx"], [{"left": a, "right": b} for a, b in steps]))
            columns = zip(*out, strict=True) if out else [()] * 8
            types = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.binary(), pa.int32(), pa.int64(), STEP_TYPE]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], ["g", "n", "top", "block", "digest", "level", "idx", "steps"])

    return grouped.mapInArrow(run, f"g long, n long, top int, block long, digest binary, level int, idx long, steps {STEP}")


def climb(nodes: DataFrame, fanout: int, largest: int, from_level: int) -> tuple[DataFrame, DataFrame]:
    """The tops of trees (g, digest) and the path of each node given (g, level, idx, steps), by rounds of merge_blocks.
    Each round takes the next levels of all trees, until the largest one has its top."""
    end, level = height(largest, fanout), from_level
    up = levels_for(NODES, fanout)
    paths = None
    while True:
        level = min(level + up, max(end, 1))
        merged = durable(merge_blocks(nodes, fanout, level))
        if paths is None:
            paths = merged.select("g", "level", "idx", "steps", F.col("top").alias("up_level"), F.col("block").alias("up"))
        else:
            more = merged.select("g", F.col("level").alias("up_level"), F.col("idx").alias("up"), F.col("steps").alias("rest"), F.col("top").alias("new_level"), F.col("block").alias("new_up"))
            paths = paths.join(more, ["g", "up_level", "up"]).select("g", "level", "idx", F.concat("steps", "rest").alias("steps"), F.col("new_level").alias("up_level"), F.col("new_up").alias("up"))
        nodes = merged.groupBy("g", "n", F.col("top").alias("level"), F.col("block").alias("idx")).agg(F.first("digest").alias("digest"))
        if level >= end:
            return nodes.select("g", "digest"), paths.select("g", "level", "idx", "steps")


def manifest(df: DataFrame, columns: list[str], group_col: str = "lang", id_col: str = "doc_id", fanout: int = 2,
             shown: list[Column] | None = None) -> DataFrame:
    """Per row: doc_id, leaf, subroot, root, proof_sha256, folded_root, verified, steps (the levels of its proof).

    A leaf hashes the columns given. Leaves of a group (nulls are one) in order of id, nulls first, make a tree whose
    top is subroot; subroots in order of group, null first and by UTF-8 bytes, make the root. shown gives the columns as
    they are found when the proof is checked (default: unchanged): folded_root is folded from them with the proof's
    siblings, and verified tells whether it is the root. Ids that repeat stand in the order of their leaves; equal rows
    have places of their own. Very long texts are hashed by Spark where they lie; no text is shuffled. The columns given
    may be of any name; others are not read. An empty table gives no rows.
    """
    spark = df.sparkSession
    own, found = leaf_bytes([F.col(f"`{c}`") for c in columns]), leaf_bytes(shown or [F.col(f"`{c}`") for c in columns])
    group, key = F.col(f"`{group_col}`").cast("string"), F.col(f"`{id_col}`").cast("bigint")
    hashed = df.select(group.alias("lang"), key.alias("doc_id"), F.unhex(F.sha2(own, 256)).alias("leaf"), F.unhex(F.sha2(found, 256)).alias("shown"))
    numbered = number_rows(durable(hashed), "lang", "doc_id", "leaf")
    groups = number_rows(numbered.groupBy("lang").agg(F.min("row_number").alias("first"), F.count("*").alias("n")), "lang").withColumnRenamed("row_number", "g")
    trees, largest = groups.agg(F.count("*"), F.max("n")).first()
    if not trees:
        return spark.createDataFrame([], RESULT)
    of = groups.select(F.col("lang").alias("_lang"), "first", "n", "g")
    rows = numbered.join(of, F.col("lang").eqNullSafe(F.col("_lang"))).withColumn("idx", F.col("row_number") - F.col("first"))
    cap = levels_for(LEAVES, fanout)
    cut = durable(peaks(rows.sortWithinPartitions("g", "idx"), fanout, cap))
    tops, paths = climb(cut.select("g", "n", "level", "idx", "digest"), fanout, largest, cap)
    above, over = climb(tops.select(F.lit(0).cast("bigint").alias("g"), F.lit(trees).cast("bigint").alias("n"), F.lit(0).alias("level"), F.col("g").alias("idx"), "digest"), fanout, trees, 0)
    root = bytes(above.first()["digest"])
    ends = tops.join(over.select(F.col("idx").alias("g"), F.col("steps").alias("over")), "g").select("g", F.col("digest").alias("subroot"), "over")
    placed = cut.join(paths, ["g", "level", "idx"]).join(ends, "g")

    def run(batches):
        for batch in batches:
            for k in range(0, batch.num_rows, 64):
                out = []
                for row in batch.slice(k, 64).to_pylist():
                    n, top, upper = row["n"], row["level"], [(s["left"], s["right"]) for s in row["steps"] + row["over"]]
                    sizes = [level_size(n, fanout, x) for x in range(top + 1)]
                    nodes = {(a, b): c for a, b, c in zip(row["levels"], row["at"], row["nodes"], strict=True)}
                    first = row["idx"] * fanout**top
                    for j, (doc, leaf, seen) in enumerate(zip(row["ids"], row["own"], row["shown"], strict=True)):
                        steps = path_steps(nodes, 0, first + j, top, sizes, fanout) + upper
                        proof = hashlib.sha256(b"".join([x for s in steps for x in s]).hex().encode()).hexdigest()
                        folded = fold(seen, steps)
                        out.append((doc, leaf.hex(), row["subroot"].hex(), root.hex(), proof, folded.hex(), folded == root, len(steps)))
                names = [c.split()[0] for c in RESULT.split(", ")]
                types = [pa.int64(), *[pa.string()] * 5, pa.bool_(), pa.int32()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)], names)

    return placed.mapInArrow(run, RESULT)
