"""Areas of equal cells as polygons: labels by blocks, sides, corners, rings."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import durable
from . import graph

BLOCK = 256  # cells a side


def block_labels(r: np.ndarray, c: np.ndarray, v: np.ndarray) -> np.ndarray:
    """For cells of a block, in order of row and column, the place of the first cell of their four-connected area of equal
    value. Runs of a row are joined with those of the row above that they touch."""
    n = len(r)
    fresh = np.ones(n, bool)
    fresh[1:] = (r[1:] != r[:-1]) | (c[1:] != c[:-1] + 1) | (v[1:] != v[:-1])
    run = np.cumsum(fresh) - 1
    first = np.flatnonzero(fresh)
    parent = list(range(len(first)))

    def root(a: int) -> int:
        while parent[a] != a:
            parent[a] = parent[parent[a]]
            a = parent[a]
        return a

    here = r.astype(np.int64) << 32 | c
    above = np.searchsorted(here, here - (1 << 32))
    above[above == n] = 0
    touch = (here[above] == here - (1 << 32)) & (v[above] == v)
    for a, b in np.unique(np.stack([run[touch], run[above[touch]]], 1), axis=0).tolist():
        a, b = root(a), root(b)
        if a != b:
            parent[max(a, b)] = min(a, b)
    return first[np.array([root(a) for a in range(len(first))], np.int64)[run]] if n else first


def labels(cells: DataFrame, value: str | None = None, block: int = BLOCK) -> DataFrame:
    """tile, r, c, label of cells (tile, r, c): the first cell, by row and column, of their four-connected area, of equal
    value if a column (of whole numbers) is named. Cells whose tile, row, column or value is null are left out; repeated ones count once.

    Each block is labelled by one task; then cells on both sides of the borders of blocks link the labels of blocks, and
    each component of these links takes its smallest. So rounds depend on how many blocks an area crosses, not on cells.
    """
    v = F.col(value).cast("bigint") if value else F.lit(0).cast("bigint")
    some = cells.where(f"tile is not null and r is not null and c is not null{f' and {value} is not null' if value else ''}")
    keyed = some.select("tile", F.col("r").cast("int").alias("r"), F.col("c").cast("int").alias("c"), v.alias("v")).distinct()
    at = [F.expr(f"floor({x} / {block})").alias(b) for x, b in (("r", "br"), ("c", "bc"))]
    key = ["tile", "br", "bc"]
    ordered = keyed.select("*", *at).repartition(*key).sortWithinPartitions(*key, "r", "c")
    kind = cells.schema["tile"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []

        def done() -> pa.RecordBatch:
            t = pa.concat_tables(held).combine_chunks()
            r, c, v = (t[x].to_numpy() for x in ("r", "c", "v"))
            first = block_labels(r, c, v)
            made = {"tile": t["tile"], "r": t["r"], "c": t["c"], "v": t["v"], "lr": pa.array(r[first]), "lc": pa.array(c[first])}
            return pa.table(made).combine_chunks().to_batches()[0]

        now = None
        for batch in batches:
            if not batch.num_rows:
                continue
            tiles = batch["tile"].dictionary_encode().indices.to_numpy()
            br, bc = batch["br"].to_numpy(), batch["bc"].to_numpy()
            new = np.flatnonzero(np.concatenate([[True], (np.diff(tiles) != 0) | (np.diff(br) != 0) | (np.diff(bc) != 0)]))
            for a, b in zip(new.tolist(), [*new[1:].tolist(), batch.num_rows], strict=True):
                here = (batch["tile"][a].as_py(), int(br[a]), int(bc[a]))
                if here != now and held:
                    yield done()
                    held.clear()
                now = here
                held.append(pa.Table.from_batches([batch.slice(a, b - a)]))
        if held:
            yield done()

    inner = durable(ordered.mapInArrow(run, f"tile {kind}, r int, c int, v bigint, lr int, lc int"))
    node = F.struct("tile", F.col("lr").alias("r"), F.col("lc").alias("c"))
    edge = inner.where(f"pmod(r, {block}) in (0, {block - 1}) or pmod(c, {block}) in (0, {block - 1})").select("tile", "r", "c", "v", node.alias("a"))
    near = edge.select("tile", F.explode(F.array(F.struct((F.col("r") + 1).alias("r"), F.col("c").alias("c")), F.struct(F.col("r").alias("r"), (F.col("c") + 1).alias("c")))).alias("o"), "v", F.col("a").alias("b"))
    near = near.select("tile", F.col("o.r").alias("r"), F.col("o.c").alias("c"), "v", "b").where(f"pmod(r, {block}) = 0 or pmod(c, {block}) = 0")
    links = edge.join(near, ["tile", "r", "c", "v"]).where("a <> b").select("a", "b").distinct()
    merged = graph.components(links).select(F.col("node.tile").alias("tile"), F.col("node.r").alias("lr"), F.col("node.c").alias("lc"), F.struct("component.r", "component.c").alias("_label"))
    own = F.struct(F.col("lr").alias("r"), F.col("lc").alias("c"))
    return inner.join(merged, ["tile", "lr", "lc"], "left").select("tile", "r", "c", F.coalesce("_label", own).alias("label"))


#: Sides of a cell clockwise from the top, each with the cell beyond it (row, column), and its ends as steps from
#: the cell's corner (x, y).
SIDES = ((-1, 0, 0, 0, 1, 0), (0, 1, 1, 0, 1, 1), (1, 0, 1, 1, 0, 1), (0, -1, 0, 1, 0, 0))


def sides(areas: DataFrame, by: list[str]) -> DataFrame:
    """by, way (0 to 3: east, south, west, north), x0, y0, x1, y1 of the sides between a cell (r, c) of an area and one that
    is not of it. The area lies to the right."""
    own = areas.select(*by, "r", "c").distinct()
    kinds = F.explode(F.array(*[F.struct(F.lit(k).alias("way"), *[F.lit(x).alias(n) for n, x in zip("ijabef", s, strict=True)]) for k, s in enumerate(SIDES)]))
    sent = own.select(*by, "r", "c", kinds.alias("s"))
    at = sent.select(*by, "s.way", (F.col("r") + F.col("s.i")).alias("r"), (F.col("c") + F.col("s.j")).alias("c"), *[(F.col(x) + F.col(f"s.{n}")).alias(o) for x, n, o in (("c", "a", "x0"), ("r", "b", "y0"), ("c", "e", "x1"), ("r", "f", "y1"))])
    return at.join(own, [*by, "r", "c"], "left_anti").select(*by, "way", "x0", "y0", "x1", "y1")


def straight(unit: DataFrame, by: list[str]) -> DataFrame:
    """Sides that go on in one direction as one: they differ by their place along a line in the same way as by their rank."""
    line = F.when(F.col("way") % 2 == 0, F.col("y0")).otherwise(F.col("x0"))
    along = F.when(F.col("way") % 2 == 0, F.least("x0", "x1")).otherwise(F.least("y0", "y1"))
    w = Window.partitionBy(*by, "way", "line").orderBy("along")
    runs = unit.withColumn("line", line).withColumn("along", along).withColumn("run", F.col("along") - F.row_number().over(w))
    g = runs.groupBy(*by, "way", "line", "run").agg(*[f(x).alias(f"{n}{x}") for x in ("x0", "y0", "x1", "y1") for f, n in ((F.min, "min_"), (F.max, "max_"))])
    first = F.col("way").isin(0, 1)  # towards larger numbers
    return g.select(*by, "way", *[F.when(first, F.col(f"{'min' if x[1] == '0' else 'max'}_{x}")).otherwise(F.col(f"{'max' if x[1] == '0' else 'min'}_{x}")).alias(x) for x in ("x0", "y0", "x1", "y1")])


def rings(areas: DataFrame, by: list[str]) -> DataFrame:
    """by, ring, area, sides and points ([x, y] of its corners in order) of the closed rings around areas of cells (r, c).

    area is positive for outer rings and negative for holes, in cells. Where two cells of an area meet at a corner alone, a
    ring keeps to its cell, so areas are four-connected and what they leave out is eight-connected.
    """
    lines = durable(straight(sides(areas, by), by).withColumn("id", F.expr("(bigint(y0) << 34) + (bigint(x0) << 2) + way")))
    after = lines.select(*by, F.col("x0").alias("x1"), F.col("y0").alias("y1"), F.col("way").alias("_way"), F.col("id").alias("_id"))
    turn = F.when(F.expr("_way = (way + 1) % 4"), 0).otherwise(1)  # right, else left
    nexts = lines.select(*by, "id", "way", "x1", "y1").join(after, [*by, "x1", "y1"]).where("_way <> way").groupBy(*by, "id").agg(F.min_by("_id", turn).alias("next"))
    order = graph.ring_order(nexts, by)
    part = F.expr("(bigint(x0) * y1 - bigint(x1) * y0) / 2")
    length = F.expr("bigint(abs(x1 - x0) + abs(y1 - y0))")
    points = F.transform(F.array_sort(F.collect_list(F.struct("place", "x0", "y0"))), lambda p: F.array(p["x0"], p["y0"]))
    return order.join(lines, [*by, "id"]).groupBy(*by, "ring").agg(F.sum(part).alias("area"), F.sum(length).alias("sides"), points.alias("points"))


def simplified(points: list[list[int]], tolerance: float) -> list[list[int]]:
    """A ring without the corners that lie within the tolerance of the line between those that stay. Its first corner and
    the one farthest from it stay; a ring that would be no polygon stays whole."""
    p = np.array(points, float)
    n = len(p)
    far = int(((p - p[0]) ** 2).sum(1).argmax())
    closed, keep, todo = np.concatenate([p, p[:1]]), {0, far, n}, [(0, far), (far, n)]
    while todo:
        a, b = todo.pop()
        if b - a < 2:
            continue
        line, inner = closed[b] - closed[a], closed[a + 1 : b] - closed[a]
        size = float(np.hypot(*line))
        away = np.abs(line[0] * inner[:, 1] - line[1] * inner[:, 0]) / size if size else np.hypot(inner[:, 0], inner[:, 1])
        k = int(away.argmax())
        if away[k] > tolerance:
            keep.add(a + 1 + k)
            todo += [(a, a + 1 + k), (a + 1 + k, b)]
    left = sorted(keep - {n})
    return [points[k] for k in left] if len(left) > 2 else points


def polygons(cells: DataFrame, value: str = "v", least_area: float = 0, tolerance: float = 0, block: int = BLOCK) -> DataFrame:
    """tile, value, r and c (first cell), area (of its rings that are kept), holes and wkt of each four-connected area of
    equal cells. Cells of value 0 or null make none. Rings under the least area, holes too, are left out, and corners within
    the tolerance of a line (see simplified). A polygon is one value, so its corners meet in one task."""
    some = cells.where(F.col(value) != 0)
    named = labels(some, value, block).join(some.select("tile", "r", "c", F.col(value).alias("value")).distinct(), ["tile", "r", "c"])
    by = ["tile", "label", "value"]
    found = rings(named, by).where(F.abs("area") >= least_area)

    @F.udf("array<array<int>>")
    def fewer(points):
        return simplified(points, tolerance)

    kept = found.withColumn("points", fewer("points")) if tolerance > 0 else found
    text: Column = F.concat(F.lit("("), F.array_join(F.transform(F.concat("points", F.slice("points", 1, 1)), lambda p: F.concat_ws(" ", p[0].cast("string"), p[1].cast("string"))), ","), F.lit(")"))
    hole = F.col("area") < 0
    g = kept.groupBy(*by).agg(F.sum("area").alias("area"), F.count_if(hole).alias("holes"), F.array_sort(F.collect_list(F.struct(hole.alias("hole"), F.col("ring"), text.alias("text")))).alias("rings"))
    outer = g.where("not rings[0].hole")
    wkt = F.concat(F.lit("POLYGON("), F.array_join(F.transform("rings", lambda x: x["text"]), ","), F.lit(")"))
    return outer.select("tile", F.col("value"), F.col("label.r").alias("r"), F.col("label.c").alias("c"), "area", "holes", wkt.alias("wkt"))
