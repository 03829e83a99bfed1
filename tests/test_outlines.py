"""Labels by blocks, rings, polygons and their simplification against plain flood fill."""

import random
import re

import pytest
from pyspark.sql import functions as F

from cellweave.operators import graph, outlines
from cellweave.operators.polygons import cells_inside


def flood(cells):
    """Label of each cell of {(tile, r, c): value}: the first of its area."""
    out = {}
    for key in sorted(cells):
        if key in out or cells[key] in (0, None):
            continue
        todo = [key]
        while todo:
            t, r, c = at = todo.pop()
            if at in out:
                continue
            out[at] = key[1:]
            todo += [n for n in ((t, r + 1, c), (t, r - 1, c), (t, r, c + 1), (t, r, c - 1)) if cells.get(n) == cells[key] and n not in out]
    return out


def image(spark, seed, side, classes):
    rng = random.Random(seed)
    cells = {(t, r - 3, c): rng.choice(classes) for t in (1, 2) for r in range(side) for c in range(side)}
    rows = [(*k, v, "x", 1) for k, v in cells.items()]
    return cells, spark.createDataFrame(rows + rows[:50] + [(1, None, 2, 1, "x", 1), (None, 1, 2, 1, "x", 1)], "tile int, r int, c int, v int, label string, ring int").repartition(4)


@pytest.mark.parametrize("block", [1, 4, 7, 256])
def test_labels_of_any_block_size(spark, block):
    cells, df = image(spark, 1, 40, [1, 1, 1, 0, 2])
    got = {(r.tile, r.r, r.c): tuple(r.label) for r in outlines.labels(df.where("v <> 0"), "v", block).collect()}
    assert got == flood(cells)


def test_a_long_snake_is_one_area(spark):
    snake = {(1, r, c) for r in range(61) for c in range(61) if r % 4 == 0 or (r % 4 == 2 and False) or (r % 4 != 0 and c == (60 if r % 8 < 4 else 0))}
    df = spark.createDataFrame(list(snake), "tile int, r int, c int")
    assert {tuple(r.label) for r in outlines.labels(df, block=8).collect()} == {(0, 0)}


def test_ring_order(spark):
    rng = random.Random(2)
    want, rows = {}, []
    for size in (1, 2, 3, 64, 65, 1000):
        ids = rng.sample(range(10**6), size)
        head = ids.index(min(ids))
        for k, i in enumerate(ids):
            rows.append((size, i, ids[(k + 1) % size]))
            want[size, i] = (min(ids), (k - head) % size)
    got = {(r.g, r.id): (r.ring, r.place) for r in graph.ring_order(spark.createDataFrame(rows, "g int, id long, next long").repartition(3), ["g"]).collect()}
    assert got == want


def parsed(wkt):
    return [[tuple(map(int, p.split())) for p in ring.split(",")] for ring in re.findall(r"\(([^()]+)\)", wkt)]


def test_polygons_hold_the_cells_that_they_came_from(spark):
    cells, df = image(spark, 5, 24, [1, 1, 0, 2, 1])
    found = outlines.polygons(df.where("r is not null"), block=8).collect()
    areas = {}
    for (t, r, c), label in flood(cells).items():
        areas.setdefault((t, *label), []).append((r, c))
    assert {(p.tile, p.r, p.c): p.area for p in found} == {k: float(len(v)) for k, v in areas.items()}
    edges = []
    for p in found:
        rings = parsed(p.wkt)
        assert len(rings) == p.holes + 1
        for ring in rings:
            assert ring[0] == ring[-1] and all((a == c) != (b == d) for (a, b), (c, d) in zip(ring, ring[1:], strict=False))
            edges += [(p.tile, p.r, p.c, float(a), float(b), float(c), float(d)) for (a, b), (c, d) in zip(ring, ring[1:], strict=False)]
    inside = cells_inside(spark.createDataFrame(edges, "tile int, lr int, lc int, x0 double, y0 double, x1 double, y1 double"), ["tile", "lr", "lc"])
    back = {}
    for x in inside.collect():
        back.setdefault((x.tile, x.lr, x.lc), []).append((x.r, x.c))
    assert {k: sorted(v) for k, v in back.items()} == {k: sorted(v) for k, v in areas.items()}


def test_small_rings_and_tolerance(spark):
    rows = [(1, r, c, 1) for r in range(20) for c in range(20) if not (r == 5 and c == 5) and not (8 <= r < 12 and 8 <= c < 12) and r + c < 30] + [(1, 40, 40, 3)]
    df = spark.createDataFrame(rows, "tile int, r int, c int, v int")
    whole = {r.value: r for r in outlines.polygons(df).collect()}
    assert whole[1].holes == 2 and whole[3].area == 1 and whole[1].area == len(rows) - 1
    few = outlines.polygons(df, least_area=2, tolerance=1.0).collect()
    assert len(few) == 1 and few[0].holes == 1 and few[0].area == len(rows) - 1 + 1
    assert len(parsed(few[0].wkt)[0]) < len(parsed(whole[1].wkt)[0])
    assert outlines.polygons(df.where("false")).collect() == []


def test_simplified_keeps_within_the_tolerance():
    stairs = [[0, 0], [10, 0]] + [p for k in range(10) for p in ([10 - k, k + 1], [9 - k, k + 1])][:-1]
    assert outlines.simplified(stairs, 0.9) == [[0, 0], [10, 0], [1, 10]] or len(outlines.simplified(stairs, 0.9)) <= 4
    assert outlines.simplified([[0, 0], [1, 0], [1, 1], [0, 1]], 9) == [[0, 0], [1, 0], [1, 1], [0, 1]]
    assert outlines.simplified(stairs, 0.1) == stairs
