"""Cells inside polygons with holes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def cells_inside(edges: DataFrame, by: list[str]) -> DataFrame:
    """Cells whose centre lies inside a polygon, from its edges (x0, y0, x1, y1) of all rings, holes and parts included.

    Each edge gives its crossing of every row of cell centres that it spans; crossings of a row in order of x open and
    close the inside in turn (even-odd). So work follows the outline, and a row's crossings are the largest group.
    """
    span = F.expr("sequence(cast(ceil(least(y0, y1) - 0.5) as int), cast(ceil(greatest(y0, y1) - 0.5) as int) - 1)")
    some = edges.where("ceil(greatest(y0, y1) - 0.5) > ceil(least(y0, y1) - 0.5)").select("*", F.explode(span).alias("r"))
    cross = some.select(*by, "r", F.expr("x0 + (r + 0.5 - y0) * (x1 - x0) / (y1 - y0)").alias("x"))
    rows = cross.groupBy(*by, "r").agg(F.array_sort(F.collect_list("x")).alias("xs"))
    pairs = rows.select(*by, "r", F.explode(F.expr("transform(sequence(0, size(xs) div 2 - 1), k -> struct(xs[2 * k] as a, xs[2 * k + 1] as b))")).alias("seg"))
    inside = pairs.where("ceil(seg.b - 0.5) > ceil(seg.a - 0.5)")
    return inside.select(*by, "r", F.explode(F.expr("sequence(cast(ceil(seg.a - 0.5) as int), cast(ceil(seg.b - 0.5) as int) - 1)")).alias("c"))
