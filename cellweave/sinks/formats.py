"""Writing cells, catalogue entries, metadata and shapes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def write_cells(df: DataFrame, path: str, mode: str = "append", by: tuple[str, ...] = ("tile", "d")) -> None:
    """Parquet by tile and day (or other columns), one sorted run a partition, so that scans prune by both."""
    df.repartition(*by).sortWithinPartitions(*by, "r", "c").write.mode(mode).partitionBy(*by).parquet(path)


def catalogue_entry(name: Column, size: Column, start: Column, stop: Column, cloud: Column, extent: Column) -> Column:
    return F.to_json(F.struct(name.alias("name"), size.alias("size"), start.alias("start"), stop.alias("stop"), cloud.alias("cloud_cover"), extent.alias("extent")))


def scene_xml(line: Column, snow: Column, cloud: Column) -> Column:
    return F.to_xml(F.struct(line.alias("zs"), snow.alias("snow"), cloud.alias("cloud")), {"rowTag": "scene"})


def lineage_xml(df: DataFrame, by: list[str], title: str) -> DataFrame:
    """One document for each product that lists its inputs, each once and in order; titles may hold any characters."""
    series = F.transform(F.array_sort(F.collect_set(title)), lambda t: F.struct(F.struct(t.alias("title")).alias("seriesMetadata")))
    return df.groupBy(*by).agg(series.alias("series")).select(*by, F.to_xml(F.struct("series"), {"rowTag": "lineage"}).alias("xml"))


def merge_features(old: DataFrame, new: DataFrame) -> DataFrame:
    """Rows of both with the fields of either."""
    return old.unionByName(new, allowMissingColumns=True)


def bounding_boxes(labels: DataFrame, by: list[str]) -> DataFrame:
    """The bounding polygon and size of each labelled area, as text."""
    g = labels.groupBy(*by).agg(F.min("r").alias("r0"), F.max("r").alias("r1"), F.min("c").alias("c0"), F.max("c").alias("c1"), F.count("*").alias("cells"))
    wkt = F.format_string("POLYGON((%d %d,%d %d,%d %d,%d %d,%d %d))", "c0", "r0", F.col("c1") + 1, "r0", F.col("c1") + 1, F.col("r1") + 1, "c0", F.col("r1") + 1, "c0", "r0")
    return g.select(*by, "cells", wkt.alias("wkt"))


def row_extremes(cells: DataFrame, valid: Column) -> DataFrame:
    """Leftmost and rightmost valid cell of each row: all that a hull of the valid area needs."""
    return cells.where(valid).groupBy("tile", "r").agg(F.min("c").alias("c0"), F.max("c").alias("c1"))


def job_spec(template: str, **columns: Column) -> Column:
    """The template with {name} replaced by each column."""
    out = F.lit(template)
    for k, x in columns.items():
        out = F.replace(out, F.lit("{" + k + "}"), x.cast("string"))
    return out


def plan_json(**fields: Column) -> Column:
    """A plan's row as JSON, with the fields given in their order; null fields are left out."""
    return F.to_json(F.struct(*[x.alias(n) for n, x in fields.items()]))


def append_batch(df: DataFrame, path: str, name: str) -> None:
    """Adds a batch to a table of batches under its name. A batch that is written again takes its own place, so a retry
    leaves nothing twice."""
    df.write.mode("overwrite").parquet(f"{path}/batch={name}")
