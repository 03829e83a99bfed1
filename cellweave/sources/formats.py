"""Reading names, pages, metadata and headers into columns."""

from __future__ import annotations

import io
import zipfile
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

PAGE = """value ARRAY<STRUCT<Id: STRING, Name: STRING, S3Path: STRING, ContentLength: BIGINT, Online: BOOLEAN, ContentDate: STRUCT<Start: TIMESTAMP, `End`: TIMESTAMP>>>, `@odata.nextLink` STRING"""
LINEAGE = "series ARRAY<STRUCT<seriesMetadata: STRUCT<title: STRING, date: STRING>>>"
SCENE = "zs DOUBLE, snow DOUBLE, cloud DOUBLE"


def name_parts(name: Column) -> dict[str, Column]:
    """Parts of a product name TYPE_timestamp_mission_tile_version_mode; null where it has fewer."""
    p = F.split(name, "_")
    return {
        "kind": F.get(p, F.lit(0)), "time": F.try_to_timestamp(F.get(p, F.lit(1)), F.lit("yyyyMMdd'T'HHmmss")), "mission": F.get(p, F.lit(2)),
        "tile": F.regexp_replace(F.get(p, F.lit(3)), "^T(?=[0-9]{2}[A-Z]{3}$)", ""), "version": F.get(p, F.lit(4)), "mode": F.get(p, F.lit(5)),
    }


def platform(path: Column) -> Column:
    """The kind of a scene by what its path holds, the first that fits."""
    return (
        F.when(path.contains("S2") & path.contains("L2A"), "sen2cor").when(path.rlike("SENTINEL2[AB]"), "sentinel-2")
        .when(path.contains("Take5"), "take5").when(path.contains("LANDSAT8"), "landsat-8").otherwise("unknown")
    )


def catalogue_pages(pages: DataFrame, text: str = "page") -> DataFrame:
    """Products of catalogue pages in JSON: name, path, start, day, size; a page that does not parse gives none."""
    page = F.from_json(text, PAGE)
    item = pages.select(F.explode(page["value"]).alias("p")).select("p.*")
    start = F.col("ContentDate.Start")
    return item.select(F.col("Name").alias("name"), F.col("S3Path").alias("input_path"), start.alias("date"), F.date_format(start, "yyyyMMdd").cast("bigint").alias("measurement_day"), F.col("ContentLength").alias("size"), F.col("Online").alias("online"))


def catalogue_filter(items: DataFrame, contains: str, since: str, until: str, box: tuple[float, float, float, float], top: int, skip: int = 0) -> DataFrame:
    """What a search of the catalogue gives: entries whose name holds a text, that start from since on and before until,
    and whose footprint (x0, y0, x1, y1) meets the box; top of them after skip, in order of start, name and id, so that
    entries of one name and start make no search differ from another. The filters are plain columns, so a table of entries
    is pruned by them."""
    x0, y0, x1, y1 = box
    some = items.where(F.col("name").contains(contains) & (F.col("date") >= F.lit(since).cast("timestamp")) & (F.col("date") < F.lit(until).cast("timestamp")))
    return some.where(f"x0 < {x1} and x1 > {x0} and y0 < {y1} and y1 > {y0}").orderBy("date", "name", "id").offset(skip).limit(top)


def read_catalogue_pages(spark: SparkSession, folder: str) -> DataFrame:
    return catalogue_pages(spark.read.text(folder, wholetext=True).withColumnRenamed("value", "page"))


def lineage(df: DataFrame, xml: str, *keys: str) -> DataFrame:
    """One row for each input that a product's metadata lists, each title once."""
    got = df.select(*keys, F.explode(F.from_xml(xml, F.lit(LINEAGE))["series"]).alias("s"))
    return got.select(*keys, F.col("s.seriesMetadata.title").alias("title")).dropDuplicates([*keys, "title"])


def scene_metadata(df: DataFrame, xml: str, *keys: str) -> DataFrame:
    return df.select(*keys, F.from_xml(xml, F.lit(SCENE)).alias("m")).select(*keys, "m.*")


def reference_candidates(scenes: DataFrame, snow: tuple[float, float], cloud: tuple[float, float]) -> DataFrame:
    return scenes.where(F.col("snow").between(*snow) & F.col("cloud").between(*cloud))


def header_values(df: DataFrame, text: str, *names: str) -> DataFrame:
    """Numbers after NAME= in a header's text."""
    return df.select("*", *[F.regexp_extract(text, rf"{n}=(-?[0-9]+(?:\.[0-9]+)?)", 1).try_cast("double").alias(n.lower()) for n in names])


def availability(catalogue: DataFrame, ready: DataFrame, downloaded: DataFrame, key: str) -> DataFrame:
    """The catalogue with what each entry still needs."""
    a = ready.select(key).distinct().withColumn("_r", F.lit(True))
    b = downloaded.select(key).distinct().withColumn("_d", F.lit(True))
    x = catalogue.join(a, key, "left").join(b, key, "left")
    return x.withColumn("status", F.when(F.col("_r"), "available").when(F.col("_d"), "needs processing").otherwise("needs download")).drop("_r", "_d")


def assemble_takes(slices: DataFrame, today: str) -> DataFrame:
    """Radar takes from their slices in order of start: time range, reference system, kind of orbit file."""
    s = slices.groupBy("take").agg(
        F.min("start").alias("start"), F.max("stop").alias("stop"), F.min("zone").alias("zone"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("start", "name"))), lambda x: x["name"]), ",").alias("slices"),
    )
    old = F.datediff(F.to_date(F.lit(today)), F.to_date("start")) > 22
    return s.select("take", "start", "stop", (F.col("zone") + 32600).alias("epsg"), F.when(old, "Precise").otherwise("Restituted").alias("orbit"), "slices")


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path).select(F.trim("value").alias("line")).where("line <> ''")


def read_objects(spark: SparkSession, folder: str, pattern: str) -> DataFrame:
    """Paths, sizes and times of files under a prefix whose names match; contents are not read."""
    return spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", "true").load(folder).select("path", "length", "modificationTime")


def unzip_members(spark: SparkSession, folder: str, suffix: str) -> DataFrame:
    """path, name, content of the zip members with a suffix; a file that is no zip gives none."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for path, content in zip(pdf["path"], pdf["content"], strict=True):
                try:
                    z = zipfile.ZipFile(io.BytesIO(content))
                except zipfile.BadZipFile:
                    continue
                for n in z.namelist():
                    if n.endswith(suffix):
                        yield pd.DataFrame({"path": [path], "name": [n], "content": [z.read(n)]})

    zips = spark.read.format("binaryFile").option("pathGlobFilter", "*.zip").option("recursiveFileLookup", "true").load(folder)
    return zips.select("path", "content").mapInPandas(run, "path string, name string, content binary")


def blocks_to_cells(blocks: DataFrame, *bands: str) -> DataFrame:
    """Cells of blocks that hold each band as an array by rows: block row and column, height, width."""
    pos = F.posexplode(F.arrays_zip(*bands))
    x = blocks.select("tile", "brow", "bcol", "h", "w", pos)
    r, c = F.expr("cast(brow * h + pos div w as int)"), F.expr("cast(bcol * w + pos % w as int)")
    return x.select("tile", r.alias("r"), c.alias("c"), *[F.col(f"col.{b}").alias(b) for b in bands])


def cells_to_blocks(cells: DataFrame, h: int, w: int, *bands: str) -> DataFrame:
    """The reverse; cells that a block lacks are null there."""
    at = F.expr(f"cast((r % {h}) * {w} + c % {w} as int)")
    g = cells.groupBy("tile", F.expr(f"cast(r div {h} as int)").alias("brow"), F.expr(f"cast(c div {w} as int)").alias("bcol"))
    s = g.agg(F.map_from_entries(F.collect_list(F.struct(at, F.struct(*bands)))).alias("x"))  # h * w entries at most
    places = F.sequence(F.lit(0), F.lit(h * w - 1))
    all_ = s.select("tile", "brow", "bcol", F.transform(places, lambda i: F.try_element_at("x", i)).alias("x"))
    return all_.select("tile", "brow", "bcol", F.lit(h).alias("h"), F.lit(w).alias("w"), *[F.col(f"x.{b}").alias(b) for b in bands])
